"""Zero replacement and centred log-ratio (CLR), kept sparse.

After zero replacement every absent cell of a sample has the same CLR value, so
the transform is stored as the CLR of the present cells plus one ``baseline``
per sample.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from simplexa.names import FEATURE, SAMPLE, VALUE
from simplexa.operators.reshape import absent_cells
from simplexa.sources.shared import stored


class SparseClr(NamedTuple):
    cells: DataFrame
    """Sample, FeatureID, clr for the cells above zero."""
    baseline: DataFrame
    """Sample, baseline: the CLR of that sample's absent cells."""
    features: DataFrame
    """Distinct FeatureID, including features that are zero everywhere."""


def cell_totals(long: DataFrame, unique: bool = False) -> DataFrame:
    """One row per (sample, feature), duplicates added up.

    ``unique`` promises that there are none, which saves the shuffle.
    """
    if unique:
        return long.select(SAMPLE, FEATURE, F.col(VALUE).cast("double").alias(VALUE))
    return long.groupBy(SAMPLE, FEATURE).agg(F.sum(VALUE).cast("double").alias(VALUE))


def sample_constants(cells: DataFrame, features: DataFrame) -> DataFrame:
    """Per sample: total, cells above zero, replaced share and mean log."""
    present = F.when(F.col(VALUE) > 0, F.col(VALUE))
    sums = cells.groupBy(SAMPLE).agg(
        F.sum(present).alias("total"),
        F.count(present).alias("nnz"),
        F.sum(F.ln(present)).alias("log_sum"),
    )
    width = features.agg(F.count(F.lit(1)).cast("double")).scalar()
    sums = sums.withColumn("width", width)
    d = F.col("width")
    delta = 1.0 / (d * d)
    zeros = d - F.col("nnz")
    shrink = F.ln(1.0 - zeros * delta)
    scale = shrink - F.ln("total")
    mean_log = (F.col("log_sum") + F.col("nnz") * scale + zeros * F.ln(delta)) / d
    usable = (d > 1) & (F.col("nnz") > 0)
    return sums.select(
        SAMPLE,
        "total",
        "nnz",
        "width",
        delta.alias("delta"),
        (1.0 - zeros * delta).alias("kept_share"),
        F.when(usable, scale - mean_log).alias("shift"),
        F.when(usable, F.ln(delta) - mean_log).otherwise(0.0).alias("baseline"),
    )


def replace_zeros(long: DataFrame) -> DataFrame:
    """Closed and zero-replaced proportions of every (sample, feature).

    Zeros become (1/D)^2 and the rest shrink so that a sample still adds to 1.
    An all-zero sample has no proportions and is left out.
    """
    cells = stored(cell_totals(long), "cells")
    features = cells.select(FEATURE).distinct()
    constants = sample_constants(cells, features).filter(F.col("nnz") > 0)
    present = (
        cells.filter(F.col(VALUE) > 0)
        .join(constants, SAMPLE)
        .select(
            SAMPLE, FEATURE,
            (F.col(VALUE) / F.col("total") * F.col("kept_share")).alias("proportion"),
        )
    )
    absent = absent_cells(
        present, constants.select(SAMPLE, F.col("delta").alias("proportion")), features
    )
    return present.unionByName(absent)


def clr(long: DataFrame, features: DataFrame | None = None, unique: bool = False) -> SparseClr:
    """CLR of a long count table.

    ``features`` fixes the column set; by default it is every feature of the
    table.  A single feature or an all-zero sample has CLR 0.  The added-up cells
    are stored first, as the per-sample constants and the cells both need them;
    ``unique`` is for a stored table with one row per cell and skips that.
    """
    cells = cell_totals(long, unique)
    if not unique:
        cells = stored(cells, "cells")
    names = (cells if features is None else features).select(FEATURE).distinct()
    constants = sample_constants(cells, names)
    present = (
        cells.filter(F.col(VALUE) > 0)
        .join(constants.select(SAMPLE, "shift"), SAMPLE)
        .select(
            SAMPLE, FEATURE,
            F.coalesce(F.ln(VALUE) + F.col("shift"), F.lit(0.0)).alias("clr"),
        )
    )
    return SparseClr(present, constants.select(SAMPLE, "baseline"), names)


def dense(table: SparseClr, value: str = VALUE) -> DataFrame:
    """Every (sample, feature) cell: samples x features rows by definition."""
    absent = absent_cells(table.cells, table.baseline, table.features)
    return table.cells.select(SAMPLE, FEATURE, F.col("clr").alias(value)).unionByName(
        absent.select(SAMPLE, FEATURE, F.col("baseline").alias(value))
    )


def of_features(table: SparseClr, chosen: Column | DataFrame) -> SparseClr:
    """The table of some features: a condition on their names, or a frame of them."""
    if isinstance(chosen, DataFrame):
        names = chosen.select(FEATURE).distinct()
        return SparseClr(
            table.cells.join(names, FEATURE, "left_semi"), table.baseline,
            table.features.join(names, FEATURE, "left_semi"),
        )
    return SparseClr(table.cells.filter(chosen), table.baseline, table.features.filter(chosen))


def sparse_counts(long: DataFrame) -> SparseClr:
    """Counts as they are, in the sparse form: the cells, and zero as the baseline of every sample."""
    cells = stored(cell_totals(long), "cells")
    return SparseClr(
        cells.select(SAMPLE, FEATURE, F.coalesce(F.col(VALUE), F.lit(0.0)).alias("clr")),
        cells.select(SAMPLE).distinct().withColumn("baseline", F.lit(0.0)),
        cells.select(FEATURE).distinct(),
    )


def clr_sums(table: SparseClr) -> DataFrame:
    """Sum of all CLR values per sample; zero up to rounding."""
    width = table.features.agg(F.count(F.lit(1))).scalar()
    stored = table.cells.groupBy(SAMPLE).agg(
        F.sum("clr").alias("_sum"), F.count(F.lit(1)).alias("_stored")
    )
    return table.baseline.join(stored, SAMPLE, "left").select(
        SAMPLE,
        (
            F.coalesce("_sum", F.lit(0.0))
            + F.col("baseline") * (width - F.coalesce("_stored", F.lit(0)))
        ).alias("clr_sum"),
    )


def feature_variances(table: SparseClr) -> DataFrame:
    """Sample variance per feature over all samples, from the stored cells.

    With u = clr - baseline, which is zero where nothing is stored, a feature's
    values are baseline + u.
    """
    base = table.baseline.agg(
        F.struct(
            F.count(F.lit(1)).cast("double").alias("n"),
            F.avg("baseline").alias("mean"),
            F.var_pop("baseline").alias("spread"),
        )
    ).scalar()
    n, mean, spread = (base.getField(f) for f in ("n", "mean", "spread"))
    # Centred on the mean baseline, so that large offsets do not cancel.
    b, u = F.col("baseline") - mean, F.col("clr") - F.col("baseline")
    sums = (
        table.cells.join(table.baseline, SAMPLE)
        .groupBy(FEATURE)
        .agg(F.sum(u).alias("u_sum"), F.sum(u * (u + 2 * b)).alias("u_square"))
    )
    full = table.features.join(sums, FEATURE, "left").na.fill(0.0, ["u_sum", "u_square"])
    square = n * spread + F.col("u_square") - F.col("u_sum") * F.col("u_sum") / n
    return full.select(
        FEATURE, F.when(n > 1, F.greatest(square / (n - 1), F.lit(0.0))).alias("variance")
    )
