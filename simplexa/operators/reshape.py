"""Wide to long and back.

Long is the working form.  Wide tables exist for export: their columns are
listed by one bounded job, because a column set has to be known to be named.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType

from simplexa.names import FEATURE, LINEAGE_LEVELS, SAMPLE, VALUE
from simplexa.operators.joins import not_broadcast
from simplexa.operators.ordered import positions
from simplexa.sources.shared import stored

MAX_WIDE_COLUMNS = 10_000
# Columns of a table without that limit which share an array.
BLOCK_COLUMNS = 2_000


class WideBlocks(NamedTuple):
    """A wide table of any number of columns, which are cut into blocks in name order."""

    rows: DataFrame
    """The index, ``_block``, and ``_cells``: an array with a number per column of the block."""
    columns: DataFrame
    """``_name``, ``_block`` and the 0-based place ``_at`` in it."""


def sample_columns(
    columns: Sequence[str],
    item: str,
    prefix: str | None = None,
    exclude: Sequence[str] | None = None,
) -> list[str]:
    """Which columns hold samples: by prefix, else by exclusion, else the rest."""
    if prefix:
        return [c for c in columns if c.startswith(prefix)]
    rest = [c for c in columns if c != item and c not in LINEAGE_LEVELS]
    if exclude:
        return [c for c in rest if c not in exclude]
    if not rest:
        raise ValueError("no sample columns found")
    return rest


def to_long(
    wide: DataFrame | WideBlocks,
    ids: Sequence[str] | str,
    columns: Sequence[str] | None = None,
    name: str = SAMPLE,
    value: str = VALUE,
) -> DataFrame:
    """Unpivot; cells become doubles so that mixed integer columns agree."""
    ids = [ids] if isinstance(ids, str) else list(ids)
    if isinstance(wide, WideBlocks):
        names = wide.columns if columns is None else wide.columns.filter(F.col("_name").isin(list(columns)))
        cells = wide.rows.select(*ids, "_block", F.posexplode("_cells").alias("_at", value))
        return cells.join(not_broadcast(names), ["_block", "_at"]).select(
            *ids, F.col("_name").alias(name), value
        )
    columns = list(columns) if columns is not None else [c for c in wide.columns if c not in ids]
    cast = wide.select(
        *[F.col(f"`{c}`") for c in ids],
        *[F.col(f"`{c}`").cast("double").alias(c) for c in columns],
    )
    return cast.unpivot(
        [F.col(f"`{c}`") for c in ids], [F.col(f"`{c}`") for c in columns], name, value
    )


def _names(df: DataFrame, column: str) -> list[str]:
    rows = df.select(column).distinct().orderBy(column).limit(MAX_WIDE_COLUMNS + 1).collect()
    if len(rows) > MAX_WIDE_COLUMNS:
        raise ValueError(
            f"more than {MAX_WIDE_COLUMNS} distinct {column} values; keep the table long"
        )
    return [r[0] for r in rows]


def to_wide(
    long: DataFrame,
    index: str,
    columns: str,
    value: str = VALUE,
    names: Sequence[str] | None = None,
) -> DataFrame:
    """Pivot, summing duplicates and filling gaps with zero."""
    names = list(names) if names is not None else _names(long, columns)
    return long.groupBy(index).pivot(columns, names).agg(F.sum(value)).na.fill(0.0)


@F.pandas_udf(ArrayType(DoubleType()))
def _placed(at: pd.Series, values: pd.Series, width: pd.Series) -> pd.Series:
    out = []
    for places, x, d in zip(at, values, width):
        row = np.zeros(int(d))
        if places is not None and len(places):
            row[np.asarray(places)] = x
        out.append(row)
    return pd.Series(out)


def to_wide_blocks(
    long: DataFrame, index: str, columns: str, value: str = VALUE, block: int = BLOCK_COLUMNS
) -> WideBlocks:
    """The table of ``to_wide`` with any number of columns, as arrays; duplicates added up, gaps zero."""
    # A pivot names its column of nulls so.
    named = long.withColumn("_name", F.coalesce(F.col(columns).cast("string"), F.lit("null")))
    sums = stored(named.groupBy(index, "_name").agg(F.sum(value).cast("double").alias("_x")), "cells")
    at = F.col("_at") - 1
    names = positions(sums.select("_name").distinct(), [], ["_name"], "_at").select(
        "_name", F.floor(at / block).cast("int").alias("_block"), (at % block).cast("int").alias("_at")
    )
    names = stored(names, "names")
    widths = names.groupBy("_block").agg(F.count(F.lit(1)).cast("int").alias("_width"))
    gathered = (
        sums.filter(F.col("_x").isNotNull() & ~F.isnan("_x"))
        .join(not_broadcast(names), "_name")
        .groupBy(F.col(index).alias("_index"), F.col("_block").alias("_of"))
        .agg(F.collect_list(F.struct("_at", "_x")).alias("_stored"))
    )
    every = sums.select(index).distinct().crossJoin(F.broadcast(widths))
    full = every.join(
        not_broadcast(gathered), F.col(index).eqNullSafe(F.col("_index")) & (F.col("_block") == F.col("_of")), "left"
    )
    return WideBlocks(
        full.select(index, "_block", _placed("_stored._at", "_stored._x", "_width").alias("_cells")), names
    )


def wide_or_blocks(long: DataFrame, index: str, columns: str, value: str = VALUE) -> DataFrame | WideBlocks:
    """A wide table where its columns can be columns, else its blocks."""
    picked = long.select(columns).distinct().limit(MAX_WIDE_COLUMNS + 1).count()
    if picked > MAX_WIDE_COLUMNS:
        return to_wide_blocks(long, index, columns, value)
    return to_wide(long, index, columns, value)


def samples_by_features(long: DataFrame, names: Sequence[str] | None = None) -> DataFrame:
    return to_wide(long, SAMPLE, FEATURE, VALUE, names)


def features_by_samples(long: DataFrame, names: Sequence[str] | None = None) -> DataFrame:
    return to_wide(long, FEATURE, SAMPLE, VALUE, names)


def transpose(wide: DataFrame, index: str, new_index: str, names: Sequence[str] | None = None) -> DataFrame:
    """Swap rows and columns of a wide table."""
    long = to_long(wide, index, name=new_index, value="_cell")
    return to_wide(long, new_index, index, "_cell", names)


def absent_cells(
    cells: DataFrame,
    samples: DataFrame,
    features: DataFrame,
    sample: str = SAMPLE,
    feature: str = FEATURE,
    chunk: int = 1024,
    spread: int = 64,
) -> DataFrame:
    """The (sample, feature) pairs without a stored cell, with the columns of
    ``samples`` (one row each) attached.

    Features are hashed into arrays of about ``chunk`` names.  Per sample and
    array the stored names are gathered and taken away from the full array, so
    only stored cells are shuffled and the absent ones are unpacked in place.
    The packed names meet the samples on (array, sample hash), which spreads an
    array over many tasks.  ``cells`` has one row per pair.
    """
    n_chunks = F.greatest(
        F.lit(1), F.ceil(features.agg(F.count(F.lit(1))).scalar() / chunk).cast("int")
    )

    def chunk_of(column):
        return F.pmod(F.xxhash64(column), n_chunks).cast("int").alias("_chunk")

    packed = (
        features.select(feature, chunk_of(feature))
        .groupBy("_chunk")
        .agg(F.collect_list(feature).alias("_names"))
        .withColumn("_spread", F.explode(F.sequence(F.lit(0), F.lit(spread - 1))))
    )
    stored_names = (
        cells.select(sample, feature, chunk_of(feature))
        .groupBy(sample, "_chunk")
        .agg(F.collect_list(feature).alias("_stored"))
    )
    every = samples.withColumn("_chunk", F.explode(F.sequence(F.lit(0), n_chunks - 1)))
    return (
        every.join(stored_names, [sample, "_chunk"], "left")
        .withColumn("_spread", F.pmod(F.xxhash64(sample), F.lit(spread)).cast("int"))
        .join(packed, ["_chunk", "_spread"])
        .withColumn(
            feature,
            F.explode(F.array_except("_names", F.coalesce("_stored", F.array().cast("array<string>")))),
        )
        .select(*samples.columns, feature)
    )


def complete_zeros(long: DataFrame, sample: str = SAMPLE, feature: str = FEATURE, value: str = VALUE) -> DataFrame:
    """One row per (sample, feature), absent cells as zero.

    The result has samples x features rows by definition; operators that can
    work on the stored cells alone do not use it.
    """
    cells = stored(
        long.groupBy(sample, feature).agg(F.sum(value).cast("double").alias(value)), "cells"
    )
    absent = absent_cells(
        cells, cells.select(sample).distinct(), cells.select(feature).distinct(), sample, feature
    )
    present = cells.select(sample, feature, F.coalesce(F.col(value), F.lit(0.0)).alias(value))
    return present.unionByName(absent.withColumn(value, F.lit(0.0)))
