"""Ordered computations inside groups of any size.

A window over ``partitionBy(key)`` puts a whole key into one task.  Here large
keys are first cut into slices of about ``slice_rows`` rows, at cut points picked
by a hash of the rows themselves.  Windows then run inside one slice, and a short
table of per-slice totals carries the running value from slice to slice.

The input is read several times, so it is written once to the shared folder; the
cut points are then a cheap scan of its order columns.  Finding none is also the
size check: a key of n rows stays uncut with probability exp(-n / slice_rows), so
a table without cut points has only small keys and takes the plain window.

There is one cut point per ``slice_rows`` rows on average.  Cut points are
broadcast, so they are counted first, and beyond ``MOST_CUTS`` slices grow instead.
A row finds its slice by halving the sorted cut points of its key.  Carried totals
meet the rows on the slice, by which both are dealt already.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from simplexa.sources.shared import stored

SLICE_ROWS = 1 << 20
# Cut points that are broadcast, at most.
MOST_CUTS = 1 << 19

_EVERYTHING = "_everything"
_HELPERS = ("_slice", "_cut", "_before", "_whole", "_local", "_slice_total", "_order", _EVERYTHING)


class Slices(NamedTuple):
    rows: DataFrame
    keys: list[str]
    cut: bool

    @property
    def block(self) -> list[str]:
        """Columns that name one slice."""
        return [*self.keys, "_slice"] if self.cut else self.keys


def slice_by_order(
    df: DataFrame, keys: Sequence[str], order: str, slice_rows: int = SLICE_ROWS,
    store: bool = True,
) -> Slices:
    """Store the table and cut its large keys into slices of the ``order``.

    Without keys the whole table is one group.  Equal values of ``order`` share
    a slice, so callers pre-aggregate ties or order by something unique.  Cut
    rows carry ``_slice`` and ``_cut``, the latter true if the key has several.
    ``store=False`` is for a table that is stored already or cheap to build.
    """
    rows = stored(df, "ordered") if store else df
    if not keys:
        keys, rows = [_EVERYTHING], rows.withColumn(_EVERYTHING, F.lit(0))
    keys = list(keys)
    hashed = [k for k in keys if k != _EVERYTHING]
    place = F.xxhash64(*hashed, order)
    picked = rows.filter(F.pmod(place, F.lit(slice_rows)) == 0).select(*keys, order).distinct()
    count = picked.count()
    if not count:
        return Slices(rows, keys, False)
    if count > MOST_CUTS:
        # Of these a share that a part of the same hash picks.
        picked = picked.filter(
            F.pmod(F.floor(place / slice_rows), F.lit(-(-count // MOST_CUTS))) == 0
        )
    cuts = picked.groupBy(*keys).agg(F.sort_array(F.collect_list(order)).alias("_cuts"))
    below = _cuts_below("_cuts", order, min(count, 2 * MOST_CUTS))
    placed = (
        rows.join(F.broadcast(cuts), keys, "left")
        .withColumn("_slice", F.when(F.col("_cuts").isNull(), 0).otherwise(below))
        .withColumn("_cut", F.col("_cuts").isNotNull())
        .drop("_cuts")
        # Without this a layout by key alone would satisfy the windows.
        .repartition(*keys, "_slice")
    )
    return Slices(placed, keys, True)


def _cuts_below(cuts: str, order: str, most: int):
    """How many of the sorted cut points, `most` or fewer, are below the row."""
    steps = F.array(*(F.lit(1 << i) for i in reversed(range(max(1, most.bit_length())))))

    def halved(passed, step):
        cut = F.get(F.col(cuts), passed + step - 1)
        return F.when(cut.isNotNull() & (cut < F.col(order)), passed + step).otherwise(passed)

    return F.aggregate(steps, F.lit(0), halved)


def carry(rows: DataFrame, slices: Slices, weight) -> DataFrame:
    """Add ``_before``, the weight in earlier slices of the key, and ``_whole``,
    the weight of the key, null where the key is one slice."""
    if not slices.cut:
        return rows.withColumns({"_before": F.lit(0), "_whole": F.lit(None).cast("bigint")})
    sums = slices.rows.filter("_cut").groupBy(*slices.block).agg(F.sum(weight).alias("_here"))
    whole = Window.partitionBy(*slices.keys)
    earlier = whole.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    totals = sums.select(
        *slices.block,
        F.sum("_here").over(earlier).alias("_before"),
        F.sum("_here").over(whole).alias("_whole"),
    )
    carried = rows.join(totals, slices.block, "left")
    return carried.withColumn("_before", F.coalesce("_before", F.lit(0)))


def running_counts(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    weight: str,
    slice_rows: int = SLICE_ROWS,
    store: bool = True,
) -> DataFrame:
    """Add ``_cum``, ``_ties`` and ``_total``: the weight at or below the value,
    at the value, and in the whole key.

    Rows should be pre-aggregated: few rows may share a key and value.
    ``store=False`` is for a table that is stored already.
    """
    slices = slice_by_order(df, keys, value, slice_rows, store)
    within = Window.partitionBy(*slices.block)
    upto = within.orderBy(value).rangeBetween(Window.unboundedPreceding, Window.currentRow)
    tied = Window.partitionBy(*slices.block, value)
    counted = slices.rows.select(
        "*",
        F.sum(weight).over(upto).alias("_local"),
        F.sum(weight).over(within).alias("_slice_total"),
        F.sum(weight).over(tied).alias("_ties"),
    )
    return (
        carry(counted, slices, F.col(weight))
        .withColumn("_cum", F.col("_local") + F.col("_before"))
        .withColumn("_total", F.coalesce("_whole", "_slice_total"))
        .drop(*_HELPERS)
    )


def positions(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    name: str = "position",
    slice_rows: int = SLICE_ROWS,
    store: bool = True,
) -> DataFrame:
    """Number the rows 1, 2, ... per key in the order of the unique ``order``.

    ``store=False`` is for a table that is cheap to build again.
    """
    df = df.withColumn("_order", F.struct(*order) if len(order) > 1 else F.col(order[0]))
    slices = slice_by_order(df, keys, "_order", slice_rows, store)
    local = F.row_number().over(Window.partitionBy(*slices.block).orderBy("_order"))
    numbered = carry(slices.rows.withColumn("_local", local), slices, F.lit(1))
    return numbered.withColumn(name, F.col("_local") + F.col("_before")).drop(*_HELPERS)


def value_counts(df: DataFrame, columns: Sequence[str], name: str = "_n") -> DataFrame:
    """Distinct rows with their number, combined before the shuffle."""
    return df.groupBy(*columns).agg(F.count(F.lit(1)).alias(name))


def midranks(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    extra: Sequence[str] = (),
    slice_rows: int = SLICE_ROWS,
    weight: str | None = None,
) -> DataFrame:
    """Tie-averaged rank of each distinct value inside its key.

    Returns distinct (keys, value, extra) rows with ``n`` rows behind each,
    ``ties`` rows at the value, ``total`` rows in the key, and ``midrank``.
    Missing values take no rank.  ``weight`` names the number of rows that each
    input row stands for.
    """
    present = df.filter(F.col(value).isNotNull() & ~F.isnan(F.col(value).cast("double")))
    rows = F.count(F.lit(1)) if weight is None else F.sum(weight)
    counts = present.groupBy(*keys, value, *extra).agg(rows.alias("n"))
    ranked = running_counts(counts, keys, value, "n", slice_rows)
    return ranked.select(
        *keys,
        value,
        *extra,
        "n",
        F.col("_ties").alias("ties"),
        F.col("_total").alias("total"),
        (F.col("_cum") - (F.col("_ties") - 1) / 2).alias("midrank"),
    )


def exact_quantiles(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    probabilities: dict[str, float],
    slice_rows: int = SLICE_ROWS,
) -> DataFrame:
    """Linearly interpolated quantiles, one column per named probability."""
    present = df.filter(F.col(value).isNotNull() & ~F.isnan(F.col(value).cast("double")))
    counts = value_counts(present, [*keys, value])
    ranked = running_counts(counts, keys, value, "_n", slice_rows)
    first, last = F.col("_cum") - F.col("_n"), F.col("_cum") - 1

    def at(place):
        return F.max(F.when((first <= place) & (place <= last), F.col(value).cast("double")))

    picks = []
    for name, p in probabilities.items():
        place = (F.col("_total") - 1) * F.lit(float(p))
        picks += [
            at(F.floor(place)).alias(f"_lo_{name}"),
            at(F.ceil(place)).alias(f"_hi_{name}"),
            F.max(place - F.floor(place)).alias(f"_part_{name}"),
        ]
    grouped = ranked.groupBy(*keys).agg(*picks)
    return grouped.select(
        *keys,
        *[
            (
                F.col(f"_lo_{name}")
                + (F.col(f"_hi_{name}") - F.col(f"_lo_{name}")) * F.col(f"_part_{name}")
            ).alias(name)
            for name in probabilities
        ],
    )
