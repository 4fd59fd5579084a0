"""Count tables to function, trait and taxon profiles.

All inputs are long: ``counts(item, Sample, Value)``, ``copies(item, KO,
copy_num)``, ``trait_map(KO, trait)``, ``lineage(item, level...)``.  Only stored
positive cells take part, so cost follows the stored cells.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from simplexa.functions.expressions import ieee_divide, round_half_even
from simplexa.names import SAMPLE, VALUE
from simplexa.operators.filters import positive
from simplexa.operators.joins import fanout_join, not_broadcast
from simplexa.operators.taxonomy import unclassified
from simplexa.sources.shared import stored

ITEM = "ASV_ID"
FUNCTION = "KO"
COPIES = "copy_num"


def normalise_by_marker(
    counts: DataFrame,
    marker: DataFrame,
    item: str = ITEM,
    value: str = VALUE,
    marker_copies: str = "marker_copies",
    on_zero_marker: str = "keep",
    digits: int = 2,
) -> DataFrame:
    """Divide each count by its item's marker copies, rounded half to even.

    ``on_zero_marker='keep'`` lets x/0 become infinity and 0/0 NaN;
    ``'drop'`` removes items with zero copies.
    """
    if on_zero_marker == "drop":
        marker = marker.filter(F.col(marker_copies) != 0)
    elif on_zero_marker != "keep":
        raise ValueError("on_zero_marker must be 'keep' or 'drop'")
    joined = counts.join(marker.select(item, F.col(marker_copies).alias("_copies")), item)
    ratio = round_half_even(ieee_divide(value, "_copies"), digits)
    return joined.withColumn(value, ratio).drop("_copies")


def contributions(
    counts: DataFrame, copies: DataFrame, item: str = ITEM, value: str = VALUE,
    function: str = FUNCTION, copy_num: str = COPIES,
) -> DataFrame:
    """Every (item, sample, function) product of abundance and copies.

    The counts are stored, as the join first looks for hot items in them.  It is
    dealt by the rows of both sides, so what a task sorts, and then adds up by
    function and sample, stays bounded.
    """
    counts, copies = stored(positive(counts, value), "counts"), positive(copies, copy_num)
    joined = fanout_join(counts, copies, item, SAMPLE, rows=max(counts.count(), copies.count()))
    return joined.select(
        item, SAMPLE, function, (F.col(value) * F.col(copy_num)).alias("contribution")
    )


def function_profile(
    counts: DataFrame, copies: DataFrame, item: str = ITEM, value: str = VALUE,
    function: str = FUNCTION, copy_num: str = COPIES,
) -> DataFrame:
    """Sum of abundance x copies per (function, sample)."""
    return (
        contributions(counts, copies, item, value, function, copy_num)
        .groupBy(function, SAMPLE)
        .agg(F.sum("contribution").alias(value))
    )


def trait_copies(
    copies: DataFrame, trait_map: DataFrame, trait: str, item: str = ITEM,
    function: str = FUNCTION, copy_num: str = COPIES,
) -> DataFrame:
    """Copies per (item, trait): a function counts in full for each of its traits."""
    return (
        positive(copies, copy_num)
        .join(trait_map.select(function, trait), function)
        .groupBy(item, trait)
        .agg(F.sum(copy_num).alias(copy_num))
    )


def trait_profile(
    function_table: DataFrame, trait_map: DataFrame, trait: str,
    function: str = FUNCTION, value: str = VALUE,
) -> DataFrame:
    """Trait totals per sample from a function profile."""
    return (
        positive(function_table, value)
        .join(trait_map.select(function, trait), function)
        .groupBy(trait, SAMPLE)
        .agg(F.sum(value).alias(value))
    )


def trait_profile_direct(
    counts: DataFrame, copies: DataFrame, trait_map: DataFrame, trait: str,
    item: str = ITEM, value: str = VALUE, function: str = FUNCTION, copy_num: str = COPIES,
) -> DataFrame:
    """The same totals without the function-level table.

    Copies are added up per trait first, so the widest join carries items x
    traits instead of items x functions.
    """
    per_trait = trait_copies(copies, trait_map, trait, item, function, copy_num)
    counts = stored(positive(counts, value), "counts")
    joined = fanout_join(counts, per_trait, item, SAMPLE, rows=counts.count())
    return joined.groupBy(trait, SAMPLE).agg(
        F.sum(F.col(value) * F.col(copy_num)).alias(value)
    )


def taxon_abundance(
    counts: DataFrame, lineage: DataFrame, level: str, item: str = ITEM,
    value: str = VALUE, keep_unclassified: bool = False,
) -> DataFrame:
    """Positive abundance per (taxon, sample)."""
    named = positive(counts, value).join(not_broadcast(lineage.select(item, level)), item)
    totals = named.groupBy(level, SAMPLE).agg(F.sum(value).alias(value))
    return unclassified(totals, level, keep_unclassified)


def taxon_copies(
    copies: DataFrame, lineage: DataFrame, level: str, item: str = ITEM,
    function: str = FUNCTION, copy_num: str = COPIES,
) -> DataFrame:
    """Mean copies per (taxon, function), over the items that have the function."""
    mapped = positive(copies, copy_num).join(not_broadcast(lineage.select(item, level).distinct()), item)
    return mapped.groupBy(level, function).agg(F.avg(copy_num).alias(copy_num))


def stratify(
    abundance: DataFrame, taxon_function: DataFrame, trait_map: DataFrame, level: str,
    trait: str, value: str = VALUE, function: str = FUNCTION, copy_num: str = COPIES,
) -> DataFrame:
    """Taxon x trait x sample totals from the two per-taxon tables.

    Mean copies are added up per trait before the join.  Both sides then have
    unique (taxon, sample) and (taxon, trait) rows, so each joined row is a
    finished cell and nothing is aggregated afterwards.  Null taxa match.
    The abundances are stored, as the join first looks for hot taxa in them.
    """
    per_trait = (
        taxon_function.join(trait_map.select(function, trait), function)
        .groupBy(level, trait)
        .agg(F.sum(copy_num).alias(copy_num))
    )
    abundance = stored(abundance, "taxon-abundance")
    joined = fanout_join(abundance, per_trait, level, SAMPLE, null_safe=True, rows=abundance.count())
    return joined.select(level, trait, SAMPLE, (F.col(value) * F.col(copy_num)).alias(value))


def stratified_profile(
    counts: DataFrame, copies: DataFrame, lineage: DataFrame, trait_map: DataFrame,
    level: str, trait: str, item: str = ITEM, value: str = VALUE,
    function: str = FUNCTION, copy_num: str = COPIES, keep_unclassified: bool = False,
) -> DataFrame:
    """Taxon x trait x sample profile from the item-level tables."""
    abundance = taxon_abundance(counts, lineage, level, item, value, keep_unclassified)
    functions = taxon_copies(copies, lineage, level, item, function, copy_num)
    functions = unclassified(functions, level, keep_unclassified)
    return stratify(abundance, functions, trait_map, level, trait, value, function, copy_num)
