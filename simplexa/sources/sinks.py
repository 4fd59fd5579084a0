"""Table output."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from simplexa.operators.composition import SparseClr, clr, dense
from simplexa.operators.keys import clean_key, combine_key, split_key
from simplexa.operators.reshape import WideBlocks, to_long, wide_or_blocks
from simplexa.operators.summary import sorted_nulls_last
from simplexa.names import FEATURE, SAMPLE, VALUE


def write_text(
    df: DataFrame, path: str, order: Sequence[str] | None = None, gzip: bool = False,
    sep: str = "\t",
) -> None:
    """Delimited files with a header, globally sorted across the parts."""
    table = sorted_nulls_last(df, order) if order else df
    options = {"compression": "gzip"} if gzip else {}
    table.write.options(**options).csv(path, sep=sep, header=True)


def write_table(df: DataFrame, path: str, partition_by: Sequence[str] | None = None) -> None:
    """Parquet, the default for anything read again."""
    writer = df.write
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def write_by_taxon(df: DataFrame, path: str, taxon: str, order: Sequence[str]) -> None:
    """One folder per taxon, rows sorted inside it.

    Rows are placed by range of (taxon, order), so a large taxon spans several
    tasks and files.
    """
    placed = df.repartitionByRange(taxon, *order).sortWithinPartitions(taxon, *order)
    placed.write.partitionBy(taxon).parquet(path)


def layouts(
    table: DataFrame, sample: str = SAMPLE, value: str = VALUE, split: bool = False,
    by_feature: bool = False,
) -> dict[str, DataFrame | SparseClr | WideBlocks]:
    """The export layouts of one long table, as lazy tables.

    ``raw_long``; ``raw_wide_N_D``; ``clr`` in sparse and ``clr_wide_N_D`` in
    wide form; with ``split`` ``clr_wide_D_N_split``, whose key is cut into
    level columns; with ``by_feature`` ``raw_wide_D_N``.  A wide form of more
    than 10,000 columns comes as ``WideBlocks``.
    """
    long = combine_key(table, sample, value).select(
        F.col(sample).alias(SAMPLE), FEATURE, F.col(value).alias(VALUE)
    )
    return {"raw_long": table, **_layouts(long, split, by_feature)}


def wide_layouts(
    table: DataFrame, index: str, by_feature: bool, split: bool = False, export_by_feature: bool = False,
) -> dict[str, DataFrame | SparseClr | WideBlocks]:
    """The same layouts, but ``raw_long``, of a wide table whose column ``index`` names its rows: features if
    ``by_feature``, else samples.  A separator in these names becomes an underscore.
    """
    named = table.withColumn(index, clean_key(F.col(f"`{index}`")))
    if by_feature:
        long = to_long(named, index, name=SAMPLE).withColumnRenamed(index, FEATURE)
    else:
        long = to_long(named, index, name=FEATURE).withColumnRenamed(index, SAMPLE)
    return _layouts(long.select(SAMPLE, FEATURE, VALUE), split, export_by_feature)


def _layouts(long: DataFrame, split: bool, by_feature: bool) -> dict[str, DataFrame | SparseClr | WideBlocks]:
    sparse = clr(long)
    logs = dense(sparse)
    out = {
        "raw_wide_N_D": wide_or_blocks(long, SAMPLE, FEATURE),
        "clr": sparse,
        "clr_wide_N_D": wide_or_blocks(logs, SAMPLE, FEATURE),
    }
    if split:
        wide = wide_or_blocks(logs, FEATURE, SAMPLE)
        blocks = isinstance(wide, WideBlocks)
        cut = split_key(wide.rows if blocks else wide)
        out["clr_wide_D_N_split"] = WideBlocks(cut, wide.columns) if blocks else cut
    if by_feature:
        out["raw_wide_D_N"] = wide_or_blocks(long, FEATURE, SAMPLE)
    return out
