"""Lineage strings to named levels."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from simplexa.functions.expressions import blank_to_null
from simplexa.names import LINEAGE_LEVELS

# The lineage format of the input tables.
LINEAGE_DELIMITER = "; "
RANK_PREFIX = "^[dkpcofgs]__"
CODE_PATTERN = r"\d|-"


def split_lineage(df: DataFrame, lineage: str = "taxonomy") -> DataFrame:
    """One nullable column per level; blank or absent levels are null."""
    parts = F.split(F.col(lineage), LINEAGE_DELIMITER)
    levels = {
        level: blank_to_null(F.regexp_replace(F.get(parts, F.lit(i)), RANK_PREFIX, ""))
        for i, level in enumerate(LINEAGE_LEVELS)
    }
    return df.withColumns(levels)


def name_codes(df: DataFrame) -> DataFrame:
    """Put the nearest named ancestor in front of a level that is only a code.

    A code has a digit or hyphen.  Ancestors are judged by their original
    values, so codes are never used as a name; without a named ancestor the
    code stays as it is.
    """
    named = {
        level: F.when(~F.col(level).rlike(CODE_PATTERN), F.col(level)) for level in LINEAGE_LEVELS
    }
    renamed = {}
    for i, level in enumerate(LINEAGE_LEVELS):
        nearest_first = [named[above] for above in reversed(LINEAGE_LEVELS[:i])]
        if not nearest_first:
            continue
        ancestor = F.coalesce(*nearest_first, F.lit(None).cast("string"))
        code = F.col(level).rlike(CODE_PATTERN)
        renamed[level] = F.when(
            code & ancestor.isNotNull(), F.concat(ancestor, F.lit("-"), F.col(level))
        ).otherwise(F.col(level))
    return df.withColumns(renamed)


def attach_lineage(table: DataFrame, taxonomy: DataFrame, key: str) -> DataFrame:
    """Left join of the taxonomy; items without one keep null."""
    return table.join(taxonomy, key, "left")


def unclassified(df: DataFrame, level: str, keep: bool = False) -> DataFrame:
    """Drop items without the level, or keep them as ``Unclassified_<level>``."""
    if keep:
        return df.withColumn(level, F.coalesce(F.col(level), F.lit(f"Unclassified_{level}")))
    return df.filter(F.col(level).isNotNull())
