"""Row filters and name listings."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from simplexa.names import FEATURE, SEPARATOR, VALUE


def within_nsti(df: DataFrame, max_nsti: float = 1.7, column: str = "metadata_NSTI") -> DataFrame:
    """Keep rows at or below the limit, then drop annotation columns.

    A table without the column is not filtered; a null is above every limit.
    """
    if column in df.columns:
        df = df.filter(F.col(column) <= max_nsti)
    return drop_annotations(df)


def drop_annotations(df: DataFrame) -> DataFrame:
    extra = [
        c for c in df.columns if c.startswith("metadata_") or c == "closest_reference_genome"
    ]
    return df.drop(*extra)


def positive(df: DataFrame, value: str = VALUE) -> DataFrame:
    """Drop zero, negative and null; NaN and infinity stay, as NaN sorts last."""
    return df.filter(F.col(value) > 0)


def where_in(df: DataFrame, column: str, values: Iterable) -> DataFrame:
    return df.filter(F.col(column).isin(list(values)))


def where_between(df: DataFrame, column: str, low, high) -> DataFrame:
    return df.filter(F.col(column).between(low, high))


def features_with_prefix(df: DataFrame, prefix: str, feature: str = FEATURE) -> DataFrame:
    return df.filter(F.col(feature).startswith(prefix))


def features_in(df: DataFrame, names: DataFrame, feature: str = FEATURE) -> DataFrame:
    """Keep the features listed in another table."""
    return df.join(names.select(feature), feature, "left_semi")


def entities(df: DataFrame, kind: str, feature: str = FEATURE) -> DataFrame:
    """Distinct taxa (before the first separator) or traits (after it), sorted."""
    keyed = df.filter(F.col(feature).contains(SEPARATOR))
    if kind == "taxon":
        part = F.substring_index(feature, SEPARATOR, 1)
    elif kind == "trait":
        part = F.expr(f"substring({feature}, instr({feature}, '{SEPARATOR}') + 1)")
    else:
        raise ValueError("kind must be 'taxon' or 'trait'")
    return keyed.select(part.alias("entity")).distinct().orderBy("entity")
