"""Composite feature keys ``A|B|...``."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from simplexa.names import FEATURE, SAMPLE, SEPARATOR, VALUE


def clean_key(column: Column | str) -> Column:
    """A key part must not hold the separator itself."""
    c = F.col(column) if isinstance(column, str) else column
    return F.translate(c.cast("string"), SEPARATOR, "_")


def combine_key(
    df: DataFrame,
    sample: str = SAMPLE,
    value: str = VALUE,
    parts: Sequence[str] | None = None,
    name: str = FEATURE,
) -> DataFrame:
    """Join all columns but sample and value into one key, in column order.

    One column is only renamed.  A null part makes the key null.
    """
    parts = list(parts or [c for c in df.columns if c not in (sample, value)])
    if not parts:
        raise ValueError(f"no feature columns besides {sample!r} and {value!r}")
    if len(parts) == 1:
        return df.withColumnRenamed(parts[0], name).select(name, sample, value)
    pieces = [clean_key(parts[0])]
    for part in parts[1:]:
        pieces += [F.lit(SEPARATOR), clean_key(part)]
    return df.select(F.concat(*pieces).alias(name), sample, value)


def key_depths(df: DataFrame, feature: str = FEATURE) -> DataFrame:
    """One row: the smallest and largest number of key parts."""
    depth = F.size(F.split(F.col(feature), r"\|"))
    return df.agg(F.min(depth).alias("min_depth"), F.max(depth).alias("max_depth"))


def split_key(
    df: DataFrame, feature: str = FEATURE, depth: int | None = None, prefix: str = "Feature_Level_"
) -> DataFrame:
    """Replace the key by one column per part; keys of unequal depth are an error.

    Without ``depth`` one small job measures it; a table whose keys have a
    single part is returned unchanged.
    """
    if depth is None:
        low, high = key_depths(df, feature).first()
        if low is None or high == 1:
            return df
        if low != high:
            raise ValueError(f"Inconsistent {feature} levels: between {low} and {high} parts")
        depth = low
    parts = F.split(F.col(feature), r"\|")
    levels = [F.get(parts, F.lit(i)).alias(f"{prefix}{i + 1}") for i in range(depth)]
    return df.select(*levels, *[c for c in df.columns if c != feature])
