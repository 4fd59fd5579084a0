"""Scalar column expressions that stay inside Spark's generated code."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

NAN = float("nan")
INF = float("inf")


def as_col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ieee_divide(numerator: Column | str, denominator: Column | str) -> Column:
    """Floating-point division as hardware does it.

    x/0 is a signed infinity, 0/0 is NaN and null stays null, where ANSI mode
    would raise and ``try_divide`` would return null.
    """
    n, d = as_col(numerator).cast("double"), as_col(denominator).cast("double")
    return (
        F.when(n.isNull() | d.isNull(), F.lit(None).cast("double"))
        .when(d != 0, n / d)
        .when(F.isnan(n) | (n == 0), F.lit(NAN))
        .when(n > 0, F.lit(INF))
        .otherwise(F.lit(-INF))
    )


def round_half_even(value: Column | str, digits: int) -> Column:
    """Round ties to even; infinities and NaN pass through."""
    scale = float(10**digits)
    return F.rint(as_col(value) * scale) / F.lit(scale)


def blank_to_null(value: Column | str) -> Column:
    return F.nullif(as_col(value), F.lit(""))


def is_missing(value: Column | str) -> Column:
    """Null or NaN."""
    c = as_col(value).cast("double")
    return c.isNull() | F.isnan(c)


def log2(value: Column | str) -> Column:
    return F.log2(as_col(value))
