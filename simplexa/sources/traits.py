"""Function to trait map."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from simplexa.functions.expressions import blank_to_null

# The id format of the map file.
FUNCTION_ID = r"-(K\d{5})$"
FUNCTION_PREFIX = "ko:"


def trait_map(raw: DataFrame, level: str, id_column: str = "PGPT_ID") -> DataFrame:
    """Distinct (KO, level) rows; ids without a function or level are dropped."""
    code = blank_to_null(F.regexp_extract(F.col(id_column), FUNCTION_ID, 1))
    return (
        raw.select(F.concat(F.lit(FUNCTION_PREFIX), code).alias("KO"), level)
        .filter(F.col("KO").isNotNull() & F.col(level).isNotNull())
        .distinct()
    )
