"""Delimited text tables.

Spark takes one null token per read, so cells are read as text and the tokens
replaced afterwards; numbers are then cast by the given schema, or by
inference over the whole file.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from simplexa.names import (
    ITEM_ID_NAMES,
    METADATA_NULL_TOKENS,
    NULL_TOKENS,
    SAMPLE,
    first_present,
)

# Header forms of the input files.
TAXONOMY_COLUMNS = ("OTU/ASV_ID", "taxonomy", "confidence")
BANNER = "# Constructed from"
COMMENT = "#"


def _separator(path: str) -> str:
    return "," if path.removesuffix(".gz").endswith(".csv") else "\t"


def _quoted(name: str):
    return F.col("`" + name.replace("`", "``") + "`")


def _typed(text: DataFrame, tokens: Sequence[str], schema: StructType | None) -> DataFrame:
    """Null the tokens, then give every column its type."""
    cells = {c: F.when(~_quoted(c).isin(list(tokens)), _quoted(c)) for c in text.columns}
    if schema is not None:
        return text.select(*[cells[f.name].cast(f.dataType).alias(f.name) for f in schema.fields])
    clean = text.select(*[cell.alias(c) for c, cell in cells.items()])
    # One pass finds, per column, whether every present cell is a number.
    flags = []
    for i, c in enumerate(clean.columns):
        cell = _quoted(c)
        whole = F.count_if(cell.isNotNull() & cell.try_cast("bigint").isNull())
        number = F.count_if(cell.isNotNull() & cell.try_cast("double").isNull())
        # A cast to bigint would also take "1.5"; a point or exponent says double.
        pointed = F.count_if(cell.rlike(r"[.eEnN]"))
        flags += [whole.alias(f"w{i}"), number.alias(f"d{i}"), pointed.alias(f"p{i}"),
                  F.count(cell).alias(f"n{i}")]
    found = clean.agg(*flags).first()
    typed = []
    for i, c in enumerate(clean.columns):
        kind = "string"
        if found[f"n{i}"] and not found[f"d{i}"]:
            kind = "double" if found[f"w{i}"] or found[f"p{i}"] else "bigint"
        typed.append(_quoted(c).cast(kind).alias(c))
    return clean.select(*typed)


def read_table(
    spark: SparkSession, path: str, tokens: Sequence[str] = NULL_TOKENS,
    schema: StructType | None = None,
) -> DataFrame:
    """Tab- or comma-separated table by extension, ``.gz`` included.

    Without a schema one extra pass infers it from every row.
    """
    text = spark.read.csv(path, sep=_separator(path), header=True, inferSchema=False)
    return _typed(text, tokens, schema)


def read_metadata(
    spark: SparkSession, path: str, schema: StructType | None = None
) -> DataFrame:
    """Sample attributes; ``#SampleID`` becomes ``Sample``."""
    table = read_table(spark, path, METADATA_NULL_TOKENS, schema)
    if SAMPLE not in table.columns and "#SampleID" in table.columns:
        table = table.withColumnRenamed("#SampleID", SAMPLE)
    return table


def read_exported_counts(
    spark: SparkSession, path: str, schema: StructType | None = None
) -> DataFrame:
    """Count matrix whose first line may be a banner above a ``#OTU ID`` header."""
    top = spark.read.text(path).filter(~F.col("value").startswith(BANNER)).first()
    if top is None:
        raise ValueError(f"no header in {path}")
    names = top["value"].split("\t")
    strings = StructType([StructField(n, StringType()) for n in names])
    text = spark.read.schema(strings).csv(path, sep="\t", header=False)
    first = F.coalesce(_quoted(names[0]), F.lit(""))
    rows = text.filter(~first.startswith(BANNER) & (first != names[0]))
    return _typed(rows, NULL_TOKENS, schema)


def read_predictions(
    spark: SparkSession, path: str, schema: StructType | None = None,
    first_name: str | None = None,
) -> DataFrame:
    """Prediction table with ``#`` comment lines; optionally rename column one."""
    text = spark.read.csv(
        path, sep="\t", header=True, comment=COMMENT, inferSchema=False
    )
    table = _typed(text, NULL_TOKENS, schema)
    if first_name is not None:
        table = table.withColumnRenamed(table.columns[0], first_name)
    return table


def read_taxonomy(spark: SparkSession, path: str) -> DataFrame:
    """Taxonomy whose header itself starts with ``#``; names are normalised."""
    text = spark.read.csv(path, sep="\t", header=True, inferSchema=False)
    if len(text.columns) < 3:
        raise ValueError("a taxonomy table has an id, a lineage and a confidence column")
    item, lineage, confidence = text.columns[:3]
    return text.select(
        _quoted(item).alias(TAXONOMY_COLUMNS[0]),
        _quoted(lineage).alias(TAXONOMY_COLUMNS[1]),
        _quoted(confidence).try_cast("double").alias(TAXONOMY_COLUMNS[2]),
    )


def item_column(table: DataFrame, names: Sequence[str] = ITEM_ID_NAMES) -> str:
    return first_present(table.columns, names, "item id")
