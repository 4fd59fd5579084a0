"""Equi-joins: id reconciliation, metadata, and fan-out joins with hot keys.

Joins against one row per key leave skew to adaptive execution, which splits an
oversized partition between several tasks.  A fan-out join (many rows per key on
both sides) multiplies what a hot key holds, so ``fanout_join`` splits such keys
up front.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from simplexa.names import SAMPLE
from simplexa.sources.shared import stored

HOT_ROWS = 2_000_000
#: Rows of a side that a task sorts or groups.
TASK_ROWS = 1_000_000


def spread_out(df: DataFrame, *keys: str, rows: int = 0, task_rows: int = TASK_ROWS) -> DataFrame:
    """Hash rows over at least one partition per core, and per ``task_rows`` of
    ``rows``.

    For work that is heavy per row: adaptive execution merges partitions by
    their bytes, and a fixed number keeps it from merging these.
    """
    spark = df.sparkSession
    wanted = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(max(wanted, spark.sparkContext.defaultParallelism, -(-rows // task_rows)), *keys)


def not_broadcast(df: DataFrame) -> DataFrame:
    """A side of a join that grows with the data.

    Spark estimates it from compressed, exploded columns and may send it whole
    through the driver; with this both sides are shuffled.
    """
    return df.hint("merge")


def shared_ids(*tables: DataFrame, key: str) -> DataFrame:
    """Distinct ids that occur in every table.

    Ids are made distinct before the joins, so a key's many rows are not
    shuffled.
    """
    first, *rest = (table.select(key).distinct() for table in tables)
    for ids in rest:
        first = first.join(ids, key, "left_semi")
    return first


def reduce_to_shared(*tables: DataFrame, key: str) -> list[DataFrame]:
    """Each table cut down to the ids that occur in all of them.

    The id list is stored, as every table is joined to it.
    """
    ids = stored(shared_ids(*tables, key=key), "ids")
    return [table.join(ids, key, "left_semi") for table in tables]


def ids_missing_from(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Distinct ids of ``left`` that ``right`` lacks."""
    return left.select(key).distinct().join(right.select(key), key, "left_anti")


def join_metadata(
    table: DataFrame,
    metadata: DataFrame,
    columns: Sequence[str],
    sample: str = SAMPLE,
    how: str = "inner",
) -> DataFrame:
    """Attach per-sample attributes."""
    return table.join(metadata.select(sample, *columns), sample, how)


def fanout_join(
    left: DataFrame,
    right: DataFrame,
    key: str,
    spread: str,
    null_safe: bool = False,
    hot_rows: int = HOT_ROWS,
    rows: int = 0,
    task_rows: int = TASK_ROWS,
) -> DataFrame:
    """Inner join, with every key of more than ``hot_rows`` left rows split.

    A hot key's left rows are dealt by a hash of ``spread`` over k parts and its
    right rows repeated k times.  The table of hot keys has at most
    rows / hot_rows rows, which is what makes broadcasting it safe.
    ``null_safe`` lets null match null.  With the ``rows`` of the larger side, a
    task gets about ``task_rows`` of them at most; else Spark decides.
    """
    if null_safe:
        tag = F.struct(F.col(key).isNull().alias("n"), F.coalesce(F.col(key), F.lit("")).alias("v"))
        left, right = left.withColumn("_key", tag), right.withColumn("_key", tag).drop(key)
        on = "_key"
    else:
        on = key
    load = left.groupBy(on).agg(F.count(F.lit(1)).alias("_rows"))
    hot = F.broadcast(
        load.filter(F.col("_rows") > hot_rows).select(
            on, F.ceil(F.col("_rows") / hot_rows).cast("int").alias("_parts")
        )
    )
    parts = F.coalesce(F.col("_parts"), F.lit(1))
    dealt = left.join(hot, on, "left").withColumn(
        "_part", F.pmod(F.xxhash64(spread), parts).cast("int")
    ).drop("_parts")
    repeated = right.join(hot, on, "left").withColumn(
        "_part", F.explode(F.sequence(F.lit(0), parts - 1))
    ).drop("_parts")
    if rows > task_rows:
        dealt, repeated = (
            spread_out(side, on, "_part", rows=rows, task_rows=task_rows) for side in (dealt, repeated))
    joined = dealt.join(not_broadcast(repeated), [on, "_part"]).drop("_part")
    return joined.drop("_key") if null_safe else joined


def every_pair(left: DataFrame, right: DataFrame, condition=None) -> DataFrame:
    """Every row of one stored table with every row of another, as tasks read them: nothing is shuffled or copied.

    For tables of few rows that each hold many, such as blocks of samples.
    """
    return left.join(right.hint("shuffle_replicate_nl"), F.lit(True) if condition is None else condition)
