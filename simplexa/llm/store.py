"""Tables in the folder that all executors share."""

from __future__ import annotations

from pyspark.sql import DataFrame

from simplexa.sources.shared import new_table_path


def kept(df: DataFrame, label: str, by: str | None = None) -> DataFrame:
    """Write a table to the shared folder and read it back: its lineage ends there."""
    spark, path = df.sparkSession, new_table_path(df.sparkSession, label)
    writer = df.write.partitionBy(by) if by else df.write
    writer.parquet(path)
    table = spark.read.schema(df.schema).parquet(path)
    table.kept_at = path
    return table


def discard(*tables: DataFrame) -> None:
    """Remove the files of kept tables that nothing reads any more."""
    for table in tables:
        jvm = table.sparkSession.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(table.kept_at)
        path.getFileSystem(table.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def slots(spark) -> int:
    """Shuffle partitions of the session."""
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
