"""Where intermediate tables go."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The cluster's shared folder, from ``spark.checkpoint.dir``.

    Only a local session without the setting, as in tests, gets a temporary
    folder: on a cluster each executor would write to its own disk.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not named:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        named = tempfile.mkdtemp(prefix="simplexa-")
        spark.sparkContext.setCheckpointDir(named)
    return named.rstrip("/")


def new_table_path(spark: SparkSession, label: str) -> str:
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"


def stored(df: DataFrame, label: str = "table") -> DataFrame:
    """Write a table to the shared folder and read it back.

    For results that several later plans read, such as distances: the work is
    done once, and a lost executor costs only a reread.
    """
    path = new_table_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
