"""Session defaults used by the tests and the benchmark."""

from __future__ import annotations

from pyspark.sql import SparkSession


def local_session(cpus: int | str = "*", memory: str = "16g") -> SparkSession:
    """Local session with the settings the operators are written for.

    On a cluster use the session you have: the operators only need adaptive
    execution, which is Spark's default, and ``spark.checkpoint.dir`` for the
    few that write intermediate tables.
    """
    partitions = "8" if cpus == "*" else str(cpus)
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("simplexa")
        .config("spark.sql.shuffle.partitions", partitions)
        .config("spark.driver.memory", memory)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        # A join whose output is regrouped may still split its hot keys.
        .config("spark.sql.adaptive.forceOptimizeSkewedJoin", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark
