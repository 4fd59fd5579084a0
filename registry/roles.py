"""The driver tables in the roles the operators expect."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from simplexa.operators.joins import not_broadcast, spread_out


class Roles:
    """Lazy role tables over one folder of parquet files."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def counts(self) -> DataFrame:
        """Parts as items, suppliers as samples, quantities as counts."""
        # Grouped by the native keys; only the result is turned into text.
        # Dealt first, by the number of rows: nearly every row is a group of its own, and a task holds all of its part.
        rows = self.table("lineitem").select("l_partkey", "l_suppkey", "l_quantity")
        dealt = spread_out(rows, "l_partkey", "l_suppkey", rows=rows.count())
        totals = dealt.groupBy("l_partkey", "l_suppkey").agg(
            F.sum("l_quantity").alias("Value")
        )
        return totals.select(
            F.col("l_partkey").alias("ASV_ID"), F.col("l_suppkey").cast("string").alias("Sample"),
            "Value",
        )

    def strat(self) -> DataFrame:
        """Composite features type|brand per supplier."""
        items = self.table("part").select(
            "p_partkey", F.concat_ws("|", "p_type", "p_brand").alias("FeatureID")
        )
        return (
            self.table("lineitem")
            .join(not_broadcast(items), F.col("l_partkey") == F.col("p_partkey"))
            .groupBy(F.col("l_suppkey").cast("string").alias("Sample"), "FeatureID")
            .agg(F.sum("l_quantity").alias("Value"))
        )

    def marker(self) -> DataFrame:
        return self.table("part").select(
            F.col("p_partkey").alias("ASV_ID"),
            (F.col("p_size") % 5).cast("double").alias("marker_copies"),
            (F.col("p_retailprice") / 1000).alias("metadata_NSTI"),
            F.col("p_name").alias("closest_reference_genome"),
        )

    def copies(self) -> DataFrame:
        # Dealt first: the file is read by few tasks, and an item's copies stay together.
        parts = spread_out(self.table("part").select("p_partkey"), "p_partkey").select(
            "p_partkey", F.explode(F.sequence(F.lit(1), F.lit(12))).alias("k")
        )
        return parts.select(
            F.col("p_partkey").alias("ASV_ID"),
            F.format_string("ko:K%05d", "k").alias("KO"),
            ((F.col("p_partkey") * F.col("k")) % 4).cast("double").alias("copy_num"),
        )

    def raw_map(self) -> DataFrame:
        """Every seventh part has a malformed id; a function has several traits."""
        key = F.col("p_partkey")
        code = F.format_string("x%d-K%05d", key, key % 12 + 1)
        return self.table("part").select(
            F.when(key % 7 == 0, F.concat(code, F.lit("-bad"))).otherwise(code).alias("PGPT_ID"),
            F.concat(F.lit("T"), ((key % 36) % 5).cast("string")).alias("Lv3"),
        )

    def taxonomy(self) -> DataFrame:
        return self.table("part").select(
            F.col("p_partkey").alias("ASV_ID"),
            F.concat(
                F.lit("k__"), "p_type", F.lit("; p__"), F.split("p_name", " ")[0],
                F.lit("; c__"), F.split("p_name", " ")[1], F.lit("; o__; f__; g__"), "p_brand",
            ).alias("taxonomy"),
            (F.col("p_size") / 50).alias("confidence"),
        )

    def lineage(self) -> DataFrame:
        """Brand as the taxon, missing for one size in ten."""
        return self.table("part").select(
            F.col("p_partkey").alias("ASV_ID"),
            F.when(F.col("p_size") % 10 != 0, F.col("p_brand")).alias("Genus"),
        )

    def metadata(self) -> DataFrame:
        nation = self.table("nation").join(
            self.table("region"), F.col("n_regionkey") == F.col("r_regionkey")
        )
        return (
            self.table("supplier")
            .join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
            .select(
                F.col("s_suppkey").cast("string").alias("Sample"),
                F.col("r_name").alias("Region"),
                F.when(F.col("s_acctbal") >= 5000, "high").otherwise("low").alias("Balance"),
                F.col("s_acctbal").alias("acctbal"),
                F.col("s_nationkey").alias("nation"),
            )
        )

    def vectors(self) -> DataFrame:
        """Embeddings as a dense long table with negative values."""
        return self.table("embeddings").select(
            F.col("vec_id").cast("string").alias("Sample"),
            F.posexplode("embedding").alias("_at", "_x"),
        ).select(
            "Sample", F.format_string("e%02d", "_at").alias("FeatureID"),
            F.col("_x").cast("double").alias("Value"),
        )

    def vector_targets(self) -> DataFrame:
        """The label, and a number that depends on three vector positions."""
        v = self.table("embeddings")
        return v.select(
            F.col("vec_id").cast("string").alias("Sample"),
            F.col("label").cast("string").alias("label"),
            (2 * v["embedding"][3] - 3 * v["embedding"][10] + v["embedding"][20])
            .cast("double").alias("target"),
        )


# The same role tables as common table expressions.
CTE = {
    "counts": """counts AS (SELECT l_partkey AS "ASV_ID",
        CAST(l_suppkey AS VARCHAR) AS "Sample", sum(l_quantity) AS "Value"
        FROM lineitem GROUP BY 1, 2)""",
    "strat": """strat AS (SELECT CAST(l_suppkey AS VARCHAR) AS "Sample",
        p_type || '|' || p_brand AS "FeatureID", sum(l_quantity) AS "Value"
        FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1, 2)""",
    "marker": """marker AS (SELECT p_partkey AS "ASV_ID",
        CAST(p_size % 5 AS DOUBLE) AS marker_copies, p_retailprice / 1000 AS "metadata_NSTI",
        p_name AS closest_reference_genome FROM part)""",
    "copies": """copies AS (SELECT p_partkey AS "ASV_ID",
        'ko:K' || lpad(CAST(k AS VARCHAR), 5, '0') AS "KO",
        CAST((p_partkey * k) % 4 AS DOUBLE) AS copy_num
        FROM part, (SELECT unnest(range(1, 13)) AS k))""",
    "raw_map": """raw_map AS (SELECT 'x' || p_partkey || '-K'
        || lpad(CAST(p_partkey % 12 + 1 AS VARCHAR), 5, '0')
        || CASE WHEN p_partkey % 7 = 0 THEN '-bad' ELSE '' END AS "PGPT_ID",
        'T' || ((p_partkey % 36) % 5) AS "Lv3" FROM part)""",
    "trait_map": """trait_map AS (SELECT DISTINCT
        'ko:K' || lpad(CAST(p_partkey % 12 + 1 AS VARCHAR), 5, '0') AS "KO",
        'T' || ((p_partkey % 36) % 5) AS "Lv3" FROM part WHERE p_partkey % 7 <> 0)""",
    "taxonomy": """taxonomy AS (SELECT p_partkey AS "ASV_ID",
        'k__' || p_type || '; p__' || split_part(p_name, ' ', 1) || '; c__'
        || split_part(p_name, ' ', 2) || '; o__; f__; g__' || p_brand AS taxonomy,
        p_size / 50.0::DOUBLE AS confidence FROM part)""",
    "lineage": """lineage AS (SELECT p_partkey AS "ASV_ID",
        CASE WHEN p_size % 10 <> 0 THEN p_brand END AS "Genus" FROM part)""",
    "metadata": """metadata AS (SELECT CAST(s_suppkey AS VARCHAR) AS "Sample",
        r_name AS "Region", CASE WHEN s_acctbal >= 5000 THEN 'high' ELSE 'low' END AS "Balance",
        s_acctbal AS acctbal, s_nationkey AS nation
        FROM supplier JOIN nation ON s_nationkey = n_nationkey
        JOIN region ON n_regionkey = r_regionkey)""",
    "vectors": """vectors AS (SELECT CAST(vec_id AS VARCHAR) AS "Sample",
        'e' || lpad(CAST(i - 1 AS VARCHAR), 2, '0') AS "FeatureID",
        CAST(embedding[i] AS DOUBLE) AS "Value"
        FROM embeddings, (SELECT unnest(range(1, 65)) AS i))""",
    # Dense CLR of strat.
    "clr": """grid AS (SELECT * FROM (SELECT DISTINCT "Sample" FROM strat),
            (SELECT DISTINCT "FeatureID" FROM strat)),
        full_cells AS (SELECT "Sample", "FeatureID", coalesce("Value", 0) AS x
            FROM grid LEFT JOIN strat USING ("Sample", "FeatureID")),
        closed AS (SELECT *, count(*) OVER w AS d, sum(x) OVER w AS s,
            count(*) FILTER (WHERE x = 0) OVER w AS z
            FROM full_cells WINDOW w AS (PARTITION BY "Sample")),
        filled AS (SELECT "Sample", "FeatureID", x, CASE WHEN x = 0 THEN 1.0 / (d * d)
            ELSE x / s * (1 - z * 1.0 / (d * d)) END AS p FROM closed),
        clr AS (SELECT "Sample", "FeatureID", x,
            ln(p) - avg(ln(p)) OVER (PARTITION BY "Sample") AS "Value" FROM filled)""",
}
