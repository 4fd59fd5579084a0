"""Shards of near-equal bytes: a k-d tree over document metadata, cut at weighted medians."""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from simplexa.llm.store import kept, slots

BLOCK = 33  # monotonically_increasing_id: partition above this bit, row in partition below


def near_median(rows: DataFrame, order: list[str]) -> DataFrame:
    """(_node, _cut): the last row, as a struct of the `order` columns, that goes left in each node.

    Rows are sorted over all partitions and stored; one sum for each node and block, accumulated, tells in which block
    half of the node's bytes is reached, and only that block's rows are summed up one by one.
    """
    spark = rows.sparkSession
    dealt = rows.repartitionByRange(2 * slots(spark), "_node", *order).sortWithinPartitions("_node", *order)
    sorted_rows = kept(dealt.withColumn("_at", F.monotonically_increasing_id()), "kd-order").withColumn(
        "_block", F.shiftright("_at", BLOCK))
    sums = sorted_rows.groupBy("_node", "_block").agg(F.sum("_weight").alias("own"))
    # At most one row for each node and block: as many as partitions and nodes.
    before = W.partitionBy("_node").orderBy("_block")
    placed = sums.select(
        "_node", "_block", "own", F.sum("own").over(before).alias("upto"),
        F.sum("own").over(W.partitionBy("_node")).alias("total"))
    hit = placed.where((F.col("upto") * 2 >= F.col("total")) & ((F.col("upto") - F.col("own")) * 2 < F.col("total")))
    inside = sorted_rows.join(F.broadcast(hit), ["_node", "_block"])  # one row for each node
    running = F.sum("_weight").over(W.partitionBy("_node", "_block").orderBy("_at"))
    gap = F.abs((F.col("upto") - F.col("own") + running) * 2 - F.col("total"))
    # The split nearest to half of the bytes is just before or just after the row that crosses it.
    return inside.withColumn("_gap", gap).groupBy("_node").agg(
        F.min_by(F.struct(*order), F.struct("_gap", "_at")).alias("_cut"))


def kd_shards(documents: DataFrame, dimensions: list[Column], weight: Column, leaf_bytes: int | None = None,
              leaves: int | None = None) -> DataFrame:
    """Rows of documents (doc_id, ...) with `shard` (leaf number) and `slot` (gapless from 0 in a shard).

    A node is cut along the dimension in which it is widest, as a share of the whole table's range, at the weighted
    median; rows with equal values are told apart by doc_id and then by a digest of the row, so a hot value is split.
    Cutting ends when leaves hold about `leaf_bytes` (or there are `leaves`, a power of 2).  Weights are positive.
    Null values come first, and so do null ids; repeated rows may fall on either side of a cut but get a shard each;
    an empty table gives an empty one; other columns stay unless named shard, slot or with a leading underscore.
    """
    names = [f"_d{i}" for i in range(len(dimensions))]
    stay = [c for c in documents.columns if c not in ("shard", "slot") and not c.startswith("_")]
    rows = documents.select(
        *stay, *(d.cast("double").alias(n) for d, n in zip(dimensions, names)), weight.cast("long").alias("_weight"))
    rows = rows.withColumn("_tie", F.monotonically_increasing_id())
    rows = kept(rows.withColumn("_node", F.lit(1).cast("long")), "kd-rows")
    whole = rows.agg(F.sum("_weight"), *(F.min(n) for n in names), *(F.max(n) for n in names)).first()
    total, k = whole[0] or 0, len(names)
    spans = [((whole[1 + k + i] or 0.0) - (whole[1 + i] or 0.0)) or 1.0 for i in range(k)]
    depth = math.ceil(math.log2(leaves)) if leaves else max(0, math.ceil(math.log2(max(1, total / leaf_bytes))))
    for _ in range(depth):
        widths = [((F.max(n) - F.min(n)) / F.lit(s)) for n, s in zip(names, spans)]
        widest = F.array_max(F.array(*(F.struct(F.coalesce(w, F.lit(0.0)).alias("wide"), F.lit(-i).alias("first")) for i, w in enumerate(widths))))
        # As many rows as nodes, which are fewer than leaves.
        nodes = rows.groupBy("_node").agg((-widest["first"]).alias("_along"))
        rows = rows.join(F.broadcast(nodes), "_node") if depth <= 12 else rows.join(nodes, "_node")
        value = reduce(lambda a, i: F.when(F.col("_along") == i, F.col(names[i])).otherwise(a), range(k),
                       F.lit(None).cast("double"))
        rows = rows.withColumn("_value", value)
        order = ["_value", "doc_id", "_tie"]
        cuts = near_median(rows.select("_node", *order, "_weight"), order)
        rows = rows.join(F.broadcast(cuts) if depth <= 12 else cuts, "_node", "left")
        right = F.struct(*order) > F.col("_cut")
        rows = kept(
            rows.withColumn("_node", F.col("_node") * 2 + F.coalesce(right, F.lit(False)).cast("long"))
            .drop("_along", "_cut", "_value"), "kd-level")
    rows = rows.withColumn("shard", (F.col("_node") - F.lit(1 << depth)).cast("int"))
    return numbered(rows.select(*stay, "shard", "_tie"), ["shard"], ["doc_id", "_tie"]).drop("_tie")


def numbered(rows: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """Rows with `slot`, gapless from 0 in each key in the given order, without a window over a whole key."""
    dealt = rows.repartitionByRange(slots(rows.sparkSession), *key, *order).sortWithinPartitions(*key, *order)
    at = kept(dealt.withColumn("_at", F.monotonically_increasing_id()), "numbered").withColumn(
        "_block", F.shiftright("_at", BLOCK))
    counts = at.groupBy(*key, "_block").agg(F.count("*").alias("_n"), F.min("_at").alias("_first"))
    before = W.partitionBy(*key).orderBy("_block")
    offsets = counts.select(
        *key, "_block", (F.sum("_n").over(before) - F.col("_n") - F.col("_first")).alias("_shift"))
    return at.join(offsets, [*key, "_block"]).withColumn("slot", F.col("_at") + F.col("_shift")).drop(
        "_at", "_block", "_shift")


def shard_table(documents: DataFrame, leaves: int = 8) -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard) over doc_id, language, source and length."""
    text = F.coalesce(F.col("text"), F.lit(""))
    compact = documents.select(
        "doc_id", (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).cast("long").alias("text_crc32"), F.col("n_chars").alias("_chars"),
        F.crc32(F.coalesce(F.col("source"), F.lit("")).cast("binary")).alias("_source"),
        F.crc32(F.coalesce(F.col("lang"), F.lit("")).cast("binary")).alias("_lang"))
    placed = kd_shards(
        compact, [F.col("_source"), F.col("_lang"), F.log1p(F.col("_chars")), F.col("doc_id")], F.col("size"),
        leaves=leaves)
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))
