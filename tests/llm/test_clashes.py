"""Columns of documents that have names of an operator's own."""

from collections import Counter

from pyspark.sql import functions as F

from simplexa.llm import sharding

NAMES = ("weight", "node", "along", "cut", "slot", "shard", "_tie", "_value", "total", "own")


def test_shards_keep_columns_of_other_meaning(spark):
    rows = [(i, "x" * (i % 7), *(f"{n}{i}" for n in NAMES)) for i in range(60)] + [(None, None, *NAMES)]
    df = spark.createDataFrame(rows, "doc_id long, text string, " + ", ".join(f"{n} string" for n in NAMES))
    weight = F.octet_length(F.coalesce("text", F.lit(""))) + 1
    got = sharding.kd_shards(df, [F.length("text"), F.col("doc_id")], weight, leaves=4)
    assert sorted(got.columns) == sorted(["doc_id", "text", "weight", "node", "along", "cut", "total", "own", "shard", "slot"])
    found = got.collect()
    assert Counter((r.doc_id, r.weight, r.node, r.along, r.cut, r.total, r.own) for r in found) == Counter(
        (r[0], r[2], r[3], r[4], r[5], r[10], r[11]) for r in rows)
    assert {r.shard for r in found} == set(range(4))
    for shard in range(4):
        assert sorted(r.slot for r in found if r.shard == shard) == list(range(sum(r.shard == shard for r in found)))
