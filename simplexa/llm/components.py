"""Connected components of an edge table by alternating star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from simplexa.llm.store import discard, kept


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of edges (a, b): the smallest node that links lead to.  The steps go on until
    nothing changes.

    Each step hangs the neighbours of a node on its smallest one, in turn the larger and the smaller ones, until the
    edges are stars.  Minima are added up before the shuffle, and the join that follows has one row for each node on
    one side, so a node with any number of links can be split.
    """
    def told(df: DataFrame) -> tuple:
        return tuple(df.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())

    def star(now: DataFrame, larger: bool) -> DataFrame:
        """now: edges (a, b) with a > b."""
        near = now.union(now.select("b", "a")) if larger else now
        least = near.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        joined = near.join(least, "a")
        if larger:
            out = joined.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        else:
            out = joined.select(F.col("b").alias("a"), F.col("m").alias("b")).union(
                joined.select("a", F.col("m").alias("b")))
        return out.where("a <> b").distinct()

    now = edges.where("a <> b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    now = kept(now, "links")
    before = told(now)
    while before[0]:
        last, now = now, kept(star(star(now, True), False), "stars")
        discard(last)
        here = told(now)
        if here == before:
            break
        before = here
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
        now.select("b", "b").distinct())
