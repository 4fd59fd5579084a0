"""Ranks of features over all samples, from the stored cells of a sparse table.

In a sparse table a sample's value of a feature is its cell, or the sample's baseline where nothing is stored.  A
feature's values are thus all baselines, less those of the samples that store it, plus the stored ones.  So ranks are
those of the baselines, which are worked out once for all features, and corrections that only stored cells take part
in: each cell counts once with its value and once, negatively, with its sample's baseline.

A value's place among the baselines (`half`: those below it and half of those equal) comes from running counts over
the distinct values.  Nothing has samples x features rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from simplexa.names import FEATURE, SAMPLE
from simplexa.operators.composition import SparseClr
from simplexa.operators.joins import fanout_join
from simplexa.operators.ordered import SLICE_ROWS, running_counts
from simplexa.sources.shared import stored


def sparse_rank_sums(
    table: SparseClr, weights: DataFrame, slice_rows: int = SLICE_ROWS, hot_rows: int | None = None
) -> tuple[DataFrame, DataFrame]:
    """Weighted sums of the midranks of every feature, by key.

    weights (Sample, key, a): samples without a row take no part, those with one have `a` as the weight of their
    midranks.  Returns

    * keys (key, n, a, base): samples and weights of a key, and its sum in a feature that no sample stores;
    * features (FeatureID, corrections, ties): every feature, with a map from key to what the sum is above `base`
      (absent: nothing), and the sum of t**3 - t over its values.
    """
    place = stored(
        table.baseline.join(weights.select(SAMPLE, "key", F.col("a").cast("double").alias("a")), SAMPLE).select(
            SAMPLE, F.col("baseline").cast("double").alias("v0"), "key", "a"),
        "placed-samples",
    )
    signed = F.explode(F.array(
        F.struct(F.col("clr").cast("double").alias("v"), F.lit(1.0).alias("w")),
        F.struct(F.col("v0").alias("v"), F.lit(-1.0).alias("w")),
    ))
    points = stored(
        table.cells.join(place, SAMPLE)
        .select(FEATURE, "key", "a", signed.alias("p"))
        .groupBy(FEATURE, F.col("p.v").alias("v"), "key")
        .agg(F.sum("p.w").alias("w"), F.sum(F.col("p.w") * F.col("a")).alias("a"))
        .filter((F.col("w") != 0) | (F.col("a") != 0))
        .groupBy(FEATURE, "v")
        .agg(F.sum("w").alias("w"), F.collect_list(F.struct("key", "w", "a")).alias("points")),
        "signed-points",
    )
    half = F.col("_cum") - F.col("_ties") / 2

    # Among the baselines: counts under the null key, and weights by key.
    keys = place.groupBy("key").agg(F.count(F.lit(1)).cast("double").alias("n"), F.sum("a").alias("a"))
    asked = points.select("v").unionByName(place.select(F.col("v0").alias("v"))).distinct()
    names = F.array_append(keys.agg(F.collect_list("key")).scalar(), F.lit(None).cast("string"))
    own = F.explode(F.array(
        F.struct("key", F.col("a").alias("m")), F.struct(F.lit(None).cast("string").alias("key"), F.lit(1.0).alias("m"))
    ))
    counts = (
        place.select(F.col("v0").alias("v"), own.alias("o")).select("o.key", "v", "o.m")
        .unionByName(asked.select(F.explode(names).alias("key"), "v", F.lit(0.0).alias("m")))
        .groupBy("key", "v").agg(F.sum("m").alias("m"))
    )
    plain = F.col("key").isNull()
    found = stored(
        running_counts(counts, ["key"], "v", "m", slice_rows)
        .withColumn("half", half)
        .groupBy("v")
        .agg(
            F.max(F.when(plain, F.col("half"))).alias("half"),
            F.max(F.when(plain, F.col("m"))).alias("m"),
            F.collect_list(F.when(~plain, F.struct("key", "half"))).alias("halves"),
        ),
        "lookups",
    )
    base = (
        place.join(found, place["v0"] == found["v"])
        .groupBy("key")
        .agg(F.sum(F.col("a") * (F.col("half") + 0.5)).alias("base"))
    )
    keys = keys.join(base, "key")
    ties = found.agg(F.sum(F.col("m") * (F.col("m") * F.col("m") - 1))).scalar()

    # Within the feature: signed counts below, and half of those at the value.
    points = running_counts(points, [FEATURE], "v", "w", slice_rows, store=False).select(
        FEATURE, "v", "w", "points", half.alias("inner")
    )
    split = {} if hot_rows is None else {"hot_rows": hot_rows}
    rows = fanout_join(points, found, "v", FEATURE, **split)
    own = F.transform("points", lambda p: F.struct(
        p["key"].alias("key"), (p["a"] * (F.col("half") + F.col("inner"))).alias("x")))
    others = F.transform("halves", lambda h: F.struct(h["key"].alias("key"), (-F.col("w") * h["half"]).alias("x")))
    now, then = F.col("m") + F.col("w"), F.col("m")
    changed = now * (now * now - 1) - then * (then * then - 1)
    parts = rows.select(
        FEATURE, F.inline(F.concat(own, others, F.array(F.struct(F.lit(None).cast("string").alias("key"), changed.alias("x")))))
    )
    sums = parts.groupBy(FEATURE, "key").agg(F.sum("x").alias("x"))
    corrected = sums.groupBy(FEATURE).agg(
        F.map_from_entries(F.filter(
            F.collect_list(F.struct("key", "x")), lambda e: e["key"].isNotNull())).alias("corrections"),
        F.sum(F.when(F.col("key").isNull(), F.col("x"))).alias("_ties"),
    )
    features = table.features.select(FEATURE).join(corrected, FEATURE, "left").select(
        FEATURE, "corrections", (F.coalesce("_ties", F.lit(0.0)) + F.coalesce(ties, F.lit(0.0))).alias("ties")
    )
    return keys, features


def corrected_sum(key, base):
    """A key's sum of midranks in a row of features."""
    return base + F.coalesce(F.try_element_at("corrections", key), F.lit(0.0))
