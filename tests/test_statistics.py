import math
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from simplexa.functions import tails
from simplexa.operators import hypothesis as H
from simplexa.operators import ordered
from tests.helpers import mapping, rows


def long_table(spark, data, groups):
    """data: feature -> list of values; groups: list of labels, per sample."""
    out = [
        (f"S{i:03d}", g, f, float(v))
        for f, values in data.items()
        for i, (v, g) in enumerate(zip(values, groups))
    ]
    return spark.createDataFrame(out, "Sample string, g string, FeatureID string, Value double")


PINNED = {"P1": [1, 2, 3, 8, 9, 10], "P2": [1, 10, 2, 9, 3, 11]}
AB = ["A"] * 3 + ["B"] * 3


def test_pinned_rank_tests(spark):
    t = long_table(spark, PINNED, AB)
    kw = mapping(H.kruskal_wallis(t, "g"), "Feature", "p_value")
    assert kw["P1"] == pytest.approx(0.0495346, abs=1e-7)
    assert kw["P2"] == pytest.approx(0.2752335, abs=1e-7)
    mw = mapping(H.mann_whitney(t, "g", "A", "B"), "Feature", "p_value")
    assert mw == pytest.approx({"P1": 0.1, "P2": 0.4})


def test_missing_group_and_constant_feature(spark):
    t = long_table(spark, {"F": [1, 1, 1, 1, 1, 1]}, AB)
    r = H.kruskal_wallis(t, "g").first()
    assert math.isnan(r["test_statistic"]) and math.isnan(r["p_value"])
    r = H.mann_whitney(t, "g", "A", "C").first()
    assert math.isnan(r["test_statistic"]) and math.isnan(r["p_value"])
    # All tied: U in the middle and p = 1.
    r = H.mann_whitney(t, "g", "A", "B").first()
    assert (r["test_statistic"], r["p_value"], r["cliffs_delta"]) == (4.5, 1.0, 0.0)


@pytest.mark.parametrize(
    "a, b, expected",
    [([1, 2, 3], [4, 5, 6], -1), ([10, 20], [1, 2], 1), ([1, 5], [2, 4], 0),
     ([1, 2, 5], [3, 4], -1 / 3)],
)
def test_cliffs_delta(spark, a, b, expected):
    t = long_table(spark, {"F": a + b}, ["A"] * len(a) + ["B"] * len(b))
    assert H.cliffs_delta(t, "g", "A", "B").first()["cliffs_delta"] == pytest.approx(expected)


def test_false_discovery_pinned(spark):
    t = spark.createDataFrame(
        [("a", 0.01), ("b", 0.03), ("c", 0.5), ("d", 0.02), ("e", None)],
        "Feature string, p_value double",
    )
    q = mapping(H.benjamini_hochberg(t), "Feature", "q_value")
    assert q.pop("e") is None
    assert q == pytest.approx({"a": 0.04, "b": 0.04, "c": 0.5, "d": 0.04})
    assert H.benjamini_hochberg(t.limit(0)).count() == 0
    flags = mapping(H.with_flags(H.benjamini_hochberg(t)), "Feature", "q_sig")
    assert flags == {"a": True, "b": True, "c": False, "d": True, "e": False}


def brute_q(p):
    order = np.argsort(p, kind="stable")
    raw = np.array(p)[order] * len(p) / np.arange(1, len(p) + 1)
    q = np.minimum(1, np.minimum.accumulate(raw[::-1])[::-1])
    out = np.empty(len(p))
    out[order] = q
    return out


@pytest.mark.parametrize("slice_rows", [3, 40, 1 << 20])
def test_false_discovery_across_slices(spark, slice_rows):
    random.seed(slice_rows)
    # A third of all p-values are the same.
    p = [0.2 if i % 3 == 0 else random.random() ** 3 for i in range(300)]
    t = spark.createDataFrame([(f"f{i:03d}", v) for i, v in enumerate(p)], "Feature string, p_value double")
    got = mapping(H.benjamini_hochberg(t, slice_rows=slice_rows), "Feature", "q_value")
    assert [got[f"f{i:03d}"] for i in range(300)] == pytest.approx(list(brute_q(p)))


def midranks(values):
    values = np.array(values)
    return np.array([(values < v).sum() + ((values == v).sum() + 1) / 2 for v in values])


@pytest.mark.parametrize("slice_rows", [2, 7, 1 << 20])
def test_midranks_and_quantiles_across_slices(spark, slice_rows):
    rng = random.Random(1)
    # One hot key, and one hot value within it.
    values = {"hot": [0.0 if i % 3 else rng.gauss(0, 1) for i in range(200)], "b": [3.0, 1.0, 2.0], "c": [5.0]}
    t = spark.createDataFrame([(k, v) for k, vs in values.items() for v in vs], "k string, v double")
    got = mapping(ordered.midranks(t, ["k"], "v", slice_rows=slice_rows), ["k", "v"], "midrank")
    for k, vs in values.items():
        for v, r in zip(vs, midranks(vs)):
            assert got[k, v] == pytest.approx(r)
    q = ordered.exact_quantiles(t, ["k"], "v", {"lo": 0.0, "a": 0.25, "m": 0.5, "hi": 1.0}, slice_rows)
    for r in q.collect():
        vs = values[r["k"]]
        assert [r["lo"], r["a"], r["m"], r["hi"]] == pytest.approx(list(np.quantile(vs, [0, 0.25, 0.5, 1])))
    numbered = ordered.positions(
        spark.range(100).withColumn("k", F.col("id") % 2), ["k"], ["id"], slice_rows=slice_rows
    )
    assert all(r["position"] == r["id"] // 2 + 1 for r in numbered.collect())


@settings(max_examples=6, deadline=None)
@given(st.lists(st.integers(0, 6), min_size=8, max_size=25), st.integers(2, 4))
def test_rank_sums_match_definition(spark, values, k):
    groups = [f"g{i % k}" for i in range(len(values))]
    t = long_table(spark, {"F": values}, groups)
    got = mapping(H.rank_sums(t, "g", slice_rows=4), "g", "rank_sum")
    ranks = midranks(values)
    for g in set(groups):
        assert got[g] == pytest.approx(sum(r for r, h in zip(ranks, groups) if h == g))


def test_correlations_against_numpy(spark):
    rng = np.random.default_rng(3)
    y = rng.normal(size=30)
    data = {"up": y * 2 + rng.normal(size=30), "tied": np.round(rng.normal(size=30)), "flat": np.ones(30)}
    t = long_table(spark, data, ["A"] * 30)
    md = spark.createDataFrame([(f"S{i:03d}", float(v)) for i, v in enumerate(y)], "Sample string, y double")
    p = mapping(H.pearson(t, md, "y"), "Feature", "correlation")
    s = mapping(H.spearman(t, md, "y", slice_rows=5), "Feature", "correlation")
    for f in ("up", "tied"):
        assert p[f] == pytest.approx(np.corrcoef(data[f], y)[0, 1])
        assert s[f] == pytest.approx(np.corrcoef(midranks(data[f]), midranks(y))[0, 1])
    assert math.isnan(p["flat"]) and math.isnan(s["flat"])
    # Fewer than three pairs give no row.
    assert H.pearson(t, md.limit(2), "y").count() == 0


def test_tail_functions():
    z = np.array([0.0, 1.96, -np.inf])
    assert tails._normal_two_sided(z) == pytest.approx([1.0, 0.04999579, 1.0], abs=1e-8)
    x, df = np.array([3.841458820694124, 9.487729036781154, 7.814727903251179, 2.0]), np.array([1, 4, 3, 2])
    assert tails._chi2_upper(x, df) == pytest.approx([0.05, 0.05, 0.05, math.exp(-1)], abs=1e-10)
    t, nu = np.array([2.0, 0.0, -2.0, np.inf]), np.array([10.0, 5.0, 10.0, 3.0])
    assert tails._t_two_sided(t, nu) == pytest.approx([0.0733880, 1.0, 0.0733880, 0.0], abs=1e-7)
    # 20 orderings of 3 and 3.
    assert list(tails._rank_sum_counts(3, 3)) == [1, 1, 2, 3, 3, 3, 3, 2, 1, 1]
    assert sum(tails._rank_sum_counts(8, 40)) == math.comb(48, 8)


def test_exact_tail_of_large_groups():
    a, b = 8, 2600
    ways = [1] + [0] * (a * b)
    for i in range(1, a + 1):
        for u in range(a * b, b + i - 1, -1):
            ways[u] -= ways[u - b - i]
        for u in range(i, a * b + 1):
            ways[u] += ways[u - i]
    us = [a * b, 20592, 15000, 10400, 3, 0]
    want = [min(1.0, 2 * sum(ways[: min(u, a * b - u) + 1]) / math.comb(a + b, a)) for u in us]
    got = tails._mann_whitney_exact(np.array(us), np.full(len(us), a), np.full(len(us), b))
    assert got == pytest.approx(want, rel=1e-9, abs=0)


def test_group_test_choice(spark, sample_run):
    long, md = sample_run
    r = mapping(H.group_tests(long, md, "Treatment"), "Feature", "test_statistic")
    assert set(r) == {"Feat_A", "Feat_B", "Feat_C", "Feat_D", "Feat_E"}
    assert H.group_tests(long, md.withColumn("one", F.lit("x")), "one") is None
    three = md.withColumn("g", F.substring("Sample", 2, 1).cast("int").cast("string"))
    assert "p_value" in H.group_tests(long, three, "g").columns


def test_sparse_pearson_equals_dense(spark):
    from simplexa.operators import composition

    rng = np.random.default_rng(11)
    counts = rng.poisson(1.0, size=(20, 6)).astype(float)
    counts[:, 0] += 1
    long = spark.createDataFrame(
        [(f"S{i:02d}", f"f{j}", v) for i, row in enumerate(counts.tolist()) for j, v in enumerate(row)],
        "Sample string, FeatureID string, Value double")
    md = spark.createDataFrame(
        [(f"S{i:02d}", None if i == 3 else float(rng.normal())) for i in range(20)], "Sample string, y double")
    sparse = composition.clr(long)
    one = H.pearson(sparse, md, "y")
    two = H.pearson(composition.dense(sparse), md, "y")
    assert mapping(one, "Feature", "n") == mapping(two, "Feature", "n")
    assert mapping(one, "Feature", "correlation") == pytest.approx(mapping(two, "Feature", "correlation"))
    assert mapping(one, "Feature", "p_value") == pytest.approx(mapping(two, "Feature", "p_value"))


def test_thousands_of_cut_points(spark):
    """Slices of a few rows of one key, found by halving, and beyond the bound on cut points larger ones."""
    n = 6000
    t = spark.range(n).select(F.lit("k").alias("k"), ((F.col("id") * 7919) % n).alias("v"))
    got = mapping(ordered.midranks(t, ["k"], "v", slice_rows=3), ["k", "v"], "midrank")
    assert got == {("k", v): v + 1 for v in range(n)}
    assert ordered.slice_by_order(t, ["k"], "v", 3).rows.select("_slice").distinct().count() > 1000


def test_more_cut_points_than_are_broadcast(spark, monkeypatch):
    monkeypatch.setattr(ordered, "MOST_CUTS", 20)
    t = spark.range(3000).select((F.col("id") % 2).alias("k"), F.col("id").alias("v"))
    slices = ordered.slice_by_order(t, ["k"], "v", 3)
    assert 4 < slices.rows.select("k", "_slice").distinct().count() < 100
    numbered = ordered.positions(t, ["k"], ["v"], slice_rows=3)
    assert all(r["position"] == r["v"] // 2 + 1 for r in numbered.collect())
