"""Rank tests of sparse tables against the dense form and against their definition."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from simplexa.operators import composition, ranks
from simplexa.operators import hypothesis as H
from tests.helpers import mapping


@pytest.fixture(autouse=True)
def always_sparse(monkeypatch):
    monkeypatch.setattr(H, "SPARSE_SHARE", 2.0)


@pytest.fixture(scope="module", params=["clr", "tied"])
def table(spark, request):
    """A CLR, and a table with heavy ties between cells, baselines and cells of other samples."""
    rng = np.random.default_rng(5)
    n, width = 24, 9
    if request.param == "clr":
        counts = rng.poisson(1.2, size=(n, width)).astype(float)
        counts[:, 0], counts[:, 1], counts[3] = 0, 4, 0
        long = spark.createDataFrame(
            [(f"S{i:02d}", f"f{j}", v) for i, row in enumerate(counts.tolist()) for j, v in enumerate(row)],
            "Sample string, FeatureID string, Value double")
        sparse = composition.clr(long)
    else:
        cells = [(f"S{i:02d}", f"f{j}", float(rng.integers(0, 4))) for i in range(n) for j in range(1, width)
                 if rng.random() < 0.5 or j == 1]
        sparse = composition.SparseClr(
            spark.createDataFrame(cells, "Sample string, FeatureID string, clr double"),
            spark.createDataFrame([(f"S{i:02d}", float(i % 3)) for i in range(n)], "Sample string, baseline double"),
            spark.createDataFrame([(f"f{j}",) for j in range(width)], "FeatureID string"))
    md = [(f"S{i:02d}", None if i == 5 else "abc"[i % 3], "xy"[i % 2], None if i in (2, 7) else float(rng.integers(0, 9)))
          for i in range(n)]
    return sparse, spark.createDataFrame(md, "Sample string, three string, two string, y double")


def same(one, two, columns, key="Feature"):
    for column in columns:
        a, b = mapping(one, key, column), mapping(two, key, column)
        assert set(a) == set(b)
        for k in a:
            assert (a[k] is None) == (b[k] is None)
            if a[k] is not None and math.isnan(b[k]):
                assert math.isnan(a[k]), (column, k)
            elif a[k] is not None:
                assert a[k] == pytest.approx(b[k], rel=1e-9, abs=1e-12), (column, k)


@pytest.mark.parametrize("slice_rows", [7])
def test_sparse_tests_equal_dense_ones(table, slice_rows):
    sparse, md = table
    dense = composition.dense(sparse)
    few, many = H.grouped_values(sparse, md, "three"), H.grouped_values(dense, md, "three")
    same(H.kruskal_wallis(few, "three", slice_rows=slice_rows), H.kruskal_wallis(many, "three"),
         ["test_statistic", "p_value"])
    for pair in (("a", "b"), ("b", "c"), ("a", "none")):
        same(H.mann_whitney(few, "three", *pair, slice_rows=slice_rows), H.mann_whitney(many, "three", *pair),
             ["test_statistic", "p_value", "cliffs_delta", "n1", "n2"])
    same(H.spearman(sparse, md, "y", slice_rows=slice_rows), H.spearman(dense, md, "y"),
         ["n", "correlation", "p_value", "q_value"])


def test_chosen_tests_and_effects(table):
    sparse, md = table
    dense = composition.dense(sparse)
    for group in ("two", "three"):
        same(H.group_tests(sparse, md, group), H.group_tests(dense, md, group), ["test_statistic", "p_value", "q_value"])
    same(H.cliffs_delta(H.grouped_values(sparse, md, "two"), "two", "x", "y"),
         H.cliffs_delta(H.grouped_values(dense, md, "two"), "two", "x", "y"), ["cliffs_delta"])


def test_hot_value_is_split(table):
    """The lookups of a value that very many cells have are dealt over several tasks, with the same sums."""
    sparse, md = table
    weights = md.filter("three IS NOT NULL").select("Sample", F.col("three").alias("key"), F.lit(1.0).alias("a"))
    found = []
    for hot in (None, 3):
        keys, features = ranks.sparse_rank_sums(sparse, weights, hot_rows=hot)
        found.append((sorted(map(tuple, keys.collect())), sorted(
            (r["FeatureID"], sorted((r["corrections"] or {}).items()), r["ties"]) for r in features.collect())))
    assert found[0] == found[1]


def midrank(values, x):
    return sum(v < x for v in values) + (sum(v == x for v in values) + 1) / 2


@pytest.mark.parametrize("seed", range(2))
def test_weighted_sums_match_definition(spark, seed):
    rng = random.Random(seed)
    samples, names = [f"s{i}" for i in range(15)], ["f", "g", "h", "empty"]
    base = {s: float(rng.randint(-2, 2)) for s in samples}
    cells = {(s, f): float(rng.randint(-3, 3)) for s in samples for f in names[:3] if rng.random() < 0.4}
    weight = {s: (rng.choice("pq"), rng.choice([-1.5, 0.0, 2.0])) for s in samples[:-2]}
    sparse = composition.SparseClr(
        spark.createDataFrame([(s, f, v) for (s, f), v in cells.items()], "Sample string, FeatureID string, clr double"),
        spark.createDataFrame(list(base.items()), "Sample string, baseline double"),
        spark.createDataFrame([(f,) for f in names], "FeatureID string"))
    frame = spark.createDataFrame([(s, k, a) for s, (k, a) in weight.items()], "Sample string, key string, a double")
    keys, features = ranks.sparse_rank_sums(sparse, frame, slice_rows=4)
    bases = {r["key"]: r["base"] for r in keys.collect()}
    for r in features.collect():
        values = {s: cells.get((s, r["FeatureID"]), base[s]) for s in weight}
        held = list(values.values())
        for k, b in bases.items():
            want = sum(a * midrank(held, values[s]) for s, (g, a) in weight.items() if g == k)
            assert b + (r["corrections"] or {}).get(k, 0.0) == pytest.approx(want)
        assert r["ties"] == sum(held.count(v) ** 3 - held.count(v) for v in set(held))


def test_features_that_no_sample_stores(spark):
    sparse = composition.SparseClr(
        spark.createDataFrame([], "Sample string, FeatureID string, clr double"),
        spark.createDataFrame([("a", 1.0), ("b", 2.0), ("c", 2.0)], "Sample string, baseline double"),
        spark.createDataFrame([("f",)], "FeatureID string"))
    md = spark.createDataFrame([("a", "x"), ("b", "x"), ("c", "y")], "Sample string, g string")
    row = H.mann_whitney(H.grouped_values(sparse, md, "g"), "g", "x", "y").first()
    assert (row["test_statistic"], row["n1"], row["n2"]) == (0.5, 2, 1)
