import itertools
import math

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from simplexa.operators import checks, composition, diversity, keys, ordination, permanova, reshape, summary
from simplexa.sources import sinks
from tests.helpers import mapping, rows


def table(spark, data):
    """data: sample -> values; features named f0, f1, ..."""
    return spark.createDataFrame(
        [(s, f"f{i}", float(v)) for s, vs in data.items() for i, v in enumerate(vs)],
        "Sample string, FeatureID string, Value double")


def dense(spark, data):
    got = mapping(composition.dense(composition.clr(table(spark, data))), ["Sample", "FeatureID"], "Value")
    return {s: [got[s, f"f{i}"] for i in range(len(vs))] for s, vs in data.items()}


def numpy_clr(matrix):
    x = np.array(matrix, dtype=float)
    d = x.shape[1]
    out = np.zeros_like(x)
    for i, row in enumerate(x):
        if d > 1 and row.any():
            p, z = row / row.sum(), (row == 0).sum()
            p = np.where(p == 0, 1 / d**2, p * (1 - z / d**2))
            out[i] = np.log(p) - np.log(p).mean()
    return out


def test_clr_pinned(spark):
    got = dense(spark, {"S1": [10, 15], "S2": [5, 20], "Z": [0, 0]})
    assert got["S1"] == pytest.approx([-0.20273, 0.20273], abs=1e-5)
    assert got["S2"] == pytest.approx([-0.69315, 0.69315], abs=1e-5)
    assert got["Z"] == [0, 0]
    assert dense(spark, {"S1": [7], "S2": [3]}) == {"S1": [0], "S2": [0]}
    got = dense(spark, {"S1": [10, 5, 15, 0], "S2": [20, 0, 0, 0], "S3": [0, 0, 0, 1]})
    assert got["S1"] == pytest.approx([0.47428, -0.218867, 0.879745, -1.135158], abs=1e-6)
    assert got["S2"] == pytest.approx([1.923712] + [-0.641237] * 3, abs=1e-6)
    assert got["S3"] == pytest.approx([-0.641237] * 3 + [1.923712], abs=1e-6)


@settings(max_examples=5, deadline=None)
@given(st.lists(st.lists(st.integers(0, 9), min_size=5, max_size=5), min_size=2, max_size=6))
def test_sparse_results_equal_dense_ones(spark, matrix):
    data = {f"S{i}": row for i, row in enumerate(matrix)}
    long, expected = table(spark, data), numpy_clr(matrix)
    sparse = composition.clr(long)
    got = mapping(composition.dense(sparse), ["Sample", "FeatureID"], "Value")
    assert [got[f"S{i}", f"f{j}"] for i in range(len(matrix)) for j in range(5)] == pytest.approx(
        list(expected.ravel()), abs=1e-9)
    assert all(abs(r["clr_sum"]) < 1e-8 for r in composition.clr_sums(sparse).collect())
    var = mapping(composition.feature_variances(sparse), "FeatureID", "variance")
    assert [var[f"f{j}"] for j in range(5)] == pytest.approx(list(expected.var(axis=0, ddof=1)), abs=1e-9)
    x = np.array(matrix, dtype=float)
    for metric in diversity.BETA_METRICS:
        source = sparse if metric == "aitchison" else long
        # Blocks of two samples and two features: many tiles even here.
        edges = mapping(diversity.beta_diversity(source, metric, 2, 2), ["sample_i", "sample_j"], "distance")
        assert len(edges) == len(matrix) * (len(matrix) - 1) // 2
        for i, j in itertools.combinations(range(len(matrix)), 2):
            if metric == "aitchison":
                want = np.linalg.norm(expected[i] - expected[j])
            elif metric == "braycurtis":
                whole = x[i].sum() + x[j].sum()
                want = np.abs(x[i] - x[j]).sum() / whole if whole else 0.0
            else:
                a, b = x[i] > 0, x[j] > 0
                want = 1 - (a & b).sum() / (a | b).sum() if (a | b).any() else 0.0
            assert edges[f"S{i}", f"S{j}"] == pytest.approx(want, abs=1e-6)


def test_diversity_pinned(spark):
    long = table(spark, {"S1": [10, 10, 0], "S2": [0, 5, 5], "S3": [1, 1, 1], "S4": [100, 0, 0], "S5": [0, 0, 0]})
    a = mapping(diversity.alpha_diversity(long), ["Sample", "Metric"], "Value")
    assert [a[s, "observed_features"] for s in ("S1", "S2", "S3")] == [2, 2, 3]
    assert a["S1", "shannon"] == pytest.approx(1) and a["S3", "shannon"] == pytest.approx(1.5849625)
    assert a["S1", "simpson"] == 0.5 and a["S1", "pielou_e"] == pytest.approx(1)
    assert a["S4", "shannon"] == 0 and a["S4", "simpson"] == 0 and a["S4", "pielou_e"] is None
    assert a["S5", "shannon"] == 0 and a["S5", "pielou_e"] == 0 and a["S5", "simpson"] is None
    bc = mapping(diversity.beta_diversity(long, "braycurtis"), ["sample_i", "sample_j"], "distance")
    assert bc["S1", "S2"] == pytest.approx(0.66667, abs=1e-5)
    jac = mapping(diversity.beta_diversity(table(spark, {"A": [10, 10, 0], "B": [10, 0, 10]}), "jaccard"),
                  ["sample_i", "sample_j"], "distance")
    assert jac["A", "B"] == pytest.approx(2 / 3)
    with pytest.raises(ValueError, match="unknown alpha"):
        diversity.alpha_diversity(long, ["chao"])
    with pytest.raises(ValueError, match="metric must be"):
        diversity.beta_diversity(long, "unifrac")


ALPHA = {
    "S1": (3.0, 1.3787834934861753, 0.8699155297736259, 0.5714285714285714),
    "S6": (4.0, 1.661765788055024, 0.830882894027512, 0.6385041551246537),
}


def test_sample_run(spark, sample_run):
    long, md = sample_run
    a = mapping(diversity.alpha_diversity(long), ["Sample", "Metric"], "Value")
    for s, values in ALPHA.items():
        for metric, v in zip(("observed_features", "shannon", "pielou_e", "simpson"), values):
            assert a[s, metric] == pytest.approx(v, abs=1e-12)
    sparse = composition.clr(long)
    edges = diversity.beta_diversity(sparse, "aitchison")
    r = permanova.permanova(edges, md, "Treatment").first()
    assert r["test_statistic"] == pytest.approx(176.17071444, abs=1e-7)
    # 20 arrangements, two of them as good as the observed one: about 0.1.
    assert r["p_value"] == pytest.approx(0.1, abs=0.03)
    assert permanova.permanova(sparse, md, "Treatment").first()["test_statistic"] == pytest.approx(176.17071444, abs=1e-7)
    scores = mapping(ordination.pca(sparse).scores, "Sample", "PC1")
    assert scores["S1"] == pytest.approx(-2.02857858, abs=1e-6)
    assert scores["S6"] == pytest.approx(1.95796106, abs=1e-6)
    pc2 = mapping(ordination.pca(sparse).scores, "Sample", "PC2")
    assert pc2["S2"] == pytest.approx(0.27349163, abs=1e-6)


def test_permanova_blocks_errors_and_brute_force(spark):
    rng = np.random.default_rng(7)
    x, groups = rng.normal(size=(12, 3)), ["a", "b", "b", "c", "c", "c"] * 2
    edges = [(f"s{i:02d}", f"s{j:02d}", float(np.linalg.norm(x[i] - x[j])))
             for i, j in itertools.combinations(range(12), 2)]
    df = spark.createDataFrame(edges, "sample_i string, sample_j string, distance double")
    md = spark.createDataFrame([(f"s{i:02d}", g) for i, g in enumerate(groups)], "Sample string, g string")
    labels = permanova.permuted_labels(md, "g", 5).collect()
    stats = mapping(permanova.permutation_statistics(df, md, "g", 5, block=3), "permutation", "f")
    for p in range(6):
        lab = {r["Sample"]: r["label"] for r in labels if r["permutation"] == p}
        sizes = {v: list(lab.values()).count(v) for v in lab.values()}
        assert sorted(sizes.values()) == [2, 4, 6]
        total = sum(d * d for *_, d in edges) / 12
        within = sum(d * d / sizes[lab[i]] for i, j, d in edges if lab[i] == lab[j])
        assert stats[p] == pytest.approx(((total - within) / 2) / (within / 9))
    # From the cells of a sparse table: the same statistics as from its distances, whatever the tiles.
    counts = rng.poisson(1.0, size=(12, 7)).astype(float)
    counts[:, 0], counts[4, 1:] = rng.integers(1, 9, 12), 0
    sparse = composition.clr(table(spark, {f"s{i:02d}": row for i, row in enumerate(counts.tolist())}))
    some = md.withColumn("g", F.when(F.col("Sample") != "s07", F.col("g")))
    want = mapping(permanova.permutation_statistics(
        diversity.beta_diversity(sparse, "aitchison"), some, "g", 9), "permutation", "f")
    for tiles in ({}, {"tile_labels": 25, "block_cells": 4}):
        got = mapping(permanova.cell_statistics(sparse, some, "g", 9, **tiles), "permutation", "f")
        assert got == pytest.approx(want, rel=1e-9)
    one = permanova.permanova(sparse, md, "g", 19).first()
    two = permanova.permanova(diversity.beta_diversity(sparse, "aitchison"), md, "g", 19).first()
    assert (one["n_samples"], one["n_groups"], one["p_value"]) == (two["n_samples"], two["n_groups"], two["p_value"])
    assert one["test_statistic"] == pytest.approx(two["test_statistic"], rel=1e-9)
    with pytest.raises(ValueError, match="lack samples"):
        permanova.permanova(df, md.filter("Sample <> 's03'"), "g")
    with pytest.raises(ValueError, match="no column"):
        permanova.permanova(df, md, "other")


def test_ordination_fixture(spark):
    rows_ = {"S1": [0.5, -0.1, -0.4], "S2": [-0.2, 0.3, -0.1], "S3": [0.1, 0.0, -0.1]}
    x = np.array(list(rows_.values()))
    xc = x - x.mean(axis=0)
    expected = np.abs(np.linalg.svd(xc, full_matrices=False)[0] * np.linalg.svd(xc)[1])
    long = table(spark, rows_)
    result = ordination.pca(long, 2)
    got = {r["Sample"]: (r["PC1"], r["PC2"]) for r in result.scores.collect()}
    for i, s in enumerate(rows_):
        assert np.abs(got[s]) == pytest.approx(expected[i, :2], abs=1e-9)
    loads = result.loadings.collect()
    for pc in ("PC1", "PC2"):
        assert max((r[pc] for r in loads), key=abs) > 0
    edges = spark.createDataFrame(
        [(f"S{i+1}", f"S{j+1}", float(np.linalg.norm(x[i] - x[j]))) for i, j in ((0, 1), (0, 2), (1, 2))],
        "sample_i string, sample_j string, distance double")
    coords = mapping(ordination.pcoa(edges, 3), "Sample", "PC1")
    assert [abs(coords[s]) for s in rows_] == pytest.approx(list(expected[:, 0]), abs=1e-7)


def test_coordinates_beside_many_negative_eigenvalues(spark):
    # Two small positive eigenvalues, fourteen larger negative ones.
    n = 150
    q = np.linalg.qr(np.column_stack([np.ones(n), np.random.default_rng(3).normal(size=(n, n - 1))]))[0][:, 1:17]
    values = np.array([0.4, 0.3, *np.linspace(-0.5, -0.6, 14)])
    shift = np.eye(n) - 1.0 / n
    g = q @ np.diag(values) @ q.T
    squares = np.diag(g)[:, None] + np.diag(g)[None, :] - 2 * g
    # A constant added to all squared distances adds half of it to every eigenvalue; none of them is then below zero.
    far = max(0.0, -squares.min())
    squares = squares + far * (1 - np.eye(n))
    eigenvalues, vectors = np.linalg.eigh(-0.5 * shift @ squares @ shift)
    assert (eigenvalues < -0.3).sum() == 14
    edges = spark.createDataFrame(
        [(f"S{i:02d}", f"S{j:02d}", float(np.sqrt(squares[i, j]))) for i in range(n) for j in range(i + 1, n)],
        "sample_i string, sample_j string, distance double")
    got = {r["Sample"]: r for r in ordination.pcoa(edges, 2).collect()}
    for c, name in ((-1, "PC1"), (-2, "PC2")):
        want = np.abs(vectors[:, c]) * np.sqrt(eigenvalues[c])
        assert [abs(got[f"S{i:02d}"][name]) for i in range(n)] == pytest.approx(list(want), abs=1e-6)


def test_many_features_use_distributed_products(spark, monkeypatch):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(15, 8))
    long = table(spark, {f"S{i:02d}": row for i, row in enumerate(x)})
    first = ordination.pca(long)
    direct = mapping(first.scores, "Sample", "PC1")
    monkeypatch.setattr(ordination, "COVARIANCE_FEATURES", 0)
    second = ordination.pca(long)
    other = mapping(second.scores, "Sample", "PC1")
    assert second.explained == pytest.approx(first.explained, abs=1e-8)
    assert other == pytest.approx(direct, abs=1e-6)


def test_reshape_and_keys(spark):
    wide = spark.createDataFrame([("A", 1, 2.0), ("B", 0, 3.0)], "F string, S1 long, S2 double")
    long = reshape.to_long(wide, "F")
    assert rows(long) == [("A", "S1", 1.0), ("A", "S2", 2.0), ("B", "S1", 0.0), ("B", "S2", 3.0)]
    assert rows(reshape.transpose(wide, "F", "Sample")) == [("S1", 1.0, 0.0), ("S2", 2.0, 3.0)]
    assert reshape.sample_columns(["id", "Genus", "S_a", "depth"], "id", prefix="S_") == ["S_a"]
    assert reshape.sample_columns(["id", "Genus", "S_a", "depth"], "id", exclude=["depth"]) == ["S_a"]
    assert reshape.sample_columns(["id", "Genus", "S_a", "depth"], "id") == ["S_a", "depth"]
    with pytest.raises(ValueError):
        reshape.sample_columns(["id", "Genus"], "id")
    key = spark.createDataFrame([("a|x", "b", "S", 1.0), (None, "b", "S", 1.0)], "F string, T string, Sample string, Value double")
    assert rows(keys.combine_key(key).filter("FeatureID is not null")) == [("a_x|b", "S", 1.0)]
    assert keys.combine_key(key).filter("FeatureID is null").count() == 1
    bad = spark.createDataFrame([("A|B", 1.0), ("A|B|C", 2.0)], "FeatureID string, S1 double")
    with pytest.raises(ValueError, match="Inconsistent"):
        keys.split_key(bad)
    flat = spark.createDataFrame([("A", 1.0)], "FeatureID string, S1 double")
    assert keys.split_key(flat).columns == ["FeatureID", "S1"]
    few = spark.createDataFrame([("1", "2", 5.0), ("1", "3", 1.0), ("4", "2", 2.0)], "Sample string, FeatureID string, Value double")
    names = spark.range(25).selectExpr("cast(id as string) FeatureID")
    samples = spark.range(30).selectExpr("cast(id as string) Sample", "id + 0.5 as fill")
    absent = reshape.absent_cells(few, samples, names, chunk=4)
    pairs = absent.select("Sample", "FeatureID")
    assert pairs.distinct().count() == pairs.count() == 30 * 25 - 3
    assert pairs.join(few, ["Sample", "FeatureID"]).isEmpty()
    assert absent.filter("fill <> cast(Sample as int) + 0.5").isEmpty()


def test_layouts(spark, sample_run):
    long, _ = sample_run
    out = sinks.layouts(long.select("FeatureID", "Sample", "Value"), split=True, by_feature=True)
    assert set(out) == {"raw_long", "raw_wide_N_D", "clr", "clr_wide_N_D", "clr_wide_D_N_split", "raw_wide_D_N"}
    logs = mapping(out["clr_wide_N_D"], "Sample", "Feat_A")
    assert logs["S1"] == pytest.approx(0.7530924989735126) and logs["S5"] == pytest.approx(-1.4895502560095815)
    assert mapping(out["raw_wide_D_N"], "FeatureID", "S2")["Feat_D"] == 19


def test_checks(spark):
    wide = spark.createDataFrame([("A", "1", "text"), ("B", "2.5", None)], "F string, S1 string, Description string")
    with pytest.raises(ValueError, match="Description"):
        checks.require_numeric(wide, ["S1", "Description"])
    checks.require_numeric(wide, ["S1"])
    small = spark.createDataFrame([(5.0,), (20.0,)], "v double")
    assert checks.looks_like_clr(small, "v").first()[0] is True
    assert checks.looks_like_clr(small, "v", "raw_x.tsv").first()[0] is False
    big = spark.createDataFrame([(5.0,), (2000.0,)], "v double")
    assert checks.looks_like_clr(big, "v").first()[0] is False
    assert checks.looks_like_clr(big, "v", "clr.tsv").first()[0] is True
    md = spark.createDataFrame([("S1", "x")], "Sample string, g string")
    with pytest.raises(KeyError):
        checks.require_overlap(md, md, ["other"])
    with pytest.raises(ValueError, match="no samples matched"):
        checks.require_overlap(spark.createDataFrame([("Q",)], "Sample string"), md, ["g"])


def test_diverse_top(spark):
    data = [(f"{t}|p{i}", float(v)) for t, vs in {"A": [9, 8, 7, 6, 5], "B": [4, 3], "C": [1]}.items() for i, v in enumerate(vs)]
    df = spark.createDataFrame(data, "FeatureID string, variance double")
    pick = lambda n: [r["variance"] for r in summary.diverse_top(df, n).orderBy("place").collect()]
    assert pick(5) == [9, 8, 7, 4, 3]
    assert pick(7) == [9, 8, 7, 4, 3, 1, 6]
    assert len(pick(20)) == 8
    plain = spark.createDataFrame([(f"x{i}", float(i)) for i in range(6)], "FeatureID string, variance double")
    assert [r["variance"] for r in summary.diverse_top(plain, 3).orderBy("place").collect()] == [5, 4, 3]


def test_group_summary_across_slices(spark):
    rng = np.random.default_rng(2)
    groups = {"big": rng.normal(size=200), "one": np.array([4.0]), "two": np.array([0.0, 0.0])}
    df = spark.createDataFrame([(g, float(v)) for g, vs in groups.items() for v in vs] + [("big", None)], "g string, Value double")
    for r in summary.group_summary(df, "g", slice_rows=16).collect():
        v = groups[r["g"]]
        assert r["N"] == len(v) and r["Median"] == pytest.approx(np.median(v))
        if r["g"] == "big":
            assert r["Std"] == pytest.approx(v.std(ddof=1)) and r["CV%"] == pytest.approx(v.std(ddof=1) / v.mean() * 100)
        if r["g"] == "two":
            assert math.isnan(r["CV%"])
