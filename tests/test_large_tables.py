"""Plans and steps that have to hold on tables much larger than those of the other tests."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from registry.queries import QUERIES
from registry.roles import Roles
from simplexa.operators import composition, diversity, joins, ordination, permanova, profile, reshape, selection
from simplexa.plans import composed
from simplexa.sources import sinks
from tests.helpers import rows

FOLDER = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_taxon_map_sends_no_lineage_through_the_driver(spark):
    assert "BroadcastExchange" not in plan(QUERIES["e6_taxon_map"](spark, FOLDER))


def test_lineage_and_abundance_are_not_broadcast(spark):
    t = Roles(spark, FOLDER)
    assert "BroadcastHashJoin" not in plan(profile.taxon_abundance(t.counts(), t.lineage(), "Genus"))
    assert "BroadcastHashJoin" not in plan(profile.taxon_copies(t.copies(), t.lineage(), "Genus"))
    left = spark.createDataFrame([("a", "s", 1.0)], "k string, s string, v double")
    right = spark.createDataFrame([("a", 2.0)], "k string, w double")
    # Only the lists of hot keys are.
    assert plan(joins.fanout_join(left, right, "k", "s")).count("SortMergeJoin") == 1


def test_permuted_labels_are_not_broadcast(spark):
    labels = spark.range(40).select(F.col("id").cast("string").alias("Sample"), (F.col("id") % 2).alias("g"))
    drawn = permanova.permuted_labels(labels, "g", 30)
    assert "SortMergeJoin [_place" in plan(drawn)
    assert drawn.count() == 31 * 40


@pytest.mark.parametrize("metric", ["braycurtis", "jaccard"])
def test_distances_shuffle_no_pairs(spark, metric):
    rng = np.random.default_rng(3)
    counts = rng.integers(0, 4, (23, 11))
    long = spark.createDataFrame(
        [(f"s{i:02d}", f"f{j}", float(v)) for (i, j), v in np.ndenumerate(counts)] + [(None, "f1", 2.0)],
        "Sample string, FeatureID string, Value double")
    got = diversity.beta_diversity(long, metric, 5, 4)
    above = plan(got).split("MapInArrow")[0]
    assert "Exchange" not in above and "HashAggregate" not in above
    found = {(r[0], r[1]): r[2] for r in got.collect()}
    assert len(found) == 23 * 22 // 2
    for (one, two), distance in found.items():
        a, b = counts[int(one[1:])], counts[int(two[1:])]
        if metric == "jaccard":
            a, b = a > 0, b > 0
            expected = 1 - (a & b).sum() / (a | b).sum()
        else:
            expected = 1 - 2 * np.minimum(a, b).sum() / (a.sum() + b.sum())
        assert one < two and distance == pytest.approx(expected)


def test_wide_tables_beyond_the_limit_of_columns(spark, monkeypatch):
    long = spark.createDataFrame(
        [("a|x", "s1", 1.0), ("a|y", "s2", 2.0), ("a|x", "s3", 4.0), ("b|x", "s5", None), ("a|y", "s2", 0.5),
         ("b|x", "s4", float("nan"))], "FeatureID string, Sample string, Value double")
    parts = long.selectExpr("split_part(FeatureID, '|', 1) t", "split_part(FeatureID, '|', 2) b", "Sample", "Value")
    functions = spark.createDataFrame(
        [("ko:K00001", "s1", 2.0), ("ko:K00001", "s2", 3.0), ("ko:K00002", "s3", 1.0)],
        "KO string, Sample string, Value double")
    raw = spark.createDataFrame([("x-K00001", "T1"), ("x-K00002", "T2")], "PGPT_ID string, Lv3 string")

    def made():
        split = sinks.layouts(parts, split=True)["clr_wide_D_N_split"]
        return (rows(reshape.to_long(split, ["Feature_Level_1", "Feature_Level_2"]).withColumn(
                    "Value", F.round("Value", 9))),
                rows(reshape.to_long(composed.trait_table(functions, raw, "Lv3"), "Lv3")),
                rows(reshape.to_long(reshape.wide_or_blocks(long, "FeatureID", "Sample"), "FeatureID")))

    pivoted = made()
    monkeypatch.setattr(reshape, "MAX_WIDE_COLUMNS", 2)
    assert made() == pivoted
    blocks = reshape.to_wide_blocks(long, "FeatureID", "Sample", block=2)
    assert rows(reshape.to_long(blocks, "FeatureID")) == pivoted[2]


@pytest.mark.parametrize("dimensions", [2, 119])
def test_pcoa_of_close_and_of_few_eigenvalues(spark, dimensions):
    n, rng = 120, np.random.default_rng(1)
    points = rng.normal(size=(n, dimensions))
    if dimensions > 2:
        points[:, :dimensions] = np.linalg.qr(points - points.mean(axis=0))[0] * np.linspace(1, 0.999, dimensions)
    points -= points.mean(axis=0)
    gap = np.linalg.norm(points[:, None] - points[None], axis=2)
    edges = spark.createDataFrame(
        [(f"s{i:03d}", f"s{j:03d}", float(gap[i, j])) for i in range(n) for j in range(i + 1, n)],
        "sample_i string, sample_j string, distance double")
    found = np.array([r[1:] for r in ordination.pcoa(edges, 2).orderBy("Sample").collect()])
    largest = np.sort(np.linalg.eigvalsh(points @ points.T))[::-1][:2]
    assert (found ** 2).sum(axis=0) == pytest.approx(largest, rel=1e-6)


def test_a_forest_of_a_larger_table_uses_all_cores(spark):
    table = spark.range(4000).selectExpr("cast(id as string) Sample", "0 features", "0 label").coalesce(1)
    assert selection.for_forest(table, 4000, 100).rdd.getNumPartitions() == 3
    assert selection.for_forest(table, 4000, 1000).rdd.getNumPartitions() == 4
    assert selection.for_forest(table, 4000, 10) is table


def test_items_and_counts_are_dealt_before_they_grow(spark):
    t = Roles(spark, FOLDER)
    for table in (t.copies(), t.counts()):
        assert "REPARTITION_BY_NUM" in plan(table)


def test_a_profile_is_dealt_by_its_rows(spark, monkeypatch):
    rng = np.random.default_rng(5)
    counts = [(f"i{i}", f"s{j}", float(v)) for (i, j), v in np.ndenumerate(rng.integers(0, 3, (30, 20)))]
    copies = [(f"i{i}", f"k{j}", float(v)) for (i, j), v in np.ndenumerate(rng.integers(0, 3, (30, 6)))]
    counts += [(None, "s1", 5.0), ("i1", "s1", 2.0)]
    expected = {}
    for i, s, v in counts:
        for other, k, c in copies:
            if i == other and v * c:
                expected[k, s] = expected.get((k, s), 0) + v * c
    join = joins.fanout_join
    monkeypatch.setattr(profile, "fanout_join", lambda *a, **k: join(*a, **{**k, "task_rows": 10}))
    got = profile.function_profile(
        spark.createDataFrame(counts, "ASV_ID string, Sample string, Value double"),
        spark.createDataFrame(copies, "ASV_ID string, KO string, copy_num double"))
    tasks = -(-sum(v > 0 for *_, v in counts) // 10)
    assert plan(got).count(f", {tasks}), REPARTITION_BY_NUM") == 2
    assert {(r[0], r[1]): r[2] for r in got.collect()} == expected


def test_counts_are_dealt_by_their_rows(spark):
    table = spark.range(10)
    assert joins.spread_out(table, "id", rows=10, task_rows=1).rdd.getNumPartitions() == 10
    assert joins.spread_out(table, "id", rows=10, task_rows=9).rdd.getNumPartitions() == 4


@pytest.mark.parametrize("metric", ["braycurtis", "jaccard", "aitchison"])
def test_cells_are_not_copied_to_pairs_of_blocks(spark, metric):
    counts = np.random.default_rng(4).integers(0, 4, (30, 9)) + np.eye(30, 9, dtype=int)
    long = spark.createDataFrame(
        [(f"s{i:02d}", f"f{j}", float(v)) for (i, j), v in np.ndenumerate(counts)],
        "Sample string, FeatureID string, Value double")
    table = composition.clr(long) if metric == "aitchison" else long
    got = diversity.beta_diversity(table, metric, 4, 5)
    # Stored blocks are read pair by pair: nothing grows with the number of pairs before the distances do.
    assert "Exchange" not in plan(got) and "CartesianProduct" in plan(got)
    whole = rows(diversity.beta_diversity(table, metric, 100, 100))
    split = rows(got)
    assert len(split) == 30 * 29 // 2 and [r[:2] for r in split] == [r[:2] for r in whole]
    assert [r[2] for r in split] == pytest.approx([r[2] for r in whole])


def test_permutations_of_cells_are_not_shuffled(spark, monkeypatch):
    """Rows that PERMANOVA of a sparse table shuffles do not follow the permutations; labels are those of the edge list."""
    rng = np.random.default_rng(6)
    counts = rng.integers(0, 4, (40, 9)) + np.eye(40, 9, dtype=int)
    sparse = composition.clr(spark.createDataFrame(
        [(f"s{i:02d}", f"f{j}", float(v)) for (i, j), v in np.ndenumerate(counts)],
        "Sample string, FeatureID string, Value double"))
    labels = spark.createDataFrame(
        [(f"s{i:02d}", f"g{g}") for i, g in enumerate(rng.integers(0, 4, 40))], "Sample string, g string")
    edges = diversity.beta_diversity(sparse, "aitchison")
    want = dict(rows(permanova.permutation_statistics(edges, labels, "g", 30), "permutation", "f"))

    def none(*a, **k):
        raise AssertionError("a row per sample and permutation")

    monkeypatch.setattr(permanova, "permuted_labels", none)
    stats = permanova.cell_statistics(sparse, labels, "g", 30, tile_labels=200, block_cells=50)
    assert dict(rows(stats, "permutation", "f")) == pytest.approx(want, rel=1e-9)
    assert "CartesianProduct" in plan(stats) and "FlatMapCoGroups" not in plan(stats)
    # More groups than a byte holds.
    many = spark.range(300).selectExpr("format_string('s%03d', id) Sample", "id")
    wide = composition.clr(many.selectExpr(
        "Sample", "explode(array('a', 'b')) FeatureID", "id").selectExpr(
        "Sample", "FeatureID", "id * ascii(FeatureID) % 11 + 1.0D Value"))
    named = many.selectExpr("Sample", "format_string('g%03d', id % 270) g")
    monkeypatch.undo()
    want = dict(rows(permanova.permutation_statistics(
        diversity.beta_diversity(wide, "aitchison"), named, "g", 3), "permutation", "f"))
    got = dict(rows(permanova.cell_statistics(wide, named, "g", 3), "permutation", "f"))
    assert got == pytest.approx(want, rel=1e-6)


def test_coordinates_store_and_shuffle_no_pairs(spark, monkeypatch):
    from registry import queries

    def none(*a, **k):
        raise AssertionError("pairs are stored")

    monkeypatch.setattr(queries, "stored", none)
    assert QUERIES["m2_pcoa"](spark, FOLDER).count() > 0
    # Edges in any order, which are added up one by one.
    n, rng = 300, np.random.default_rng(2)
    points = rng.normal(size=(n, 4)) * [4, 3, 2, 1]
    gap = np.linalg.norm(points[:, None] - points[None], axis=2)
    edges = [(f"s{i:03d}", f"s{j:03d}", float(gap[i, j])) for i in range(n) for j in range(i + 1, n)]
    order = rng.permutation(len(edges))
    frame = spark.createDataFrame([edges[i] for i in order], "sample_i string, sample_j string, distance double")
    found = np.array([r[1:] for r in ordination.pcoa(frame.repartition(32), 2).orderBy("Sample").collect()])
    centred = points - points.mean(axis=0)
    largest = np.sort(np.linalg.eigvalsh(centred.T @ centred))[::-1][:2]
    assert (found ** 2).sum(axis=0) == pytest.approx(largest, rel=1e-9)


def test_the_space_of_products_starts_again(monkeypatch):
    n, rng = 200, np.random.default_rng(8)
    q = np.linalg.qr(rng.normal(size=(n, n)))[0]
    q = np.linalg.qr(np.column_stack([np.ones(n), q[:, 1:]]))[0]
    values = np.r_[0.0, 5, 4.8, rng.uniform(-3, 3, n - 3)]
    matrix = (q * values) @ q.T
    monkeypatch.setattr(ordination, "START_VECTORS", 6)
    monkeypatch.setattr(ordination, "COMPONENT_CELLS", 2 * 30 * n)
    found, vectors = ordination._leading(lambda x: matrix @ x, n, 2)
    assert found == pytest.approx([5, 4.8], rel=1e-9)
    assert np.abs(vectors.T @ q[:, 1:3]).max(axis=1) == pytest.approx([1, 1], abs=1e-7)
