import math

import pytest
from pyspark.sql import functions as F

from simplexa.operators import filters, joins, profile, reshape, taxonomy
from simplexa.plans import composed
from simplexa.sources import traits
from tests.helpers import mapping, rows

ITEMS = "ASV_ID string, Genus string, Sample_1 long, Sample_2 long"
TABLE = [("A1", "GenusA", 10, 0), ("A2", "GenusA", 5, 15), ("A3", "GenusB", 0, 20),
         ("A4", None, 8, 0), ("A5", "GenusB", 2, 0)]
COPIES = [("A1", 1.0, 0.0), ("A2", 2.0, 3.0), ("A3", 0.0, 5.0), ("A4", 4.0, 0.0)]
MAP = [("ko:K001", "PGPT_A"), ("ko:K002", "PGPT_A"), ("ko:K002", "PGPT_B")]


@pytest.fixture()
def tables(spark):
    wide = spark.createDataFrame(TABLE, ITEMS)
    counts = reshape.to_long(wide.drop("Genus"), "ASV_ID")
    copies = reshape.to_long(
        spark.createDataFrame(COPIES, "ASV_ID string, `ko:K001` double, `ko:K002` double"),
        "ASV_ID", name="KO", value="copy_num",
    )
    return counts, copies, wide.select("ASV_ID", "Genus"), spark.createDataFrame(MAP, "KO string, Lv3 string")


def test_taxon_tables(tables):
    counts, copies, lineage, _ = tables
    got = mapping(profile.taxon_abundance(counts, lineage, "Genus"), ["Genus", "Sample"], "Value")
    assert got == {("GenusA", "Sample_1"): 15, ("GenusA", "Sample_2"): 15,
                   ("GenusB", "Sample_1"): 2, ("GenusB", "Sample_2"): 20}
    kept = profile.taxon_abundance(counts, lineage, "Genus", keep_unclassified=True)
    assert mapping(kept, ["Genus", "Sample"], "Value")["Unclassified_Genus", "Sample_1"] == 8
    means = mapping(profile.taxon_copies(copies, lineage, "Genus"), ["Genus", "KO"], "copy_num")
    assert means == {("GenusA", "ko:K001"): 1.5, ("GenusA", "ko:K002"): 3.0,
                     ("GenusB", "ko:K002"): 5.0, (None, "ko:K001"): 4.0}


@pytest.mark.parametrize("hot_rows", [1, 2_000_000])
def test_stratified_profile_with_split_keys(tables, hot_rows, monkeypatch):
    counts, copies, lineage, trait_map = tables
    split = joins.fanout_join
    monkeypatch.setattr(
        profile, "fanout_join", lambda *a, **k: split(*a, **{**k, "hot_rows": hot_rows})
    )
    expected = {("GenusA", t, s): v for t, v in (("PGPT_A", 67.5), ("PGPT_B", 45.0))
                for s in ("Sample_1", "Sample_2")}
    expected |= {("GenusB", t, s): v for t in ("PGPT_A", "PGPT_B")
                 for s, v in (("Sample_1", 10.0), ("Sample_2", 100.0))}
    got = profile.stratified_profile(counts, copies, lineage, trait_map, "Genus", "Lv3")
    assert mapping(got, ["Genus", "Lv3", "Sample"], "Value") == expected
    # Null taxa match each other when they are let through.
    totals = counts.filter("Value > 0").join(lineage, "ASV_ID").groupBy("Genus", "Sample").agg(
        F.sum("Value").alias("Value"))
    got = profile.stratify(totals, profile.taxon_copies(copies, lineage, "Genus"), trait_map, "Genus", "Lv3")
    assert mapping(got, ["Genus", "Lv3", "Sample"], "Value") == expected | {(None, "PGPT_A", "Sample_1"): 32.0}


MARKER = [("ASV1", 2.0, 0.5, "g1"), ("ASV2", 1.0, 1.0, "g2"), ("ASV3", 0.0, 0.1, "g3"), ("ASV4", 1.0, 5.0, "g4")]


@pytest.fixture()
def marked(spark):
    counts = reshape.to_long(
        spark.createDataFrame([("ASV1", 100, 20), ("ASV2", 50, 0), ("ASV3", 0, 30), ("ASV5", 1, 1)],
                              "ASV_ID string, SampleA long, SampleB long"), "ASV_ID")
    marker = spark.createDataFrame(
        MARKER, "ASV_ID string, marker_copies double, metadata_NSTI double, closest_reference_genome string")
    copies = spark.createDataFrame(
        [("ASV1", "ko:K00001", 2.0), ("ASV2", "ko:K00002", 2.0), ("ASV3", "ko:K00001", 1.0), ("ASV1", "EC:1", 9.0)],
        "ASV_ID string, KO string, copy_num double")
    return counts, marker, copies


def test_marker_normalisation(marked):
    counts, marker, copies = marked
    kept = filters.within_nsti(marker, 2.0)
    assert kept.columns == ["ASV_ID", "marker_copies"] and kept.count() == 3
    normal = mapping(profile.normalise_by_marker(counts, kept), ["ASV_ID", "Sample"], "Value")
    assert normal["ASV1", "SampleA"] == 50 and normal["ASV1", "SampleB"] == 10
    assert normal["ASV2", "SampleA"] == 50 and normal["ASV2", "SampleB"] == 0
    assert math.isnan(normal["ASV3", "SampleA"]) and normal["ASV3", "SampleB"] == math.inf


def test_function_profile_keeps_or_drops_zero_markers(marked):
    normal, table = composed.predicted_functions(*marked, max_nsti=2.0, prefix="ko:")
    got = mapping(table, ["KO", "Sample"], "Value")
    assert math.isnan(got["ko:K00001", "SampleA"]) and got["ko:K00001", "SampleB"] == math.inf
    assert got["ko:K00002", "SampleA"] == 100
    assert {r[0] for r in normal.select("ASV_ID").distinct().collect()} == {"ASV1", "ASV2", "ASV3"}
    _, table = composed.predicted_functions(*marked, max_nsti=2.0, prefix="ko:", on_zero_marker="drop")
    assert mapping(table, ["KO", "Sample"], "Value") == {
        ("ko:K00001", "SampleA"): 100, ("ko:K00001", "SampleB"): 20, ("ko:K00002", "SampleA"): 100}


def test_trait_first_equals_function_first(spark, marked):
    counts, marker, copies = marked
    normal, table = composed.predicted_functions(counts, marker, copies, 2.0)
    tm = spark.createDataFrame([("ko:K00001", "x"), ("ko:K00001", "y"), ("ko:K00002", "x")], "KO string, t string")
    one = mapping(profile.trait_profile(table, tm, "t"), ["t", "Sample"], "Value")
    two = mapping(profile.trait_profile_direct(normal, copies.filter("KO like 'ko:%'"), tm, "t"), ["t", "Sample"], "Value")
    assert set(one) == set(two)
    for k in one:
        assert one[k] == two[k] or (math.isnan(one[k]) and math.isnan(two[k]))


def test_rounding_is_half_to_even(spark):
    counts = spark.createDataFrame([("a", "s", 1.0), ("b", "s", 3.0), ("c", "s", None)], "ASV_ID string, Sample string, Value double")
    marker = spark.createDataFrame([(i, 8.0) for i in "abc"], "ASV_ID string, marker_copies double")
    got = mapping(profile.normalise_by_marker(counts, marker), "ASV_ID", "Value")
    assert got == {"a": 0.12, "b": 0.38, "c": None}


LINEAGES = {
    "full": ("k__Bacteria; p__Firmicutes; c__Bacilli; o__Lacto; f__Fam; g__Gen; s__spec",
             ["Bacteria", "Firmicutes", "Bacilli", "Lacto", "Fam", "Gen", "spec"]),
    "short": ("d__Bacteria; p__Firmicutes", ["Bacteria", "Firmicutes"] + [None] * 5),
    "blank": ("k__Bacteria; p__Firmicutes; c__C; o__O; f__F; g__; s__", ["Bacteria", "Firmicutes", "C", "O", "F", None, None]),
    "codes": ("Bacteria; Firmicutes; c__BAC-1; o__; f__; g__UBA12; s__",
              ["Bacteria", "Firmicutes", "Firmicutes-BAC-1", None, None, "Firmicutes-UBA12", None]),
    "top code": ("k__A1; p__B2", ["A1", "B2"] + [None] * 5),
    "none": (None, [None] * 7),
    "empty": ("", [None] * 7),
}


def test_lineage(spark):
    df = spark.createDataFrame([(k, v[0]) for k, v in LINEAGES.items()], "id string, taxonomy string")
    named = taxonomy.name_codes(taxonomy.split_lineage(df))
    for r in named.collect():
        assert [r[c] for c in taxonomy.LINEAGE_LEVELS] == LINEAGES[r["id"]][1], r["id"]


def test_trait_map(spark):
    raw = spark.createDataFrame(
        [("P1-K00001", "a"), ("P2-K00002", "b"), ("P2b-K00002", "b"), ("P3-K00003", None), ("P4-invalid", "c"), ("P5-K00005", "c")],
        "PGPT_ID string, Lv3 string")
    assert rows(traits.trait_map(raw, "Lv3")) == [("ko:K00001", "a"), ("ko:K00002", "b"), ("ko:K00005", "c")]


def test_tables_from_composed_plans(spark, tables):
    counts, copies, lineage, _ = tables
    raw = spark.createDataFrame([("x-K00001", "t")], "PGPT_ID string, Lv3 string")
    with pytest.raises(ValueError, match="no functions matched"):
        composed.stratified_table(counts, copies, lineage, raw, "Genus", "Lv3")
    tax = spark.createDataFrame([("A1", "k__B; p__P"), ("A2", "k__A")], "ASV_ID string, taxonomy string")
    merged = composed.lineage_table(counts, tax).collect()
    assert merged[0]["Kingdom"] == "A" and merged[-1]["Kingdom"] is None and len(merged) == 10


def test_all_profiles(spark, marked):
    counts, marker, copies = marked
    tax = spark.createDataFrame([("ASV1", "k__B; p__P; g__G"), ("ASV2", "k__B; p__Q")], "ASV_ID string, taxonomy string")
    raw = spark.createDataFrame([("P1-K00001", "x"), ("P2-K00002", "x")], "PGPT_ID string, Lv3 string")
    settings = dict(max_nsti=2.0, prefix="ko:", on_zero_marker="drop")
    done = composed.profiles(counts, marker, copies, tax, raw, "Lv3", **settings)
    assert mapping(done.traits, ["Lv3", "Sample"], "Value") == {("x", "SampleA"): 200, ("x", "SampleB"): 20}
    assert done.functions.count() == 3 and done.stratified is None and done.failure is None
    assert done.lineage.filter("Phylum = 'Q'").count() == 2
    with_taxa = composed.profiles(counts, marker, copies, tax, raw, "Lv3", "Phylum", **settings)
    got = mapping(with_taxa.stratified, ["Phylum", "Lv3", "Sample"], "Value")
    assert got["P", "x", "SampleA"] == 100 and got["Q", "x", "SampleA"] == 100
    # Nothing matches in the stratified part: the others are there, and the reason.
    lost = composed.profiles(counts, marker, copies, tax, raw.filter("false"), "Lv3", "Phylum", **settings)
    assert lost.stratified is None and "no functions matched" in lost.failure
    assert lost.functions.count() == 3 and lost.lineage.count() == done.lineage.count()
