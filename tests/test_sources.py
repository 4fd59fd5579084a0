import gzip
import os

import pytest

from simplexa.sources import delimited, sinks
from simplexa.sources.shared import shared_folder, stored
from tests.helpers import rows


def write(path, text, zipped=False):
    with (gzip.open(path, "wt") if zipped else open(path, "w")) as f:
        f.write(text)
    return str(path)


def test_read_table_types_and_nulls(spark, tmp_path):
    text = "id\tn\tx\tmixed\nA\t1\t1.5\t3\nB\tNA\tnan\tq\nnull\t3\t2\t\n"
    for name, zipped in (("t.tsv", False), ("t.tsv.gz", True)):
        df = delimited.read_table(spark, write(tmp_path / name, text, zipped))
        assert dict(df.dtypes) == {"id": "string", "n": "bigint", "x": "double", "mixed": "string"}
        assert df.collect()[1] == ("B", None, None, "q")
        assert df.filter("id is null").first() == (None, 3, 2.0, None)
    csv = delimited.read_table(spark, write(tmp_path / "t.csv", "a,b\n1,2\n"))
    assert rows(csv) == [(1, 2)]
    typed = delimited.read_table(spark, write(tmp_path / "u.tsv", "a\tb\n1\tNA\n"), schema=csv.schema)
    assert typed.first() == (1, None)


def test_read_metadata(spark, tmp_path):
    df = delimited.read_metadata(spark, write(tmp_path / "m.tsv", "#SampleID\tg\tpH\nS1\tNaN\t7.0\nS2\tx\tNA\n"))
    assert df.columns == ["Sample", "g", "pH"] and rows(df.filter("g is null")) == [("S1", None, 7.0)]


def test_exported_counts_with_and_without_banner(spark, tmp_path):
    body = "#OTU ID\tS1\tS2\nA\t1.0\t0.0\nB\t2.0\t5.0\n"
    for name, text in (("a.tsv", "# Constructed from biom file\n" + body), ("b.tsv", body)):
        df = delimited.read_exported_counts(spark, write(tmp_path / name, text))
        assert df.columns == ["#OTU ID", "S1", "S2"]
        assert rows(df) == [("A", 1.0, 0.0), ("B", 2.0, 5.0)]
    assert delimited.item_column(df) == "#OTU ID"


def test_predictions_and_taxonomy(spark, tmp_path):
    p = write(tmp_path / "p.tsv.gz", "# made by a tool\nfunction\tS1\nko:K00001\t4\n", True)
    df = delimited.read_predictions(spark, p, first_name="KO")
    assert df.columns == ["KO", "S1"] and rows(df) == [("ko:K00001", 4)]
    t = write(tmp_path / "t.tsv", "#OTU/ASV_ID\ttaxonomy\tconfidence\nA\tk__B; p__P\t0.9\n")
    df = delimited.read_taxonomy(spark, t)
    assert df.columns == ["OTU/ASV_ID", "taxonomy", "confidence"] and rows(df) == [("A", "k__B; p__P", 0.9)]


def test_sinks(spark, tmp_path, sample_run):
    long, _ = sample_run
    path = str(tmp_path / "out")
    sinks.write_text(long, path, ["FeatureID", "Sample"], gzip=True)
    assert any(f.endswith(".csv.gz") for f in os.listdir(path))
    assert delimited.read_table(spark, path).count() == 30
    by = str(tmp_path / "by")
    sinks.write_by_taxon(long, by, "FeatureID", ["Sample"])
    assert "FeatureID=Feat_A" in os.listdir(by)
    flat = str(tmp_path / "flat")
    sinks.write_table(long, flat, ["Sample"])
    assert spark.read.parquet(flat).count() == 30


def test_stored_tables_go_to_the_shared_folder(spark):
    df = stored(spark.range(5))
    assert df.count() == 5
    assert df.inputFiles()[0].removeprefix("file:").lstrip("/").startswith(
        shared_folder(spark).removeprefix("file:").lstrip("/"))


def test_layouts_of_wide_tables(spark):
    by_feature = spark.createDataFrame([("T|a", 10, 5, 15), ("b", 15, 20, 0)], "Lv3 string, S1 int, S2 int, S3 int")
    by_sample = spark.createDataFrame(
        [("S1", 10.0, 15.0), ("S2", 5.0, 20.0), ("S3", 15.0, 0.0)], "id string, T_a double, b double")
    one = sinks.wide_layouts(by_feature, "Lv3", by_feature=True, split=True, export_by_feature=True)
    two = sinks.wide_layouts(by_sample, "id", by_feature=False)
    assert set(one) == {"raw_wide_N_D", "clr", "clr_wide_N_D", "clr_wide_D_N_split", "raw_wide_D_N"}
    assert set(two) == {"raw_wide_N_D", "clr", "clr_wide_N_D"}
    for name in two:
        if name != "clr":
            assert one[name].columns == ["Sample", "T_a", "b"]
            assert sorted(map(tuple, one[name].collect())) == sorted(map(tuple, two[name].collect()))
    logs = {r["Sample"]: r["T_a"] for r in two["clr_wide_N_D"].collect()}
    assert abs(logs["S1"] + 0.20273) < 1e-4 and abs(logs["S2"] + 0.69315) < 1e-4


def test_a_cluster_needs_the_shared_folder():
    class Context:
        master = "local-cluster[2,1,1024]"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()
        conf = {}

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_folder(Session())
