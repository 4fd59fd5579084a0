"""Every SQL twin belongs to a query; a few pairs are run end to end."""

import math

import duckdb
import pytest

import __spark_entry__ as contract

FOLDER = "/root/testdata/sf0.001"
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels"
          " conversations").split()
CHECKED = ("f5_stratified_profile", "i2_clr", "k1_braycurtis", "l5_false_discovery", "g7_midranks", "n1_functions")


def test_twins_have_queries():
    assert set(contract.oracle_sql()) <= set(contract.queries())


def canonical(rows):
    def cell(v):
        if v is None or (isinstance(v, float) and math.isnan(v)):
            return "-"
        return repr(float(v)) if isinstance(v, (int, float)) and not isinstance(v, bool) else str(v)

    return sorted(tuple(cell(v) for v in r) for r in rows)


@pytest.mark.parametrize("name", CHECKED)
def test_query_equals_twin(spark, name):
    df = contract.queries()[name](spark, FOLDER)
    columns = sorted(df.columns)
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{FOLDER}/{t}.parquet'")
    picked = ", ".join(f'"{c}"' for c in columns)
    expected = con.execute(f"select {picked} from ({contract.oracle_sql()[name]})").fetchall()
    got = df.select(*columns).collect()
    assert len(got) > 0 and canonical(got) == canonical(expected)


def test_entry(spark):
    assert contract.entry(spark).limit(1).count() == 1
