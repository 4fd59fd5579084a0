"""The pipeline stage by stage against brute force, and the keys of the near-duplicate stage."""

import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

import corpus_pipeline
from simplexa.llm import jaccard
from simplexa.llm.components import components
from tests.llm.conftest import FOLDER
from tests.llm.test_operators import brute_components, brute_hits, brute_spans, check_packing, rows, texts


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """What each stage returned, written and read again."""
    docs, out = spark.read.parquet(f"{FOLDER}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path_factory.mktemp(name) / "table")
        stage(spark, docs, FOLDER).write.parquet(path)
        before, docs = docs, spark.read.parquet(path)
        out.append((name, before, docs))
    return out


def test_columns_and_order(stages):
    assert [name for name, *_ in stages] == ["language", "near_duplicates", "decontamination", "personal_data", "packing"]
    first = stages[0][1].columns
    assert all(after.columns == first for _, _, after in stages[:-1])


def test_language_keeps_documents_with_letters(stages):
    _, before, after = stages[0]
    kept = {i for i, _ in texts(after)}
    for i, t in texts(before):
        assert i in kept or not any(c.isalpha() for c in t) or len(t.split()) < 5


def test_one_of_each_near_duplicate_stays(stages):
    _, before, after = stages[1]
    found = brute_components(texts(before), 5, 80, 100)
    assert Counter(i for i, _ in texts(after)) == Counter({i: 1 for i, _, c in found if i == c})
    own = dict(texts(before))
    assert all(own[i] == t for i, t in texts(after))


def test_contaminated_documents_go(stages, benchmark):
    _, before, after = stages[2]
    items = [(str(r["item_id"]), r["text"]) for r in benchmark.collect()]
    want = {i for (i, *_, bad) in brute_hits(texts(before), items) if not bad}
    assert {i for i, _ in texts(after)} == want


def test_personal_data_goes_and_the_rest_stays(stages):
    _, before, after = stages[3]
    left, n = dict(texts(after)), 0
    assert len(left) == before.count()
    for i, t in texts(before):
        spans = brute_spans(t)
        n += len(spans)
        if not spans:
            assert left[i] == t or "[" in left[i]
        assert not brute_spans(left[i])
    assert n > 0


def test_all_that_is_left_is_packed(stages):
    _, before, after = stages[4]
    got = rows(after)
    check_packing(got, 1024)
    assert {r["doc_id"] for r in got} == {i for i, _ in texts(before)}


def test_run_is_all_stages(spark, stages):
    want = Counter((r["doc_id"], r["piece"], r["length"], r["ids_crc32"]) for r in rows(stages[-1][2]))
    got = Counter((r["doc_id"], r["piece"], r["length"], r["ids_crc32"]) for r in rows(corpus_pipeline.run(spark, FOLDER)))
    assert got == want


@pytest.mark.parametrize("k,num", [(5, 80), (3, 90)])
def test_unrelated_texts_share_no_keys(k, num):
    """Candidates come from what sets hold, never from what they lack."""
    rng, bands = random.Random(1), jaccard.Bands(num, 100)
    some = pa.array([" ".join(f"w{rng.randrange(10**7)}" for _ in range(rng.randrange(60, 91))) for _ in range(3000)])
    keys = Counter()
    for grams in jaccard.sets_of(some, k):
        keys.update(jaccard.segments(grams, bands).tolist())
    assert max(keys.values()) == 1


def test_partners_share_a_key():
    """Sets over the threshold that differ as much and as unevenly as they may, with empty segments on every level."""
    rng = np.random.default_rng(3)
    for num in (80, 90, 50):
        bands = jaccard.Bands(num, 100)
        for size in [*range(1, 40), 100, 400]:
            for spread in (2**64 - 1, 2**60, 2**44):
                whole = np.unique(rng.integers(0, spread, size, dtype=np.uint64))
                n = len(whole)
                gone = n - -(-n * num // 100)  # a subset at exactly the threshold
                part = np.delete(whole, np.sort(rng.permutation(n)[:gone]))
                if not len(part):
                    continue
                one, two = jaccard.segments(whole, bands), jaccard.segments(part, bands)
                assert set(one.tolist()) & set(two.tolist()), (num, size, spread)


def test_components_of_a_long_path(spark):
    n = 400
    edges = spark.createDataFrame([(i, i + 1) for i in range(n)], "a long, b long").repartition(4)
    found = {r["node"]: r["component"] for r in components(edges).collect()}
    assert found == {i: 0 for i in range(n + 1)}
