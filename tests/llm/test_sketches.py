"""Sketches of sets keep unrelated texts from being fetched, and never part linked ones."""

import random
from collections import Counter

import numpy as np

from simplexa.llm import jaccard
from tests.llm.test_operators import brute_components, rows


def test_sets_that_share_a_passage_are_not_fetched(spark, monkeypatch):
    """A passage in all texts makes keys common; only the sets of near copies are read and shuffled."""
    rng, sizes = random.Random(5), []
    passage = [f"p{i}" for i in range(60)]
    out = [(i, " ".join(passage + [f"w{rng.randrange(10**9)}" for _ in range(60)])) for i in range(40)]
    out += [(100 + i, out[i][1] + " end") for i in range(3)]
    whole = jaccard.kept

    def kept(df, label, *more):
        table = whole(df, label, *more)
        if label == "sets":
            sizes.append(table.count())
        return table

    monkeypatch.setattr(jaccard, "kept", kept)
    df = spark.createDataFrame(out, "doc_id long, text string").repartition(3)
    got = rows(jaccard.jaccard_components(df, 5, 80, 100))
    assert Counter((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got) == brute_components(out, 5, 80, 100)
    assert max(sizes) <= 6


def test_linked_sets_are_close():
    """Sets at the threshold, the larger one with a longer sketch or not, pass at every number of bits."""
    rng = np.random.default_rng(7)
    for num in (50, 80, 90):
        for size in (1, 2, 5, 31, 33, 40, 63, 65, 130, 400, 1030):
            whole = np.unique(rng.integers(0, 2**64 - 1, size, dtype=np.uint64))
            part = np.sort(rng.permutation(whole)[: -(-len(whole) * num // 100)])
            one, two = jaccard.sketch(whole), jaccard.sketch(part)
            words = min(len(one), len(two)) // 8
            assert jaccard.close(
                jaccard.folded(one, words), jaccard.folded(two, words), len(whole), len(part), num, 100)
            assert jaccard.block_edges([1, 2], [0, 0], [1, 2], [len(whole), len(part)], [one, two], num, 100) == [(2, 1)]
            assert jaccard.block_edges([1, 2], [0, 0], [1, 1], [len(whole), len(part)], [one, two], num, 100) == []
