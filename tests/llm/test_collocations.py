"""Phrases against brute force."""

import random
import re
import tracemalloc
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.errors import PySparkException

from simplexa.llm import collocations

SCHEMA = "doc_id long, text string, lang string, phrase string, words string, shard string, start string"


def frequencies(rows, longest):
    f, n = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", text):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for k in range(1, longest + 1):
                f[lang].update(" ".join(w[i : i + k]) for i in range(len(w) - k + 1))
    return f, n


def brute(rows, longest=3, threshold=10, top=2000, inside=50):
    out, (f, n) = [], frequencies(rows, longest)
    for lang, own in f.items():
        found = {p: a for p, a in own.items() if a >= threshold and " " in p}
        inner = defaultdict(int)
        for p, a in found.items():
            w = p.split(" ")
            for k in range(2, len(w)):
                for i in range(len(w) - k + 1):
                    q = " ".join(w[i : i + k])
                    inner[q] = max(inner[q], a)
        scored = []
        for p, a in found.items():
            if 100 * inner[p] >= inside * a and inner[p]:
                continue
            w = p.split(" ")
            parts = [(own[" ".join(w[:k])], own[" ".join(w[k:])], k) for k in range(1, len(w))]
            s, k, x, y = min((10**6 * a * a // (x * y), k, x, y) for x, y, k in parts)
            scored.append((-s, -a, p.encode(), x, y))
        out += [(lang, i + 1, p.decode(), -a, x, y, n[lang], -s)
                for i, (s, a, p, x, y) in enumerate(sorted(scored)[:top])]
    return Counter(out)


def random_rows(seed, n=300, width=7):
    rng = random.Random(seed)
    words = [*"abcdefg"[:width], "The", "THE", "é", "x-y", "\xa0", "(q)"]
    gaps = [" "] * 8 + ["\t", "  ", ". ", ",", "\n", "\x0b", ";", "!? "]
    rows = [(rng.choice(["en", "de", None, ""]),
             "".join(rng.choice(words) + rng.choice(gaps) for _ in range(rng.choice([0, 1, 2, 5, 30])))) for _ in range(n)]
    return rows + [("en", None), ("en", ""), ("xx", "."), ("long", "to and fro " * 3000), *[("en", "hot passage of words")] * 150]


def checked(spark, rows, **settings):
    table = spark.createDataFrame([(i, t, x, *"abcd") for i, (x, t) in enumerate(rows)], SCHEMA).repartition(3)
    got = collocations.collocations(table, **settings).collect()
    settings.pop("shards", None)
    assert Counter((r.lang, r["rank"], r.phrase, r.a, r.l, r.r, r.n, r.score) for r in got) == brute(rows, **settings)


@pytest.mark.parametrize("settings", [
    {}, {"shards": 3, "threshold": 4}, {"shards": 1, "threshold": 2, "longest": 4}, {"top": 3, "inside": 90, "longest": 2}])
def test_collocations(spark, settings):
    checked(spark, random_rows(len(settings)), **settings)


def test_words_that_reach_the_threshold_late(spark):
    """Phrases that start in the last step of a cycle, and so end two cycles later, are counted whole."""
    rng = random.Random(4)
    rows = [("en", f"rare{i} pair{i} ends{i}") for i in range(30) for _ in range(rng.choice([9, 10, 11]))]
    rng.shuffle(rows)
    checked(spark, rows, shards=5)


def test_no_rows(spark):
    assert collocations.collocations(spark.createDataFrame([], SCHEMA)).count() == 0


def found(frame):
    """Frequencies by language and phrase, and all words by language."""
    rows = frame.collect()
    words = {(r.lang, r.key[0]): r.word for r in rows if r.words == 1}
    return ({(r.lang, " ".join(words[r.lang, c] for c in r.key)): r.f for r in rows if r.words},
            {r.lang: r.f for r in rows if not r.words})


def wanted(rows, longest, threshold):
    f, n = frequencies(rows, longest)
    return {(x, p): a for x, own in f.items() for p, a in own.items() if a >= threshold}, dict(n)


def test_filters_that_let_all_pass_change_nothing(spark, monkeypatch):
    def blind(parts, filters):
        for each in filters:
            each.bits[:] = 255
        return filters

    monkeypatch.setattr(collocations, "assembled", blind)
    rows = random_rows(8, 120)
    table = spark.createDataFrame(rows, "lang string, text string")
    assert found(collocations.frequent_phrases(table, 3, 5, 2)) == wanted(rows, 3, 5)


def test_words_with_one_code_are_told_apart(spark, monkeypatch):
    """Two words with one code are seen, and the steps run again with other codes."""
    keys, ones = np.array([[5], [7], [5]], np.uint64), np.ones(3, np.int64)
    summed = collocations.summed(keys, ones, ones, [b"a", b"b", b"a"])
    assert sorted(zip(summed[0][:, 0].tolist(), summed[1].tolist(), summed[3])) == [(5, 2, b"a"), (7, 1, b"b")]
    with pytest.raises(ValueError, match=collocations.CLASH):
        collocations.summed(keys, ones, ones, [b"a", b"b", b"c"])
    tried = []

    def clashing(*args, run=collocations._frequent):
        tried.append(args[-1])
        if len(tried) < 3:
            raise PySparkException(f"... {collocations.CLASH} ...")
        return run(*args)

    monkeypatch.setattr(collocations, "_frequent", clashing)
    rows = random_rows(3, 40)
    table = spark.createDataFrame(rows, "lang string, text string")
    assert found(collocations.frequent_phrases(table, 2, 3, 2)) == wanted(rows, 2, 3)
    assert tried == [0, 1, 2]


def test_phrases_with_one_hash_are_told_apart(monkeypatch):
    rng = np.random.default_rng(1)
    keys, f = rng.integers(0, 3, (200, 2)).astype(np.uint64), rng.integers(1, 9, 200)
    monkeypatch.setattr(collocations, "joined", lambda k: k[:, 0] * np.uint64(0))
    got, sums, first, _ = collocations.summed(keys, f, np.arange(200), None)
    want = Counter()
    for k, n in zip(map(tuple, keys.tolist()), f.tolist()):
        want[k] += n
    assert dict(zip(map(tuple, got.tolist()), sums.tolist())) == want


def test_blocks_of_a_few_words(spark):
    """Blocks that end inside documents count every phrase across their ends once."""
    rows = random_rows(11, 60) + [("en", "one two three four " * 40)]
    table = spark.createDataFrame(rows, "lang string, text string").na.fill({"lang": "und", "text": ""})
    full = [collocations.Filter(1 << 15, 4, k) for k in (1, 2, 3)]
    for each in full:
        each.bits[:] = 255
    sums = []
    for size in (6_000_000, 1, 7, 30):
        held = Counter()
        run = collocations.counted(4, collocations.Known(full, [None] * 3), True, 4, 0, size)
        for r in table.mapInArrow(run, collocations.COUNTS).collect():
            keys = np.frombuffer(r.keys, np.uint64).reshape(-1, max(1, r.words)) if r.words else np.zeros((1, 0))
            for key, f in zip(map(tuple, keys.tolist()), np.frombuffer(r.f, np.int64).tolist()):
                held[r.lang, r.words, key] += f
        sums.append(held)
    f, n = frequencies(rows, 4)
    assert sum(sums[0].values()) == sum(sum(own.values()) for own in f.values()) + sum(n.values())
    assert all(s == sums[0] for s in sums[1:])


def test_long_texts_are_cut_between_words():
    text = b"ab cde  f. g" * 50
    for size in (1, 2, 7, 1000):
        assert b"".join(collocations.slices(text, size)) == text
        parts = [p.replace(b".", b" . ").split() for p in collocations.slices(text, size)]
        assert sum(parts, []) == text.replace(b".", b" . ").split()


def test_a_block_of_texts_takes_little_memory():
    """The arrays that counting holds at once were 201 MB here, and are 110 MB."""
    rng = np.random.default_rng(2)
    texts = [" ".join(f"w{w}" for w in rng.zipf(1.5, 200_000) % 50_000) + "." for _ in range(10)]
    batch = pa.RecordBatch.from_arrays([pa.array(["en"] * 10), pa.array(texts)], names=["lang", "text"])
    size = 1 << 20
    full = [collocations.Filter(size, 4, k) for k in (1, 2)]
    for each in full:
        each.bits[:] = 255
    known = collocations.Known(full, [None, None])
    tracemalloc.start()
    found = sum(np.frombuffer(b["f"][i].as_py(), np.int64).sum() for b in collocations.counted(3, known, True, 8, 0)(
        iter([batch])) for i, k in enumerate(b["words"].to_pylist()) if k == 3)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert found == sum(max(0, len(t.split()) - 2) for t in texts)
    assert peak < 150e6


def test_slots_are_dealt_by_levels(spark, monkeypatch):
    """With more slots than a bundle is dealt to, sums are dealt on: once, or several times."""
    rows = random_rows(9, 150)
    table = spark.createDataFrame(rows, "lang string, text string").repartition(3)
    for fan, counts in ((8, [8, 64]), (4, [4, 16, 64])):
        monkeypatch.setattr(collocations, "FAN", fan)
        monkeypatch.setattr(collocations, "SLOT_BYTES", sum(len((t or "").encode()) for _, t in rows) // 60)
        assert collocations.fans(60) == counts
        assert found(collocations.frequent_phrases(table, 3, 5, 2)) == wanted(rows, 3, 5)


def test_rows_of_counts_grow_with_the_texts(monkeypatch):
    """Eight times the texts, and with them eight times the slots, made 64 times the rows."""
    monkeypatch.setattr(collocations, "FAN", 16)
    rng, full = np.random.default_rng(5), [collocations.Filter(1 << 15, 4, k) for k in (1, 2)]
    for each in full:
        each.bits[:] = 255
    known, made, sums = collocations.Known(full, [None, None]), [], []
    for times in (1, 8):
        texts = [" ".join(f"w{w}" for w in rng.integers(0, 400, 2000)) for _ in range(8 * times)]
        batch = pa.RecordBatch.from_arrays(
            [pa.array(["en", "de"] * (4 * times)), pa.array(texts)], names=["lang", "text"])
        counts = collocations.fans(16 * times)
        run = collocations.bundled(collocations.counted(3, known, True, counts[0], 0, 10_000), 100_000)
        bundles = pa.Table.from_batches(run(iter([batch])))
        held = pa.chunked_array([x.flatten().field("f") for x in bundles.column("counts").chunks])
        made.append(len(bundles))
        sums.append(sum(np.frombuffer(f, np.int64).sum() for f in held.to_pylist()))
        assert sums[-1] == sum(2000 + 2000 + 1999 + 1998 for _ in texts)
    assert made[1] <= 12 * made[0]
    assert max(collocations.fans(n)[0] for n in range(1, 5000)) <= 16
