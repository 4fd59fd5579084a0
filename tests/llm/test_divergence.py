"""The inverted index and the differences of sources against brute force."""

import random
import re
from collections import Counter, defaultdict

import pytest

from simplexa.llm import divergence

SCHEMA = "doc_id long, text string, lang string, source string, term string, item string, p string, shard string"
TERM = re.compile(rb"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def counts(rows, least):
    own, df, groups = defaultdict(Counter), Counter(), set()
    for lang, source, text in rows:
        lang, source = lang or "", source or ""
        found = [w.decode() for w in TERM.findall((text or "").encode().lower())]
        groups.add((lang, source))
        own[lang, source].update(found)
        df.update((lang, w) for w in set(found))
    kept = defaultdict(list)
    for (lang, w), n in df.items():
        if n >= least:
            kept[lang].append(w)
    return own, kept, groups


def brute(rows, least, top):
    own, kept, groups = counts(rows, least)
    out = []
    for lang in {g[0] for g in groups}:
        words, v = kept[lang], len(kept[lang])
        whole = Counter()
        for g in groups:
            if g[0] == lang:
                whole.update(own[g])

        def shares(c):
            n = sum(c[w] for w in words)
            return {w: 1 + 10**9 * (c[w] + 5) // (n + 5 * v) for w in words}

        q, p = shares(whole), {s: shares(own[lang, s]) for g, s in groups if g == lang}
        for s in p:
            pairs = sorted((-sum(abs(p[s][w] - p[t][w]) for w in words), t.encode()) for t in p if t != s)
            out += [(lang, s, "pair", t.decode(), -f, i + 1) for i, (f, t) in enumerate(pairs)]
            terms = sorted((q[w] - p[s][w], w.encode()) for w in words if own[lang, s][w] and p[s][w] > q[w])
            out += [(lang, s, "term", w.decode(), -f, i + 1) for i, (f, w) in enumerate(terms[:top])]
    return Counter(out)


def checked(spark, rows, least=3, top=5):
    table = spark.createDataFrame([(i, t, x, s, "a", "b", "c", "d") for i, (x, s, t) in enumerate(rows)], SCHEMA)
    got = divergence.source_divergence(table.repartition(4), least, top).collect()
    assert Counter((r.lang, r.source, r.part, r.item, r.value, r["rank"]) for r in got) == brute(rows, least, top)


def random_rows(seed, n=400, langs=("en", "de", None, ""), sources=6):
    rng = random.Random(seed)
    words = [f"w{chr(97 + i)}{'é' * (i % 3)}" for i in range(26)] + ["The", "THE", "ẞ", "İ", "x1y", "a`b"]
    rows = [(rng.choice(langs), rng.choice([None, *(f"s{i}" for i in range(sources))]),
             rng.choice(["", ".", " "]).join(rng.choices(words, k=rng.choice([0, 1, 3, 12])))) for _ in range(n)]
    return rows + [("en", "s1", None), ("lone", "s1", "no term is kept here"), ("lone", "s2", ""), *[("en", "s0", "hot the")] * 200]


@pytest.mark.parametrize("seed", [1, 2])
def test_divergence(spark, seed):
    checked(spark, random_rows(seed))


def test_no_rows_and_no_kept_terms(spark):
    checked(spark, [("en", "a", "one two"), ("en", "b", "")])
    assert divergence.source_divergence(spark.createDataFrame([], SCHEMA)).count() == 0


def test_runs_are_merged_whole(spark):
    """Blocks of a few tokens make many runs; the frequencies are those of one block."""
    rows = random_rows(5)
    table = spark.createDataFrame(rows, "lang string, source string, text string").repartition(3)
    own, kept, _ = counts(rows, 3)
    want = Counter({(lang, s, w): own[lang, s][w] for lang, s in own for w in kept[lang] if own[lang, s][w]})
    for settings in ({}, {"block_tokens": 20}, {"block_terms": 5}):
        got = divergence.term_frequencies(table, 3, **settings).collect()
        assert Counter({(r.lang, r.source, r.term): r.n for r in got}) == want
        assert len(got) == len(want)
        assert sum(r["head"] for r in got) == sum(map(len, kept.values()))


def test_pairs_of_many_sources_are_added_in_tiles(spark):
    """More sources than a task adds up at a time."""
    rng = random.Random(9)
    rows = [("en", f"s{i % 40}", " ".join(rng.choices("abcdefgh", k=6))) for i in range(400)]
    table = spark.createDataFrame(rows, "lang string, source string, text string")
    terms = divergence.term_frequencies(table, 3).collect()
    dealt = sorted((r.lang, r.term, r.source, 10 * r.n, 3) for r in terms)
    frame = spark.createDataFrame(dealt, "lang string, term string, source string, p long, rest long").coalesce(1)
    sums = [Counter() for _ in range(2)]
    for held, most in zip(sums, (512, 8)):
        for r in frame.mapInArrow(divergence.corrections(most), divergence.PAIRS).collect():
            held[r.source, r.item] += r.correction
    assert {k: v for k, v in sums[0].items() if v} == {k: v for k, v in sums[1].items() if v}


def test_long_texts_are_cut_at_spaces():
    text = b"ab cde  f " * 50
    for size in (1, 2, 7, 1000):
        parts = list(divergence.slices(text, size))
        assert b"".join(parts) == text
        assert [w for p in parts for w in p.split()] == text.split()
