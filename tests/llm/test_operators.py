"""The operators against brute force, on the smallest table and on odd rows."""

import hashlib
import re
import time
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from simplexa.llm import (
    decontamination,
    fingerprints,
    jaccard,
    language,
    licenses,
    packing,
    personal,
    repeats,
    sharding,
    tokens,
)

BPE = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="session")
def library():
    return Tokenizer.from_file(BPE)


def rows(df):
    return [r.asDict() for r in df.collect()]


def texts(df):
    return [(r["doc_id"], r["text"] or "") for r in df.select("doc_id", "text").collect()]


@pytest.fixture(params=["docs", "odd", "empty"])
def table(request):
    return request.getfixturevalue(request.param)


def test_shards(table):
    got, n = rows(sharding.shard_table(table)), table.count()
    assert Counter((r["doc_id"], r["text_crc32"], r["size"]) for r in got) == Counter(
        (i, zlib.crc32(t.encode()), len(t.encode()) + 1) for i, t in texts(table))
    held = defaultdict(list)
    for r in got:
        assert r["law"] == "bytes" and r["grown_shard"] is None and 0 <= r["shard"] < 8
        held[r["shard"]].append(r)
    for own in held.values():
        assert sorted(r["slot"] for r in own) == list(range(len(own)))
    if n > 100:
        total, largest = sum(r["size"] for r in got), max(r["size"] for r in got)
        assert all(abs(sum(r["size"] for r in own) - total / 8) <= 2 * largest for own in held.values())
        assert len(held) == 8


def test_token_counts(table, library, spark, tmp_path):
    got = rows(tokens.token_count_table(table, BPE))
    want = Counter((i, len(t.encode()), n := len(library.encode(t, add_special_tokens=False).ids), n > 1024)
                   for i, t in texts(table))
    assert Counter((r["doc_id"], r["n_bytes"], r["n_tokens"], r["over_limit"]) for r in got) == want


def test_token_cache_is_read_and_grows(docs, spark, tmp_path):
    cache = str(tmp_path / "cache")
    some = docs.where("doc_id < 20")
    first = tokens.token_counts(some, BPE, cache).count()
    held = spark.read.parquet(cache).count()
    assert first == 20 and held == some.select("text").distinct().count()
    # What is stored is believed, so a changed count shows that nothing was encoded anew.
    version = tokens.version_of(BPE)
    false = str(tmp_path / "false")
    spark.read.parquet(cache).withColumn("n_tokens", tokens.F.lit(7).cast("long")).write.parquet(false)
    assert {r["n_tokens"] for r in tokens.token_counts(some, BPE, false).collect()} == {7}
    tokens.token_counts(docs, BPE, cache).count()
    stored = spark.read.parquet(cache)
    assert stored.count() == stored.select("digest").distinct().count() == docs.select("text").distinct().count()
    assert stored.select("version").distinct().collect()[0][0] == version


def test_counts_of_a_sentencepiece_model(odd):
    import sentencepiece

    path = public_tokenizers.path("piece_bpe_32k.model")
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    got = rows(tokens.token_count_table(odd, path))
    assert Counter((r["doc_id"], r["n_tokens"]) for r in got) == Counter(
        (i, len(model.encode(t))) for i, t in texts(odd))


def check_packing(got, limit):
    by = defaultdict(list)
    for r in got:
        by[r["sequence_id"]].append((r["offset"], r["length"]))
    for pieces in by.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= limit
    return len(by)


def test_packing(table, library):
    got = rows(packing.packed_documents(table, BPE))
    want = Counter()
    for i, t in texts(table):
        ids = np.array(library.encode(t, add_special_tokens=False).ids + [2], "<u4")
        start, stop, piece = 0, len(ids) % 1024 or 1024, 0
        while start < len(ids):
            want[i, piece, start, stop - start, zlib.crc32(ids[start:stop].tobytes())] += 1
            start, stop, piece = stop, stop + 1024, piece + 1
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got) == want
    used = check_packing(got, 1024)
    counts = np.bincount([r["length"] for r in got], minlength=1025)
    assert used <= packing.lower_bound(counts, 1024) + 1


def test_parts_exchange_documents(spark):
    rng = np.random.default_rng(3)
    lengths = rng.integers(1, 60, 4000).tolist() + [100] * 30
    pieces = spark.createDataFrame(
        [(i, 0, 0, n, 1) for i, n in enumerate(lengths)],
        "doc_id long, piece int, start long, length long, ids_crc32 long")
    got = rows(packing.pack(pieces, 100, task_pieces=300))
    assert sorted(r["doc_id"] for r in got) == list(range(len(lengths)))
    used = check_packing(got, 100)
    assert used <= packing.lower_bound(np.bincount(lengths, minlength=101), 100) + 2


def test_bounds_never_exceed_a_packing():
    rng = np.random.default_rng(5)
    for _ in range(60):
        lengths = rng.integers(1, 51, rng.integers(1, 40))
        _, _, fills = packing.best_fit_decreasing(lengths, 50)
        assert packing.lower_bound(np.bincount(lengths, minlength=51), 50) <= len(fills)
    assert packing.lower_bound(np.bincount([30] * 7, minlength=51), 50) == 7


def test_fingerprints(table):
    got = rows(fingerprints.fingerprint_table(table, per_range=20))
    ordered = sorted(texts(table), key=lambda x: (x[0] is not None, x[0] or 0))
    if len({i for i, _ in ordered}) == len(ordered):
        want = {}
        for (i, t), (_, after) in zip(ordered, ordered[1:] + ordered[:1]):
            half = len(t) // 2
            want[i] = (len(t), hashlib.sha256((t[: len(t) - half] + after[:half]).encode()).hexdigest())
        assert {r["doc_id"]: (r["n_chars"], r["edited_sha256"]) for r in got} == want
    assert len(got) == len(ordered)
    by_text, of = defaultdict(set), defaultdict(set)
    for i, t in ordered:
        of[i].add(t)
    for r in got:
        assert 0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1
        if len(of[r["doc_id"]]) == 1:
            by_text[next(iter(of[r["doc_id"]]))].add(r["fingerprint"])
    assert all(len(x) == 1 for x in by_text.values())
    if len(got) > 100:
        assert np.mean([r["near_edited"] for r in got]) > np.mean([r["near_next"] for r in got]) + 0.25


def order_minhash(text, k=2, n=64, chosen=2):
    """The rows that are filled, and which pairs of texts agree, by the definition (another hash)."""
    words = text.split()
    grams = [" ".join(words[i : i + k]) for i in range(len(words) - k + 1)] or ([" ".join(words)] if words else [])
    seen, out = Counter(), defaultdict(list)
    for place, g in enumerate(grams):
        h = int(hashlib.sha256(f"{g}|{seen[g]}".encode()).hexdigest()[:16], 16)
        seen[g] += 1
        out[h % n].append((h, place))
    return {r: tuple(h for h, _ in sorted(sorted(x)[:chosen], key=lambda y: y[1])) for r, x in out.items()}


def test_likeness_follows_the_definition(spark):
    rng = np.random.default_rng(1)
    words = [f"v{i}" for i in range(400)]
    pairs = []
    for share in (0.0, 0.05, 0.2, 0.5):
        for _ in range(15):
            a = rng.choice(words, 300).tolist()
            b = [w if rng.random() > share else str(rng.choice(words)) for w in a]
            pairs.append((share, " ".join(a), " ".join(b)))
    df = spark.createDataFrame(pairs, "share double, a string, b string")
    F = fingerprints.F
    got = rows(df.select("share", fingerprints.likeness(
        fingerprints.fingerprint(F.col("a")), fingerprints.fingerprint(F.col("b"))).alias("near")))
    mean = {s: np.mean([r["near"] for r in got if r["share"] == s]) for s in (0.0, 0.05, 0.2, 0.5)}
    brute = {}
    for share, a, b in pairs:
        x, y = order_minhash(a), order_minhash(b)
        j = (sum(x.get(r) == y.get(r) for r in {*x, *y}) / max(1, len({*x, *y}))) ** 0.5
        brute.setdefault(share, []).append(2 * j / (1 + j))
    assert mean[0.0] == 1 and all(abs(mean[s] - np.mean(brute[s])) < 0.06 for s in mean)


def test_order_of_words_counts(spark):
    F = fingerprints.F
    block = [f"u{i}" for i in range(200)]
    df = spark.createDataFrame([(" ".join(block), " ".join(block[100:] + block[:100]))], "a string, b string")
    near = df.select(fingerprints.likeness(
        fingerprints.fingerprint(F.col("a")), fingerprints.fingerprint(F.col("b")))).first()[0]
    assert near < 0.9  # a set of 2-mers would give 0.99


def shingle_set(text, k):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + k]) for i in range(len(words) - k + 1)) or frozenset([tuple(words)])


def brute_components(pairs, k, num, den):
    sets = [(i, shingle_set(t, k)) for i, t in pairs]
    root = list(range(len(sets)))

    def top(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for x in range(len(sets)):
        for y in range(x):
            a, b = sets[x][1], sets[y][1]
            if a and b and den * min(len(a), len(b)) >= num * max(len(a), len(b)):
                common = len(a & b)
                if den * common >= num * (len(a) + len(b) - common):
                    root[top(x)] = top(y)
    least = {}
    for x, (i, _) in enumerate(sets):
        if i is not None:
            least[top(x)] = min(least.get(top(x), i), i)
    return Counter((i, len(s), least.get(top(x))) for x, (i, s) in enumerate(sets))


@pytest.mark.parametrize("setting", [(3, 90, 100), (5, 80, 100)])
def test_jaccard(table, setting):
    got = rows(jaccard.jaccard_components(table, *setting))
    assert Counter((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got) == brute_components(
        texts(table), *setting)


def test_jaccard_of_edited_copies(spark):
    rng = np.random.default_rng(11)
    out = []
    for base in range(6):
        words = [f"b{base}_{rng.integers(0, 500)}" for _ in range(int(rng.integers(5, 200)))]
        for _ in range(30):
            copy = list(words)
            for _ in range(int(rng.integers(0, 6))):
                copy[int(rng.integers(0, len(copy)))] = f"n{rng.integers(0, 10**6)}"
            out.append((len(out) * 7 % 1000, " ".join(copy)))
    df = spark.createDataFrame(out, "doc_id long, text string").repartition(5)
    for setting in ((3, 90, 100), (5, 80, 100), (1, 50, 100)):
        got = rows(jaccard.jaccard_components(df, *setting))
        assert Counter((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got) == brute_components(
            out, *setting)


def test_blocks_of_a_large_cluster(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "BLOCK_SETS", 8)
    rng, out = np.random.default_rng(12), []
    words = [f"c{i}" for i in range(90)]
    for i in range(150):
        copy = list(words[: int(rng.integers(70, 90))])
        for _ in range(int(rng.integers(0, 4))):
            copy[int(rng.integers(0, len(copy)))] = f"n{rng.integers(0, 10**6)}"
        out.append((i, " ".join(copy)))
    df = spark.createDataFrame(out, "doc_id long, text string").repartition(5)
    for setting in ((3, 90, 100), (5, 80, 100)):
        got = rows(jaccard.jaccard_components(df, *setting))
        assert Counter((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got) == brute_components(
            out, *setting)


def item_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))


def brute_hits(pairs, items, window=13):
    wanted = defaultdict(set)
    for name, text in items:
        words = item_words(text)
        size = min(window, len(words))
        for i in range(len(words) - size + 1 if size else 0):
            wanted[tuple(words[i : i + size])].add(name)
    sizes = sorted({len(w) for w in wanted})
    out = Counter()
    for i, text in pairs:
        words, hit, names = item_words(text), set(), set()
        for size in sizes:
            for j in range(len(words) - size + 1):
                if found := wanted.get(tuple(words[j : j + size])):
                    hit |= set(range(j, j + size))
                    names |= found
        digest = hashlib.sha256(",".join(sorted(names)).encode()).hexdigest()
        out[i, len(words), len(hit), len(names), digest, len(hit) > 0 and 20 * len(hit) >= len(words)] += 1
    return out


def hit_rows(df):
    return Counter((r["doc_id"], r["n_words"], r["n_hit"], r["n_items"], r["items_sha256"], r["contaminated"])
                   for r in rows(df))


@pytest.mark.parametrize("block_words", [10**6, 40])
def test_decontamination(table, spark, benchmark, block_words):
    items = [(str(r["item_id"]), r["text"]) for r in benchmark.collect()]
    short = [("s1", "one two"), ("s2", "a"), ("s3", "W5 w6 W7 w8"), ("s4", "..."), ("s5", None),
             ("s6", " ".join(f"w{i}" for i in range(2, 40))), ("s7", " ".join(f"w{i}" for i in range(20, 36)))]
    if block_words == 40:
        items = items[:4]
    both = spark.createDataFrame([*items, *short], "item_id string, text string")
    got = decontamination.benchmark_hits(table, both, block_words=block_words)
    want = brute_hits(texts(table), [*items, *short])
    assert hit_rows(got) == want
    left = decontamination.without_contaminated(table, both, block_words=block_words)
    assert left.columns == table.columns
    assert Counter(r["doc_id"] for r in rows(left)) == Counter(
        i for (i, *_, bad), n in want.items() for _ in range(n) if not bad)


def test_empty_benchmark(odd, spark):
    none = spark.createDataFrame([], "item_id string, text string")
    assert all(r["n_hit"] == 0 for r in rows(decontamination.benchmark_hits(odd, none)))


def brute_spans(text):
    def parts(m):
        return all(int(p) <= 255 for p in m.group().split("."))

    def luhn(m):
        d = [int(c) for c in re.sub("[^0-9]", "", m.group())]
        return 12 <= len(d) <= 19 and sum(x if i % 2 == 0 else x * 2 - 9 * (x > 4) for i, x in enumerate(d[::-1])) % 10 == 0

    kinds = (
        ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
        ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", parts),
        ("card", r"[0-9]([\x20-]?[0-9])+", luhn),
        ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 9 <= len(re.sub("[^0-9]", "", m.group())) <= 15))
    return sorted((m.start(), k, name, m.end()) for k, (name, pattern, good) in enumerate(kinds)
                  for m in re.finditer(pattern, text) if good(m))


def brute_personal(text):
    spans = brute_spans(text)
    counts = Counter(s[2] for s in spans)
    listed = ",".join(f"{n}:{a}:{b}" for a, _, n, b in spans)
    return (*(counts[k] for k in ("email", "ip", "card", "phone")), hashlib.sha256(listed.encode()).hexdigest()), listed


def test_personal_data(table):
    got, want, listed = rows(personal.personal_data(table)), Counter(), defaultdict(set)
    for i, t in texts(table):
        facts, spans = brute_personal(t)
        want[i, *facts] += 1
        listed[i, facts].add(spans)
    assert Counter((r["doc_id"], r["n_email"], r["n_ip"], r["n_card"], r["n_phone"], r["base_sha256"])
                   for r in got) == want
    for r in got:
        base = listed[r["doc_id"], (r["n_email"], r["n_ip"], r["n_card"], r["n_phone"], r["base_sha256"])]
        assert any(set(b.split(",")) <= set(r["spans"].split(",")) for b in base)


def test_personal_patterns(spark):
    rng = np.random.default_rng(2)
    bits = ["a", "b@", "@", ".", "c.d", "1", "23", "255", "256", "4111111111111111", "+", "+1 ", "(555) ", "-", " ", "_", "é"]
    lines = ["".join(rng.choice(bits, rng.integers(1, 25))) for _ in range(1500)]
    df = spark.createDataFrame(list(enumerate(lines)), "doc_id long, text string")
    got = {r["doc_id"]: r for r in rows(personal.personal_data(df, personal.Model()))}
    for i, line in enumerate(lines):
        facts, spans = brute_personal(line)
        assert got[i]["spans"] == spans and got[i]["base_sha256"] == facts[-1], line


def test_redaction(odd, docs):
    for table in (odd, docs):
        left = personal.redacted(table, personal.Model())
        assert left.columns == table.columns and left.count() == table.count()
        # A placeholder that stands beside digits may make a new card number, but not in these tables.
        assert not any(brute_spans(r["text"] or "") for r in rows(left))
    by = {r["doc_id"]: r["text"] for r in rows(personal.redacted(odd, personal.Model()))}
    assert by[15].startswith("mail [EMAIL] or [EMAIL]") and by[8] == "don't we'll  'twas\n\n it's"


def test_languages(table):
    got = rows(language.predicted_languages(table))
    ids = [i for i, _ in texts(table)]
    assert Counter(r["doc_id"] for r in got) == Counter(ids)
    for r in got:
        assert r["held_out"] == (r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2)
        assert 0 <= r["score"] <= 1
    letters = defaultdict(set)
    for i, t in texts(table):
        letters[i].add(any(c.isalpha() for c in t))
    for r in got:
        if letters[r["doc_id"]] == {False}:
            assert r["lang_pred"] == "und"
        elif letters[r["doc_id"]] == {True}:
            assert r["lang_pred"] != "und"
    if len(got) > 100:
        lang = {r["doc_id"]: r["lang"] for r in table.collect()}
        held = [r for r in got if r["held_out"] and lang[r["doc_id"]] and r["lang_pred"] != "und"]
        assert np.mean([r["lang_pred"] == lang[r["doc_id"]] for r in held]) > 0.85


def test_bound_vectors_by_definition():
    made = language.Memory(256)
    codes = [ord(c) for c in "abc"]
    key = (codes[0] * language.CODES + codes[1]) * language.CODES + codes[2]
    vectors = language.letter_vectors(np.array(codes), 256)
    want = np.roll(vectors[0], 2) * np.roll(vectors[1], 1) * vectors[2]
    assert (made.of(np.array([key]))[0] == want).all() and set(np.unique(vectors)) == {-1, 1}


def brute_windows(pairs, size=50):
    """Words inside runs of `size` words that another text has too, by (id, text)."""
    places = defaultdict(set)
    for t in {t for _, t in pairs}:
        words = t.split()
        for i in range(len(words) - size + 1):
            places[tuple(words[i : i + size])].add((t, i))
    texts_of = {k: {t for t, _ in v} for k, v in places.items()}
    copies, out = Counter(t for _, t in pairs), {}
    for _, t in pairs:
        words, hit = t.split(), set()
        if copies[t] > 1 and len(words) >= size:
            hit = set(range(len(words)))
        for i in range(len(words) - size + 1):
            if len(texts_of[tuple(words[i : i + size])]) > 1:
                hit |= set(range(i, i + size))
        out[t] = hit
    return out


def test_repeats(table):
    pairs = [(r["doc_id"], r["text"]) for r in table.collect() if r["text"] is not None]
    want = brute_windows(pairs)
    found = defaultdict(set)
    for r in rows(repeats.repeated_spans(table)):
        found[r["doc_id"]] |= set(range(r["start_word"], r["stop_word"]))
    by_id = defaultdict(set)
    for i, t in pairs:
        by_id[i] |= want[t]
    assert all(found[i] <= by_id[i] for i in found)
    total = sum(map(len, by_id.values()))
    assert sum(len(found[i] & by_id[i]) for i in by_id) >= 0.98 * total


def test_planted_passage(spark):
    rng = np.random.default_rng(4)
    passage = " ".join(f"p{i}" for i in range(55))
    out = []
    for i in range(40):
        own = [f"d{i}_{j}" for j in range(int(rng.integers(10, 90)))]
        cut = int(rng.integers(0, len(own)))
        out.append((i, " ".join([*own[:cut], *([passage] if i % 2 else []), *own[cut:]]), cut))
    got = rows(repeats.repeated_spans(spark.createDataFrame(out, "doc_id long, text string, cut long").repartition(4)))
    assert {(r["doc_id"], r["start_word"], r["stop_word"]) for r in got} == {
        (i, cut, cut + 55) for i, _, cut in out if i % 2}


def test_licenses(table, spark):
    import duckdb

    pairs = table.select("doc_id", "text").toPandas()
    con = duckdb.connect()
    con.register("documents", pairs.astype({"doc_id": "Int64"}))
    want = con.execute(f"select * from ({licenses.scan_sql()})").fetchall()
    names = [d[0] for d in con.description]
    got = licenses.license_scan(table, licenses.known_licenses(spark)).select(*names).collect()
    assert Counter(map(tuple, got)) == Counter(want)


def test_license_spellings(spark):
    text = licenses.TEXTS["MIT"]
    forms = [text, text.upper(), "Copyright (c) 2020 Someone\n\n" + text.replace("sublicense", "sub-licence"),
             text.replace(",", " ,").replace("\n", "\r\n"), text + " and more"]
    df = spark.createDataFrame(list(enumerate(forms)), "doc_id long, text string")
    got = {r["doc_id"]: r["license"] for r in rows(licenses.license_scan(df, licenses.known_licenses(spark)))}
    assert got == {0: "MIT", 1: "MIT", 2: "MIT", 3: "MIT", 4: None}


def test_a_signature_costs_no_more_for_rows_that_hold_nothing(spark):
    """Every row used to look through all k-mers: here 8,000 million looks, minutes."""
    F = fingerprints.F
    df = spark.createDataFrame([(" ".join(f"w{i + 7 * j}" for i in range(2000)),) for j in range(16)], "text string").repartition(4)
    began = time.perf_counter()
    got = df.select(fingerprints.fingerprint(F.col("text"), rows=1 << 18).alias("f")).collect()
    assert time.perf_counter() - began < 30
    for r in got:
        filled = [x for x in (r["f"][i : i + 8] for i in range(0, 8 << 18, 8)) if x != "-" * 8]
        assert len(r["f"]) == 8 << 18 and 1950 < len(filled) <= 1999
    odd = spark.createDataFrame([(None, None), (None, "-" * 512), ("-" * 512, "a" * 512), ("a" * 512, "a" * 512)],
                                "a string, b string")
    likeness = fingerprints.likeness(F.col("a"), F.col("b")).alias("l")
    assert [r["l"] for r in odd.select(likeness).collect()] == [0, 0, 0, 1]
