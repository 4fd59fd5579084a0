"""Collocations: phrases whose parts stand together more often than apart, by dynamic itemset counting.

The documents are dealt to shards once.  Steps scan one shard each, in turn and over again.  Words are counted from
the first step on; a longer phrase becomes active once both of its parts without an end word have reached the
threshold, and is counted for as many steps as there are shards, so once over everything.  Lengths are thus counted
side by side, and the steps end when the last phrase has had its cycle.

Which phrases have reached the threshold is kept in Bloom filters of one bounded size, to which steps only add bits.
So a phrase that passes them in one step does so in all later ones; it is active from its first such step.  What a
filter lets pass wrongly is counted in vain, but as exactly as all else.

Words have 64-bit codes, verified to differ by the words themselves; a phrase is the codes of its words.  Counts are
shuffled as arrays by slot, a hash of the phrase.  A bundle of counts is cut to a bounded number of slots; where there
are more, these are parts of them, to which the sums of each are dealt on.  So the rows grow with the bundles alone.
"""

from __future__ import annotations

import math
import re
from collections import defaultdict

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from simplexa.llm.bits import WIRE, Filter, assembled
from simplexa.llm.store import discard, kept, slots
from simplexa.llm.words import mix

#: Bytes of a block of texts in memory, and of texts whose counts are one slot's.
BLOCK_BYTES, SLOT_BYTES = 3 << 20, 4 << 20
#: Bytes of counts that a task gathers to a bundle, and slots to which it is dealt at most.
BUNDLE_BYTES, FAN = 8 << 20, 256
#: Bits of a filter, at least and at most (16 MB), and its hash functions.
LEAST_BITS, MOST_BITS, HASHES = 1 << 20, 1 << 27, 4
SLICE = 1 << 20
#: keys: codes, `words` a phrase; f: counts; first: the steps that first saw them, null in what a step has counted;
#: texts: the words, for phrases of one.
COUNTS = "slot int, lang string, words int, keys binary, f binary, first binary, texts binary"
TYPES = [pa.int32(), pa.string(), pa.int32(), *[pa.binary()] * 4]
NAMES = ["slot", "lang", "words", "keys", "f", "first", "texts"]
#: All COUNTS of a slot in a bundle.
BUNDLES = f"slot int, counts array<struct<{COUNTS.partition(', ')[2]}>>"
HELD = pa.struct(list(zip(NAMES[1:], TYPES[1:])))
SPACE, BREAK = ord(" "), ord(".")
GAP = re.compile(rb"[ .]")
CLASH = "two words have one code"


def word_table() -> bytes:
    """A-Z lower-cased, tabs made spaces, and every separator of pieces a full stop."""
    table = bytearray(range(256))
    table[0x41:0x5B] = table[0x61:0x7B]
    table[0x09] = SPACE
    for c in b".,;:!?\x0a\x0b\x0c\x0d":
        table[c] = BREAK
    return bytes(table)


def slices(text: bytes, size: int = SLICE):
    """Parts of a text that is cut before spaces and separators."""
    start = 0
    while len(text) - start > size:
        gap = GAP.search(text, start + size)
        if gap is None:
            break
        yield text[start : gap.start()]
        start = gap.start()
    yield text[start:] if start else text


def joined(keys: np.ndarray) -> np.ndarray:
    """A hash of phrases, rows of codes."""
    h = mix(keys[:, 0])
    for j in range(1, keys.shape[1]):
        h = mix(h * np.uint64(0x9E3779B97F4A7C15) + keys[:, j])
    return h


def second(h: np.ndarray) -> np.ndarray:
    return mix(h ^ np.uint64(0xD6E8FEB86659FD93))


def batch_of(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), TYPES)], names=NAMES)


def fans(slots_: int) -> list[int]:
    """Numbers of slots, to which counts are dealt one after another: each a multiple of the one before by FAN at most,
    and the last no less than `slots_`."""
    levels = 1
    while FAN**levels < slots_:
        levels += 1
    fan = min(FAN, math.ceil(slots_ ** (1 / levels)))
    return [fan**i for i in range(1, levels + 1)]


def dealt_counts(lang: str, k: int, keys: np.ndarray, f: np.ndarray, texts: list[bytes] | None, slots_: int):
    """Rows of COUNTS, one for each slot; the number of all words is in the first."""
    if not k:
        yield 0, lang, 0, b"", f.astype(np.int64).tobytes(), None, None
        return
    slot = (joined(keys) % np.uint64(slots_)).astype(np.int64)
    order = np.argsort(slot, kind="stable")
    held, starts = np.unique(slot[order], return_index=True)
    for s, own in zip(held.tolist(), np.split(order, starts[1:])):
        yield (s, lang, k, keys[own].tobytes(), f[own].astype(np.int64).tobytes(), None,
               b"\n".join([texts[i] for i in own.tolist()]) if texts else None)


def bundle_rows(held: dict[int, list[dict]]):
    """BUNDLES of the COUNTS of each slot, some slots a batch."""
    slots_ = sorted(held)
    for i in range(0, len(slots_), 32):
        own = slots_[i : i + 32]
        yield pa.RecordBatch.from_arrays([
            pa.array(own, pa.int32()), pa.array([held[s] for s in own], pa.list_(HELD))], names=["slot", "counts"])


def bundled(run, size: int = BUNDLE_BYTES):
    """Task function: the COUNTS of another one as BUNDLES."""

    def whole(batches):
        held, total = defaultdict(list), 0
        for batch in run(batches):
            for row in batch.to_pylist():
                held[row.pop("slot")].append(row)
                total += len(row["keys"]) + len(row["f"]) + len(row["texts"] or b"")
            if total >= size:
                yield from bundle_rows(held)
                held, total = defaultdict(list), 0
        yield from bundle_rows(held)

    return whole


class Block:
    """Translated texts of one language.  It may go on with a document that the block before has begun, and then holds
    the words before the cut once more, which are not counted again."""

    def __init__(self, carried: list[bytes]):
        self.carried, self.parts = len(carried), [b" ".join(carried)]

    def words(self) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
        """Number and piece of each word, and the words by number."""
        text = b"".join(self.parts)
        data = np.frombuffer(text, np.uint8)
        breaks = data == BREAK
        inside = ~breaks & (data != SPACE)
        edges = np.flatnonzero(np.diff(inside, prepend=False, append=False))
        starts, ends = edges[::2], edges[1::2]
        offsets = np.zeros(len(starts) + 1, np.int64)
        np.cumsum(ends - starts, out=offsets[1:])
        listed = pa.Array.from_buffers(
            pa.large_binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(data[inside])]).dictionary_encode()
        return (listed.indices.to_numpy(zero_copy_only=False).astype(np.int64),
                np.searchsorted(np.flatnonzero(breaks), starts).astype(np.int32), listed.dictionary.to_pylist())


def grouped(x: np.ndarray):
    """Order of the numbers, where each different one begins in it, and the place of every number among these."""
    order = np.argsort(x)
    new, ordered = np.ones(len(x), bool), x[order]
    new[1:] = ordered[1:] != ordered[:-1]
    inverse = np.empty(len(x), np.int64)
    inverse[order] = np.cumsum(new) - 1
    return order, np.flatnonzero(new), inverse


class Known:
    """The filters of each length before a step, and those of a cycle before; None where nothing has come so far."""

    def __init__(self, now: list[Filter | None], then: list[Filter | None]):
        self.now, self.then = now, then

    @staticmethod
    def passes(each: Filter | None, h: np.ndarray) -> np.ndarray:
        return np.zeros(len(h), bool) if each is None else each.has(h, second(h))


def counted(longest: int, known: Known, first_cycle: bool, slots_: int, seed: int, block_bytes: int = BLOCK_BYTES):
    """Task function: (lang, text) to COUNTS of the phrases that are active, with the number of all words as the
    phrase of no words."""

    def phrases(block: Block):
        """(words, codes, counts, texts) of the active phrases of each length."""
        ids, piece, words = block.words()
        if first_cycle:
            yield 0, np.zeros((1, 0), np.uint64), np.array([len(ids) - block.carried]), None
        if not len(ids):
            return
        v, code = len(words), np.array([xxhash.xxh64_intdigest(w, seed) for w in words], np.uint64)
        if first_cycle:
            n = np.bincount(ids[block.carried :], minlength=v)
            at = np.flatnonzero(n)
            yield 1, code[at, None], n[at], [words[i] for i in at.tolist()]
        if known.now[0] is None:
            return
        h, same = joined(code[:, None]), piece[1:] == piece[:-1]
        # By place: whether the phrase that starts there passes now, passed a cycle ago, and its number.
        now, then = (Known.passes(each[0], h)[ids] for each in (known.now, known.then))
        number, keys = ids, code[:, None]
        for k in range(2, longest + 1):
            ok, before = now[:-1] & now[1:] & same[: len(now) - 1], then[:-1] & then[1:]
            at = np.flatnonzero(ok)
            if not len(at):
                return
            both = number[at] * v + ids[k - 1 :][at]
            order, starts, here = grouped(both)
            n, both = np.bincount(here[at > block.carried - k], minlength=len(starts)), both[order[starts]]
            keys = np.concatenate([keys[both // v], code[both % v, None]], axis=1)
            fresh = n > 0
            fresh[here[before[at]]] = False
            yield k, keys[fresh], n[fresh], None
            if k == longest or known.now[k - 1] is None:
                return
            h = joined(keys)
            now, then = (np.zeros(len(ok), bool) for _ in range(2))
            for mark, each in ((now, known.now), (then, known.then)):
                mark[at] = Known.passes(each[k - 1], h)[here]
            number = np.zeros(len(ok), np.int64)
            number[at] = here

    def told(lang: str, block: Block):
        rows = []
        for k, keys, n, texts in phrases(block):
            for row in dealt_counts(lang, k, keys, n, texts, slots_):
                rows.append(row)
                if len(rows) == 256:
                    yield batch_of(rows)
                    rows = []
        if rows:
            yield batch_of(rows)

    def run(batches):
        table, blocks, held = word_table(), {}, 0
        for batch in batches:
            langs = batch.column("lang").to_pylist()
            for lang, text in zip(langs, batch.column("text").cast(pa.binary())):
                carried: list[bytes] = []
                parts = list(slices(text.as_py().translate(table), min(SLICE, block_bytes)))
                for number, part in enumerate(parts, 1):
                    blocks.setdefault(lang, Block(carried)).parts.append(part)
                    held += len(part)
                    if number < len(parts):
                        piece = part[part.rfind(b".") + 1 :].split()
                        carried = (piece if BREAK in part else carried + piece)[1 - longest :]
                    if held >= block_bytes:
                        for name in sorted(blocks):
                            yield from told(name, blocks[name])
                        blocks, held = {}, 0
                if lang in blocks:
                    blocks[lang].parts.append(b".")
        for name in sorted(blocks):
            yield from told(name, blocks[name])

    return run


def summed(keys: np.ndarray, f: np.ndarray, first: np.ndarray, texts: list[bytes] | None):
    """Each phrase once, with the sum of its counts and the first step that saw it."""
    h = joined(keys)
    order = np.argsort(h, kind="stable")
    step = np.concatenate([[True], (keys[order][1:] != keys[order][:-1]).any(axis=1)])
    if (step[1:] & (h[order][1:] == h[order][:-1])).any():  # other codes, same hash: order by all codes
        order = np.lexsort(keys.T)
        step = np.concatenate([[True], (keys[order][1:] != keys[order][:-1]).any(axis=1)])
    at = np.flatnonzero(step)
    if texts is not None:
        own = [texts[i] for i in order.tolist()]
        if any(own[i] != own[i - 1] for i in np.flatnonzero(~step).tolist()):
            raise ValueError(CLASH)
        texts = [own[i] for i in at.tolist()]
    return keys[order[at]], np.add.reduceat(f[order], at), np.minimum.reduceat(first[order], at), texts


def sums(bundles: pa.Table, step: int):
    """(lang, words, keys, f, first, texts) of the BUNDLES of a slot, each phrase once; `step` is the first step of
    what has none."""
    table = pa.Table.from_batches([pa.RecordBatch.from_struct_array(x.flatten()) for x in bundles.column("counts").chunks])
    parts = defaultdict(list)
    for i, key in enumerate(zip(table.column("lang").to_pylist(), table.column("words").to_pylist())):
        parts[key].append(i)

    def arrays(column: str, kind, rows: list[int]):
        """Without a copy of the table's bytes; None where there is nothing."""
        found = (table.column(column)[i] for i in rows)
        return [np.frombuffer(x.as_buffer(), kind) if x.is_valid else None for x in found]

    for lang, k in sorted(parts):
        rows = parts[lang, k]
        each = arrays("f", np.int64, rows)
        f = np.concatenate(each)
        if not k:
            yield lang, 0, np.zeros((1, 0), np.uint64), np.array([f.sum()]), np.ones(1, np.int32), None
            continue
        keys = np.concatenate(arrays("keys", np.uint64, rows)).reshape(-1, k)
        first = np.concatenate([
            np.full(len(n), step, np.int32) if x is None else x for x, n in zip(arrays("first", np.int32, rows), each)])
        texts = None
        if k == 1:
            texts = [w for i in rows for w in table.column("texts")[i].as_py().split(b"\n")]
        yield lang, k, *summed(keys, f, first, texts)


def dealt_on(slots_: int):
    """Group function over BUNDLES of a step and one slot: their sums as BUNDLES of more slots."""

    def run(table: pa.Table) -> pa.Table:
        held = defaultdict(list)
        for lang, k, keys, f, _, texts in sums(table, 0):
            for slot, *row in dealt_counts(lang, k, keys, f, texts, slots_):
                held[slot].append(dict(zip(NAMES[1:], row)))
        return pa.Table.from_batches(bundle_rows(held))

    return run


def folded(step: int, threshold: int, shards: int):
    """Group function over the BUNDLES of a slot, those before a step and those of it: the COUNTS after it, without
    the phrases that had their cycle and stayed below the threshold."""

    def run(table: pa.Table) -> pa.Table:
        out, slot = [], table.column("slot")[0].as_py()
        for lang, k, keys, f, first, texts in sums(table, step):
            stay = np.flatnonzero((f >= threshold) | (first + shards - 1 > step)) if k else np.zeros(1, np.int64)
            if len(stay):
                out.append((slot, lang, k, keys[stay].tobytes(), f[stay].tobytes(), first[stay].tobytes(),
                            b"\n".join([texts[i] for i in stay.tolist()]) if k == 1 else None))
        return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), TYPES)], names=NAMES) if out else (
            pa.schema(list(zip(NAMES, TYPES))).empty_table())

    return run


def marks(longest: int, threshold: int, size: int):
    """Task function: COUNTS to the filters' rows of the phrases that have reached the threshold."""

    def run(batches):
        own = [Filter(size, HASHES, k) for k in range(1, longest)]
        for batch in batches:
            for row in batch.select(["words", "keys", "f"]).to_pylist():
                if 0 < row["words"] < longest:
                    f = np.frombuffer(row["f"], np.int64)
                    keys = np.frombuffer(row["keys"], np.uint64).reshape(-1, row["words"])
                    h = joined(keys[f >= threshold])
                    own[row["words"] - 1].add(h, second(h))
        for which, each in enumerate(own):
            yield each.batch(which)

    return run


def unpacked(threshold: int):
    """Task function: COUNTS to rows (lang, words, key, f, word) of the phrases that reached the threshold."""

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                k, f = row["words"], np.frombuffer(row["f"], np.int64)
                at = np.flatnonzero((f >= threshold) | (k == 0))
                keys = np.frombuffer(row["keys"], np.int64)
                keys = keys.reshape(-1, k) if k else np.zeros((len(f), 0), np.int64)
                texts = row["texts"].split(b"\n") if k == 1 else None
                n = len(at)
                yield pa.RecordBatch.from_arrays([
                    pa.array([row["lang"]] * n, pa.string()), pa.array([k] * n, pa.int32()),
                    pa.ListArray.from_arrays(np.arange(n + 1, dtype=np.int32) * k, pa.array(keys[at].ravel())),
                    pa.array(f[at]), pa.array([texts[i] for i in at.tolist()] if texts else [None] * n, pa.binary()).cast(
                        pa.string())], names=["lang", "words", "key", "f", "word"])

    return run


PHRASES = "lang string, words int, key array<bigint>, f long, word string"


def slot_bundles(rows: DataFrame, run, counts: list[int]) -> DataFrame:
    """BUNDLES of what `run` counts in the rows, for as many slots as `counts` says last.  Until then, the bundles of a
    slot are added up in as many parts as it has slots in the end, so that a part is no more than one of these."""
    out = rows.mapInArrow(bundled(run), BUNDLES)
    for now, more in zip(counts, counts[1:]):
        part = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(counts[-1] // now))
        out = out.withColumn("_part", part).groupBy("slot", "_part").applyInArrow(dealt_on(more), BUNDLES)
    return out


def _frequent(dealt: DataFrame, longest: int, threshold: int, shards: int, n: int, size: int, seed: int) -> DataFrame:
    """The steps of one choice of codes: PHRASES, stored."""
    counts, held = fans(n), F.array(F.struct(*NAMES[1:])).alias("counts")
    nothing = [Filter(size, HASHES, k) for k in range(1, longest)]
    filters = [nothing]  # before each step
    state, step, last = None, 0, shards
    while step < last:
        step += 1
        known = Known(*([each if each.bits.any() else None for each in filters[max(0, i)]] for i in (
            step - 1, step - 1 - shards)))
        seen = slot_bundles(dealt.where(F.col("shard") == (step - 1) % shards).select("lang", "text"), counted(
            longest, known, step <= shards, counts[0], seed), counts)
        if state is not None:
            seen = seen.unionByName(state.select("slot", held))
        now = kept(seen.groupBy("slot").applyInArrow(folded(step, threshold, shards), COUNTS), "phrases")
        if state is not None:
            discard(state)
        state = now
        found = assembled(state.where(f"words BETWEEN 1 AND {longest - 1}").mapInArrow(
            marks(longest, threshold, size), WIRE), [Filter(size, HASHES, k) for k in range(1, longest)])
        if any((a.bits != b.bits).any() for a, b in zip(found, filters[-1])):
            last = max(last, step + shards)
        filters.append(found)
        filters[: max(0, step - shards)] = [None] * max(0, step - shards)  # no longer asked for
    out = kept(state.mapInArrow(unpacked(threshold), PHRASES), "frequent")
    discard(state)
    return out


def frequent_phrases(documents: DataFrame, longest: int = 3, threshold: int = 10, shards: int = 2) -> DataFrame:
    """PHRASES: all phrases of 1 to `longest` words (2 or more) that are there `threshold` times or more, as the codes
    of their words, with the word of those of one; and as the phrase of no words the number of all words of the
    language.

    documents (lang, text): a null lang is 'und', a null text empty; see `collocations` for words and pieces.  The
    result is stored.
    """
    rows = documents.select(
        F.coalesce("lang", F.lit("und")).alias("lang"), F.coalesce("text", F.lit("")).alias("text"),
        F.pmod(F.monotonically_increasing_id(), F.lit(shards)).cast("int").alias("shard"))
    dealt = kept(rows, "shards", "shard")
    total = dealt.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(slots(documents.sparkSession), math.ceil(total / SLOT_BYTES))
    size = min(MOST_BITS, max(LEAST_BITS, 1 << math.ceil(math.log2(total / 16 + 1))))
    for seed in range(8):
        try:
            found = _frequent(dealt, longest, threshold, shards, n, size, seed)
            break
        except PySparkException as error:
            if CLASH not in str(error) or seed == 7:
                raise
    discard(dealt)
    return found


def collocations(documents: DataFrame, longest: int = 3, threshold: int = 10, top: int = 2000, inside: int = 50,
                 shards: int = 2) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score) of the best `top` phrases of 2 to `longest` words in each language.

    documents (lang, text): a null lang is 'und', a null text empty.  A-Z are lower-cased; a text is cut at
    . , ; : ! ? and the characters 10 to 13, and the pieces at spaces and tabs.  a is how often the phrase is there,
    l and r its two parts at the cut with the lowest floor(10**6 a a / (l r)), the shortest left part of equal ones,
    n all words of the language.  A phrase goes if a longer one that holds it is there in `inside` of 100 cases or
    more.  Order: score, a, phrase by its bytes.  Repeated rows count each, ids and further columns are not looked at,
    an empty table gives an empty one.
    """
    found = frequent_phrases(documents, longest, threshold, shards)
    number = found.where("words = 0").select("lang", F.col("f").alias("n"))
    phrases = found.where("words > 1").select("lang", "words", "key", F.col("f").alias("a"))
    left, right = (found.where(f"words BETWEEN 1 AND {longest - 1}").select(
        "lang", F.col("key").alias(side), F.col("f").alias(f)) for side, f in (("left", "l"), ("right", "r")))
    cuts = phrases.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("words") - 1))).select(
        "*", F.slice("key", F.lit(1), F.col("k")).alias("left"),
        F.slice("key", F.col("k") + 1, F.col("words") - F.col("k")).alias("right"))
    wide = {c: F.col(c).cast("decimal(14,0)") for c in ("a", "l", "r")}
    score = F.call_function("div", wide["a"] * wide["a"] * F.lit(1_000_000).cast("decimal(7,0)"), wide["l"] * wide["r"])
    scored = cuts.join(left, ["lang", "left"]).join(right, ["lang", "right"]).withColumn("score", score)
    best = scored.groupBy("lang", "key", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    inner = phrases.where("words > 2").select(
        "lang", "a", "key", "words", F.explode(F.sequence(F.lit(2), F.col("words") - 1)).alias("size")).select(
        "lang", "a", "key", "size", F.explode(F.sequence(F.lit(1), F.col("words") - F.col("size") + 1)).alias("at")).select(
        "lang", F.slice("key", F.col("at"), F.col("size")).alias("key"), "a").groupBy(
        "lang", "key").agg(F.max("a").alias("outer"))
    free = best.join(inner, ["lang", "key"], "left").where(
        F.col("outer").isNull() | (F.col("outer").cast("decimal(20,0)") * 100 < F.col("a").cast("decimal(20,0)") * inside))
    by = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"))
    # All that may be among the best by score and count; only they are spelt.
    near = free.select("lang", "key", "a", "cut.l", "cut.r", "cut.score").withColumn("_place", F.rank().over(by)).where(
        F.col("_place") <= top)
    words = found.where("words = 1").select("lang", F.get("key", F.lit(0)).alias("code"), "word")
    spelt = near.select("*", F.posexplode("key").alias("_at", "code")).join(words, ["lang", "code"]).groupBy(
        "lang", "key", "a", "l", "r", "score").agg(F.sort_array(F.collect_list(F.struct("_at", "word"))).alias("_words"))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = spelt.select("lang", F.array_join("_words.word", " ").alias("phrase"), "a", "l", "r", "score").withColumn(
        "rank", F.row_number().over(order).cast("long")).where(F.col("rank") <= top)
    return ranked.join(number, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def collocations_sql(threshold: int = 10, top: int = 2000, inside: int = 50) -> str:
    """The query for phrases of two and three words."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return f"""
        WITH pieces AS (
            SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
                translate(coalesce(text, ''), '{upper}', '{lower}'), '[.,;:!?\\x0A-\\x0D]')) AS piece
            FROM documents
        ), worded AS (
            SELECT row_number() OVER () AS place, lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS w FROM pieces
        ), listed AS (
            SELECT place, lang, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS i FROM worded
        ), followed AS (
            SELECT lang, word, lead(word, 1) OVER here AS word_2, lead(word, 2) OVER here AS word_3
            FROM listed WINDOW here AS (PARTITION BY place ORDER BY i)
        ), grams AS (
            SELECT lang, 1 AS k, word AS phrase, CAST(count(*) AS HUGEINT) AS f FROM followed GROUP BY ALL
            UNION ALL
            SELECT lang, 2, word || ' ' || word_2, CAST(count(*) AS HUGEINT) FROM followed
            WHERE word_2 IS NOT NULL GROUP BY ALL
            UNION ALL
            SELECT lang, 3, word || ' ' || word_2 || ' ' || word_3, CAST(count(*) AS HUGEINT) FROM followed
            WHERE word_3 IS NOT NULL GROUP BY ALL
        ), totals AS (
            SELECT lang, sum(f) AS n FROM grams WHERE k = 1 GROUP BY ALL
        ), candidates AS (
            SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS w FROM grams WHERE k > 1 AND f >= {threshold}
        ), cuts AS (
            SELECT lang, k, phrase, a, j, array_to_string(list_slice(w, 1, j), ' ') AS left_part,
                   array_to_string(list_slice(w, j + 1, k), ' ') AS right_part
            FROM candidates, (VALUES (1), (2)) places(j) WHERE j < k
        ), scored AS (
            SELECT c.lang, c.phrase, c.a, x.f AS l, y.f AS r, (1000000 * c.a * c.a) // (x.f * y.f) AS score
            FROM cuts c JOIN grams x ON x.lang = c.lang AND x.phrase = c.left_part
            JOIN grams y ON y.lang = c.lang AND y.phrase = c.right_part
            QUALIFY row_number() OVER (PARTITION BY c.lang, c.phrase ORDER BY score, j) = 1
        ), inner_phrases AS (
            SELECT lang, array_to_string(list_slice(w, s, s + 1), ' ') AS phrase, max(a) AS most
            FROM candidates, (VALUES (1), (2)) starts(s) WHERE k = 3 GROUP BY ALL
        )
        SELECT s.lang, row_number() OVER (PARTITION BY s.lang ORDER BY score DESC, a DESC, s.phrase) AS rank, s.phrase,
               CAST(a AS BIGINT) AS a, CAST(l AS BIGINT) AS l, CAST(r AS BIGINT) AS r, CAST(n AS BIGINT) AS n,
               CAST(score AS BIGINT) AS score
        FROM scored s JOIN totals t ON t.lang = s.lang
        LEFT JOIN inner_phrases i ON i.lang = s.lang AND i.phrase = s.phrase
        WHERE i.most IS NULL OR 100 * i.most < {inside} * a
        QUALIFY rank <= {top}"""
