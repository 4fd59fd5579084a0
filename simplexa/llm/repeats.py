"""Repeated passages through sparse suffix arrays.

Only suffixes that begin at a minimiser are kept: the place of the smallest hash of `k` words among `w` such places in a
row.  A passage of k + w - 1 words or more holds the same minimisers wherever it occurs.  The kept suffixes are sorted by
the words that follow, and once more by the words that come before, backwards; neighbours of other documents are
compared word by word to the left and right.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from simplexa.llm.store import kept, slots
from simplexa.llm.words import byte_values, hashed_words, parts, shingles, spaced_words

WIRE = "slot int, kind int, handle long, key long, place int, base long, body binary"
NAMES = ["slot", "kind", "handle", "key", "place", "base", "body"]
SHARED, BUNDLE = 1, 2
FLUSH_PLACES = 1_000_000
#: Words of a hashed run; words of the shortest passage.
RUN, PASSAGE = 16, 50


def sliding(values: np.ndarray, width: int, pick) -> np.ndarray:
    """The least or largest of each `width` values in a row, in steps that double."""
    out, done = values, 1
    while done < width:
        step = min(done, width - done)
        out = pick(out[:-step], out[step:])
        done += step
    return out


def minimisers(words: np.ndarray, k: int, passage: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of the minimisers of a text, and the hashes of their runs."""
    w = passage - k + 1
    if len(words) < passage:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    runs = shingles(words, k)
    least = sliding(runs, w, np.minimum)
    padded = np.concatenate([np.zeros(w - 1, np.uint64), least, np.zeros(w - 1, np.uint64)])
    chosen = np.flatnonzero(sliding(padded, w, np.maximum) == runs)
    return chosen, runs[chosen]


def words_of(texts: pa.Array):
    values = byte_values(spaced_words(), False)
    for _, data, offsets in parts(texts):
        words, at = hashed_words(data, offsets, values)
        for i in range(len(at) - 1):
            yield words[at[i] : at[i + 1]]


def shared_rows(slot, key, place, handle):
    for i in range(0, len(key), 50_000):
        n = len(key[i : i + 50_000])
        yield pa.RecordBatch.from_arrays([
            pa.array(slot[i : i + n].astype(np.int32)), pa.array(np.full(n, SHARED, np.int32)),
            pa.array(handle[i : i + n]), pa.array(key[i : i + n].view(np.int64)),
            pa.array(place[i : i + n].astype(np.int32)), pa.nulls(n, pa.int64()), pa.nulls(n, pa.binary())],
            names=NAMES)


def places_of(k: int, passage: int, slots_: int):
    """Task function: (handle, text) to WIRE: the minimisers of each text, bundled by slot; those that two texts of
    the task share are told as rows, and one of them goes on for all."""

    def run(batches):
        keys, places, owners, handles, held, seen = [], [], [], [], 0, set()

        def flush():
            if not held:
                return
            key, place = np.concatenate(keys), np.concatenate(places)
            owner = np.repeat(np.arange(len(handles)), owners)
            order = np.argsort(key, kind="stable")
            key, place, owner = key[order], place[order], owner[order]
            first = np.ones(len(key), bool)
            first[1:] = key[1:] != key[:-1]
            alone = first.copy()
            alone[:-1] &= first[1:]
            known = np.array(handles, np.int64)
            both = np.flatnonzero(~alone)
            yield from shared_rows(np.arange(len(both)) % slots_, key[both], place[both], known[owner[both]])
            key, place, owner = key[first], place[first].astype(np.int32), known[owner[first]]
            slot = (key % np.uint64(slots_)).astype(np.int64)
            order = np.argsort(slot, kind="stable")
            ends = np.searchsorted(slot[order], np.arange(slots_ + 1))
            rows = []
            for s in range(slots_):
                mine = order[ends[s] : ends[s + 1]]
                if len(mine):
                    rows.append((s, key[mine].tobytes() + owner[mine].tobytes() + place[mine].tobytes()))
            n = len(rows)
            yield pa.RecordBatch.from_arrays([
                pa.array([s for s, _ in rows], pa.int32()), pa.array(np.full(n, BUNDLE, np.int32)),
                pa.nulls(n, pa.int64()), pa.nulls(n, pa.int64()), pa.nulls(n, pa.int32()), pa.nulls(n, pa.int64()),
                pa.array([b for _, b in rows], pa.binary())], names=NAMES)

        for batch in batches:
            for handle, words in zip(batch.column("handle").to_pylist(), words_of(batch.column("text"))):
                if handle in seen:
                    continue
                seen.add(handle)
                place, key = minimisers(words, k, passage)
                if len(key):
                    keys.append(key)
                    places.append(place)
                    owners.append(len(key))
                    handles.append(handle)
                    held += len(key)
                if held >= FLUSH_PLACES:
                    yield from flush()
                    keys, places, owners, handles, held, seen = [], [], [], [], 0, set()
        yield from flush()

    return run


def met(batches):
    """Task function: passes shared places on, and finds those that several bundles hold."""
    keys, owners, places = [], [], []
    for batch in batches:
        kind = batch.column("kind").to_numpy()
        if (rest := np.flatnonzero(kind != BUNDLE)).size:
            yield batch.take(pa.array(rest))
        for i in np.flatnonzero(kind == BUNDLE).tolist():
            body = batch.column("body")[i].as_py()
            n = len(body) // 20
            keys.append(np.frombuffer(body, np.uint64, n))
            owners.append(np.frombuffer(body, np.int64, n, 8 * n))
            places.append(np.frombuffer(body, np.int32, n, 16 * n))
    if not keys:
        return
    key, owner, place = (np.concatenate(x) for x in (keys, owners, places))
    order = np.argsort(key, kind="stable")
    key, owner, place = key[order], owner[order], place[order]
    same = np.zeros(len(key), bool)
    same[1:] = key[1:] == key[:-1]
    same[:-1] |= same[1:]
    at = np.flatnonzero(same)
    yield from shared_rows(np.zeros(len(at)), key[at], place[at], owner[at])


SUFFIX = "handle long, key long, place int, before binary, after binary"


def suffixes(k: int, passage: int):
    """Task function: (handle, text, keys, places) to SUFFIX: 32-bit hashes of up to w - 1 words before the place, the
    nearest first, and of up to `passage` words from it on."""

    def run(batches):
        for batch in batches:
            out = ([], [], [], [], [])
            lists = zip(batch.column("handle").to_pylist(), batch.column("shared").to_pylist(),
                        words_of(batch.column("text")))
            for handle, shared, words in lists:
                short = (words >> np.uint64(32)).astype(">u4")
                for one in shared:
                    at = one["place"]
                    for column, value in zip(out, (
                            handle, one["key"], at, short[max(0, at - passage + k) : at][::-1].tobytes(),
                            short[at : at + passage].tobytes())):
                        column.append(value)
            kinds = (pa.int64(), pa.int64(), pa.int32(), pa.binary(), pa.binary())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(out, kinds)], ["handle", "key", "place", "before", "after"])

    return run


def common(a: bytes, b: bytes) -> int:
    """Words that two arrays begin with alike."""
    n = min(len(a), len(b)) // 4
    if a[: 4 * n] == b[: 4 * n]:
        return n
    x, y = np.frombuffer(a, np.uint32, n), np.frombuffer(b, np.uint32, n)
    return int(np.argmax(x != y))


SPAN = "handle long, start int, stop int, edge int, at long, key long, place int, before binary, after binary"


def neighbours(passage: int):
    """Task function over sorted SUFFIX rows: spans (edge 0), and the first and last row of the task (edge 1 and 2)."""

    def run(batches):
        task = TaskContext.get().partitionId()
        spans: list[tuple] = []
        others: list[tuple] = []  # rows of the document before this one that have this key: those it is compared with
        mine: list[tuple] = []
        first = last = None

        def compare(x, y):
            left, right = common(x[3], y[3]), common(x[4], y[4])
            if left + right >= passage:
                spans.append((x[0], x[2] - left, x[2] + right))
                spans.append((y[0], y[2] - left, y[2] + right))

        def rows_out(rows):
            return pa.RecordBatch.from_arrays([
                pa.array([r[i] for r in rows], t) for i, t in enumerate((
                    pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.binary(),
                    pa.binary()))], ["handle", "start", "stop", "edge", "at", "key", "place", "before", "after"])

        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in ("handle", "key", "place", "before", "after"))):
                first = first or row
                if mine and mine[-1][1] != row[1]:
                    others, mine = [], []
                elif mine and mine[-1][0] != row[0]:
                    for x in mine:
                        compare(x, row)
                    others, mine = mine[-1:], []
                elif others:
                    compare(others[0], row)
                mine.append(row)
                last = row
            if spans:
                spans = sorted(set(spans))
                yield rows_out([(*s, 0, None, None, None, None, None) for s in spans])
                spans = []
        if first is not None:
            yield rows_out([(r[0], None, None, edge, 2 * task + edge, *r[1:]) for edge, r in ((1, first), (2, last))])

    return run


def edge_spans(edges: DataFrame, passage: int) -> DataFrame:
    """Spans of the last row of each task and the first of the next: two rows for each task."""
    order = W.orderBy("at")
    pair = edges.select(
        *(F.col(c) for c in ("handle", "edge", "key", "place", "before", "after")),
        *(F.lead(c).over(order).alias(f"{c}_2") for c in ("handle", "key", "place", "before", "after"))
    ).where("edge = 2 and key = key_2 and handle <> handle_2")

    def run(batches):
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                left, right = common(r["before"], r["before_2"]), common(r["after"], r["after_2"])
                if left + right >= passage:
                    out += [(r["handle"], r["place"] - left, r["place"] + right),
                            (r["handle_2"], r["place_2"] - left, r["place_2"] + right)]
            yield pa.RecordBatch.from_arrays([
                pa.array([o[i] for o in out], t) for i, t in enumerate((pa.int64(), pa.int32(), pa.int32()))],
                ["handle", "start", "stop"])

    return pair.mapInArrow(run, "handle long, start int, stop int")


def word_counts(batches):
    """Task function: (handle, copies, text) to (handle, copies, n_words)."""
    for batch in batches:
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("digest"),
             pa.array([len(w) for w in words_of(batch.column("text"))], pa.int64())],
            names=["doc_id", "digest", "n_words"])


def repeated_spans(documents: DataFrame, passage: int = PASSAGE, k: int = RUN) -> DataFrame:
    """(doc_id, start_word, stop_word, n_words) for the passages of documents (doc_id, text) that another text has too.

    Words are separated by white space and compared as they are.  Spans of a document that overlap or touch are one;
    n_words is the document's number.  Rows with equal texts are copies: each of them is one span if it has `passage`
    words.  Repeats within one text alone are not looked for.  Every span but a copy is made of matches of `passage`
    words or more; where a text's matches with several others begin and end at odd places, parts of less common ones
    may be left out.  Null, short and empty texts have no spans; rows with a null id have spans with it; an empty
    table gives an empty one; further columns are not looked at.
    """
    spark = documents.sparkSession
    n = slots(spark)
    docs = documents.where("text is not null").select("doc_id", F.xxhash64("text").alias("digest"), "text")
    ids = kept(docs.mapInArrow(word_counts, "doc_id long, digest long, n_words long"), "texts").where(
        F.col("n_words") >= passage)
    # One row stands for all with the same text; handle and digest are one, so copies meet without a further number.
    leaders = ids.groupBy("digest").agg(
        F.min("doc_id").alias("doc_id"), F.max("n_words").alias("n_words"), F.count("*").alias("copies"))
    texts = docs.select(F.col("digest").alias("handle"), "text")
    told = kept(texts.mapInArrow(places_of(k, passage, n), WIRE).repartition(n, "slot").mapInArrow(met, WIRE), "places")
    shared = told.select("key", "handle", "place").distinct()
    several = shared.groupBy("key").agg(F.min("handle").alias("_a"), F.max("handle").alias("_b")).where("_a <> _b")
    shared = shared.join(several.select("key"), "key")
    lists = shared.groupBy("handle").agg(F.collect_list(F.struct("key", "place")).alias("shared"))
    wanted = lists.join(leaders.withColumnRenamed("digest", "handle").select("handle", "doc_id"), "handle")
    here = (docs["digest"] == wanted["handle"]) & docs["doc_id"].eqNullSafe(wanted["doc_id"])
    with_text = docs.join(wanted, here).select("handle", "shared", "text").dropDuplicates(["handle"])
    found = kept(with_text.mapInArrow(suffixes(k, passage), SUFFIX), "suffixes")
    spans = None
    for order in (("key", "after", "before"), ("key", "before", "after")):
        dealt = found.repartitionByRange(n, *order, "handle").sortWithinPartitions(*order, "handle", "place")
        compared = kept(dealt.mapInArrow(neighbours(passage), SPAN), "spans")
        own = compared.where("edge = 0").select("handle", "start", "stop").union(
            edge_spans(compared.where("edge > 0"), passage))
        spans = own if spans is None else spans.union(own)
    pieces = spans.distinct().withColumnRenamed("handle", "digest").unionByName(
        leaders.where("copies > 1").select("digest", F.lit(0).alias("start"), F.col("n_words").cast("int").alias("stop")))
    by_start = W.partitionBy("digest").orderBy("start", "stop")
    reach = F.max("stop").over(by_start.rowsBetween(W.unboundedPreceding, -1))
    runs = pieces.withColumn("_new", F.when(reach.isNull() | (F.col("start") > reach), 1).otherwise(0)).withColumn(
        "_run", F.sum("_new").over(by_start.rowsBetween(W.unboundedPreceding, 0)))
    joined = runs.groupBy("digest", "_run").agg(F.min("start").alias("start_word"), F.max("stop").alias("stop_word"))
    return ids.join(joined, "digest").select(
        "doc_id", F.col("start_word").cast("long").alias("start_word"),
        F.col("stop_word").cast("long").alias("stop_word"), "n_words")
