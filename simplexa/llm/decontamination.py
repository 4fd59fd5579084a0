"""Benchmark passages in documents, found with a suffix automaton of the test items."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from simplexa.llm.store import kept
from simplexa.llm.words import worker_state

FOUND = ("doc_id long, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean,"
         " spans array<struct<start: long, stop: long>>, items array<string>")
#: Words of test items in one automaton; more items take more passes over the documents.
BLOCK_WORDS = 200_000

#: Bytes of words: 0-9, a-z and all beyond ASCII; A-Z become a-z and the rest blanks.
TABLE = bytes(
    b if 48 <= b < 58 or 97 <= b < 123 or b >= 128 else b + 32 if 65 <= b < 91 else 32 for b in range(256))


def normalised(raw: bytes | None) -> list[bytes]:
    return (raw or b"").translate(TABLE).split()


class Automaton:
    """Suffix automaton of several word sequences.

    A state is a dictionary from the next word to the next state; its fixed facts have the keys below.  `WINDOWS` has
    the items one of whose windows is the state's shortest run of `window` words or more; `SHORT` has pairs (length,
    item) of shorter items that are suffixes of the state.
    """

    LENGTH, LINK, WINDOWS, SHORT = 0, 1, 2, 3

    def __init__(self, items: list[tuple[str, list[bytes]]], window: int):
        self.window = window
        self.root: dict = {self.LENGTH: 0, self.LINK: None}
        self.states = [self.root]
        self.shortest = window
        owners: list[tuple[dict, str]] = []
        for name, words in items:
            last = self.root
            for w in words:
                last = self.extended(last, w)
                owners.append((last, name))
            if 0 < len(words) < window:
                self.shortest = min(self.shortest, len(words))
                last.setdefault(self.SHORT, set()).add((len(words), name))
        self.settle(owners)

    def state(self, length: int, **_) -> dict:
        made = {self.LENGTH: length, self.LINK: None}
        self.states.append(made)
        return made

    def extended(self, last: dict, w: bytes) -> dict:
        there = last.get(w)
        if there is not None:
            if there[self.LENGTH] == last[self.LENGTH] + 1:
                return there
            return self.split(last, there, w)
        new = self.state(last[self.LENGTH] + 1)
        at = last
        while at is not None and w not in at:
            at[w] = new
            at = at[self.LINK]
        if at is None:
            new[self.LINK] = self.root
        else:
            there = at[w]
            new[self.LINK] = there if there[self.LENGTH] == at[self.LENGTH] + 1 else self.split(at, there, w)
        return new

    def split(self, at: dict, there: dict, w: bytes) -> dict:
        twin = {k: v for k, v in there.items() if k not in (self.WINDOWS, self.SHORT)}
        twin[self.LENGTH] = at[self.LENGTH] + 1
        self.states.append(twin)
        there[self.LINK] = twin
        while at is not None and at.get(w) is there:
            at[w] = twin
            at = at[self.LINK]
        return twin

    def settle(self, owners: list[tuple[dict, str]]) -> None:
        """Carry items up to the states that stand for their windows, and short items down."""
        for state, name in owners:
            while state is not None and state[self.LENGTH] >= self.window:
                if state[self.LINK][self.LENGTH] < self.window:
                    state.setdefault(self.WINDOWS, set()).add(name)
                    break
                state = state[self.LINK]
        for state in sorted(self.states, key=lambda s: s[self.LENGTH]):
            up = state[self.LINK]
            if up is not None and self.SHORT in up:
                state[self.SHORT] = state.get(self.SHORT, set()) | up[self.SHORT]

    def hits(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
        """Runs [start, stop) of words inside windows, and the items whose windows occur."""
        length_of, link_of = self.LENGTH, self.LINK
        window, shortest, root = self.window, self.shortest, self.root
        at, length, spans, items = root, 0, [], set()
        for i, w in enumerate(words):
            then = at.get(w)
            if then is not None:
                at = then
                length += 1
            elif at is not root:
                while True:
                    at = at[link_of]
                    if at is None:
                        at, length = root, 0
                        break
                    then = at.get(w)
                    if then is not None:
                        length = at[length_of] + 1
                        at = then
                        break
            if length >= shortest:
                start = i + 1
                if length >= window:
                    start = i + 1 - window
                    state = at
                    while state[link_of][length_of] >= window:
                        state = state[link_of]
                    items |= state[self.WINDOWS]
                for size, name in at.get(self.SHORT, ()):
                    if size <= length:
                        items.add(name)
                        start = min(start, i + 1 - size)
                # A state's short items longer than the match belong to longer runs; shorter ones come by its links.
                if start <= i:
                    while spans and spans[-1][0] >= start:
                        spans.pop()
                    if spans and spans[-1][1] >= start:
                        spans[-1] = (spans[-1][0], i + 1)
                    else:
                        spans.append((start, i + 1))
        return spans, items


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for start, stop in sorted(spans):
        if out and out[-1][1] >= start:
            out[-1] = (out[-1][0], max(out[-1][1], stop))
        else:
            out.append((start, stop))
    return out


def found_in(texts: list[tuple[str, bytes]], window: int, name: str, share: int):
    """Task function: (doc_id, text as bytes) to FOUND, against one block of items."""

    def run(batches):
        state = worker_state()
        if ("automaton", name) not in state:
            state["automaton", name] = Automaton([(k, normalised(raw)) for k, raw in texts], window)
        automaton = state["automaton", name]
        for batch in batches:
            docs, out = batch.column("doc_id"), []
            for raw in batch.column("text"):
                words = normalised(raw.as_py())
                spans, items = automaton.hits(words)
                n_hit, ordered = sum(b - a for a, b in spans), sorted(items)
                out.append((len(words), n_hit, len(ordered), hashlib.sha256(",".join(ordered).encode()).hexdigest(),
                            n_hit > 0 and share * n_hit >= len(words),
                            [{"start": a, "stop": b} for a, b in spans], ordered))
            columns = list(zip(*out)) or [[]] * 7
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.bool_(),
                     pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())])), pa.list_(pa.string()))
            yield pa.RecordBatch.from_arrays(
                [docs] + [pa.array(c, k) for c, k in zip(columns, kinds)],
                names=["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated", "spans", "items"])

    return run


def joined_blocks(share: int):
    """Task function: the findings of all blocks for a row, as one."""

    def run(batches):
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                spans = merged([(s["start"], s["stop"]) for part in row["spans"] for s in part])
                items, n_hit = sorted({i for part in row["items"] for i in part}), sum(b - a for a, b in spans)
                out.append({
                    "doc_id": row["doc_id"], "n_words": row["n_words"], "n_hit": n_hit, "n_items": len(items),
                    "items_sha256": hashlib.sha256(",".join(items).encode()).hexdigest(),
                    "contaminated": n_hit > 0 and share * n_hit >= row["n_words"],
                    "spans": [{"start": a, "stop": b} for a, b in spans], "items": items})
            schema = pa.schema([
                ("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_hit", pa.int64()), ("n_items", pa.int64()),
                ("items_sha256", pa.string()), ("contaminated", pa.bool_()),
                ("spans", pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))),
                ("items", pa.list_(pa.string()))])
            yield pa.RecordBatch.from_pylist(out, schema)

    return run


def blocks_of(benchmark: DataFrame, block_words: int):
    """Lists of (item_id, text as bytes) of up to `block_words` words, or one item."""
    block, size = [], 0
    items = benchmark.select(
        F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item_id"),
        F.coalesce("text", F.lit("")).cast("binary").alias("text")).distinct().orderBy("item_id", "text")
    for row in items.toLocalIterator():
        n = len(normalised(bytes(row["text"])))
        if block and size + n > block_words:
            yield block
            block, size = [], 0
        block.append((row["item_id"], bytes(row["text"])))
        size += n
    yield block


def benchmark_hits(documents: DataFrame, benchmark: DataFrame, window: int = 13, share: int = 20,
                   block_words: int = BLOCK_WORDS) -> DataFrame:
    """One row (FOUND) for each row of documents (doc_id, text) against benchmark (item_id, text).

    An item's windows are its runs of `window` words, or the item if it is shorter.  A document is contaminated if
    words inside windows are at least one in `share`.  Words are runs of a-z, 0-9 and characters beyond ASCII after
    lower-casing A-Z.  The automaton goes to the executors in blocks of items of bounded size; documents are passed
    once for each block and are not shuffled unless there are several.
    A null or wordless text has no words and no hits; a null item id counts as the id '' ; items without words and an
    empty benchmark find nothing; repeated rows and null doc ids stay; further columns are not looked at.
    """
    docs = documents.select("doc_id", F.col("text").cast("binary").alias("text"))
    found = []
    for block in blocks_of(benchmark, block_words):
        name = hashlib.sha256(repr((window, block)).encode()).hexdigest()
        found.append(docs.mapInArrow(found_in(block, window, name, share), FOUND))
    if len(found) == 1:
        return found[0]
    # Several blocks: the rows of a document meet by a number that the stored table gives each of them.
    numbered = kept(docs.withColumn("_row", F.monotonically_increasing_id()), "decontamination")
    parts = None
    for block in blocks_of(benchmark, block_words):
        name = hashlib.sha256(repr((window, block)).encode()).hexdigest()
        by_row = numbered.select(F.col("_row").alias("doc_id"), "text").mapInArrow(
            found_in(block, window, name, share), FOUND)
        parts = by_row if parts is None else parts.unionByName(by_row)
    together = parts.groupBy("doc_id").agg(
        F.max("n_words").alias("n_words"), F.collect_list("spans").alias("spans"),
        F.collect_list("items").alias("items")).withColumnRenamed("doc_id", "_row")
    together = together.join(numbered.select("_row", "doc_id"), "_row").drop("_row")
    return together.mapInArrow(joined_blocks(share), FOUND)


def cleaned(texts: list[tuple[str, bytes]], window: int, name: str, share: int):
    """Task function: the rows that are not contaminated."""

    def run(batches):
        state = worker_state()
        if ("automaton", name) not in state:
            state["automaton", name] = Automaton([(k, normalised(raw)) for k, raw in texts], window)
        automaton = state["automaton", name]
        for batch in batches:
            keep = []
            for text in batch.column("text").cast(pa.binary()):
                words = normalised(text.as_py())
                n_hit = sum(b - a for a, b in automaton.hits(words)[0])
                keep.append(not n_hit or share * n_hit < len(words))
            yield batch.filter(pa.array(keep, pa.bool_()))

    return run


def without_contaminated(documents: DataFrame, benchmark: DataFrame, window: int = 13, share: int = 20,
                         block_words: int = BLOCK_WORDS) -> DataFrame:
    """Documents, all columns, less the contaminated ones, as in benchmark_hits; others keep their whole text."""
    blocks = blocks_of(benchmark, block_words)
    first, second = next(blocks), next(blocks, None)
    if second is None:
        name = hashlib.sha256(repr((window, first)).encode()).hexdigest()
        return documents.mapInArrow(cleaned(first, window, name, share), documents.schema)
    rows = kept(documents.withColumn("_decontamination_row", F.monotonically_increasing_id()), "documents")
    hits = benchmark_hits(
        rows.select(F.col("_decontamination_row").alias("doc_id"), "text"), benchmark, window, share, block_words)
    gone = hits.where("contaminated").select(F.col("doc_id").alias("_decontamination_row"))
    return rows.join(gone, "_decontamination_row", "left_anti").select(*documents.columns)
