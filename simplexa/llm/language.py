"""Language identification with hyperdimensional letter vectors."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from simplexa.llm.words import mix, scrambled, worker_state

#: Entries of a vector, letters of an n-gram.
DIMENSIONS, GRAM = 1024, 3
#: Language values that the learner accepts; their prototypes go through the driver (8 KB each).
MAX_LANGUAGES = 2000
UNKNOWN = "und"
HELD_GRAMS = 20_000
CODES = 1 << 21  # code points fit in 21 bits, so three make one key


def letters(text: str) -> np.ndarray:
    """Lower-cased letters as code points, every run of others as one blank; empty if there is no letter."""
    state = worker_state()
    if "folded" not in state:
        state["folded"] = np.full(0x110000, -1, np.int32)
    folded = state["folded"]
    chars = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    kinds = folded[chars]
    if (kinds < 0).any():
        for c in np.unique(chars[kinds < 0]):
            folded[c] = ord(chr(c).lower()[0]) if chr(c).isalpha() else 32
        kinds = folded[chars]
    blank = kinds == 32
    if blank.all():
        return kinds[:0]
    keep = ~blank
    keep[1:] |= ~blank[:-1]
    out = kinds[keep]
    return np.concatenate([[32], out, [32]] if out[-1] != 32 else [[32], out]).astype(np.int64)


def grams(text: str, n: int = GRAM) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-grams of a text as numbers, and their counts."""
    at = letters(text)
    if len(at) < n:
        return at[:0], at[:0]
    keys = at[: len(at) - n + 1].copy()
    for j in range(1, n):
        keys = keys * CODES + at[j : len(at) - n + 1 + j]
    return np.unique(keys, return_counts=True)


def letter_vectors(codes: np.ndarray, dimensions: int) -> np.ndarray:
    """A fixed random vector of +1 and -1 for every letter: bits of mixed (letter, place) pairs."""
    words = (dimensions + 63) // 64
    bits = mix(mix(codes.astype(np.uint64) + np.uint64(77))[:, None] ^ scrambled(words, 23)[None, :])
    raw = np.unpackbits(bits.view(np.uint8), axis=1)[:, :dimensions]
    return raw.astype(np.int8) * 2 - 1


class Memory:
    """Vectors of n-grams: the product of the letters' vectors, each turned by its place in the n-gram."""

    def __init__(self, dimensions: int):
        self.dimensions = dimensions
        self.fresh()

    def fresh(self) -> None:
        self.keys, self.rows = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.vectors = np.zeros((1024, self.dimensions), np.int8)

    def bound(self, keys: np.ndarray) -> np.ndarray:
        out = np.ones((len(keys), self.dimensions), np.int8)
        for place in range(GRAM):
            out *= np.roll(letter_vectors(keys % CODES, self.dimensions), place, axis=1)
            keys = keys // CODES
        return out

    def of(self, keys: np.ndarray) -> np.ndarray:
        if len(keys) > HELD_GRAMS:
            return self.bound(keys)
        at = np.searchsorted(self.keys, keys)
        there = at < len(self.keys)
        there[there] = self.keys[at[there]] == keys[there]
        if not there.all():
            new = keys[~there]
            if len(self.keys) + len(new) > HELD_GRAMS:
                self.fresh()
                new = keys
            held = len(self.keys)
            while held + len(new) > len(self.vectors):
                self.vectors = np.concatenate([self.vectors, np.zeros_like(self.vectors)])
            self.vectors[held : held + len(new)] = self.bound(new)
            at = np.searchsorted(self.keys, new)
            self.keys = np.insert(self.keys, at, new)
            self.rows = np.insert(self.rows, at, np.arange(held, held + len(new)))
            at = np.searchsorted(self.keys, keys)
        return self.vectors[self.rows[at]]

    def bundle(self, keys: np.ndarray, weights: np.ndarray, block: int = 8192) -> np.ndarray:
        """Weighted sum of n-gram vectors, a block at a time."""
        out = np.zeros(self.dimensions, np.float64)
        for i in range(0, len(keys), block):
            out += weights[i : i + block].astype(np.float32) @ self.of(keys[i : i + block]).astype(np.float32)
        return out


def memory(dimensions: int) -> Memory:
    state = worker_state()
    if ("grams", dimensions) not in state:
        state["grams", dimensions] = Memory(dimensions)
    return state["grams", dimensions]


def bundled(dimensions: int, flush: int = 50_000):
    """Task function: (lang, text) to partial prototypes (lang, place, value).  N-gram shares of a language's texts
    are added up first, as bundling is a sum; each text weighs the same whatever its length."""

    def run(batches):
        shares: dict[str, dict[int, float]] = {}
        sums: dict[str, np.ndarray] = {}

        def pour(lang: str) -> None:
            held = sorted(shares.pop(lang).items())
            part = memory(dimensions).bundle(np.array([k for k, _ in held]), np.array([w for _, w in held]))
            sums[lang] = sums.get(lang, 0) + part

        def add(lang: str, found: list) -> None:
            keys, at = np.unique(np.concatenate([k for k, _ in found]), return_inverse=True)
            mine = shares.setdefault(lang, {})
            for k, w in zip(keys.tolist(), np.bincount(at, np.concatenate([w for _, w in found])).tolist()):
                mine[k] = mine.get(k, 0.0) + w
            if len(mine) > flush:
                pour(lang)

        for batch in batches:
            pending: dict[str, list] = {}
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text")):
                keys, counts = grams(text.as_py() or "")
                if len(keys):
                    pending.setdefault(lang, []).append((keys, counts / counts.sum()))
                    if len(pending[lang]) == 64:
                        add(lang, pending.pop(lang))
            for lang, found in pending.items():
                add(lang, found)
        for lang in list(shares):
            pour(lang)
        for lang, total in sums.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * dimensions), pa.array(np.arange(dimensions, dtype=np.int32)), pa.array(total)],
                names=["lang", "place", "value"])

    return run


def prototypes(documents: DataFrame, dimensions: int = DIMENSIONS) -> dict[str, np.ndarray]:
    """One vector for each value of lang, from all rows of (lang, text) that have both."""
    parts = documents.where("lang is not null and text is not null").select("lang", "text").mapInArrow(
        bundled(dimensions), "lang string, place int, value double")
    table = parts.groupBy("lang", "place").agg(F.sum("value").alias("value"))
    out: dict[str, np.ndarray] = {}
    for row in table.toLocalIterator():
        if row["lang"] not in out and len(out) == MAX_LANGUAGES:
            raise ValueError(f"more than {MAX_LANGUAGES} languages to learn")
        out.setdefault(row["lang"], np.zeros(dimensions))[row["place"]] = row["value"]
    return dict(sorted(out.items()))


def compared(names: list[str], units: np.ndarray, dimensions: int):
    """Task function: adds lang_pred and score to (doc_id, held_out, text)."""

    def run(batches):
        for batch in batches:
            preds, scores = [], []
            for text in batch.column("text").to_pylist():
                keys, counts = grams(text or "")
                if not len(keys) or not names:
                    preds.append(UNKNOWN)
                    scores.append(0.0)
                    continue
                vector = memory(dimensions).bundle(keys, counts)
                likeness = units @ vector / max(np.linalg.norm(vector), 1e-12)
                best = int(np.argmax(likeness))
                preds.append(names[best])
                scores.append(float(min(1.0, max(0.0, likeness[best]))))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(preds, pa.string()),
                 pa.array(scores, pa.float64())], names=["doc_id", "held_out", "lang_pred", "score"])

    return run


def held_out(doc_id: Column) -> Column:
    """Whether crc32 of the id as text leaves 2 modulo 4; a null id is not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def identify(documents: DataFrame, learned: dict[str, np.ndarray], dimensions: int = DIMENSIONS) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) for each row of documents (doc_id, text).

    The language whose prototype has the largest cosine with the text's bundle of n-gram vectors, ties to the first by
    name; the score is that cosine, 0 if negative.  A null text or one without letters gets 'und' and 0, and so does
    every text if nothing was learned.  Repeated rows and null ids stay; further columns are not looked at.
    """
    names = list(learned)
    units = np.array([v / max(np.linalg.norm(v), 1e-12) for v in learned.values()]).reshape(len(names), dimensions)
    rows = documents.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "text")
    return rows.mapInArrow(
        compared(names, units, dimensions), "doc_id long, held_out boolean, lang_pred string, score double")


def predicted_languages(documents: DataFrame, dimensions: int = DIMENSIONS) -> DataFrame:
    """Learn from the rows that are not held out, predict all; text and id alone enter a prediction."""
    learned = prototypes(documents.where(~held_out(F.col("doc_id"))), dimensions)
    return identify(documents, learned, dimensions)


def recognised(names: list[str], units: np.ndarray, dimensions: int, least: float):
    """Task function: the rows whose text is in one of the languages."""

    def run(batches):
        for batch in batches:
            keep = []
            for text in batch.column("text"):
                keys, counts = grams(text.as_py() or "")
                if not len(keys):
                    keep.append(False)
                    continue
                vector = memory(dimensions).bundle(keys, counts)
                keep.append(not names or float((units @ vector).max()) >= least * float(np.linalg.norm(vector)))
            yield batch.filter(pa.array(keep, pa.bool_()))

    return run


def in_known_languages(documents: DataFrame, dimensions: int = DIMENSIONS, sigmas: float = 3.0) -> DataFrame:
    """Documents, all columns, whose text has a letter and is nearer to some prototype than chance: cosines of random
    vectors have a deviation of 1 / sqrt(dimensions), and `sigmas` of them are asked for.  Learns from the rows that
    are not held out; if none has a language, only texts without letters go."""
    learned = prototypes(documents.where(~held_out(F.col("doc_id"))), dimensions)
    units = np.array([v / max(np.linalg.norm(v), 1e-12) for v in learned.values()]).reshape(len(learned), dimensions)
    return documents.mapInArrow(
        recognised(list(learned), units, dimensions, sigmas / dimensions**0.5), documents.schema)
