"""Words and their hashes, for whole Arrow batches at once.

All functions run inside tasks.  A word's hash is the sum over its bytes of a random value of the byte times a random
value of its place, modulo 2**64, mixed at the end.
"""

from __future__ import annotations

import sys
import types

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 18


def worker_state() -> dict:
    """A dictionary that lives as long as the Python worker, also for functions that are shipped by value."""
    name = "_simplexa_worker_state"
    if name not in sys.modules:
        sys.modules[name] = types.ModuleType(name)
    return sys.modules[name].__dict__


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit over all of them."""
    x = np.asarray(x, dtype=np.uint64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def scrambled(n: int, seed: int) -> np.ndarray:
    """n fixed odd 64-bit numbers."""
    step = np.uint64(0x9E3779B97F4A7C15)
    return mix((np.arange(1, n + 1, dtype=np.uint64) + np.uint64(seed << 32)) * step) | np.uint64(1)


def places(n: int) -> np.ndarray:
    """The random value of every place in a word, for words of up to n bytes or more."""
    state = worker_state()
    held = state.get("places")
    if held is None or len(held) < n:
        held = state["places"] = scrambled(max(1024, 2 * n), 7)
    return held


def byte_values(word: np.ndarray, fold: bool) -> np.ndarray:
    """The random value of each byte, 0 for a byte outside words; A-Z count as a-z if `fold`."""
    values = scrambled(256, 3)
    if fold:
        values[65:91] = values[97:123]
    return np.where(word, values, np.uint64(0))


def spaced_words() -> np.ndarray:
    """Bytes of words that white space (9 to 13 and 32) separates."""
    word = np.ones(256, bool)
    word[[9, 10, 11, 12, 13, 32]] = False
    return word


def parts(texts: pa.Array, limit: int = SLICE_BYTES):
    """Slices of a column of strings: (first row, bytes, offsets of rows in them); null is an empty text."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.cast(pa.large_binary()).fill_null(b"")
    n = len(texts)
    if not n:
        return
    ends = np.frombuffer(texts.buffers()[1], np.int64, n + 1, texts.offset * 8)
    data = texts.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    first = 0
    while first < n:
        last = int(np.searchsorted(ends, ends[first] + limit, "right")) - 1
        last = min(n, max(last, first + 1))
        yield first, data[ends[first] : ends[last]], ends[first : last + 1] - ends[first]
        first = last


def hashed_words(data: np.ndarray, offsets: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of a slice, and where each row's words begin and end among them."""
    n = len(data)
    if not n:
        return np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64)
    each = values[data]
    inside = each != 0
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    heads = offsets[:-1][offsets[:-1] < n]
    begins[heads] = inside[heads]
    starts = np.flatnonzero(begins)
    if not len(starts):
        return np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64)
    at = np.arange(n, dtype=np.int64)
    head = np.where(begins, at, 0)
    np.maximum.accumulate(head, out=head)
    at -= head
    at[~inside] = 0
    each *= places(int(at.max()) + 1)[at]
    return mix(np.add.reduceat(each, starts)), np.searchsorted(starts, offsets)


def shingles(words: np.ndarray, k: int) -> np.ndarray:
    """Hashes of the runs of k words; the whole sequence is one if it is shorter."""
    n = len(words)
    if n == 0:
        return words
    factors = scrambled(max(k, 64), 11)
    if n < k:
        return mix(np.array([(words * factors[:n]).sum() + np.uint64(n)], np.uint64))
    total = words[: n - k + 1] * factors[0]
    for j in range(1, k):
        total += words[j : n - k + 1 + j] * factors[j]
    return mix(total)
