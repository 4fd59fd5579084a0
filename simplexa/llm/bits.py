"""Bloom filters: built in tasks, put together bucket by bucket, shipped with task functions.

A filter is addressed by two 64-bit hashes of a key.  Its number of bits is chosen by the caller, who thereby bounds
what the driver and every task hold.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from simplexa.llm.words import mix

#: Bits of a bucket, the unit of Spark's bitmap functions.
BUCKET = 1 << 15
WIRE = "which int, bucket long, bits binary"


def addresses(h1: np.ndarray, h2: np.ndarray, size: int, hashes: int, level: int) -> np.ndarray:
    """Bit places of each key, one row a hash function; another level gives other places."""
    own = np.uint64((level + 1) * 0x9E3779B97F4A7C15 & (2**64 - 1))
    first, step = mix(h1.astype(np.uint64) ^ own), mix(h2.astype(np.uint64) + own) | np.uint64(1)
    turns = np.arange(hashes, dtype=np.uint64)[:, None]
    return ((first + turns * step) % np.uint64(size)).astype(np.int64)


class Filter:
    """A Bloom filter of `size` bits; without bits it holds nothing."""

    def __init__(self, size: int, hashes: int, level: int = 0):
        self.size, self.hashes, self.level = size, hashes, level
        self.bits = np.zeros(size // 8, np.uint8)

    @staticmethod
    def shape(keys: int, rate: float, most: int) -> tuple[int, int]:
        """Bits, a whole number of buckets and at most `most`, and hash functions for a rate of false positives."""
        bits = keys * math.log2(1 / rate) / math.log(2)
        size = max(1, math.ceil(min(bits, most) / BUCKET)) * BUCKET
        return size, max(1, min(30, round(size / max(1, keys) * math.log(2)), math.ceil(math.log2(1 / rate))))

    def add(self, h1: np.ndarray, h2: np.ndarray) -> None:
        at = addresses(h1, h2, self.size, self.hashes, self.level).ravel()
        np.bitwise_or.at(self.bits, at >> 3, np.left_shift(1, at & 7).astype(np.uint8))

    def has(self, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
        out = np.ones(len(h1), bool)
        for at in addresses(h1, h2, self.size, self.hashes, self.level):
            out &= (self.bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1
        return out

    def batch(self, which: int) -> pa.RecordBatch:
        """Rows (which, bucket, bits) of the buckets with a bit."""
        buckets = self.bits.reshape(-1, BUCKET // 8)
        used = np.flatnonzero(buckets.any(axis=1))
        return pa.RecordBatch.from_arrays([
            pa.array(np.full(len(used), which, np.int32)), pa.array(used.astype(np.int64)),
            pa.array([buckets[i].tobytes() for i in used], pa.binary())], names=["which", "bucket", "bits"])


def assembled(parts: DataFrame, filters: list[Filter]) -> list[Filter]:
    """The filters filled from the tasks' rows (which, bucket, bits); as many bytes as the filters have pass the
    driver."""
    for row in parts.groupBy("which", "bucket").agg(F.bitmap_or_agg("bits").alias("bits")).toLocalIterator():
        each = filters[row["which"]]
        at = row["bucket"] * (BUCKET // 8)
        each.bits[at : at + BUCKET // 8] = np.frombuffer(row["bits"], np.uint8)
    return filters
