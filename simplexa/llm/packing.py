"""Best-fit packing of documents into sequences, certified by lower bounds."""

from __future__ import annotations

import math
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from simplexa.llm.bpe import encoder
from simplexa.llm.store import kept

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, fill long"
#: Pieces that one task packs at a time.
TASK_PIECES = 1 << 16


def pieces_of(tokenizer: str, limit: int, end: int):
    """Task function: (doc_id, text) to pieces.  A text with more than `limit` ids is cut from its end, so that only
    its first piece is shorter."""

    def run(batches):
        encode = encoder(tokenizer)
        for batch in batches:
            docs = batch.column("doc_id").to_pylist()
            texts = [t or "" for t in batch.column("text").to_pylist()]
            for at in range(0, len(texts), 256):
                out: list[tuple] = []
                for doc, ids in zip(docs[at : at + 256], encode.ids(texts[at : at + 256])):
                    raw = np.append(ids, end).astype("<u4").tobytes()
                    n = len(raw) // 4
                    start, stop, piece = 0, n % limit or limit, 0
                    while start < n:
                        stop = min(stop, n)
                        out.append((doc, piece, start, stop - start, zlib.crc32(raw[4 * start : 4 * stop])))
                        start, stop, piece = stop, stop + limit, piece + 1
                columns = list(zip(*out)) or [[]] * 5
                yield pa.RecordBatch.from_arrays([
                    pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int32()),
                    pa.array(columns[2], pa.int64()), pa.array(columns[3], pa.int64()),
                    pa.array(columns[4], pa.int64()), pa.nulls(len(out), pa.int64()),
                ], names=["doc_id", "piece", "start", "length", "ids_crc32", "fill"])

    return run


def best_fit_decreasing(lengths: np.ndarray, limit: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bin and offset of each item, and fill of each bin.  Open bins are stacked by free space; the bits of a number
    tell which stacks hold any, so the tightest fit is its lowest set bit from the item's length on."""
    stacks: list[list[int]] = [[] for _ in range(limit + 1)]
    bits, fills = 0, []
    bins, offsets = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    for i in np.argsort(-lengths, kind="stable").tolist():
        size = int(lengths[i])
        fitting = bits >> size
        if fitting:
            free = size + (fitting & -fitting).bit_length() - 1
            b = stacks[free].pop()
            if not stacks[free]:
                bits ^= 1 << free
        else:
            free, b = limit, len(fills)
            fills.append(0)
        bins[i], offsets[i] = b, fills[b]
        fills[b] += size
        if rest := free - size:
            stacks[rest].append(b)
            bits |= 1 << rest
    return bins, offsets, np.array(fills, np.int64)


def lower_bound(counts: np.ndarray, limit: int) -> int:
    """Bins that any packing needs, from the number of items of each length 0..limit, by dual feasible functions:
    the total size; those that leave out items under t and count ones over limit - t as whole bins; and rounding ones.
    """
    sizes = np.arange(limit + 1)
    best = math.ceil(int((counts * sizes).sum()) / limit)
    above, mass = np.cumsum(counts[::-1])[::-1], np.cumsum(counts * sizes)
    for t in range(1, limit // 2 + 1):
        big = int(above[limit - t + 1])
        middle = int(mass[limit - t] - mass[t - 1])
        best = max(best, big + math.ceil(middle / limit))
    for k in range(1, 33):
        up = (k + 1) * sizes
        value = np.where(up % limit == 0, sizes * k, (up // limit) * limit)  # scaled by k * limit
        best = max(best, math.ceil(int((counts * value).sum()) / (k * limit)))
    return best


def packed_parts(limit: int):
    """Task function for the pieces of one part: packs them, and returns the part's bound in `need`."""

    def run(key, table):
        lengths = table.column("length").to_numpy()
        bins, offsets, fills = best_fit_decreasing(lengths, limit)
        need = lower_bound(np.bincount(lengths, minlength=limit + 1), limit)
        n = len(lengths)
        names = ["doc_id", "piece", "start", "length", "ids_crc32"]
        return pa.Table.from_arrays(
            [table.column(c) for c in names] + [
                pa.array(fills[bins]), pa.array(bins), pa.array(offsets),
                pa.array(np.full(n, key[0].as_py(), np.int32)), pa.array(np.full(n, len(fills), np.int64)),
                pa.array(np.full(n, need, np.int64))],
            names=[*names, "fill", "bin", "offset", "part", "bins", "need"])

    return run


def pack(pieces: DataFrame, limit: int = 1024, task_pieces: int = TASK_PIECES, rounds: int = 4) -> DataFrame:
    """Place pieces (doc_id, piece, start, length, ids_crc32) in sequences of at most `limit` tokens.

    Pieces are dealt to parts by hash and each part is packed by best-fit decreasing.  A part whose bins equal its
    lower bound is certified and done.  The others keep their full bins and exchange what is in the bins with gaps:
    it is dealt anew, to as few parts as hold it, and packed again, until the bins of all equal the bound of all, a
    round saves nothing, or `rounds` are over.  Full-length pieces need no packing.
    Adds `sequence_id` (any numbers) and `offset` (gapless from 0 in a sequence).
    """
    names = ["doc_id", "piece", "start", "length", "ids_crc32"]
    # Even numbers for pieces that fill a sequence, odd ones made of round, part and bin for the others.
    out = pieces.where(F.col("length") >= limit).select(
        *names, (F.monotonically_increasing_id() * 2).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))

    def numbered(placed: DataFrame) -> DataFrame:
        number = (F.col("round") * F.lit(1 << 58) + F.col("part") * F.lit(1 << 24) + F.col("bin")) * 2 + 1
        return placed.select(*names, number.alias("sequence_id"), "offset")

    layout = f"{PIECES}, bin long, offset long, part int, bins long, need long"
    left, before, bins_before = pieces.where(F.col("length") < limit).select(*names), None, None
    for r in range(rounds):
        if (n := left.count()) == 0:
            break
        parts = max(1, math.ceil(n / task_pieces))
        part = F.pmod(F.xxhash64("doc_id", "piece", "start", F.lit(r)), F.lit(parts)).cast("int")
        dealt = left.withColumn("part", part).groupBy("part")
        placed = kept(dealt.applyInArrow(packed_parts(limit), layout), f"pack-{r}").withColumn(
            "round", F.lit(r).cast("long"))
        # One row for each part, then one for each length.
        told = placed.groupBy("part").agg(F.max("bins").alias("bins"), F.max("need").alias("need"))
        bins, gaps = told.agg(F.sum("bins"), F.sum(F.col("bins") - F.col("need"))).first()
        counts = np.zeros(limit + 1, np.int64)
        for row in placed.groupBy("length").count().collect():
            counts[row["length"]] = row["count"]
        if before is not None and bins >= bins_before:
            break  # the exchange saved nothing: the former places hold
        last = bins <= lower_bound(counts, limit) or (parts == 1 and gaps == 0) or r + 1 == rounds
        if last:
            out, before = out.unionByName(numbered(placed)), None
            break
        out = out.unionByName(numbered(placed.where(F.col("fill") >= limit)))
        before = placed.where(F.col("fill") < limit)
        left = before.select(*names)
        bins_before = before.select("part", "bin").distinct().count()
    if before is not None:
        out = out.unionByName(numbered(before))
    return out


def packed_documents(documents: DataFrame, tokenizer: str, limit: int = 1024, end: int = 2) -> DataFrame:
    """Tokenise documents (doc_id, text) and pack them: one row for each piece.

    A document is its ids and then `end`; a null text is an empty one, so it is a piece of one token.  Repeated rows
    are packed each, null ids stay null, an empty table gives an empty one, further columns are not looked at.
    """
    cut = documents.select("doc_id", "text").mapInArrow(pieces_of(tokenizer, limit, end), PIECES)
    return pack(kept(cut, "pieces"), limit)
