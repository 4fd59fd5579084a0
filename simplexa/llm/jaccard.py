"""Exact Jaccard join of word n-gram sets, with tries over globally ordered sets.

All n-grams have one order, that of their hashes, and a set is the sorted array of its hashes.  Cut at fixed places of
the hash range, the array is a path of segments.  Two sets over the threshold differ in few n-grams, so of one segment
more than that number at least one is the same in both: those that share a segment at the same place are the only
candidates.  Candidates whose sketches (bits for odd numbers of hashes) are close enough are then joined in tries:
sorted arrays share the work on their common beginnings, and a subtree ends as soon as the n-grams that remain cannot
reach the needed overlap.
"""

from __future__ import annotations

import math
from bisect import bisect_right

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from simplexa.llm.components import components
from simplexa.llm.store import kept, slots
from simplexa.llm.urls import filled
from simplexa.llm.words import byte_values, hashed_words, mix, parts, shingles, spaced_words

WIRE = ("slot int, kind int, doc_id long, digest long, node long, size long, handle long, key long, base long,"
        " body binary")
NAMES = ["slot", "kind", "doc_id", "digest", "node", "size", "handle", "key", "base", "body"]
TYPES = [pa.int32(), pa.int32(), *[pa.int64()] * 7, pa.binary()]
DOCUMENT, SHARED, BUNDLE = 0, 1, 2
#: Documents and segments that a task holds before it passes them on; members that a trie holds.
FLUSH_DOCUMENTS, FLUSH_SEGMENTS, TRIE = 20_000, 400_000, 256
#: Levels of segments before single n-grams.
LEVELS = 8
#: Sketch bits for each n-gram of a set, at least.
SKETCH = 2
#: Sets and n-grams of a block.
BLOCK_SETS, BLOCK_GRAMS = 1536, 3_000_000


class Bands:
    """Sizes in bands such that partners are in the same band or the next.

    Pairs whose smaller set is in band g have at most `differ(g)` n-grams that only one of them has.
    """

    def __init__(self, num: int, den: int):
        self.num, self.den = num, den
        self.begins = [1]
        while self.begins[-1] < 1 << 40:
            self.begins.append(self.begins[-1] * den // num + 1)
        self.bounds: dict[tuple[int, int], np.ndarray] = {}

    def of(self, size: int) -> int:
        return bisect_right(self.begins, size) - 1

    def differ(self, g: int) -> int:
        """The most n-grams that only one set of a pair in band g has."""
        small = self.begins[g + 1] - 1
        return (small + small * self.den // self.num) * (self.den - self.num) // (self.den + self.num)

    def limits(self, g: int, level: int) -> np.ndarray:
        """Where the segments of band g begin, in the upper half of the hash.  Each level has more of them: by three
        times those that a set leaves empty on average."""
        if (g, level) not in self.bounds:
            n = self.differ(g) + 1
            empty = math.exp(-(self.den + self.num) / (2 * (self.den - self.num))) if self.num < self.den else 0
            n += (level + 1) * math.ceil(3 * n * empty + 0.5)
            self.bounds[g, level] = (np.arange(n + 1, dtype=np.float64) * (2.0**32 / n)).astype(np.uint64)
        return self.bounds[g, level]


def sets_of(texts: pa.Array, k: int):
    """Sorted distinct n-gram hashes of each text of a column."""
    values = byte_values(spaced_words(), True)
    for _, data, offsets in parts(texts):
        words, at = hashed_words(data, offsets, values)
        for i in range(len(at) - 1):
            yield np.unique(shingles(words[at[i] : at[i + 1]], k))


def shared_rows(slot: np.ndarray, key: np.ndarray, handle: np.ndarray):
    """SHARED rows in batches."""
    for i in range(0, len(key), 50_000):
        n = len(key[i : i + 50_000])
        empty = pa.nulls(n, pa.int64())
        yield pa.RecordBatch.from_arrays([
            pa.array(slot[i : i + 50_000].astype(np.int32)), pa.array(np.full(n, SHARED, np.int32)), empty, empty,
            empty, empty, pa.array(handle[i : i + 50_000]), pa.array(key[i : i + 50_000].view(np.int64)), empty,
            pa.nulls(n, pa.binary())], names=NAMES)


def node_of(grams: np.ndarray) -> int:
    """A digest of a set, 0 for the empty one."""
    if not len(grams):
        return 0
    return int((mix(np.array([mix(grams).sum() + np.uint64(len(grams))], np.uint64)) | np.uint64(1)).view(np.int64)[0])


def sketch(grams: np.ndarray) -> bytes:
    """Bits that say whether an odd number of a set's hashes falls on each; their number is a power of two."""
    bits = 64
    while bits < SKETCH * len(grams):
        bits *= 2
    return differing([grams], bits).tobytes()


def folded(body: bytes, words: int) -> np.ndarray:
    """A sketch with so many words at most: halves are laid on one another, as if it had been made with fewer bits."""
    out = np.frombuffer(body, np.uint64)
    while len(out) > words:
        out = out[: len(out) // 2] ^ out[len(out) // 2 :]
    return out


def segments(grams: np.ndarray, bands: Bands) -> np.ndarray:
    """Digests of the segments of a set, for its own band as the smaller partner and the band before as the larger.

    An empty segment says nothing and has no digest.  Where more than `differ` segments of a level hold something, one
    of these is the same in any partner; else the set is told at the next level too, and last by its n-grams alone.
    Partners meet at the lower of their last levels, where one of them has that many.
    """
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(grams ^ np.uint64(0x5BF0)))])
    upper, own, out = grams >> np.uint64(32), bands.of(len(grams)), []
    for g in (own, own - 1) if own else (own,):
        for level in range(LEVELS):
            limits = bands.limits(g, level)
            at = np.searchsorted(upper, limits)
            at[-1] = len(grams)
            held = np.flatnonzero(at[1:] > at[:-1])
            place = held.astype(np.uint64) + np.uint64((level << 52) + (g << 40) + 1)
            out.append(mix((sums[at[held + 1]] - sums[at[held]]) ^ mix(place)))
            if len(held) > bands.differ(g):
                break
        else:
            out.append(mix(grams ^ mix(np.array([(LEVELS << 52) + (g << 40)], np.uint64))))
    return np.concatenate(out)


def paths(k: int, num: int, den: int, slots_: int):
    """Task function: (doc_id, text) to WIRE: each document, and each distinct set's segments, bundled by slot.

    Sets of a task that share a segment are told as SHARED rows, and one of them goes into the bundle for all, so a
    segment of any number of sets leaves each task once.
    """

    def run(batches):
        bands, task = Bands(num, den), TaskContext.get().partitionId() << 36
        seen = 0
        keys: list[np.ndarray] = []
        owners: list[int] = []
        nodes: set[int] = set()
        held = 0

        def batch_of(rows: list[tuple]):
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*rows), TYPES)], names=NAMES)

        def flush(base: int):
            if not keys:
                return
            key = np.concatenate(keys)
            owner = np.repeat(np.array(owners, np.int64), [len(x) for x in keys])
            order = np.lexsort((owner, key))
            key, owner = key[order], owner[order]
            first = np.ones(len(key), bool)
            first[1:] = key[1:] != key[:-1]
            alone = first.copy()
            alone[:-1] &= first[1:]
            both = np.flatnonzero(~alone)
            yield from shared_rows(np.arange(len(both)) % slots_, key[both], owner[both])
            key, owner = key[first], (owner[first] - base).astype(np.uint16)
            slot = (key % np.uint64(slots_)).astype(np.int64)
            order = np.argsort(slot, kind="stable")
            ends = np.searchsorted(slot[order], np.arange(slots_ + 1))
            rows = []
            for s in range(slots_):
                mine = order[ends[s] : ends[s + 1]]
                if len(mine):
                    body = key[mine].tobytes() + owner[mine].tobytes()
                    rows.append((s, BUNDLE, *[None] * 6, base, body))
            if rows:
                yield batch_of(rows)

        base = task
        for batch in batches:
            ids, rows = zip(batch.column("doc_id").to_pylist(), batch.column("digest").to_pylist()), []
            for (doc, digest), grams in zip(ids, sets_of(batch.column("text"), k)):
                node, handle, body = node_of(grams), None, None
                if node and node not in nodes:
                    nodes.add(node)
                    handle, body = task + seen, sketch(grams)
                    keys.append(segments(grams, bands))
                    owners.append(handle)
                    held += len(keys[-1])
                    seen += 1
                rows.append((seen % slots_, DOCUMENT, doc, digest, node, len(grams), handle, None, None, body))
                if held >= FLUSH_SEGMENTS or len(owners) >= FLUSH_DOCUMENTS:
                    yield from flush(base)
                    keys, owners, nodes, held, base = [], [], set(), 0, task + seen
            if rows:
                yield batch_of(rows)
        yield from flush(base)

    return run


def met(batches):
    """Task function: passes documents and shared segments on, and finds segments that several bundles hold."""
    keys, owners = [], []
    for batch in batches:
        kind = batch.column("kind").to_numpy()
        if (rest := np.flatnonzero(kind != BUNDLE)).size:
            yield batch.take(pa.array(rest))
        for i in np.flatnonzero(kind == BUNDLE).tolist():
            body = batch.column("body")[i].as_py()
            n = len(body) // 10
            keys.append(np.frombuffer(body, np.uint64, n))
            owners.append((np.frombuffer(body, np.uint16, n, 8 * n), np.int64(batch.column("base")[i].as_py())))
    if not keys:
        return
    # A part of the keys at a time: by their highest bits, as their lowest chose the slot.
    for part in range(16):
        mine = [k >> np.uint64(60) == np.uint64(part) for k in keys]
        key = np.concatenate([k[m] for k, m in zip(keys, mine)])
        owner = np.concatenate([o[m] + base for (o, base), m in zip(owners, mine)])
        order = np.argsort(key, kind="stable")
        key, owner = key[order], owner[order]
        same = np.zeros(len(key), bool)
        same[1:] = key[1:] == key[:-1]
        same[:-1] |= same[1:]
        at = np.flatnonzero(same)
        yield from shared_rows(np.zeros(len(at)), key[at], owner[at])


def passing(wanted):
    """Task function: rows whose digest may be in the filter."""

    def run(batches):
        for batch in batches:
            digest = batch.column("digest").to_numpy().view(np.uint64)
            yield batch.filter(pa.array(wanted.has(digest, digest)))

    return run


def checked_sets(k: int):
    """Task function: (node, text) to (node, size, grams) where the text has that node's set: the sorted
    hashes, big end first, so that bytes sort alike."""

    def run(batches):
        for batch in batches:
            nodes, kept_, out = batch.column("node").to_pylist(), [], []
            for node, grams in zip(nodes, sets_of(batch.column("text"), k)):
                if node_of(grams) == node:
                    kept_.append(node)
                    out.append(grams)
            yield pa.RecordBatch.from_arrays([
                pa.array(kept_, pa.int64()), pa.array([len(g) for g in out], pa.int64()),
                pa.array([g.astype(">u8").tobytes() for g in out], pa.binary())], names=["node", "size", "grams"])

    return run


class Trie:
    """Sorted arrays against one array: work on a common beginning is done once, hopeless subtrees are left."""

    STEP = 64

    def __init__(self, other: np.ndarray, num: int, den: int):
        self.other, self.num, self.den = other, num, den
        self.last = np.zeros(0, np.uint64)
        self.found = np.zeros(1, np.int64)  # n-grams of `last` in `other`, up to each place that was visited

    def links(self, mine: np.ndarray) -> bool:
        """Arrays come in their sorted order."""
        n, m = len(mine), len(self.other)
        # overlap * den >= num * union, with union = n + m - overlap
        need = -(-self.num * (n + m) // (self.num + self.den))
        common = min(n, len(self.last))
        differ = np.flatnonzero(mine[:common] != self.last[:common])
        shared = min(int(differ[0]) if len(differ) else common, len(self.found) - 1)
        self.last, self.found = mine, self.found[: shared + 1]
        at = shared
        while at < n:
            passed = int(np.searchsorted(self.other, mine[at]))
            if int(self.found[at]) + min(n - at, m - passed) < need:
                return False  # all that go on from here end with it
            some = mine[at : at + self.STEP]
            where = np.minimum(np.searchsorted(self.other, some), max(m - 1, 0))
            hit = np.cumsum(self.other[where] == some) + self.found[at] if m else np.zeros(len(some), np.int64)
            self.found = np.concatenate([self.found, hit])
            at += len(some)
        return int(self.found[n]) >= need


def joined(num: int, den: int):
    """Task function over rows (a, b, part, own, grams) sorted by (b, part, own first, grams): linked pairs (a, b)."""

    def run(batches):
        now, trie = None, None
        for batch in batches:
            a, b, part = (batch.column(c).to_pylist() for c in ("a", "b", "part"))
            own, left, right = batch.column("own").to_pylist(), [], []
            for i, body in enumerate(batch.column("grams")):
                grams = np.frombuffer(body.as_py(), ">u8").astype(np.uint64)
                if own[i]:
                    now, trie = (b[i], part[i]), Trie(grams, num, den)
                elif now == (b[i], part[i]) and trie.links(grams):
                    left.append(a[i])
                    right.append(b[i])
            yield pa.RecordBatch.from_arrays([pa.array(left, pa.int64()), pa.array(right, pa.int64())], ["a", "b"])

    return run


def linked_pairs(pairs: DataFrame, sets: DataFrame, num: int, den: int) -> DataFrame:
    """Those of the pairs (a, b) of sets (node, grams) that are over the threshold.  The sets that b is paired with
    are dealt to tries of a bounded number of members."""
    counts = pairs.groupBy("b").agg(F.count("*").alias("_n"))
    spread = pairs.join(counts, "b").withColumn(
        "part", F.pmod(F.xxhash64("a"), F.ceil(F.col("_n") / TRIE)).cast("int")).select("a", "b", "part")
    members = spread.join(sets.select(F.col("node").alias("a"), "grams"), "a").select(
        "a", "b", "part", F.lit(0).alias("own"), "grams")
    roots = spread.select("b", "part").distinct().join(sets.select(F.col("node").alias("b"), "grams"), "b").select(
        F.col("b").alias("a"), "b", "part", F.lit(1).alias("own"), "grams")
    rows = members.unionByName(roots).repartition(slots(pairs.sparkSession), "b", "part").sortWithinPartitions(
        "b", "part", F.desc("own"), "grams")
    return rows.mapInArrow(joined(num, den), "a long, b long")


def differing(grams: list[np.ndarray], bits: int) -> np.ndarray:
    """One row of bits for each set: whether an odd number of its hashes falls on each.  Two sets differ in at least
    as many n-grams as their rows do in bits."""
    out = np.zeros((len(grams), bits // 64), np.uint64)
    for i, g in enumerate(grams):
        odd = np.bincount((g % np.uint64(bits)).astype(np.int64), minlength=bits) & 1
        out[i] = np.packbits(odd.astype(np.uint8)).view(np.uint64)
    return out


def block_links(nodes: list[int], sides: list[int], labels: list[int], sizes: list[int], bodies: list[bytes],
                num: int, den: int):
    """Links between sets of different labels that join their components.  Sets come in sorted order; if both sides
    are there, only sets of different sides are compared."""
    sizes = np.array(sizes, np.int64)
    grams = [np.frombuffer(b, ">u8").astype(np.uint64) for b in bodies]
    marks = differing(grams, 64 * max(1, int(sizes.max()) // 16))
    side, two, label, out = np.array(sides), len(set(sides)) == 2, np.array(labels, np.int64), []
    for i in range(1, len(nodes)):
        near = np.minimum(sizes[:i], sizes[i]) * den >= np.maximum(sizes[:i], sizes[i]) * num
        near &= label[:i] != label[i]
        if two:
            near &= side[:i] != side[i]
        at = np.flatnonzero(near)
        if not len(at):
            continue
        apart = np.bitwise_count(marks[at] ^ marks[i]).sum(axis=1, dtype=np.int64)
        at = at[apart * (den + num) <= (sizes[at] + sizes[i]) * (den - num)]
        trie = Trie(grams[i], num, den)
        for j in at.tolist():
            if label[j] != label[i] and trie.links(grams[j]):
                out.append((nodes[i], nodes[j]))
                label[label == label[j]] = label[i]
    return out


def close(one: np.ndarray, other: np.ndarray, sizes, size: int, num: int, den: int):
    """Whether sets with such sketches (a row each) and sizes may link with the set of the other sketch and size."""
    apart = np.bitwise_count(one ^ other).sum(axis=-1, dtype=np.int64)
    return ((np.minimum(sizes, size) * den >= np.maximum(sizes, size) * num)
            & (apart * (den + num) <= (sizes + size) * (den - num)))


def close_pairs(num: int, den: int):
    """Task function over rows (a, b, size_a, size_b, sketch_a, sketch_b): pairs (a, b) that may link."""

    def run(batches):
        for batch in batches:
            keep = []
            columns = (batch.column(c).to_pylist() for c in ("size_a", "size_b", "sketch_a", "sketch_b"))
            for size_a, size_b, one, other in zip(*columns):
                words = min(len(one), len(other)) // 8
                keep.append(bool(close(folded(one, words), folded(other, words), size_a, size_b, num, den)))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return run


def block_edges(nodes: list[int], sides: list[int], labels: list[int], sizes: list[int], bodies: list[bytes],
                num: int, den: int):
    """Edges that connect all sets of different labels that may link by their sketches; if both sides are there, only
    sets of different sides are compared.  Edges are fewer than sets."""
    size, label, side = np.array(sizes, np.int64), np.array(labels, np.int64), np.array(sides)
    words, two = min(len(b) for b in bodies) // 8, len(set(sides)) == 2
    marks, group, out = np.stack([folded(b, words) for b in bodies]), np.arange(len(nodes)), []
    for i in range(1, len(nodes)):
        apart = (label[:i] != label[i]) & (group[:i] != group[i])
        if two:
            apart &= side[:i] != side[i]
        at = np.flatnonzero(apart)
        for j in at[close(marks[at], marks[i], size[at], size[i], num, den)].tolist():
            if group[j] != group[i]:
                out.append((nodes[i], nodes[j]))
                group[group == group[j]] = group[i]
    return out


def across(meet, num: int, den: int):
    """Task function over rows (task, node, side, label, size, body) sorted by task: what `meet` finds in each task."""

    def run(batches):
        now, held = None, []
        for batch in batches:
            found = []
            columns = (batch.column(c).to_pylist() for c in ("task", "node", "side", "label", "size", "body"))
            for task, *row in zip(*columns):
                if task != now:
                    if len(held) > 1:
                        found += meet(*map(list, zip(*held)), num, den)
                    now, held = task, []
                held.append(row)
            yield pa.RecordBatch.from_arrays(
                [pa.array([f[i] for f in found], pa.int64()) for i in (0, 1)], ["a", "b"])
        if len(held) > 1:
            found = meet(*map(list, zip(*held)), num, den)
            yield pa.RecordBatch.from_arrays(
                [pa.array([f[i] for f in found], pa.int64()) for i in (0, 1)], ["a", "b"])

    return run


def in_blocks(members: DataFrame, num: int, den: int) -> DataFrame:
    """Rows (task, node, side, label, size) of the blocks that meet, from members (cluster, node, size, label).

    A cluster that one task holds is one block; others have a block for each label with many nodes and each band of
    sizes, salted to a bounded number of nodes and n-grams.  Pairs of blocks are compared unless their sizes are too
    far apart or they are of one large label.
    """
    def parts_of(count, total):
        return F.greatest(F.ceil(count / F.lit(BLOCK_SETS)), F.ceil(total / F.lit(BLOCK_GRAMS))).cast("int")

    wholes = members.groupBy("cluster").agg(parts_of(F.count("*"), F.sum("size")).alias("whole"))
    large = members.groupBy("cluster", "label").agg(F.count("*").alias("n")).where(F.col("n") > BLOCK_SETS)
    banded = members.join(wholes, "cluster").join(large, ["cluster", "label"], "left").select(
        "cluster", "node", "size", "label", F.when(F.col("n").isNotNull(), F.col("label")).otherwise(0).alias("large"),
        F.when(F.col("whole") > 1, F.floor(F.log(F.col("size").cast("double")) / F.lit(np.log(den / num).item())))
        .otherwise(0).cast("int").alias("band"))
    sides = banded.groupBy("cluster", "large", "band").agg(
        parts_of(F.count("*"), F.sum("size")).alias("parts"), F.min("size").alias("low"), F.max("size").alias("high"))
    placed = banded.join(sides.select("cluster", "large", "band", "parts"), ["cluster", "large", "band"]).select(
        "cluster", "node", "label", "size",
        F.struct("large", "band", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int").alias("salt")).alias("block"))
    blocks = sides.select("cluster", "low", "high", "large", "band", F.explode(
        F.sequence(F.lit(0), F.col("parts") - 1)).alias("salt")).select(
        "cluster", "low", "high", F.struct("large", "band", "salt").alias("block"))
    one, other = (blocks.select("cluster", *(F.col(c).alias(f"{c}_{i}") for c in ("low", "high", "block")))
                  for i in (1, 2))
    meet = one.join(other, "cluster").where(
        (F.col("block_1") <= F.col("block_2"))
        & (F.greatest("low_1", "low_2") * num <= F.least("high_1", "high_2") * den)
        & ((F.col("block_1.large") != F.col("block_2.large")) | (F.col("block_1.large") == 0)))
    meet = kept(meet.select("cluster", "block_1", "block_2", F.monotonically_increasing_id().alias("task")), "blocks")
    first = meet.select("cluster", F.col("block_1").alias("block"), "task", F.lit(0).alias("side"))
    second = meet.where("block_1 <> block_2").select(
        "cluster", F.col("block_2").alias("block"), "task", F.lit(1).alias("side"))
    return first.union(second).join(placed, ["cluster", "block"]).select("task", "node", "side", "label", "size")


def met_in(rows: DataFrame, bodies: DataFrame, meet, num: int, den: int) -> DataFrame:
    """(a, b) that `meet` finds in each task of rows (task, node, side, label, size), with bodies (node, body)."""
    dealt = rows.join(bodies, "node").repartition(slots(rows.sparkSession), "task").sortWithinPartitions("task", "body")
    return dealt.mapInArrow(across(meet, num, den), "a long, b long")


def clusters_of(shared: DataFrame, sketches: DataFrame, num: int, den: int) -> DataFrame:
    """(cluster, node, size, label) of those nodes of `shared` (key, node, size, label) that may link to others of
    another label.  They share a key and their sketches are close; nodes that such pairs lead to are one cluster.

    Of the keys of the very same nodes one is looked at.  Nodes of a key meet as sketches, in blocks where they are
    many, and only the edges that connect them leave a task.
    """
    shared = shared.repartition(slots(shared.sparkSession), "key")
    keys = shared.groupBy("key").agg(
        F.min("label").alias("_a"), F.max("label").alias("_b"), F.count("*").alias("n"),
        F.bit_xor(F.xxhash64("node")).alias("_x"), F.bit_xor(F.xxhash64(F.lit(1), "node")).alias("_y"))
    chosen = keys.where("_a < _b").groupBy("n", "_x", "_y").agg(F.min("key").alias("key")).select("key", "n")
    open_ = kept(shared.join(chosen, "key"), "open")
    little = open_.where(F.col("n") <= BLOCK_SETS).select(
        F.col("key").alias("task"), "node", F.lit(0).alias("side"), "label", "size")
    much = open_.where(F.col("n") > BLOCK_SETS).select(F.col("key").alias("cluster"), "node", "size", "label")
    bodies = sketches.select("node", F.col("sketch").alias("body"))
    edges = met_in(little, bodies, block_edges, num, den).union(
        met_in(in_blocks(much, num, den), bodies, block_edges, num, den))
    clusters = components(edges.distinct()).withColumnRenamed("component", "cluster")
    return kept(open_.select("node", "size", "label").distinct().join(clusters, "node"), "clusters")


def jaccard_components(documents: DataFrame, k: int = 3, num: int = 90, den: int = 100) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row of documents (doc_id, text), by exact links.

    Words are lower-cased in A-Z and separated by white space (9 to 13, 32); a set has the distinct runs of k words,
    or the whole sequence if that is shorter.  Texts link if num/den of the union of their sets is common; texts
    without words and null ones link with nothing.  The component is the smallest doc_id that links lead to, a row's
    own id at most; a row with a null id has a null component unless it links to one with an id.  Repeated rows stay,
    an empty table gives an empty one, further columns are not looked at.  Sets are told apart by 64-bit digests of
    their n-grams' 64-bit hashes.

    First each set is compared with one that it shares most segments with.  Then the sets that share a segment across
    components are gathered to clusters, and blocks of a cluster are compared: within a component a further link tells
    nothing, so blocks of one component do not meet, and no pair leaves its task but those that join components.
    Before any two sets are compared, their sketches are: where these differ in more bits than linked sets could in
    n-grams, the sets are not fetched.
    """
    spark = documents.sparkSession
    n = slots(spark)
    docs = documents.select("doc_id", F.xxhash64("text").alias("digest"), "text")
    told = kept(docs.mapInArrow(paths(k, num, den, n), WIRE).repartition(n, "slot").mapInArrow(met, WIRE), "paths", "kind")
    rows = told.where(F.col("kind") == DOCUMENT).select(
        "doc_id", "digest", "node", "size", "handle", F.col("body").alias("sketch"))
    handles = rows.where("handle is not null").select("handle", "node", "size")
    # All that follows for a key reads one shuffle by it; copies in several tasks share keys with themselves alone.
    keyed = told.where(F.col("kind") == SHARED).select("key", "handle").join(handles, "handle").select(
        "key", "node", "size").repartition(n, "key").distinct()

    def near(small, large):
        return F.least(small, large) * den >= F.greatest(small, large) * num

    least = keyed.groupBy("key").agg(
        F.min("node").alias("first"), F.max("node").alias("_last"), F.min_by("size", "node").alias("first_size")
    ).where("first < _last")
    shared = kept(keyed.join(least.drop("_last"), "key"), "shared")
    stars = shared.where("node <> first").where(near(F.col("size"), F.col("first_size")))
    counted = stars.groupBy("node", "first").agg(F.count("*").alias("n"))
    pairs = kept(counted.groupBy("node").agg(F.max_by("first", F.struct("n", "first")).alias("first")).select(
        F.col("node").alias("a"), F.col("first").alias("b")), "pairs")

    active = shared.select("node").distinct()
    sketches = kept(rows.where("handle is not null").select("node", "size", "sketch").join(
        active, "node", "left_semi").groupBy("node").agg(
        F.first("size").alias("size"), F.first("sketch").alias("sketch")), "sketches")
    ends = (sketches.select(*(F.col(c).alias(d) for c, d in (("node", x), ("size", f"size_{x}"), ("sketch", f"sketch_{x}"))))
            for x in "ab")
    pairs = kept(pairs.join(next(ends), "a").join(next(ends), "b").mapInArrow(
        close_pairs(num, den), "a long, b long"), "close")
    place = kept(rows.where("handle is not null").groupBy("node").agg(
        F.min(F.struct("doc_id", "digest")).alias("_at")).join(active, "node", "left_semi"), "places")

    def sets_for(nodes: DataFrame) -> DataFrame:
        """(node, grams) of these nodes, from one text of each.  Texts that no node can want are not shuffled."""
        wanted = kept(place.join(nodes.distinct(), "node").select(
            "node", F.col("_at.doc_id").alias("_doc_id"), F.col("_at.digest").alias("_digest")), "wanted")
        digests = wanted.select(F.col("_digest").alias("h0"), F.col("_digest").alias("h1"))
        some = docs.mapInArrow(passing(filled(digests, wanted.count(), 0.01, 0)), docs.schema)
        here = (F.col("digest") == F.col("_digest")) & F.col("doc_id").eqNullSafe(F.col("_doc_id"))
        made = some.join(wanted, here).select("node", "text").mapInArrow(
            checked_sets(k), "node long, size long, grams binary")
        return kept(made.groupBy("node").agg(F.first("grams").alias("grams")), "sets")

    sets = sets_for(pairs.select(F.col("a").alias("node")).union(pairs.select("b")))
    links = kept(linked_pairs(pairs, sets, num, den), "links")
    labels = kept(components(links), "labels")
    labelled = shared.join(labels.withColumnRenamed("component", "label"), "node", "left").select(
        "key", "node", "size", F.coalesce("label", "node").alias("label"))
    members = clusters_of(labelled, sketches, num, den)
    bodies = sets_for(members.select("node")).select("node", F.col("grams").alias("body"))
    links = links.union(met_in(in_blocks(members, num, den), bodies, block_links, num, den))
    found = components(links)
    roots = rows.where("node <> 0").groupBy("node").agg(F.min("doc_id").alias("root"))
    grouped = roots.join(found, "node", "left").select(
        "node", "root", F.coalesce("component", "node").alias("component"))
    smallest = grouped.groupBy("component").agg(F.min("root").alias("component_id"))
    named = grouped.join(smallest, "component").select("node", "component_id")
    return rows.join(named, "node", "left").select(
        "doc_id", F.col("size").alias("n_shingles"),
        F.when(F.col("node") == 0, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"))



def one_of_each(documents: DataFrame, k: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """Documents, all columns, less those that link to one with a smaller doc_id; rows of one id and text become one.
    Rows with a null id all stay."""
    found = jaccard_components(documents, k, num, den)
    gone = found.where("component_id < doc_id").select("doc_id").distinct()
    rows = documents.join(gone, "doc_id", "left_anti").select(*documents.columns)
    same = rows.where("doc_id is not null").dropDuplicates(["doc_id", "text"])
    return same.unionByName(rows.where("doc_id is null"))
