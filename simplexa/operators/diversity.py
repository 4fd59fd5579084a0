"""Within-sample diversity and between-sample distances."""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from simplexa.names import FEATURE, SAMPLE, VALUE
from simplexa.operators.composition import SparseClr, cell_totals
from simplexa.operators.joins import every_pair, not_broadcast, spread_out
from simplexa.operators.ordered import positions
from simplexa.sources.shared import stored

ALPHA_METRICS = ("observed_features", "shannon", "pielou_e", "simpson")
BETA_METRICS = ("braycurtis", "jaccard", "aitchison")

LARGEST_BLOCK = 2048
SMALLEST_BLOCK = 64
FEATURE_BLOCK = 1024
PAIRS_A_BATCH = 1 << 18
# Cells of a block of samples, about.
BLOCK_CELLS = 1 << 20


def block_count(samples: DataFrame, block: int | None = None) -> Column:
    """Into how many blocks to cut the samples, as a scalar of the plan.

    Blocks are as large as memory allows, since every cell is read once per
    block, but few samples are cut finer to give each core a pair of blocks.
    """
    rows = samples.agg(F.count(F.lit(1))).scalar()
    if block is not None:
        return F.greatest(F.lit(1), F.ceil(rows / block).cast("int"))
    cores = samples.sparkSession.sparkContext.defaultParallelism
    for_cores = F.least(F.ceil(rows / SMALLEST_BLOCK), F.lit(math.ceil(math.sqrt(2 * cores))))
    return F.greatest(F.lit(1), F.ceil(rows / LARGEST_BLOCK), for_cores).cast("int")


def alpha_diversity(
    long: DataFrame, metrics: Sequence[str] = ALPHA_METRICS, unique: bool = False
) -> DataFrame:
    """Sample, Metric, Value from one aggregation pass over the cells.

    An empty sample has Shannon and evenness 0 and no Simpson index; evenness
    of a single present feature is null.  ``unique`` promises one row per cell.
    """
    unknown = set(metrics) - set(ALPHA_METRICS)
    if unknown:
        raise ValueError(f"unknown alpha metrics: {sorted(unknown)}")
    x = F.col(VALUE)
    sums = cell_totals(long, unique).groupBy(SAMPLE).agg(
        F.sum(x).alias("s"),
        F.sum(x * x).alias("q"),
        F.sum(F.when(x > 0, x * F.log2(x))).alias("l"),
        F.count(F.when(x > 0, 1)).cast("double").alias("observed_features"),
    )
    filled = F.col("s") > 0
    richness = F.col("observed_features")
    # Clamped: for one present feature rounding may leave a tiny negative.
    entropy = F.greatest(F.log2("s") - F.col("l") / F.col("s"), F.lit(0.0))
    measured = sums.select(
        SAMPLE,
        "observed_features",
        F.when(filled, entropy).otherwise(0.0).alias("shannon"),
        F.when(~filled, 0.0)
        .when(richness >= 2, entropy / F.log2(richness))
        .alias("pielou_e"),
        F.when(filled, 1 - F.col("q") / (F.col("s") * F.col("s"))).alias("simpson"),
    )
    return measured.unpivot([SAMPLE], list(metrics), "Metric", "Value")


def _blocks(cells: DataFrame, heads: DataFrame, features: DataFrame, block: int | None) -> DataFrame:
    """Blocks of samples, one row each: _block, and _rows with Sample, x of its head, and its cells as two arrays.

    Blocks are stored, and hold a bounded number of cells.
    """
    index = positions(features, [], [FEATURE], "_code", store=False).select(
        FEATURE, (F.col("_code") - 1).cast("int").alias("c"))
    gathered = (
        cells.join(index, FEATURE).groupBy(SAMPLE).agg(F.collect_list(F.struct("c", "x")).alias("_cells"))
    )
    count = block_count(heads, block)
    if block is None:
        held = cells.agg(F.count(F.lit(1))).scalar()
        count = F.greatest(count, F.ceil(held / BLOCK_CELLS).cast("int"))
    named = heads.filter(F.col(SAMPLE).isNotNull())
    packed = named.join(not_broadcast(gathered), SAMPLE, "left").select(
        F.pmod(F.xxhash64(SAMPLE), count).cast("int").alias("_block"),
        F.struct(
            SAMPLE, "x",
            F.coalesce("_cells.c", F.array().cast("array<int>")).alias("codes"),
            F.coalesce("_cells.x", F.array().cast("array<double>")).alias("values"),
        ).alias("_row"),
    )
    return stored(spread_out(packed, "_block").groupBy("_block").agg(F.collect_list("_row").alias("_rows")), "blocks")


def _tile_distances(metric: str, feature_block: int, width: float):
    """Distances of pairs of blocks of samples.

    A tile holds its matrix of sums over all blocks of features and the cells of both sides.
    """

    class Side:
        def __init__(self, rows: pa.StructArray):
            names, x, codes, values = rows.flatten()
            self.names, self.x = names, x.to_numpy(zero_copy_only=False)
            sizes = codes.value_lengths().to_numpy(zero_copy_only=False)
            self.at = np.repeat(np.arange(len(sizes)), sizes)
            self.codes = codes.flatten().to_numpy(zero_copy_only=False)
            self.values = values.flatten().to_numpy(zero_copy_only=False)
            # Cells by block of features.
            of = self.codes // feature_block
            order = np.argsort(of, kind="stable")
            self.at, self.codes, self.values = self.at[order], self.codes[order], self.values[order]
            self.blocks, self.first = np.unique(of[order], return_index=True)
            self.first = np.append(self.first, len(of))
            self.used = {b: np.unique(self.cells(b)[1]) for b in self.blocks.tolist()}

        def cells(self, block: int):
            k = np.searchsorted(self.blocks, block)
            own = slice(self.first[k], self.first[k + 1]) if k < len(self.blocks) and self.blocks[k] == block else slice(0, 0)
            return self.at[own], self.codes[own] - block * feature_block, self.values[own]

        def matrix(self, block: int, used: np.ndarray) -> np.ndarray:
            """Values of the used features of a block."""
            at, codes, values = self.cells(block)
            out = np.repeat((self.x if metric == "aitchison" else np.zeros(len(self.x)))[:, None], len(used), axis=1)
            out[at, np.searchsorted(used, codes)] = values
            return out

    def tile(left: Side, right: Side):
        part, seen = np.zeros((len(left.x), len(right.x))), 0
        for block in np.union1d(left.blocks, right.blocks).tolist():
            used = np.union1d(left.used.get(block, ()), right.used.get(block, ())).astype(int)
            seen += len(used)
            a = left.matrix(block, used)
            b = a if right is left else right.matrix(block, used)
            if metric == "jaccard":
                part += a @ b.T
                continue
            for row in range(len(a)):
                # Within a block of samples a pair is met once.
                at = row + 1 if right is left else 0
                if metric == "braycurtis":
                    part[row, at:] += np.minimum(a[row], b[at:]).sum(axis=1)
                else:
                    gap = b[at:] - a[row]
                    part[row, at:] += np.einsum("ij,ij->i", gap, gap)
        return part, seen

    def ended(left: Side, right: Side, part: np.ndarray, used: int):
        text = pa.concat_arrays([left.names, right.names])
        names = text.to_numpy(zero_copy_only=False)
        place = np.empty(len(names), dtype=np.int64)
        place[np.argsort(names, kind="stable")] = np.arange(len(names))
        x, y = left.x, right.x
        step = max(1, PAIRS_A_BATCH // max(1, len(y)))
        for at in range(0, len(x), step):
            rows = slice(at, min(at + step, len(x)))
            one, two, sums = x[rows, None], y[None, :], part[rows]
            if metric == "aitchison":
                gap = one - two
                distance = np.sqrt(np.maximum(sums + (width - used) * gap * gap, 0.0))
            else:
                whole = one + two
                shared = 2 * sums if metric == "braycurtis" else sums
                whole = whole if metric == "braycurtis" else whole - shared
                distance = np.where(whole > 0, 1 - shared / np.where(whole > 0, whole, 1.0), 0.0)
            i, j = (k.ravel() for k in np.indices(distance.shape, dtype=np.int32))
            i, distance = i + rows.start, distance.ravel()
            if right is left:
                keep = i < j
                i, j, distance = i[keep], j[keep], distance[keep]
            j = j + len(x)
            ordered = place[i] < place[j]
            yield pa.RecordBatch.from_arrays(
                [text.take(pa.array(np.where(ordered, i, j))), text.take(pa.array(np.where(ordered, j, i))),
                 pa.array(distance)], names=["sample_i", "sample_j", "distance"])

    def measure(batches):
        held = (None, None)
        for batch in batches:
            one, two, rows, others = (batch.column(c) for c in range(4))
            for k in range(batch.num_rows):
                first, second = one[k].as_py(), two[k].as_py()
                # The rows of a task come with one left block after another.
                if held[0] != first:
                    held = first, Side(rows.slice(k, 1).flatten())
                left = held[1]
                right = left if first == second else Side(others.slice(k, 1).flatten())
                yield from ended(left, right, *tile(left, right))

    return measure


def beta_diversity(
    table: DataFrame | SparseClr,
    metric: str,
    sample_block: int | None = None,
    feature_block: int = FEATURE_BLOCK,
    unique: bool = False,
) -> DataFrame:
    """Distances of all sample pairs: sample_i < sample_j, distance.

    ``braycurtis`` and ``jaccard`` (presence) take a long count table,
    ``aitchison`` a sparse CLR.  Samples are hashed into blocks, which are stored
    once; tasks read them two at a time and add one block of features after
    another, so neither cells nor partial distances are shuffled by pair.  The
    output has one row per pair of samples by definition.  Samples without a name have no pairs.  ``unique`` is
    for a stored table with one row per cell.
    """
    if metric not in BETA_METRICS:
        raise ValueError(f"metric must be one of {BETA_METRICS}")
    if metric == "aitchison":
        if not isinstance(table, SparseClr):
            raise ValueError("aitchison takes the result of clr()")
        cells = table.cells.select(SAMPLE, FEATURE, F.col("clr").alias("x"))
        heads = table.baseline.select(SAMPLE, F.col("baseline").alias("x"))
        features = table.features
    else:
        totals = cell_totals(table, unique)
        if not unique:
            totals = stored(totals, "cells")
        x = F.col(VALUE) if metric == "braycurtis" else F.lit(1.0)
        cells = totals.filter(F.col(VALUE) > 0).select(SAMPLE, FEATURE, x.alias("x"))
        measure = F.when(F.col(VALUE) > 0, x).otherwise(0.0)
        heads = totals.groupBy(SAMPLE).agg(F.sum(measure).alias("x"))
        features = totals.select(FEATURE).distinct()

    blocks = _blocks(cells, heads, features, sample_block)
    width = float(features.count())
    # Each two blocks once, and as many pairs with the one as with the other in front.
    i, j = F.col("_i"), F.col("_j")
    once = (i == j) | ((i < j) == ((i + j) % 2 == 0))
    pairs = every_pair(
        blocks.select(F.col("_block").alias("_i"), F.col("_rows").alias("_left")),
        blocks.select(F.col("_block").alias("_j"), F.col("_rows").alias("_right")), once)
    return pairs.select("_i", "_j", "_left", "_right").mapInArrow(
        _tile_distances(metric, feature_block, width), "sample_i string, sample_j string, distance double"
    )
