"""One-way permutational analysis of variance.

On Euclidean distances of a sparse CLR it works from the stored cells: sums of squares around a group's centre follow
from the squared length of the group's sum of rows, so each permutation costs a pass over the cells and no distance is
made.  Other metrics take an edge list.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from simplexa.names import FEATURE, SAMPLE
from simplexa.operators.checks import require_samples
from simplexa.operators.composition import SparseClr
from simplexa.operators.diversity import block_count
from simplexa.operators.joins import every_pair, not_broadcast, spread_out
from simplexa.operators.ordered import positions
from simplexa.sources.shared import stored

# Fixed value: number of label permutations.
PERMUTATIONS = 999
# Equal label arrangements give F values that differ only by summation order.
SAME = 1e-9


def permuted_labels(
    labels: DataFrame, group: str, permutations: int = PERMUTATIONS, seed: int = 42,
    sample: str = SAMPLE,
) -> DataFrame:
    """(permutation, sample, label, label_n); permutation 0 is the observed one.

    Samples are ordered by a hash of (seed, permutation, sample) and take the
    label at their place in the group-sorted layout, so a rerun of a lost task
    draws the same permutation and group sizes never change.
    """
    layout = positions(labels.select(sample, group), [], [group, sample], "_place", store=False)
    sizes = layout.groupBy(group).agg(
        F.min("_place").cast("int").alias("label"), F.count(F.lit(1)).cast("int").alias("label_n")
    )
    coded = layout.join(sizes, group).select("_place", sample, "label", "label_n")
    drawn = spread_out(labels, sample).select(
        sample, F.explode(F.sequence(F.lit(1), F.lit(permutations))).alias("permutation")
    )
    # Sixty bits of the hash order the samples; equal keys fall back on the name.
    text = F.concat_ws("|", F.lit(str(seed)), F.col("permutation").cast("string"), F.col(sample))
    key = F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("bigint")
    placed = positions(
        drawn.withColumn("_key", key), ["permutation"], ["_key", sample], "_place", store=False
    )
    shuffled = placed.join(not_broadcast(coded.drop(sample)), "_place").select(
        "permutation", sample, "label", "label_n"
    )
    observed = coded.select(F.lit(0).alias("permutation"), sample, "label", "label_n")
    return observed.unionByName(shuffled)


def distance_samples(distances: DataFrame) -> DataFrame:
    """Distinct samples of an edge list."""
    return distances.select(
        F.explode(F.array("sample_i", "sample_j")).alias(SAMPLE)
    ).distinct()


def _within_sums(width: int):
    """Within-group sums of one tile of squared distances, for all permutations."""

    def measure(key, edges: pd.DataFrame, names: pd.DataFrame) -> pd.DataFrame:
        first, second = key
        if edges.empty:
            return pd.DataFrame({"permutation": [], "within": []})
        left = names[names["_own"] == first]
        right = names[names["_own"] == second]
        rows, columns = pd.Index(left[SAMPLE]), pd.Index(right[SAMPLE])
        i, j = rows.get_indexer(edges["sample_i"]), columns.get_indexer(edges["sample_j"])
        turned = (i < 0) | (j < 0)
        i[turned] = rows.get_indexer(edges["sample_j"][turned])
        j[turned] = columns.get_indexer(edges["sample_i"][turned])
        # Edges of samples without a label take no part.
        known = (i >= 0) & (j >= 0)
        square = np.zeros((len(rows), len(columns)))
        square[i[known], j[known]] = edges["distance"].to_numpy()[known] ** 2
        a, b = np.stack(left["labels"]), np.stack(right["labels"])
        weight = 1.0 / np.stack(left["sizes"])
        within = np.zeros(width)
        shared = np.intersect1d(a, b)
        if len(shared) <= width:
            for label in shared:
                ours = (a == label) * weight
                within += ((square @ (b == label).astype(float)) * ours).sum(axis=0)
        else:
            for p in range(width):
                same = a[:, p][:, None] == b[:, p][None, :]
                within[p] = (square * same * weight[:, p][:, None]).sum()
        return pd.DataFrame({
            "permutation": np.arange(-1, width),
            "within": np.concatenate([[square.sum()], within]),
        })

    return measure


def permutation_statistics(
    distances: DataFrame, labels: DataFrame, group: str, permutations: int = PERMUTATIONS,
    seed: int = 42, sample: str = SAMPLE, samples: DataFrame | None = None,
    block: int | None = None,
) -> DataFrame:
    """(permutation, f) for the observed labels (0) and every permutation.

    The edge list is cut into tiles of two sample blocks.  A tile meets the
    label arrays of its own samples only and handles all permutations as one
    matrix product, so edges are never multiplied.  ``samples`` lists the
    samples of the distance table; without it the edges are read for them.
    """
    labels = labels.filter(F.col(group).isNotNull()).select(
        F.col(sample).alias(SAMPLE), F.col(group).cast("string").alias(group)
    )
    if samples is None:
        samples = distance_samples(distances)
    within_table = stored(labels.join(samples.select(SAMPLE), SAMPLE, "left_semi"), "labels")
    blocks = block_count(within_table, block)

    def block_of(column):
        return F.pmod(F.xxhash64(column), blocks).cast("int")

    arrays = (
        permuted_labels(within_table, group, permutations, seed)
        .groupBy(SAMPLE)
        .agg(F.sort_array(F.collect_list(F.struct("permutation", "label", "label_n"))).alias("_l"))
        .select(
            SAMPLE,
            F.col("_l.label").alias("labels"),
            F.col("_l.label_n").alias("sizes"),
            block_of(SAMPLE).alias("_own"),
            F.explode(F.sequence(F.lit(0), blocks - 1)).alias("_other"),
        )
        .withColumn("_i", F.least("_own", "_other"))
        .withColumn("_j", F.greatest("_own", "_other"))
        .drop("_other")
    )
    one, two = block_of("sample_i"), block_of("sample_j")
    tiles = distances.select(
        "sample_i", "sample_j", "distance",
        F.least(one, two).alias("_i"), F.greatest(one, two).alias("_j"),
    )
    sums = (
        spread_out(tiles, "_i", "_j").groupBy("_i", "_j")
        .cogroup(spread_out(arrays, "_i", "_j").groupBy("_i", "_j"))
        .applyInPandas(_within_sums(permutations + 1), "permutation int, within double")
        .groupBy("permutation")
        .agg(F.sum("within").alias("within"))
    )
    counts = within_table.agg(F.struct(
        F.count(F.lit(1)).cast("double").alias("n"),
        F.count_distinct(group).cast("double").alias("k"),
    )).scalar()
    # permutations + 2 rows.
    line = sums.withColumns({"n": counts.getField("n"), "k": counts.getField("k")})
    total = F.max(F.when(F.col("permutation") == -1, F.col("within") / F.col("n")))
    gathered = line.groupBy("n", "k").agg(
        total.alias("total"),
        F.collect_list(F.struct("permutation", "within")).alias("_rows"),
    )
    between = (F.col("total") - F.col("within")) / (F.col("k") - 1)
    return (
        gathered.select("n", "k", "total", F.inline("_rows"))
        .filter(F.col("permutation") >= 0)
        .select("permutation", "n", "k", (between / (F.col("within") / (F.col("n") - F.col("k")))).alias("f"))
    )


# Labels of one tile, and cells of one block of features.
TILE_LABELS, TILE_PERMUTATIONS, BLOCK_CELLS = 1 << 23, 64, 1 << 20


def _labels_of_tiles(width: int, permutations: int, seed: int):
    """Per tile: the labels of all samples for its permutations, packed; and per permutation and group of each the sums
    over samples.

    The labels are those of `permuted_labels`: samples, which come in the order of their names, are ordered by sixty bits
    of a hash and take the label at their place in the layout.
    """

    def measure(batches):
        for batch in batches:
            for k in range(batch.num_rows):
                tile = batch.column(0)[k].as_py()
                fields = dict(zip(("_index", "name", "group", "b", "row"), batch.column(1).slice(k, 1).flatten().flatten()))
                order = np.argsort(fields["_index"].to_numpy())
                names = [n.encode() for n in fields["name"].take(pa.array(order)).to_pylist()]
                layout = fields["group"].to_numpy()[order]
                b, row = (fields[c].to_numpy()[order] for c in ("b", "row"))
                n, groups = len(names), int(layout.max()) + 1
                kind = np.uint8 if groups <= 256 else np.int32
                placed = np.sort(layout).astype(kind)

                def drawn(p):
                    if p == 0:
                        return layout.astype(kind)
                    start = f"{seed}|{p}|".encode()
                    bits = b"".join([hashlib.md5(start + name, usedforsecurity=False).digest()[:8] for name in names])
                    keys = np.frombuffer(bits, dtype=">u8").astype(np.uint64) >> np.uint64(4)
                    out = np.empty(n, dtype=kind)
                    out[np.argsort(keys, kind="stable")] = placed
                    return out

                numbers = range(tile * width, min((tile + 1) * width, permutations + 1))
                labels = np.stack([drawn(p) for p in numbers])
                sums = np.zeros((len(numbers), 3, groups))
                for at, own in enumerate(labels):
                    sums[at] = (np.bincount(own, weights=b, minlength=groups),
                                np.bincount(own, weights=row, minlength=groups), np.bincount(own, minlength=groups))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([tile], pa.int32()), pa.array([len(numbers)], pa.int32()), pa.array([groups], pa.int32()),
                     pa.array([labels.tobytes()], pa.binary()), pa.array([sums.tobytes()], pa.binary())],
                    names=["_tile", "_count", "_groups", "_labels", "_sums"])

    return measure


def _packed_cells():
    """The cells of a block of features as one row."""

    def pack(key, cells):
        feature, seen = pd.factorize(cells[FEATURE], use_na_sentinel=False)
        return pd.DataFrame({
            "_block": [key[0]], "_features": [len(seen)], "_feature": [feature.astype(np.int32).tobytes()],
            "_sample": [cells["_index"].to_numpy().astype(np.int32).tobytes()],
            "_u": [cells["u"].to_numpy().astype(float).tobytes()]})

    return pack


def _group_squares(width: int):
    """Per permutation and group of a tile: the squares, added over features, of the group's sum of cells; and in the
    first block of features the group's sums over samples."""

    def measure(batches):
        for batch in batches:
            for line in range(batch.num_rows):
                held = {name: batch.column(i)[line] for i, name in enumerate(batch.schema.names)}

                def numbers(name, kind):
                    return np.frombuffer(held[name].as_buffer(), dtype=kind) if held[name].is_valid else np.empty(0, kind)

                block, tile, count, k = (held[c].as_py() for c in ("_block", "_tile", "_count", "_groups"))
                features = held["_features"].as_py() or 0
                labels = numbers("_labels", np.uint8 if k <= 256 else np.int32).reshape(count, -1)
                sums = numbers("_sums", float).reshape(count, 3, k)
                base, sample, u = numbers("_feature", np.int32) * k, numbers("_sample", np.int32), numbers("_u", float)
                for p in range(count):
                    cells = np.bincount(base + labels[p][sample], weights=u, minlength=features * k).astype(float).reshape(-1, k)
                    b, row, n = sums[p] if block == 0 else np.zeros((3, k))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(k, tile * width + p, dtype=np.int32)), pa.array(np.arange(k, dtype=np.int32)),
                         *(pa.array(x) for x in ((cells * cells).sum(axis=0), b, row, n))],
                        names=["permutation", "label", "squares", "b", "row", "n"])

    return measure


def cell_statistics(
    table: SparseClr, labels: DataFrame, group: str, permutations: int = PERMUTATIONS, seed: int = 42,
    sample: str = SAMPLE, tile_labels: int = TILE_LABELS, block_cells: int = BLOCK_CELLS,
) -> DataFrame:
    """(permutation, n, k, f) as `permutation_statistics` has them for Euclidean distances, from the stored cells.

    Cells are stored by blocks of features, labels by tiles of a few permutations of all samples; tasks read each block
    with each tile, so neither is shuffled by pair, and no permutation is sorted on the cluster.
    """
    labels = labels.filter(F.col(group).isNotNull()).select(
        F.col(sample).alias(SAMPLE), F.col(group).cast("string").alias(group)
    )
    known = stored(
        positions(labels.join(table.baseline, SAMPLE), [], [SAMPLE], "_index").withColumn(
            "_index", F.col("_index").cast("int") - 1), "labels"
    )
    # Rows less the mean baseline: no distance changes, and nothing large cancels.
    middle = known.agg(F.avg("baseline")).scalar()
    cells = stored(
        table.cells.join(known.select(SAMPLE, "_index", "baseline"), SAMPLE).select(
            "_index", FEATURE, (F.col("clr") - F.col("baseline")).alias("u")), "differences"
    )
    rows = cells.groupBy("_index").agg(F.sum("u").alias("row"), F.sum(F.col("u") * F.col("u")).alias("square"))
    codes = positions(known.select(group).distinct(), [], [group], "_group").select(
        group, (F.col("_group") - 1).cast("int").alias("_group"))
    samples = stored(
        known.join(rows, "_index", "left").na.fill(0.0, ["row", "square"]).join(codes, group).select(
            SAMPLE, "_index", "_group", (F.col("baseline") - middle).alias("b"), "row", "square"), "samples"
    )
    size = samples.agg(F.struct(
        F.count(F.lit(1)).alias("n"), F.sum("b").alias("b"), F.sum("row").alias("row"), F.sum("square").alias("square"),
        F.sum(F.col("b") * F.col("b")).alias("bb"), F.sum(F.col("b") * F.col("row")).alias("br"),
    ).alias("s")).first()["s"]
    count = cells.count()
    width = max(1, min(TILE_PERMUTATIONS, tile_labels // max(1, size["n"])))
    tiles, blocks = -(-(permutations + 1) // width), max(1, -(-count // block_cells))
    spark = samples.sparkSession
    one_row = stored(samples.agg(F.collect_list(
        F.struct("_index", F.col(SAMPLE).alias("name"), F.col("_group").alias("group"), "b", "row")).alias("_samples")), "layout")
    numbered = spark.range(0, tiles, 1, min(tiles, spark.sparkContext.defaultParallelism))
    drawn = stored(
        every_pair(numbered.select(F.col("id").cast("int").alias("_tile")), one_row).select("_tile", "_samples").mapInArrow(
            _labels_of_tiles(width, permutations, seed),
            "_tile int, _count int, _groups int, _labels binary, _sums binary"), "permuted")
    packed = (
        spread_out(cells.withColumn("_block", F.pmod(F.xxhash64(FEATURE), F.lit(blocks)).cast("int")), "_block")
        .groupBy("_block")
        .applyInPandas(_packed_cells(), "_block int, _features int, _feature binary, _sample binary, _u binary")
    )
    # A block without cells still has the samples' sums.
    every_block = spark.range(blocks).select(F.col("id").cast("int").alias("_block"))
    dealt = stored(every_block.join(not_broadcast(packed), "_block", "left"), "cell-blocks")
    sums = (
        every_pair(dealt, drawn)
        .mapInArrow(
            _group_squares(width),
            "permutation int, label int, squares double, b double, row double, n double")
        .groupBy("permutation", "label")
        .agg(*(F.sum(c).alias(c) for c in ("squares", "b", "row", "n")))
    )
    features = table.features.agg(F.count(F.lit(1)).cast("double")).scalar()
    whole = cells.groupBy(FEATURE).agg(F.sum("u").alias("s")).agg(
        F.coalesce(F.sum(F.col("s") * F.col("s")), F.lit(0.0))).scalar()
    d, n = F.col("_d"), F.lit(float(size["n"]))

    def around(squares, b, row, members):
        """Squared length of a sum of rows over its number: (b + u)**2 over all features."""
        return (d * b * b + 2 * b * row + squares) / members

    length = d * F.lit(size["bb"] or 0.0) + F.lit(2 * (size["br"] or 0.0) + (size["square"] or 0.0))
    total = length - around(F.col("_whole"), F.lit(size["b"] or 0.0), F.lit(size["row"] or 0.0), n)
    per = sums.withColumns({"_d": features, "_whole": whole}).groupBy("permutation", "_d", "_whole").agg(
        F.sum(around(F.col("squares"), F.col("b"), F.col("row"), F.col("n"))).alias("centres"),
        F.count(F.lit(1)).cast("double").alias("k"),
    )
    within = length - F.col("centres")
    return per.select("permutation", n.alias("n"), "k", total.alias("_total"), within.alias("_within")).select(
        "permutation", "n", "k",
        ((F.col("_total") - F.col("_within")) / (F.col("k") - 1) / (F.col("_within") / (F.col("n") - F.col("k")))).alias("f"),
    )


def permanova(
    distances: DataFrame | SparseClr, metadata: DataFrame, group: str, permutations: int = PERMUTATIONS,
    seed: int = 42, sample: str = SAMPLE, samples: DataFrame | None = None,
    check: bool = True,
) -> DataFrame:
    """One row: method, formula, test_statistic, p_value, permutations, n, groups.

    A sparse CLR stands for the Euclidean distances of its rows, none of which is made.  ``check`` runs one small job and raises if the metadata lack a sample.
    """
    if group not in metadata.columns:
        raise ValueError(f"no column {group!r} in the metadata")
    if isinstance(distances, SparseClr):
        if check:
            require_samples(distances.baseline, metadata, sample)
        stats = cell_statistics(distances, metadata, group, permutations, seed, sample)
    else:
        if check:
            require_samples(samples or distance_samples(distances), metadata, sample)
        stats = permutation_statistics(
            distances, metadata, group, permutations, seed, sample, samples
        )
    gathered = stats.groupBy("n", "k").agg(
        F.max(F.when(F.col("permutation") == 0, F.col("f"))).alias("test_statistic"),
        F.collect_list(F.when(F.col("permutation") > 0, F.col("f"))).alias("_drawn"),
    )
    threshold = F.col("test_statistic") * (1 - SAME)
    as_high = F.size(F.filter("_drawn", lambda f: f >= threshold))
    return gathered.select(
        F.lit("PERMANOVA").alias("method"),
        F.lit(f"~{group}").alias("formula"),
        "test_statistic",
        ((as_high + 1) / (permutations + 1)).alias("p_value"),
        F.lit(permutations).alias("permutations"),
        F.col("n").cast("bigint").alias("n_samples"),
        F.col("k").cast("bigint").alias("n_groups"),
    )
