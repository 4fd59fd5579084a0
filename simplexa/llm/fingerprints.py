"""Order MinHash of word k-mers, in Spark SQL functions alone."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

#: Words of a k-mer; rows of a signature; k-mers of a row.
KMER, ROWS, CHOSEN = 2, 64, 2
PLACE_BITS = 27
PLACES = 1 << PLACE_BITS


def let(value: Column, body) -> Column:
    """body(value), with the value worked out once also inside lambdas."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def above(packed: Column) -> Column:
    """The hash of a packed (hash, place) number."""
    return F.shiftrightunsigned(packed, PLACE_BITS)


def packed(hashed: Column, place: Column) -> Column:
    """36 bits of a hash over a place of 27 bits, positive, so that numbers sort by hash."""
    return F.shiftleft(hashed.bitwiseAND(F.lit((1 << 36) - 1)), PLACE_BITS).bitwiseOR(place.cast("long"))


def fingerprint(text: Column, k: int = KMER, rows: int = ROWS, chosen: int = CHOSEN) -> Column:
    """Signature of a text: `rows` numbers of eight hex digits.

    Each run of k words is a k-mer, numbered by how often it came before.  The hash of (k-mer, number) deals it to one
    of the rows; a row takes its `chosen` smallest ones, in the order of the text, and hashes that tuple.  Rows
    without a k-mer are '--------'.  Texts of fewer than k words have one k-mer of all; null and wordless texts have
    empty rows only.  Words are separated by white space.
    """
    words = F.filter(F.split(F.coalesce(text, F.lit("")), r"\s+"), lambda w: w != "")

    def sorted_kmers(w: Column) -> Column:
        last = F.greatest(F.size(w) - k, F.lit(0))
        hashed = F.transform(F.sequence(F.lit(0), last), lambda i: packed(
            F.xxhash64(*(F.get(w, i + j) for j in range(k))), F.least(i, F.lit(PLACES - 1))))
        return F.when(F.size(w) > 0, F.sort_array(hashed))

    def numbered(p: Column) -> Column:
        """Packed (hash of k-mer and number, place): runs of equal hashes lie side by side in the sorted array."""
        n = F.size(p)
        starts = F.filter(F.sequence(F.lit(0), n - 1), lambda i: (i == 0) | (above(F.get(p, i)) != above(
            F.get(p, i - 1))))

        def runs(s: Column) -> Column:
            def run(begin: Column, at: Column) -> Column:
                stop = F.coalesce(F.get(s, at + 1), n)
                return F.transform(F.sequence(begin, stop - 1), lambda i: packed(
                    F.xxhash64(above(F.get(p, i)), i - begin), F.get(p, i).bitwiseAND(F.lit(PLACES - 1))))

            return F.flatten(F.transform(s, run))

        return F.sort_array(let(starts, runs))

    # The highest six or so bits of the hash are the row, so rows lie side by side.
    row_bits = int(math.log2(rows))

    def row_of(x: Column) -> Column:
        return F.shiftrightunsigned(x, PLACE_BITS + 36 - row_bits)

    def least(p: Column) -> Column:
        return F.filter(p, lambda x, i: (i < chosen) | (row_of(x) != row_of(F.get(p, i - chosen))))

    def signature(p: Column) -> Column:
        """A row's numbers are read where they stand; rows between two that hold something are empty."""
        n, empty = F.size(p), F.lit("-" * 8)
        starts = F.filter(F.sequence(F.lit(0), n - 1), lambda i: (i == 0) | (row_of(F.get(p, i)) != row_of(F.get(
            p, i - 1))))

        def rows_of(s: Column) -> Column:
            def row(begin: Column, at: Column) -> Column:
                mine = F.slice(p, begin + 1, F.coalesce(F.get(s, at + 1), n) - begin)
                ordered = F.sort_array(F.transform(mine, lambda x: F.shiftleft(
                    x.bitwiseAND(F.lit(PLACES - 1)), 36).bitwiseOR(above(x))))
                tuple_hash = F.xxhash64(F.transform(ordered, lambda x: x.bitwiseAND(F.lit((1 << 36) - 1))))
                gap = row_of(F.get(p, begin)) - F.coalesce(row_of(F.get(p, begin - 1)), F.lit(-1)) - 1
                return F.concat(F.repeat(empty, gap.cast("int")), F.lower(F.lpad(F.hex(tuple_hash.bitwiseAND(
                    F.lit(0xFFFFFFFF))), 8, "0")))

            return F.transform(s, row)

        rest = F.lit(rows - 1) - row_of(F.get(p, n - 1))
        return F.concat(F.array_join(let(starts, rows_of), ""), F.repeat(empty, rest.cast("int")))

    made = let(words, lambda w: let(sorted_kmers(w), lambda p: F.when(p.isNotNull(), let(numbered(p), lambda q: let(
        least(q), signature)))))
    return F.coalesce(made, F.lit("-" * 8 * rows))


def likeness(a: Column, b: Column, rows: int = ROWS, chosen: int = CHOSEN) -> Column:
    """Estimate of the share of k-mers in common, 0 to 1, from two signatures: 1 for equal ones.

    Rows empty on both sides say nothing.  A row agrees if all of its k-mers do, so the share of agreeing rows, to the
    power 1 / chosen, estimates the overlap of the union; of that the share in both texts' k-mers follows.
    """
    # Bytes are cut in place, characters by counting from the first one on.
    empty = F.lit("-" * 8).cast("binary")

    def cut(s: Column) -> Column:
        return let(s.cast("binary"), lambda x: F.transform(
            F.sequence(F.lit(0), F.lit(rows - 1)), lambda i: F.substring(x, i * 8 + 1, F.lit(8))))

    # 1 where both rows agree, 0 where they differ, null where both are empty.
    agree = F.filter(F.zip_with(cut(a), cut(b), lambda x, y: F.when(x != y, 0).when(x != empty, 1)), F.isnotnull)
    counts = F.transform(F.array(agree), lambda g: F.struct(
        F.size(g).alias("said"), F.size(F.filter(g, lambda v: v == 1)).alias("same")))
    said, same = F.get(counts, F.lit(0))["said"], F.get(counts, F.lit(0))["same"]
    j = F.pow(same / said, F.lit(1.0 / chosen))
    return F.when(a == b, F.lit(1.0)).when(said == 0, F.lit(0.0)).otherwise(2 * j / (1 + j))


def ranges(rows: DataFrame, per_range: int) -> DataFrame:
    """Rows with `_segment` and `_part`, ranges of `_key` of about `per_range` rows: quantiles, then even steps."""
    n = rows.count()
    pieces = max(1, math.ceil(n / per_range))
    cuts = min(64, pieces)
    shares = F.array(*(F.lit(i / cuts) for i in range(cuts + 1)))
    marks = rows.agg(F.percentile_approx("doc_id", shares, F.lit(10_000))).first()[0] or [0] * (cuts + 1)
    steps = [max(1.0, (b - a + 1) / math.ceil(pieces / cuts)) for a, b in zip(marks[:-1], marks[1:])]
    lows = F.array(*(F.lit(int(m)) for m in marks[:-1]))
    key = F.coalesce("doc_id", F.lit(int(marks[0])) - 1)
    segment = F.greatest(F.size(F.filter(lows, lambda m: m <= F.col("_key"))) - 1, F.lit(0))
    past = F.col("_key").cast("double") - F.get(lows, F.col("_segment")).cast("double")
    part = F.floor(past / F.get(F.array(*map(F.lit, steps)), F.col("_segment"))).cast("long")
    return rows.withColumn("_key", key).withColumn("_segment", segment).withColumn("_part", part)


def fingerprint_table(documents: DataFrame, per_range: int = 500) -> DataFrame:
    """(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next) of every row.

    The edited text has its last floor(n_chars / 2) code points replaced by the first as many of the next row's text,
    in the order of doc_id; rows of one id follow each other by a hash of their texts, null ids come first, and the
    last row is followed by the first.  A single row follows itself.  A null text is empty; an empty table gives an
    empty one; further columns are not looked at.

    Each window holds one range of ids.  The first row of a range is added to the range before it as a last row, which
    is dropped afterwards, so texts are shuffled once.
    """
    rows = ranges(documents.select("doc_id", F.coalesce("text", F.lit("")).alias("text")), per_range).withColumn(
        "_tie", F.xxhash64("text"))
    heads = rows.groupBy("_segment", "_part").agg(F.min_by("text", F.struct("_key", "_tie")).alias("text"))
    # One row for each range, by segment; then one for each of at most 64 segments.
    in_segment = W.partitionBy("_segment").orderBy("_part")
    last = heads.select(
        "_segment", "_part", F.lead("text").over(in_segment).alias("text"))
    firsts = heads.groupBy("_segment").agg(F.min_by("text", "_part").alias("_first"))
    around = W.orderBy("_segment")
    after = firsts.select(
        "_segment", F.coalesce(F.lead("_first").over(around), F.first("_first").over(around)).alias("_after"))
    ends = last.join(F.broadcast(after), "_segment").select(
        F.lit(None).cast("long").alias("doc_id"), F.coalesce("text", "_after").alias("text"),
        F.lit(0).cast("long").alias("_key"), "_segment", "_part", F.lit(0).cast("long").alias("_tie"),
        F.lit(1).alias("_end"))
    both = rows.withColumn("_end", F.lit(0)).unionByName(ends).withColumn("fingerprint", fingerprint(F.col("text")))
    follow = W.partitionBy("_segment", "_part").orderBy("_end", "_key", "_tie")
    paired = both.select(
        "doc_id", "text", "fingerprint", "_end", F.lead("text").over(follow).alias("_next"),
        F.lead("fingerprint").over(follow).alias("_next_fingerprint")).where("_end = 0")
    n = F.length("text")
    half = F.floor(n / 2).cast("int")
    edited = paired.select(
        "doc_id", n.cast("long").alias("n_chars"), "fingerprint", "_next_fingerprint",
        F.concat(F.substring("text", F.lit(1), n - half), F.substring("_next", F.lit(1), half)).alias("_edited"))
    marked = edited.withColumn("edited_fingerprint", fingerprint(F.col("_edited")))
    return marked.select(
        "doc_id", "n_chars", F.sha2("_edited", 256).alias("edited_sha256"), "fingerprint", "edited_fingerprint",
        likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"),
        likeness(F.col("fingerprint"), F.col("_next_fingerprint")).alias("near_next"))
