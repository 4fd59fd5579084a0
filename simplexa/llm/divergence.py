"""How the sources of a language differ in their words, from a single-pass inverted index.

Each task builds postings (term, source, occurrences, documents) of a block in memory until it is full and spills it
as a run of term-sorted blocks.  Runs are dealt to shards by a hash of the term; a shard's blocks come in the order of
their first terms and are merged with a heap, so one block of each run is open at a time.  Differences of two sources
are summed over the terms as if neither had any, and the shards stream the corrections of the terms that they have.
"""

from __future__ import annotations

import heapq
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from simplexa.llm.store import discard, kept, slots

#: Tokens and terms of a block in memory, and terms of a spilled block.
BLOCK_TOKENS, BLOCK_TERMS, RUN_TERMS = 4_000_000, 1_000_000, 256
#: Sources whose pairs a task adds up before it passes them on.
PAIR_SOURCES = 512
SLICE = 1 << 20
RUNS = ("shard int, lang string, first binary, names array<string>, terms binary, at binary, source binary,"
        " occurrences binary, documents binary")
FREQUENCIES = "lang string, term binary, source string, n long, total long, head boolean"
PAIRS = "lang string, source string, item string, correction long"


def term_table() -> bytes:
    """Bytes of terms, A-Z lower-cased; spaces for all others."""
    table = bytearray(b" " * 256)
    table[0x61:0x7B] = table[0x41:0x5B] = bytes(range(0x61, 0x7B))
    table[0x80:] = bytes(range(0x80, 0x100))
    return bytes(table)


def slices(text: bytes, size: int = SLICE):
    """Parts of a text that is cut at spaces."""
    start = 0
    while len(text) - start > size:
        stop = text.find(b" ", start + size)
        if stop < 0:
            break
        yield text[start:stop]
        start = stop
    yield text[start:] if start else text


class Block:
    """Tokens of one language: term numbers, and the length and source of each document."""

    def __init__(self):
        self.vocabulary = defaultdict()
        self.vocabulary.default_factory = self.vocabulary.__len__
        self.names: dict[str, int] = {}
        self.tokens, self.lengths, self.sources = [], [], []

    def add(self, source: str, text: bytes, table: bytes) -> int:
        number = self.vocabulary.__getitem__
        ids = [np.fromiter(map(number, part.split()), np.int32) for part in slices(text.translate(table))]
        self.tokens += ids
        self.lengths.append(sum(map(len, ids)))
        self.sources.append(self.names.setdefault(source, len(self.names)))
        return self.lengths[-1]

    def postings(self):
        """Arrays (term, source, occurrences, documents), by the order of terms and source; and the sorted terms."""
        v, terms = len(self.vocabulary), sorted(self.vocabulary)
        rank = np.empty(v, np.int64)
        rank[[self.vocabulary[t] for t in terms]] = np.arange(v)
        tokens = rank[np.concatenate(self.tokens)]
        document = np.repeat(np.arange(len(self.lengths)), self.lengths)
        one, n = np.unique(document * v + tokens, return_counts=True)
        k = len(self.names)
        code = one % v * k + np.array(self.sources)[one // v]
        order = np.argsort(code, kind="stable")
        code, n = code[order], n[order]
        starts = np.flatnonzero(np.concatenate([[True], code[1:] != code[:-1]]))
        documents = np.diff(np.append(starts, len(code)))
        return code[starts] // k, code[starts] % k, np.add.reduceat(n, starts), documents, terms


def runs(shards: int, block_tokens: int, block_terms: int):
    """Task function: (lang, source, text) to RUNS."""

    def spilled(lang: str, block: Block):
        if not block.vocabulary:
            return
        term, source, occurrences, documents, terms = block.postings()
        salt = zlib.crc32(lang.encode()) & 0xFFFFFFFF
        shard = np.array([zlib.crc32(t, salt) for t in terms], np.int64) % shards
        begin = np.searchsorted(term, np.arange(len(terms) + 1))
        order = np.argsort(shard, kind="stable")  # terms of a shard stay sorted
        ends = np.searchsorted(shard[order], np.arange(shards + 1))
        names, rows = list(block.names), []
        for s in np.flatnonzero(np.diff(ends)).tolist():
            for i in range(ends[s], ends[s + 1], RUN_TERMS):
                own = order[i : min(i + RUN_TERMS, ends[s + 1])]
                sizes = begin[own + 1] - begin[own]
                picked = np.repeat(begin[own] - np.concatenate([[0], np.cumsum(sizes)[:-1]]), sizes) + np.arange(
                    int(sizes.sum()))
                mine = [terms[t] for t in own.tolist()]
                rows.append((
                    s, lang, mine[0], names, b"\0".join(mine), np.append(0, np.cumsum(sizes)).astype(np.int32).tobytes(),
                    source[picked].astype(np.int32).tobytes(), occurrences[picked].astype(np.int64).tobytes(),
                    documents[picked].astype(np.int64).tobytes()))
                if len(rows) == 512:
                    yield rows
                    rows = []
        if rows:
            yield rows

    kinds = [pa.int32(), pa.string(), pa.binary(), pa.list_(pa.string()), *[pa.binary()] * 5]
    columns = ["shard", "lang", "first", "names", "terms", "at", "source", "occurrences", "documents"]

    def run(batches):
        table, blocks, held = term_table(), {}, 0

        def flush():
            for lang in sorted(blocks):
                for rows in spilled(lang, blocks[lang]):
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], columns)

        for batch in batches:
            langs, sources = batch.column("lang").to_pylist(), batch.column("source").to_pylist()
            for i, text in enumerate(batch.column("text").cast(pa.binary())):
                held += blocks.setdefault(langs[i], Block()).add(sources[i], text.as_py(), table)
                if held >= block_tokens or sum(len(b.vocabulary) for b in blocks.values()) >= block_terms:
                    yield from flush()
                    blocks, held = {}, 0
        yield from flush()

    return run


class Postings:
    """An open block of a run: its terms in order, each with its postings."""

    def __init__(self, row: dict):
        self.names, self.terms, self.here = row["names"], row["terms"].split(b"\0"), 0
        self.at = np.frombuffer(row["at"], np.int32).tolist()
        self.source = np.frombuffer(row["source"], np.int32).tolist()
        self.occurrences = np.frombuffer(row["occurrences"], np.int64).tolist()
        self.documents = np.frombuffer(row["documents"], np.int64).tolist()


def merged(least: int):
    """Task function over RUNS sorted by (shard, lang, first): FREQUENCIES of the terms in `least` documents or more."""

    def run(batches):
        heap, out, now, opened = [], [], None, 0

        def drained(until):
            """Terms before `until` are whole: every block that may hold one is open."""
            while heap and (until is None or heap[0][0] < until):
                term, documents, counts = heap[0][0], 0, {}
                while heap and heap[0][0] == term:
                    _, number, block = heap[0]
                    for j in range(block.at[block.here], block.at[block.here + 1]):
                        name = block.names[block.source[j]]
                        counts[name] = counts.get(name, 0) + block.occurrences[j]
                        documents += block.documents[j]
                    block.here += 1
                    if block.here < len(block.terms):
                        heapq.heapreplace(heap, (block.terms[block.here], number, block))
                    else:
                        heapq.heappop(heap)
                if documents >= least:
                    total = sum(counts.values())
                    out.extend((now[1], term, name, n, total, first == 0)
                               for first, (name, n) in enumerate(sorted(counts.items())))

        def told():
            kinds = [pa.string(), pa.binary(), pa.string(), pa.int64(), pa.int64(), pa.bool_()]
            columns = ["lang", "term", "source", "n", "total", "head"]
            batch = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], columns)
            out.clear()
            return batch

        for batch in batches:
            for row in batch.to_pylist():
                if (row["shard"], row["lang"]) != now:
                    drained(None)
                    now = (row["shard"], row["lang"])
                drained(row["first"])
                opened += 1
                block = Postings(row)
                heapq.heappush(heap, (block.terms[0], opened, block))
                if len(out) >= 20_000:
                    yield told()
        drained(None)
        if out:
            yield told()

    return run


def corrections(most: int = PAIR_SOURCES):
    """Task function over rows (lang, term, source, p, rest), a term's rows together: for each two sources of a term
    what its real difference is over what `zero` terms (`rest` of either source) were counted for.  PAIRS, added up
    for up to `most` sources at a time."""

    def run(batches):
        lang, names, sums, out = None, {}, None, []

        def told():
            nonlocal names, sums
            if names:
                n, known = len(names), list(names)
                a, b = np.nonzero(sums[:n, :n])
                for i in range(0, len(a), 50_000):
                    x, y = a[i : i + 50_000], b[i : i + 50_000]
                    yield pa.RecordBatch.from_arrays([
                        pa.array([lang] * len(x), pa.string()), pa.array([known[j] for j in x], pa.string()),
                        pa.array([known[j] for j in y], pa.string()), pa.array(sums[x, y])],
                        ["lang", "source", "item", "correction"])
            names, sums = {}, None

        def term(own, sources, p, rest):
            nonlocal lang, names, sums
            if own != lang:
                yield from told()
                lang = own
            for i in range(0, len(sources), most // 2):
                for j in range(0, len(sources), most // 2):
                    a, b = slice(i, i + most // 2), slice(j, j + most // 2)
                    need = set(sources[a]) | set(sources[b])
                    if len(names.keys() | need) > most:
                        yield from told()
                    if sums is None:
                        sums = np.zeros((most, most), np.int64)
                    x = [names.setdefault(s, len(names)) for s in sources[a]]
                    y = [names.setdefault(s, len(names)) for s in sources[b]]
                    pa_, pb, ra, rb = p[a, None], p[None, b], rest[a, None], rest[None, b]
                    both = np.abs(pa_ - pb) - np.abs(pa_ - rb) - np.abs(pb - ra) + np.abs(ra - rb)
                    sums[np.ix_(x, y)] += both

        held = None
        for batch in batches:
            langs, terms = batch.column("lang").to_pylist(), batch.column("term").to_pylist()
            sources = batch.column("source").to_pylist()
            p, rest = (batch.column(c).to_numpy() for c in ("p", "rest"))
            cuts = [i for i in range(1, len(terms)) if terms[i] != terms[i - 1] or langs[i] != langs[i - 1]]
            for i, j in zip([0, *cuts], [*cuts, len(terms)]):
                if i == j:
                    continue
                key, mine = (langs[i], terms[i]), (sources[i:j], p[i:j], rest[i:j])
                if held and held[0] == key:
                    held = (key, (held[1][0] + mine[0], np.append(held[1][1], mine[1]), np.append(held[1][2], mine[2])))
                    continue
                if held and len(held[1][0]) > 1:
                    yield from term(held[0][0], *held[1])
                held = (key, mine)
        if held and len(held[1][0]) > 1:
            yield from term(held[0][0], *held[1])
        yield from told()

    return run


def share(count, total, width):
    """1 + floor(10**9 * (count + 5) / (total + 5 * width)), in decimals of 38 digits."""
    above = (count.cast("decimal(20,0)") + F.lit(5)) * F.lit(1_000_000_000).cast("decimal(10,0)")
    below = total.cast("decimal(20,0)") + F.lit(5) * width.cast("decimal(17,0)")
    return F.call_function("div", above, below) + F.lit(1)


def term_frequencies(documents: DataFrame, least: int = 30, block_tokens: int = BLOCK_TOKENS,
                     block_terms: int = BLOCK_TERMS) -> DataFrame:
    """FREQUENCIES: occurrences of each kept term by language and source, `total` over the language's sources, and
    `head` on one row of each term.  A term is kept in a language that has it in `least` documents or more.

    documents (lang, source, text); nulls count as ''.  The table is stored.
    """
    n = slots(documents.sparkSession)
    rows = documents.select(*(F.coalesce(F.col(c), F.lit("")).alias(c) for c in ("lang", "source", "text")))
    spilled = rows.mapInArrow(runs(n, block_tokens, block_terms), RUNS)
    dealt = spilled.repartition(n, "shard").sortWithinPartitions("shard", "lang", "first")
    return kept(dealt.mapInArrow(merged(least), FREQUENCIES).withColumn("term", F.col("term").cast("string")), "terms")


def source_divergence(documents: DataFrame, least: int = 30, top: int = 50) -> DataFrame:
    """(lang, source, part, item, value, rank): how far each source of a language is from its others, and its terms
    that are most above the language's.

    documents (lang, source, text): a null counts as ''.  Every group that occurs is in part `pair`, also without
    terms; a language without kept terms has distances 0.  All rows of `pair` are returned and ranks to `top` of
    `term`; equal values rank by the bytes of the item.  Repeated rows count each, ids and further columns are not
    looked at, an empty table gives an empty one.
    """
    n = slots(documents.sparkSession)
    terms = term_frequencies(documents, least)
    groups = documents.select(*(F.coalesce(F.col(c), F.lit("")).alias(c) for c in ("lang", "source"))).distinct()
    own = terms.groupBy("lang", "source").agg(F.sum("n").alias("group_total"), F.count("*").alias("group_terms"))
    width = terms.groupBy("lang").agg(F.count_if("head").alias("width"), F.sum("n").alias("lang_total"))
    zero = F.lit(0).cast("long")
    sizes = groups.join(own, ["lang", "source"], "left").join(width, "lang", "left").na.fill(0).select(
        "lang", "source", "group_terms", "width", "group_total", "lang_total",
        F.when(F.col("width") > 0, share(zero, F.col("group_total"), F.col("width"))).otherwise(zero).alias("rest"))
    sizes = kept(sizes, "sizes")

    shares = kept(terms.join(sizes.where("group_terms > 0").drop("group_terms"), ["lang", "source"]).select(
        "lang", "term", "source", "rest", share(F.col("n"), F.col("group_total"), F.col("width")).alias("p"),
        share(F.col("total"), F.col("lang_total"), F.col("width")).alias("q")), "shares")
    discard(terms)

    ranked = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    above = shares.where("p > q").select(
        "lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), (F.col("p") - F.col("q")).alias("value"))
    most = above.withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= top)

    # How far the terms that a source has are from another's share of a term that it lacks: sums of distances to a
    # point, from the counts and sums of the shares at or below it.
    pairs = sizes.select("lang", "source", "rest", "width", "group_terms").join(
        sizes.select("lang", F.col("source").alias("item"), F.col("rest").alias("item_rest")), "lang").where(
        F.col("source") != F.col("item"))
    steps = shares.groupBy("lang", "source", "p").agg(F.count("*").alias("m"))
    points = steps.select(
        "lang", "source", F.col("p").alias("v"), "m", (F.col("p") * F.col("m")).alias("s"),
        *(F.lit(None).cast(t).alias(c) for c, t in (("item", "string"), ("rest", "long"), ("width", "long"))),
    ).unionByName(pairs.select(
        "lang", "source", F.col("item_rest").alias("v"), zero.alias("m"), zero.alias("s"), "item", "rest", "width"))
    whole = Window.partitionBy("lang", "source")
    upto = whole.orderBy("v").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    placed = points.select(
        "*", F.sum("m").over(upto).alias("m_low"), F.sum("s").over(upto).alias("s_low"),
        F.sum("m").over(whole).alias("m_all"), F.sum("s").over(whole).alias("s_all")).where("item IS NOT NULL")
    v, apart = F.col("v"), F.abs(F.col("v") - F.col("rest"))
    one_sided = placed.select("lang", "source", "item", (
        v * F.col("m_low") - F.col("s_low") + F.col("s_all") - F.col("s_low") - v * (F.col("m_all") - F.col("m_low"))
        - F.col("m_all") * apart).alias("correction"), (F.col("width") * apart).alias("base"))
    nothing = zero.alias("base")
    dealt = shares.select("lang", "term", "source", "p", "rest").repartition(n, "lang", "term").sortWithinPartitions(
        "lang", "term", "source")
    both = dealt.mapInArrow(corrections(), PAIRS).where("source <> item").select(
        "lang", "source", "item", "correction", nothing)
    turned = one_sided.select("lang", F.col("item").alias("source"), F.col("source").alias("item"), "correction", nothing)
    far = one_sided.unionByName(turned).unionByName(both).groupBy("lang", "source", "item").agg(
        (F.sum("base") + F.sum("correction")).alias("value"))
    distances = far.select("lang", "source", F.lit("pair").alias("part"), "item", "value").withColumn(
        "rank", F.row_number().over(ranked))
    return distances.unionByName(most)


def divergence_sql(least: int = 30, top: int = 50) -> str:
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    share_of = "CAST(1 + (1000000000::HUGEINT * ({0} + 5)) // ({1} + 5 * {2}) AS BIGINT)".format
    return f"""
        WITH docs AS (
            SELECT row_number() OVER () AS place, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
                   translate(coalesce(text, ''), '{upper}', '{lower}') AS text
            FROM documents
        ), words AS (
            SELECT place, lang, source,
                   unnest(regexp_extract_all(text, '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term
            FROM docs
        ), kept AS (
            SELECT lang, term, count(*) AS total FROM words GROUP BY ALL HAVING count(DISTINCT place) >= {least}
        ), counted AS (
            SELECT lang, source, term, count(*) AS n FROM words JOIN kept USING (lang, term) GROUP BY ALL
        ), langs AS (
            SELECT lang, count(*) AS width, sum(total) AS lang_total FROM kept GROUP BY ALL
        ), sized AS (
            SELECT g.lang, g.source, coalesce(s.group_total, 0) AS group_total, l.width, l.lang_total
            FROM (SELECT DISTINCT lang, source FROM docs) g
            LEFT JOIN (SELECT lang, source, sum(n) AS group_total FROM counted GROUP BY ALL) s USING (lang, source)
            LEFT JOIN langs l ON g.lang = l.lang
        ), grid AS (
            SELECT z.lang, z.source, k.term, coalesce(c.n, 0) AS n,
                   {share_of('coalesce(c.n, 0)', 'z.group_total', 'z.width')} AS p,
                   {share_of('k.total', 'z.lang_total', 'z.width')} AS q
            FROM sized z JOIN kept k ON z.lang = k.lang
            LEFT JOIN counted c ON c.lang = z.lang AND c.source = z.source AND c.term = k.term
        ), summed AS (
            SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value
            FROM grid a JOIN grid b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
        ), parts AS (
            SELECT a.lang, a.source, 'pair' AS part, b.source AS item, CAST(coalesce(s.value, 0) AS BIGINT) AS value
            FROM sized a JOIN sized b ON a.lang = b.lang AND a.source <> b.source
            LEFT JOIN summed s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source
            UNION ALL
            SELECT lang, source, 'term', term, p - q FROM grid WHERE n > 0 AND p > q
        )
        SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank
        FROM parts
        QUALIFY part = 'pair' OR rank <= {top}"""
