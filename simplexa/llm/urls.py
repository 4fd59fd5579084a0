"""Rules on hosts and paths of URLs, looked up in cascades of Bloom filters.

A rule's key is its host followed by its path.  A URL is asked for the keys that could name it: the ends of its host
with as many labels, followed by the beginnings of its path of as many characters, as some rule has.  The first filter
of a cascade holds the listed keys; every further one holds those keys of the other side that passed all filters
before, until none passes.  So the cascade is exact for every key that the corpus asks for, and neither the pages nor
their keys are joined with the list.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from simplexa.llm.bits import WIRE, Filter, assembled
from simplexa.llm.store import discard, kept

#: The verdicts.  BLOCK comes first where both lists have a key.
ALLOW, BLOCK = "allow", "block"
#: Keys of one list that a cascade is built for, and bits that its first filter has at most (32 MB).
SEGMENT_KEYS, MOST_BITS = 4_000_000, 1 << 28
MOST_LEVELS = 200
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host with A-Z lower-cased, and path; both empty for a null URL and one without `://`."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url)))
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), UPPER, LOWER)
    return F.coalesce(host, F.lit("")), F.coalesce(F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def labels(host: Column) -> Column:
    return F.size(F.split(host, r"\."))


def listed_keys(rules: DataFrame) -> DataFrame:
    """(key, verdict, labels, length) of the distinct rules; a null host or path is empty, an unknown verdict is
    refused."""
    empty = F.lit("")
    host = F.translate(F.coalesce(F.col("host"), empty), UPPER, LOWER)
    path = F.coalesce(F.col("path"), empty)
    known = F.when(F.col("verdict").isin(ALLOW, BLOCK), F.col("verdict")).otherwise(
        F.raise_error(F.concat(F.lit("unknown verdict of a rule: "), F.coalesce("verdict", F.lit("null")))))
    return rules.select(
        F.concat(host, path).alias("key"), known.cast("string").alias("verdict"), labels(host).alias("labels"),
        F.length(path).alias("length")).distinct()


HASHES = {"h0": lambda key: F.xxhash64(key), "h1": lambda key: F.xxhash64(key, F.lit(11))}


def asked(pages: DataFrame, shapes: list[tuple[int, int]]) -> DataFrame:
    """page_id, host, path, the keys that a rule of one of the shapes (labels, characters of path) may have, and the
    keys' hashes."""
    host, path = host_and_path(F.col("url"))
    rows = pages.select("page_id", host.alias("host"), path.alias("path"))
    kind = "array<struct<labels: int, length: int>>"
    every = F.array(*(F.struct(F.lit(n).alias("labels"), F.lit(m).alias("length")) for n, m in shapes)).cast(kind)
    fitting = F.filter(every, lambda s: (s["labels"] <= labels(F.col("host"))) & (s["length"] <= F.length("path")))
    keys = F.transform(fitting, lambda s: F.concat(
        F.call_function("substring_index", F.col("host"), F.lit("."), -s["labels"]),
        F.call_function("substring", F.col("path"), F.lit(1), s["length"])))
    return rows.withColumn("keys", keys).withColumns({n: F.transform("keys", h) for n, h in HASHES.items()})


def flat(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of all keys of a batch, and the row of each."""
    h = [batch.column(c).flatten().to_numpy(zero_copy_only=False).view(np.uint64) for c in ("h0", "h1")]
    sizes = np.diff(batch.column("h0").offsets.to_numpy())
    return h[0], h[1], np.repeat(np.arange(len(sizes)), sizes)


def in_segment(h1: np.ndarray, segment: int, segments: int) -> np.ndarray:
    return (h1 >> np.uint64(40)) % np.uint64(segments) == np.uint64(segment)


def passing(first: dict[str, Filter], segment: int, segments: int):
    """Task function over asked rows: (verdict, key, h0, h1) of the keys that the first filter of a list lets pass."""

    def run(batches):
        for batch in batches:
            h1, h2, _ = flat(batch)
            keys, mine = batch.column("keys").flatten(), in_segment(h1, segment, segments)
            for verdict, each in first.items():
                at = np.flatnonzero(each.has(h1, h2) & mine)
                if len(at):
                    at = at[np.unique(np.stack([h1[at], h2[at]], axis=1), axis=0, return_index=True)[1]]
                yield pa.RecordBatch.from_arrays([
                    pa.array([verdict] * len(at), pa.string()), keys.take(pa.array(at)).cast(pa.string()),
                    pa.array(h1[at].view(np.int64)), pa.array(h2[at].view(np.int64))], ["verdict", "key", "h0", "h1"])

    return run


def filling(filters: list[Filter], column: str = "which"):
    """Task function over (which, h0, h1): the rows of the filters that hold these keys."""

    def run(batches):
        own = {}
        for batch in batches:
            which = batch.column(column).to_numpy(zero_copy_only=False)
            h = [batch.column(c).to_numpy().view(np.uint64) for c in ("h0", "h1")]
            for w in np.unique(which).tolist():
                shape = filters[w]
                each = own.setdefault(w, Filter(shape.size, shape.hashes, shape.level))
                each.add(h[0][which == w], h[1][which == w])
        for w, each in own.items():
            yield each.batch(w)

    return run


def still_passing(each: Filter):
    """Task function over (key, h0, h1): the rows that the filter holds."""

    def run(batches):
        for batch in batches:
            h = [batch.column(c).to_numpy().view(np.uint64) for c in ("h0", "h1")]
            yield batch.filter(pa.array(each.has(*h)))

    return run


KEY_ROWS = "key string, h0 long, h1 long"


def filled(keys: DataFrame, count: int, rate: float, level: int) -> Filter:
    size, hashes = Filter.shape(count, rate, MOST_BITS)
    shape = [Filter(size, hashes, level)]
    parts = keys.select(F.lit(0).alias("which"), "h0", "h1").mapInArrow(filling(shape), WIRE)
    return assembled(parts, shape)[0]


def cascades(rows: DataFrame, listed: DataFrame, universe: int, segment: int, segments: int) -> dict[str, list[Filter]]:
    """A cascade for each verdict of listed (verdict, key, h0, h1), exact for the keys that `rows` ask for.

    The first filter lets so few keys of `universe` pass that they are no more than the listed ones, so a cascade's
    size follows the list and the logarithm of the corpus.
    """
    counts = {r["verdict"]: r["n"] for r in listed.groupBy("verdict").agg(F.count("*").alias("n")).collect()}
    first = {v: filled(listed.where(F.col("verdict") == v), n, min(0.5, 0.7 * n / max(1, universe)), 0)
             for v, n in sorted(counts.items())}
    if not first:
        return {}
    seen = kept(rows.select("keys", "h0", "h1").mapInArrow(
        passing(first, segment, segments), f"verdict string, {KEY_ROWS}").distinct(), "passing")
    out = {}
    for verdict in first:
        mine = listed.where(F.col("verdict") == verdict).select("key")
        both = seen.where(F.col("verdict") == verdict).select("key", "h0", "h1")
        # sides[0]: listed keys that occur; sides[1]: others that the first filter let pass.
        sides = [kept(both.join(mine, "key", "left_semi"), "listed"), kept(both.join(mine, "key", "left_anti"), "others")]
        levels, count, turn = [first[verdict]], sides[1].count(), 1
        while count:
            # Each level lets half of the keys pass at most, so only equal hashes come this far.
            if len(levels) == MOST_LEVELS:
                raise RuntimeError(f"{count} keys that no level tells apart")
            each = filled(sides[turn], count, 0.5, len(levels))
            levels.append(each)
            turn = 1 - turn
            left = kept(sides[turn].mapInArrow(still_passing(each), KEY_ROWS), "left")
            discard(sides[turn])
            sides[turn], count = left, left.count()
        discard(*sides)
        out[verdict] = levels
    discard(seen)
    return out


def contained(levels: list[Filter], h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
    """Whether keys are listed: they are not if the first, third, ... filter is the first that lacks them."""
    listed, open_ = np.zeros(len(h1), bool), np.arange(len(h1))
    for number, each in enumerate(levels):
        if not len(open_):
            break
        has = each.has(h1[open_], h2[open_])
        listed[open_[~has]] = number % 2 == 1
        open_ = open_[has]
    listed[open_] = len(levels) % 2 == 1
    return listed


def judging(found: dict[str, list[Filter]], segment: int, segments: int):
    """Task function over asked rows with `rule` and `verdict` so far: the longest listed key of each row, block
    before allow."""

    def run(batches):
        for batch in batches:
            h1, h2, row = flat(batch)
            mine = np.flatnonzero(in_segment(h1, segment, segments))
            keys = batch.column("keys").flatten()
            rules, verdicts = batch.column("rule").to_pylist(), batch.column("verdict").to_pylist()
            for verdict in (ALLOW, BLOCK):
                if verdict not in found:
                    continue
                at = mine[contained(found[verdict], h1[mine], h2[mine])]
                for i, key in zip(row[at].tolist(), keys.take(pa.array(at)).to_pylist()):
                    # The longer key; of two as long the one with the longer host.
                    rank = (len(key), len(key.split("/", 1)[0]))
                    if rules[i] is None or rank >= (len(rules[i]), len(rules[i].split("/", 1)[0])):
                        rules[i], verdicts[i] = key, verdict
            columns = [batch.column(c) for c in batch.schema.names[:-2]]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(rules, pa.string()), pa.array(verdicts, pa.string())], batch.schema.names)

    return run


def judged(pages: DataFrame, rules: DataFrame, segment_keys: int = SEGMENT_KEYS, default: str = ALLOW) -> DataFrame:
    """(page_id, host, path, rule, verdict) of every row of pages (page_id, url).

    rules (host, path, verdict: allow or block) fit their host and its subdomains where the path starts with theirs;
    the longest rule (host and path together, then host) wins, block before allow for the same key, and `default`
    where none fits, with a null rule.  A null URL, or one without `://`, has an empty host and path.  Null ids and
    repeated rows stay, an empty table gives an empty one, without rules all rows have the default, further columns
    are not looked at.  The shapes of rules (labels of the host, characters of the path) pass the driver: at most the
    labels times the path lengths that occur.

    A list of more than `segment_keys` keys is cut by hash, with one cascade and one pass over the keys a segment.
    """
    keys = kept(listed_keys(rules).withColumns({n: h(F.col("key")) for n, h in HASHES.items()}), "rules")
    shapes = sorted((r["labels"], r["length"]) for r in keys.select("labels", "length").distinct().collect())
    rows = asked(pages, shapes)
    kind = T.StructType([
        *rows.schema.fields, T.StructField("rule", T.StringType()), T.StructField("verdict", T.StringType())])
    universe = rows.agg(F.sum(F.size("keys"))).first()[0] or 0
    segments = max(1, -(-keys.count() // segment_keys))
    rows = rows.withColumns({"rule": F.lit(None).cast("string"), "verdict": F.lit(None).cast("string")})
    for segment in range(segments):
        own = F.pmod(F.shiftrightunsigned("h0", 40), F.lit(segments)) == segment
        listed = keys.where(own).select("verdict", "key", "h0", "h1")
        found = cascades(rows, listed, universe, segment, segments)
        rows = rows.mapInArrow(judging(found, segment, segments), kind)
        if segments > 1:
            rows = kept(rows, "judged")
    return rows.select("page_id", "host", "path", "rule", F.coalesce("verdict", F.lit(default)).alias("verdict"))


#: The rules of the query.
RULES = [
    (ALLOW, "com", "/"), (BLOCK, "example.com", "/en/"), (ALLOW, "www.example.com", "/en/"), (BLOCK, "net", "/es/"),
    (BLOCK, "net", "/fr/"),
]


def rule_table(spark, rules=tuple(RULES)) -> DataFrame:
    return spark.createDataFrame(list(rules), "verdict string, host string, path string")


def judged_sql() -> str:
    """The query in SQL: all rules against all pages, the longest that fits."""
    rules = ", ".join(f"('{h}', '{p}', '{v}')" for v, h, p in RULES)
    return f"""
        WITH cut AS (
            SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) END AS rest
            FROM pages
        ), split AS (
            SELECT page_id, translate(coalesce(regexp_extract(rest, '^([^/?#]*)', 1), ''), '{UPPER}', '{LOWER}') AS host,
                   coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') AS path
            FROM cut
        ), rules(rule_host, rule_path, rule_verdict) AS (VALUES {rules}),
        fit AS (
            SELECT s.page_id, s.host, s.path, r.rule_host || r.rule_path AS rule, r.rule_verdict
            FROM (SELECT *, row_number() OVER () AS place FROM split) s LEFT JOIN rules r
              ON (s.host = r.rule_host OR ends_with(s.host, '.' || r.rule_host)) AND starts_with(s.path, r.rule_path)
            QUALIFY row_number() OVER (PARTITION BY s.place ORDER BY length(r.rule_host || r.rule_path) DESC NULLS LAST) = 1
        )
        SELECT page_id, host, path, rule, coalesce(rule_verdict, '{ALLOW}') AS verdict FROM fit"""
