"""Known licences by the digest of a canonical text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from simplexa.llm.license_texts import NOTICES, TEXTS

#: Spellings that count as one, replaced in this order after lower-casing.
SPELLINGS = (
    ("licence", "license"), ("organisation", "organization"), ("https:", "http:"), ("©", "(c)"),
    ("sub-license", "sublicense"), ("non-commercial", "noncommercial"), ("per cent", "percent"),
)
COPYRIGHT_LINE = r"(^|\n)[^a-z0-9\n(]*(copyright|\(c\))[^\n]*"
PUNCTUATION = r"[^\p{L}\p{N}]+"
#: Known texts whose digests a line is looked up in without a join.
MAX_KNOWN = 10_000


def spelt(text: Column) -> Column:
    """Lower case, one spelling, no copyright lines."""
    out = F.lower(F.coalesce(text, F.lit("")))
    for old, new in SPELLINGS:
        out = F.replace(out, F.lit(old), F.lit(new))
    return F.regexp_replace(out, COPYRIGHT_LINE, "$1")


def digest(spelt_text: Column) -> Column:
    """MD5 of the words, one blank between; null for a text without words."""
    words = F.trim(F.regexp_replace(spelt_text, PUNCTUATION, " "))
    return F.when(words != "", F.md5(words))


def known_licenses(spark: SparkSession) -> DataFrame:
    """(license, text) of the texts and notices that come with the library."""
    rows = [(name, text) for name, text in TEXTS.items()]
    rows += [(name, text) for name, texts in NOTICES.items() for text in texts]
    return spark.createDataFrame(rows, "license string, text string")


def license_scan(documents: DataFrame, known: DataFrame) -> DataFrame:
    """(doc_id, digest, license, n_license_lines, line_licenses) for each row of documents (doc_id, text).

    `license` is the known licence whose canonical text the whole text has; `n_license_lines` counts the lines that
    have one alone, and `line_licenses` has their names, distinct, sorted and joined by commas ('' if none).  Known
    texts (license, text) with the same canonical text count as the first by name.  A null or wordless text has a null
    digest and no licence; null ids and repeated rows stay; an empty table gives an empty one; further columns are not
    looked at.  Whole texts meet the known ones by a join on digests, whatever their number; lines look digests up in
    a map, for up to MAX_KNOWN known texts.
    """
    digests = known.select(digest(spelt(F.col("text"))).alias("digest"), "license").where(
        "digest is not null").groupBy("digest").agg(F.min("license").alias("license"))
    held = digests.limit(MAX_KNOWN + 1).collect()
    if len(held) > MAX_KNOWN:
        raise ValueError(f"more than {MAX_KNOWN} known texts")
    names = F.map_from_arrays(F.array(*(F.lit(r["digest"]) for r in held)).cast("array<string>"),
                              F.array(*(F.lit(r["license"]) for r in held)).cast("array<string>"))
    lines = F.transform(F.split("_spelt", "\n", -1), lambda x: F.try_element_at(names, F.coalesce(
        digest(x), F.lit(""))))
    rows = documents.select("doc_id", spelt(F.col("text")).alias("_spelt"))
    scanned = rows.select("doc_id", digest(F.col("_spelt")).alias("digest"), F.filter(
        lines, lambda x: x.isNotNull()).alias("_found"))
    return scanned.join(digests, "digest", "left").select(
        "doc_id", "digest", "license", F.size("_found").cast("long").alias("n_license_lines"),
        F.array_join(F.array_sort(F.array_distinct("_found")), ",").alias("line_licenses"))


def literal(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def scan_sql() -> str:
    """The same as license_scan with the library's known texts, for DuckDB over a view `documents`."""
    def spelling(column: str) -> str:
        out = f"lower(coalesce({column}, ''))"
        for old, new in SPELLINGS:
            out = f"replace({out}, {literal(old)}, {literal(new)})"
        return f"regexp_replace({out}, {literal(COPYRIGHT_LINE)}, '\\1', 'g')"

    def digested(column: str) -> str:
        words = f"trim(regexp_replace({column}, {literal(PUNCTUATION)}, ' ', 'g'))"
        return f"case when {words} <> '' then md5({words}) end"

    rows = [(name, text) for name, text in TEXTS.items()]
    rows += [(name, text) for name, texts in NOTICES.items() for text in texts]
    values = ", ".join(f"({literal(n)}, {literal(t)})" for n, t in rows)
    return f"""
with known as (
  select digest, min(license) as license from (
    select license, {digested("s")} as digest from (
      select license, {spelling("text")} as s from (values {values}) v(license, text))) group by digest),
docs as (select row_number() over () as r, doc_id, {spelling("text")} as s from documents),
lines as (select r, {digested("line")} as digest from (select r, unnest(string_split(s, chr(10))) as line from docs)),
found as (
  select r, count(*) as n, string_agg(distinct license, ',' order by license) as names
  from lines join known using (digest) group by r)
select doc_id, d.digest, k.license, coalesce(f.n, 0) as n_license_lines, coalesce(f.names, '') as line_licenses
from (select r, doc_id, {digested("s")} as digest from docs) d
left join known k using (digest) left join found f using (r)"""
