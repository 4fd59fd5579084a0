"""Personal data in texts: candidate spans, boosted trees over their features, a calibrated threshold.

Everything on the rows is Spark SQL functions; the trees are turned into an expression.
"""

from __future__ import annotations

from functools import partial, reduce

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from simplexa.llm.store import kept

#: The base patterns by kind, in the order that ties have.  A match starts where a run of its first
#: characters starts, or where the last match ended, so that no run is tried from each of its places.  Groups repeat
#: possessively: what follows never needs a part back, and the matcher loops over them where it would recurse.
BASE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++(\.[0-9]++)(\.[0-9]++)(\.[0-9]++)",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
SIGNS = {"email": "@", "ip": ".", "card": "", "phone": "+"}
#: High-recall patterns: written-out addresses, and runs of digits with any of the usual separators.
WIDE = {
    "address": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++(?:@|\x20?[\[(](?:at|AT)[\])]\x20?)[A-Za-z0-9-]++"
               r"(?:(?:\.|\x20?[\[(](?:dot|DOT)[\])]\x20?)[A-Za-z0-9-]++)*+",
    "number": r"[+(]?[0-9](?:[\x20()./-]{0,2}[0-9]){6,}+",
}
KINDS = (*BASE, *WIDE)
#: Labelled candidates that the trees are fitted and the threshold is calibrated on.
TREES, DEPTH, PRECISION, CONTEXT = 12, 3, 0.99, 24
#: Places of an array that are added up together.
PART = 512
SPAN = "array<struct<start: bigint, kind: int, stop: bigint>>"


def let(value: Column, body) -> Column:
    """body(value), with the value worked out once also inside lambdas."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def sums_before(lengths: Column) -> Column:
    """For each place of an array of longs the sum of those before it, by parts: only parts are copied as they grow."""
    def grown(part: Column) -> Column:
        return F.aggregate(part, F.array(F.lit(0).cast("long")), lambda acc, x: F.concat(
            acc, F.array(F.element_at(acc, -1) + x)))

    def of_parts(inner: Column) -> Column:
        starts = grown(F.transform(inner, lambda p: F.element_at(p, -1)))
        return F.flatten(F.zip_with(inner, F.slice(starts, 1, F.size(inner)), lambda p, o: F.transform(
            F.slice(p, 1, F.size(p) - 1), lambda x: x + o)))

    firsts = F.sequence(F.lit(0), F.floor(F.size(lengths) / PART).cast("int"))
    return let(F.transform(firsts, lambda i: grown(F.slice(lengths, i * PART + 1, PART))), of_parts)


def matches(text: Column, pattern: str) -> Column:
    """Array of (start, stop, match), in code points: between the matches lie what a split by the pattern leaves."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    between = F.transform(F.split(text, pattern, -1), F.length)

    def placed(pair: Column) -> Column:
        steps = F.zip_with(pair["between"], pair["found"], lambda b, m: F.struct(
            b.cast("long").alias("gap"), F.coalesce(F.length(m), F.lit(0)).cast("long").alias("n"), m.alias("match")))
        return let(steps, lambda s: F.filter(F.zip_with(
            s, sums_before(F.transform(s, lambda x: x["gap"] + x["n"])), lambda x, at: F.struct(
                (at + x["gap"]).alias("start"), (at + x["gap"] + x["n"]).alias("stop"), x["match"].alias("match"))),
            lambda m: m["match"].isNotNull()))

    return let(F.struct(between.alias("between"), found.alias("found")), placed)


def digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def valid(kind: str, match: Column) -> Column:
    """Whether a base match passes its check."""
    if kind == "email":
        return F.lit(True)
    if kind == "ip":
        # A part is above 255 by its digits without leading zeros.
        parts = F.transform(F.split(match, r"\."), lambda p: F.regexp_replace(p, "^0+(?=.)", ""))
        return F.forall(parts, lambda p: (F.length(p) < 3) | ((F.length(p) == 3) & (p <= F.lit("255"))))
    count = F.length(digits(match))
    if kind == "card":
        return count.between(12, 19) & F.call_function("luhn_check", digits(match))
    return count.between(9, 15)


def passing(kind: str, m: Column) -> Column:
    return valid(kind, m["match"])


def numbered(number: int, m: Column) -> Column:
    return F.struct(m["start"].alias("start"), F.lit(number).alias("kind"), m["stop"].alias("stop"))


def base_spans(text: Column) -> Column:
    """Spans (start, kind number, stop) of the base patterns, by start and then kind."""
    out = []
    for number, (kind, pattern) in enumerate(BASE.items()):
        spans = F.transform(
            F.filter(matches(text, pattern), partial(passing, kind)), partial(numbered, number))
        present = F.contains(text, F.lit(SIGNS[kind])) & text.rlike("[0-9]") if kind != "email" else F.contains(
            text, F.lit("@"))
        out.append(F.when(present, spans).otherwise(F.array().cast(SPAN)))
    return F.array_sort(F.concat(*out))


def around(text: Column, start: Column, stop: Column) -> tuple[Column, Column]:
    """The characters before a span, and the one after it."""
    before = F.substring(text, F.greatest(start - CONTEXT + 1, F.lit(1)).cast("int"), F.least(
        start, F.lit(CONTEXT)).cast("int"))
    return before, F.substring(text, (stop + 1).cast("int"), F.lit(1))


def features(match: Column, before: Column, after: Column, wide: Column) -> Column:
    """Format and context of a candidate as an array of doubles."""
    number, before, parts = digits(match), F.lower(before), F.split(match, r"[^0-9]+")
    flags = (
        wide, F.length(match), F.length(number), F.length(F.regexp_replace(match, r"[^.]", "")),
        F.length(F.regexp_replace(match, r"[^\x20/-]", "")), F.length(F.regexp_replace(match, r"[^()]", "")),
        F.startswith(match, F.lit("+")), F.contains(match, F.lit("@")), F.size(parts),
        F.array_max(F.transform(parts, F.length)), F.array_min(F.transform(parts, F.length)),
        F.length(number).between(12, 19) & F.coalesce(
            F.call_function("luhn_check", F.substring(number, 1, 19)), F.lit(False)),
        before.rlike(r"(mail|contact|phone|tel|call|fax|mobile|card|visa|ip|host|address)"),
        before.rlike(r"[\p{L}\p{N}_=]$"), after.rlike(r"^[\p{L}\p{N}_=]"), before.rlike(r"[:.]\s*$"),
        match.rlike(r"[\[(](?:dot|DOT)[\])]"),
    )
    return F.array(*(F.coalesce(f.cast("double"), F.lit(0.0)) for f in flags))


HOST_DOT = r"\.(?=[^@]*$)"


def spelt(at: str, dot: str, digit: str, m: Column) -> Column:
    """An address with the sign and the dots of its host replaced, and each digit by `digit` if that is not empty."""
    m = F.regexp_replace(F.regexp_replace(m, HOST_DOT, dot), "@", at)
    return F.regexp_replace(m, "[0-9]", digit) if digit else m


#: The base spans as people write them to keep them from programs: (base kind, wide kind, rewritten).
DISGUISES = (
    *(("email", 0, partial(spelt, at, dot, digit)) for at, dot in ((" (at) ", " (dot) "), ("[at]", "[dot]"), (" [at] ", "."))
      for digit in ("", "o")),
    ("card", 1, lambda m: F.regexp_replace(digits(m), r"([0-9]{4})(?=[0-9])", "$1.")),
    ("card", 1, lambda m: F.regexp_replace(digits(m), r"([0-9]{4})(?=[0-9])", "$1 / ")),
    ("phone", 1, lambda m: F.regexp_replace(m, r"^\+[0-9]{1,3}[\x20.-]*", "")),
    ("phone", 1, lambda m: F.regexp_replace(F.regexp_replace(m, r"^\+", ""), r"[\x20()-]+", ".")),
)


def disguised(text: Column, base: Column) -> Column:
    """Features of the base spans rewritten in each of the ways that the wide patterns take whole."""
    def rewritten(k: int, wide: int, way, b: Column) -> Column:
        match = way(F.substring(text, (b["start"] + 1).cast("int"), (b["stop"] - b["start"]).cast("int")))
        whole = match.rlike("^(?:" + tuple(WIDE.values())[wide].replace(r"(?:\G|(?<![A-Za-z0-9._%+-]))", "") + ")$")
        return F.when((b["kind"] == k) & whole, features(match, *around(text, b["start"], b["stop"]), F.lit(wide)))

    ways = [partial(rewritten, list(BASE).index(kind), wide, way) for kind, wide, way in DISGUISES]
    return F.filter(F.flatten(F.transform(base, lambda b: F.array(*(w(b) for w in ways)))), lambda x: x.isNotNull())


def overlapping(base: Column, m: Column) -> Column:
    return F.exists(base, lambda b: (b["start"] < m["stop"]) & (m["start"] < b["stop"]))


def described(text: Column, base: Column, wide: int, m: Column) -> Column:
    return F.struct(
        m["start"].alias("start"), F.lit(len(BASE) + wide).alias("kind"), m["stop"].alias("stop"),
        features(m["match"], *around(text, m["start"], m["stop"]), F.lit(wide)).alias("features"),
        overlapping(base, m).alias("known"))


def of_kind(number: int, s: Column) -> Column:
    return s["kind"] == number


def candidates(text: Column, base: Column) -> Column:
    """Array of (start, kind number, stop, features, known): known if it overlaps a base span."""
    out = []
    for wide, pattern in enumerate(WIDE.values()):
        present = text.rlike(r"@|[\[(](?:at|AT)[\])]") if wide == 0 else text.rlike("[0-9]")
        rows = F.transform(matches(text, pattern), partial(described, text, base, wide))
        out.append(F.when(present, rows))
    kind = "array<struct<start: bigint, kind: int, stop: bigint, features: array<double>, known: boolean>>"
    return F.concat(*(F.coalesce(x, F.array().cast(kind)) for x in out))


def tree_value(node, feature: Column) -> Column:
    """A regression tree as an expression."""
    if node.getClass().getSimpleName() == "LeafNode":
        return F.lit(node.prediction())
    split = node.split()
    return F.when(
        F.get(feature, F.lit(split.featureIndex())) <= F.lit(split.threshold()), tree_value(node.leftChild(), feature)
    ).otherwise(tree_value(node.rightChild(), feature))


class Model:
    """Boosted trees and the score from which a candidate is redacted; `trees` is empty if there was one class."""

    def __init__(self, trees=(), weights=(), threshold: float = 2.0):
        self.trees, self.weights, self.threshold = list(trees), list(weights), threshold

    def score(self, feature: Column) -> Column:
        margin = reduce(lambda a, b: a + b, (
            tree_value(t._call_java("rootNode"), feature) * F.lit(w) for t, w in zip(self.trees, self.weights)))
        return F.lit(1.0) / (F.lit(1.0) + F.exp(margin * -2))


def fitted(documents: DataFrame) -> Model:
    """Fit on base spans in disguise against the candidates that no base span overlaps.

    A base span, rewritten in the ways of DISGUISES, is what the base patterns miss and the trees are there to find;
    so no label follows from the patterns' own signs.  All documents are looked at and all their candidates used:
    three quarters for the trees, a quarter for the threshold, which is the lowest score from which that share of
    candidates (PRECISION) is personal data.
    """
    picked = documents.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    picked = picked.where(F.col("text").rlike("[0-9@]|[\\[(](?:at|AT)[\\])]")).withColumn(
        "base", base_spans(F.col("text")))
    text, base = F.col("text"), F.col("base")
    other = F.transform(F.filter(candidates(text, base), lambda c: ~c["known"]), lambda c: c["features"])
    labelled = [picked.select("doc_id", F.posexplode(rows_).alias("at", "features"), F.lit(label).alias("label"))
                for rows_, label in ((disguised(text, base), 1.0), (other, 0.0))]
    found = kept(labelled[0].unionByName(labelled[1]).select(
        F.xxhash64("doc_id", "at", "label").alias("h"), "features", "label"), "candidates")
    n = found.agg(F.count("*"), F.sum("label")).first()
    if not n[0] or n[1] in (0, n[0]):
        return Model()
    fit, hold = found.where(F.pmod("h", F.lit(4)) > 0), found.where(F.pmod("h", F.lit(4)) == 0)
    if fit.select("label").distinct().count() < 2:
        return Model()
    gbt = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, stepSize=0.3, seed=1, checkpointInterval=-1, maxBins=32)
    built = gbt.fit(fit.select("label", array_to_vector("features").alias("features")))
    model = Model(built.trees, built.treeWeights)
    levels = F.floor(model.score(F.col("features")) * 100).cast("int")
    by_level = {r["level"]: (r["n"], r["known"]) for r in hold.groupBy(levels.alias("level")).agg(
        F.count("*").alias("n"), F.sum("label").alias("known")).collect()}  # 101 rows at most
    total = known = 0
    for level in range(100, 49, -1):
        total, known = total + by_level.get(level, (0, 0))[0], known + by_level.get(level, (0, 0))[1]
        if total and known >= PRECISION * total:
            model.threshold = level / 100
    return model


def spans_in(documents: DataFrame, model: Model) -> DataFrame:
    """Documents (doc_id, text, ...) with `_pii_base` and `_pii_added`, arrays of (start, kind number, stop)."""
    rows = documents.withColumn("_pii_text", F.coalesce(F.col("text"), F.lit("")))
    rows = rows.withColumn("_pii_base", let(F.col("_pii_text"), base_spans))
    added = F.array().cast(SPAN)
    if model.trees:
        def chosen(c):
            return ~c["known"] & (model.score(c["features"]) >= F.lit(model.threshold))

        both = F.struct(F.col("_pii_text").alias("t"), F.col("_pii_base").alias("b"))
        added = let(both, lambda x: F.transform(F.filter(candidates(x["t"], x["b"]), chosen), lambda c: F.struct(
            c["start"].alias("start"), c["kind"].alias("kind"), c["stop"].alias("stop"))))
        added = F.when(F.col("_pii_text").rlike("[0-9@]|[\\[(](?:at|AT)[\\])]"), added).otherwise(F.array().cast(SPAN))
    return rows.withColumn("_pii_added", added).drop("_pii_text")


def listed(spans: Column) -> Column:
    """kind:start:stop of each span, joined by commas."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.get(names, s["kind"]), s["start"].cast("string"), s["stop"].cast("string"))), ",")


def personal_data(documents: DataFrame, model: Model | None = None) -> DataFrame:
    """One row for each row of documents (doc_id, text): counts by base kind, digest of the base spans, all spans.

    A null or empty text has no spans; null ids and repeated rows stay; an empty table gives an empty one; further
    columns are not looked at.  Without both labels among the candidates no spans are added to the base ones.
    """
    docs = documents.select("doc_id", "text")
    rows = spans_in(docs, model or fitted(docs))
    counts = [F.size(F.filter("_pii_base", partial(of_kind, k))).cast("long").alias(f"n_{name}")
              for k, name in enumerate(BASE)]
    return rows.select(
        "doc_id", *counts, F.sha2(listed(F.col("_pii_base")), 256).alias("base_sha256"),
        listed(F.array_sort(F.concat("_pii_base", "_pii_added"))).alias("spans"))


def redacted(documents: DataFrame, model: Model | None = None) -> DataFrame:
    """Documents with every span of `text` replaced by its kind in brackets; the first of overlapping spans counts,
    and takes in what overlaps it."""
    rows = spans_in(documents, model or fitted(documents.select("doc_id", "text")))
    names = F.array(*(F.lit(f"[{k.upper()}]") for k in KINDS))

    def rebuilt(x: Column) -> Column:
        first = F.struct(F.lit(0).cast("long").alias("at"), F.lit("").alias("out"))

        def step(acc: Column, s: Column) -> Column:
            gap = F.substring(x["t"], (acc["at"] + 1).cast("int"), (s["start"] - acc["at"]).cast("int"))
            fresh = s["start"] >= acc["at"]
            return F.struct(
                F.greatest(acc["at"], s["stop"]).alias("at"),
                F.when(fresh, F.concat(acc["out"], gap, F.get(names, s["kind"]))).otherwise(acc["out"]).alias("out"))

        return F.aggregate(x["s"], first, step, lambda acc: F.concat(
            acc["out"], F.substring(x["t"], (acc["at"] + 1).cast("int"), F.length(x["t"]))))

    spans = F.array_sort(F.concat("_pii_base", "_pii_added"))
    rows = rows.withColumn("_pii_spans", spans)
    text = F.when(F.size("_pii_spans") > 0, let(F.struct(F.col("text").alias("t"), F.col("_pii_spans").alias("s")), rebuilt))
    return rows.withColumn("text", F.coalesce(text, F.col("text"))).drop("_pii_base", "_pii_added", "_pii_spans")
