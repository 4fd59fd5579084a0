"""Rank tests, effect sizes, false-discovery control and correlation screens.

Tests take a long table with one row per (sample, feature), or a sparse CLR
whose absent cells then cost nothing (`ranks`).  Long values are counted per
(feature, value, group) before anything is ranked, which combines ties on the
map side.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from simplexa.functions.expressions import NAN, ieee_divide, is_missing
from simplexa.functions.tails import (
    chi2_upper,
    mann_whitney_exact,
    normal_two_sided,
    t_two_sided,
)
from simplexa.names import FEATURE, SAMPLE, VALUE
from simplexa.operators.composition import SparseClr, dense
from simplexa.operators.joins import join_metadata
from simplexa.operators.ordered import (
    SLICE_ROWS,
    carry,
    midranks,
    slice_by_order,
    value_counts,
)
from simplexa.operators.ranks import corrected_sum, sparse_rank_sums
from simplexa.sources.shared import stored

# Fixed value: at or below this group size untied data get the exact p-value.
EXACT_GROUP_SIZE = 8
SIGNIFICANT = 0.05
# Up to this share of stored cells ranks come from the cells alone; above, the grid has fewer rows than the lookups.
SPARSE_SHARE = 0.1


def grouped_values(
    long: DataFrame | SparseClr, metadata: DataFrame, group: str, sample: str = SAMPLE
) -> DataFrame | SparseClr:
    """Attach the group; samples without one do not take part in tests.

    A sparse table gets it on its baselines.
    """
    known = metadata.filter(F.col(group).isNotNull())
    if isinstance(long, SparseClr):
        known = known.withColumnRenamed(sample, SAMPLE)
        return long._replace(baseline=join_metadata(long.baseline, known, [group]))
    return join_metadata(long, known, [group], sample)


def rank_sums(
    grouped: DataFrame, group: str, feature: str = FEATURE, value: str = VALUE,
    slice_rows: int = SLICE_ROWS,
) -> DataFrame:
    """Per (feature, group): n, rank sum, and the group's share of the tie term."""
    ranked = midranks(grouped, [feature], value, [group], slice_rows)
    n, ties = F.col("n").cast("double"), F.col("ties").cast("double")
    return ranked.groupBy(feature, group).agg(
        F.sum(n).alias("n"),
        F.sum(n * F.col("midrank")).alias("rank_sum"),
        F.sum(n * (ties * ties - 1)).alias("tie_term"),
    )


def _cheaper_form(table: DataFrame | SparseClr, extra: list[str]) -> DataFrame | SparseClr:
    """A sparse table whose cells are mostly stored as a long one, with ``extra`` columns of its baselines.

    Both forms give the same ranks; counting the cells decides.
    """
    if not isinstance(table, SparseClr):
        return table
    grid = table.baseline.count() * table.features.count()
    if table.cells.count() <= SPARSE_SHARE * grid:
        return table
    long = dense(table._replace(baseline=table.baseline.select(SAMPLE, "baseline")))
    return long.join(table.baseline.select(SAMPLE, *extra), SAMPLE) if extra else long


def _sparse_sums(grouped: SparseClr, group: str, slice_rows: int) -> DataFrame:
    """The features' corrections, each with all groups (key, n, base) as an array."""
    weights = grouped.baseline.select(SAMPLE, F.col(group).cast("string").alias("key"), F.lit(1.0).alias("a"))
    keys, features = sparse_rank_sums(grouped, weights, slice_rows)
    groups = keys.agg(F.sort_array(F.collect_list(F.struct("key", "n", "base")))).scalar()
    return features.withColumn("_groups", groups)


def kruskal_wallis(
    grouped: DataFrame | SparseClr, group: str, feature: str = FEATURE, value: str = VALUE,
    slice_rows: int = SLICE_ROWS,
) -> DataFrame:
    """Feature, test_statistic (tie-corrected H), p_value; sorted by feature.

    Fewer than two groups, or a constant feature, gives NaN.
    """
    grouped = _cheaper_form(grouped, [group])
    if isinstance(grouped, SparseClr):
        feature = FEATURE
        features, groups = _sparse_sums(grouped, group, slice_rows), F.col("_groups")

        def added(total, g):
            ranks = corrected_sum(g["key"], g["base"])
            return total + ranks * ranks / g["n"]

        per = features.select(
            feature,
            F.size(groups).cast("bigint").alias("k"),
            F.aggregate(groups, F.lit(0.0), lambda total, g: total + g["n"]).alias("n"),
            F.aggregate(groups, F.lit(0.0), added).alias("spread"),
            "ties",
        )
    else:
        sums = rank_sums(grouped, group, feature, value, slice_rows)
        per = sums.groupBy(feature).agg(
            F.count(F.lit(1)).alias("k"),
            F.sum("n").alias("n"),
            F.sum(F.col("rank_sum") * F.col("rank_sum") / F.col("n")).alias("spread"),
            F.sum("tie_term").alias("ties"),
        )
    n = F.col("n")
    h = 12 / (n * (n + 1)) * F.col("spread") - 3 * (n + 1)
    correction = 1 - ieee_divide(F.col("ties"), n * n * n - n)
    statistic = F.when(
        (F.col("k") > 1) & (correction > 0), ieee_divide(h, correction)
    ).otherwise(F.lit(NAN))
    tested = per.select(F.col(feature).alias("Feature"), "k", statistic.alias("test_statistic"))
    return tested.select(
        "Feature",
        "test_statistic",
        chi2_upper("test_statistic", (F.col("k") - 1).cast("double")).alias("p_value"),
    ).orderBy("Feature")


def _pair_sums(grouped, group, group_1, group_2, feature, value, slice_rows) -> DataFrame:
    """Per feature: n1, n2, the rank sum of group_1 and the tie term."""
    pair = F.col(group).isin(group_1, group_2)
    if isinstance(grouped, SparseClr):
        groups = F.col("_groups")
        features = _sparse_sums(
            grouped._replace(baseline=grouped.baseline.filter(pair)), group, slice_rows
        )

        def of(name, value):
            own = F.filter(groups, lambda g: g["key"] == F.lit(name).cast("string"))
            return F.aggregate(own, F.lit(0.0), lambda total, g: total + value(g))

        return features.select(
            F.col(FEATURE).alias(feature),
            of(group_1, lambda g: g["n"]).alias("n1"),
            of(group_2, lambda g: g["n"]).alias("n2"),
            of(group_1, lambda g: corrected_sum(g["key"], g["base"])).alias("r1"),
            "ties",
        )
    sums = rank_sums(grouped.filter(pair), group, feature, value, slice_rows)

    def of(name, column):
        return F.coalesce(F.sum(F.when(F.col(group) == name, F.col(column))), F.lit(0.0))

    per = sums.groupBy(feature).agg(
        of(group_1, "n").alias("n1"),
        of(group_2, "n").alias("n2"),
        of(group_1, "rank_sum").alias("r1"),
        F.sum("tie_term").alias("ties"),
    )
    every = grouped.select(feature).distinct().join(per, feature, "left")
    return every.na.fill(0.0, ["n1", "n2", "r1", "ties"])


def mann_whitney(
    grouped: DataFrame | SparseClr, group: str, group_1: str, group_2: str, feature: str = FEATURE,
    value: str = VALUE, slice_rows: int = SLICE_ROWS,
) -> DataFrame:
    """Feature, test_statistic (U of group_1), p_value, cliffs_delta, n1, n2.

    Two-sided.  Exact when a group has at most eight rows and nothing is tied,
    otherwise normal with tie and continuity correction.  A feature without
    rows in one group gives NaN.
    """
    grouped = _cheaper_form(grouped, [group])
    every = _pair_sums(grouped, group, group_1, group_2, feature, value, slice_rows)
    n1, n2 = F.col("n1"), F.col("n2")
    n, pairs, both = n1 + n2, n1 * n2, (n1 > 0) & (n2 > 0)
    u = F.when(both, F.col("r1") - n1 * (n1 + 1) / 2).otherwise(F.lit(NAN))
    spread = F.sqrt(pairs / 12 * (n + 1 - ieee_divide(F.col("ties"), n * (n - 1))))
    far = F.greatest(F.col("u"), pairs - F.col("u")) - pairs / 2 - 0.5
    exact = (F.least(n1, n2) <= EXACT_GROUP_SIZE) & (F.col("ties") == 0)
    scored = every.withColumn("u", u).select(
        F.col(feature).alias("Feature"), "u", "n1", "n2",
        (both & exact).alias("exact"),
        F.when(both, ieee_divide(far, spread)).otherwise(F.lit(NAN)).alias("z"),
    )
    # The UDFs see NaN, and so do no work, on the rows of the other branch.
    skip = F.lit(NAN)
    return scored.select(
        "Feature",
        F.col("u").alias("test_statistic"),
        F.when(
            F.col("exact"),
            mann_whitney_exact(F.when(F.col("exact"), F.col("u")).otherwise(skip), n1, n2),
        )
        .otherwise(normal_two_sided(F.when(F.col("exact"), skip).otherwise(F.col("z"))))
        .alias("p_value"),
        F.when(F.isnan("u"), skip).otherwise(ieee_divide(2 * F.col("u"), n1 * n2) - 1)
        .alias("cliffs_delta"),
        n1.cast("bigint").alias("n1"),
        n2.cast("bigint").alias("n2"),
    ).orderBy("Feature")


def cliffs_delta(
    grouped: DataFrame | SparseClr, group: str, group_1: str, group_2: str, feature: str = FEATURE,
    value: str = VALUE,
) -> DataFrame:
    """(pairs above - pairs below) / all pairs, from the rank sums."""
    tested = mann_whitney(grouped, group, group_1, group_2, feature, value)
    return tested.select("Feature", "cliffs_delta")


def benjamini_hochberg(
    tests: DataFrame, p_value: str = "p_value", key: str = "Feature", name: str = "q_value",
    slice_rows: int = SLICE_ROWS,
) -> DataFrame:
    """Add the false-discovery q-value; a missing p takes no part and gets null.

    q is the smallest p m / rank at or above the own p.  The running minimum is
    taken inside slices of the p order and carried over from later slices.  The
    test table, one row per feature, is stored first.
    """
    missing = is_missing(p_value)
    tests = stored(tests, "tests")
    untested = tests.filter(missing).withColumn(name, F.lit(None).cast("double"))
    present = tests.filter(~missing).withColumn("_order", F.struct(p_value, key))
    slices = slice_by_order(present, [], "_order", slice_rows, store=False)
    block = Window.partitionBy(*slices.block)
    family = tests.agg(F.count(F.when(~missing, 1)).cast("double")).scalar()
    local = F.row_number().over(block.orderBy("_order"))
    numbered = carry(slices.rows.withColumn("_local", local), slices, F.lit(1))
    raised = numbered.withColumn(
        "_raw", F.col(p_value) * family / (F.col("_local") + F.col("_before"))
    )
    onwards = block.orderBy(F.desc("_order")).rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    lowered = raised.withColumn("_own", F.min("_raw").over(onwards))
    if slices.cut:
        lowest = raised.groupBy(*slices.block).agg(F.min("_raw").alias("_low"))
        later = Window.partitionBy(*slices.keys).orderBy(F.desc("_slice")).rowsBetween(
            Window.unboundedPreceding, -1
        )
        after = lowest.select(*slices.block, F.min("_low").over(later).alias("_later"))
        lowered = lowered.join(after, slices.block, "left")
    else:
        lowered = lowered.withColumn("_later", F.lit(None).cast("double"))
    q = F.least(F.col("_own"), F.col("_later"), F.lit(1.0))
    return lowered.withColumn(name, q).select(*tests.columns, name).unionByName(untested)


def with_flags(tests: DataFrame, alpha: float = SIGNIFICANT) -> DataFrame:
    """Add ``p_sig`` and ``q_sig``; a missing value is not significant."""

    def below(column):
        return F.coalesce(~is_missing(column) & (F.col(column) < alpha), F.lit(False))

    return tests.withColumns({"p_sig": below("p_value"), "q_sig": below("q_value")})


def group_tests(
    long: DataFrame | SparseClr, metadata: DataFrame, group: str, sample: str = SAMPLE,
    feature: str = FEATURE, value: str = VALUE,
) -> DataFrame | None:
    """The test that fits the number of groups in the metadata, with q-values.

    Two groups: Mann-Whitney, the first name in sort order being group_1.
    More: Kruskal-Wallis.  Fewer: no test.  Reads at most three group names.
    """
    names = [
        row[0]
        for row in metadata.filter(F.col(group).isNotNull())
        .select(group).distinct().orderBy(group).limit(3).collect()
    ]
    if len(names) < 2:
        return None
    grouped = grouped_values(long, metadata, group, sample)
    if len(names) == 2:
        tests = mann_whitney(grouped, group, names[0], names[1], feature, value)
        tests = tests.select("Feature", "test_statistic", "p_value")
    else:
        tests = kruskal_wallis(grouped, group, feature, value)
    return benjamini_hochberg(tests)


def _correlation_result(sums: DataFrame, feature: str) -> DataFrame:
    """From n, sxy, sxx, syy per feature to r, p, q and flags."""
    r = ieee_divide(F.col("sxy"), F.sqrt("sxx") * F.sqrt("syy"))
    r = F.when(F.isnan(r), r).otherwise(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), r)))
    scored = sums.filter(F.col("n") >= 3).select(
        F.col(feature).alias("Feature"), F.col("n").cast("bigint").alias("n"),
        r.alias("correlation"),
    )
    degrees = F.col("n") - 2
    t = ieee_divide(
        F.col("correlation") * F.sqrt(degrees),
        F.sqrt((1 - F.col("correlation")) * (1 + F.col("correlation"))),
    )
    tested = scored.withColumn("p_value", t_two_sided(t, degrees.cast("double")))
    flagged = with_flags(benjamini_hochberg(tested))
    return flagged.withColumn("abs_correlation", F.abs("correlation")).orderBy(
        F.desc("abs_correlation"), "Feature"
    )


def _attribute_pairs(long, metadata, attribute, sample, feature, value):
    y = metadata.select(sample, F.col(attribute).cast("double").alias("_y"))
    return (
        long.join(y, sample)
        .select(feature, F.col(value).cast("double").alias("_x"), "_y")
        .filter(~is_missing("_x") & ~is_missing("_y"))
    )


def pearson(
    long: DataFrame | SparseClr, metadata: DataFrame, attribute: str, sample: str = SAMPLE,
    feature: str = FEATURE, value: str = VALUE,
) -> DataFrame:
    """Correlation of every feature with a numeric attribute, largest first.

    Takes a dense long table, or a sparse CLR whose absent cells then cost
    nothing.
    """
    if isinstance(long, SparseClr):
        return _correlation_result(_sparse_products(long, metadata, attribute, sample), FEATURE)
    pairs = _attribute_pairs(long, metadata, attribute, sample, feature, value)
    n = F.count(F.lit(1)).cast("double")
    sums = pairs.groupBy(feature).agg(
        n.alias("n"),
        (F.covar_pop("_x", "_y") * n).alias("sxy"),
        (F.var_pop("_x") * n).alias("sxx"),
        (F.var_pop("_y") * n).alias("syy"),
    )
    return _correlation_result(sums, feature)


def _sparse_products(table: SparseClr, metadata: DataFrame, attribute: str, sample: str) -> DataFrame:
    """Centred sums of squares and products per feature, from the stored cells.

    A feature's values are baseline + u with u = 0 where nothing is stored, so
    the baseline's part is the same for all features and computed once.
    """
    y = metadata.select(F.col(sample).alias(SAMPLE), F.col(attribute).cast("double").alias("_y"))
    known = stored(table.baseline.join(y, SAMPLE).filter(~is_missing("_y")), "attribute")
    middle = known.agg(
        F.struct(F.avg("_y").alias("y"), F.avg("baseline").alias("b"))
    ).scalar()
    centred = known.select(
        SAMPLE, "baseline", (F.col("_y") - middle.getField("y")).alias("_y"),
        (F.col("baseline") - middle.getField("b")).alias("_b"),
    )
    common = known.agg(F.struct(
        F.count(F.lit(1)).cast("double").alias("n"),
        F.covar_pop("baseline", "_y").alias("by"),
        F.var_pop("baseline").alias("bb"),
        F.var_pop("_y").alias("yy"),
    )).scalar()
    n = common.getField("n")
    u = F.col("clr") - F.col("baseline")
    own = (
        table.cells.join(centred, SAMPLE)
        .groupBy(FEATURE)
        .agg(
            F.sum(u).alias("_u"),
            F.sum(u * F.col("_y")).alias("_uy"),
            F.sum(u * (u + 2 * F.col("_b"))).alias("_uu"),
        )
    )
    every = table.features.join(own, FEATURE, "left").na.fill(0.0, ["_u", "_uy", "_uu"])
    square = n * common.getField("bb") + F.col("_uu") - F.col("_u") * F.col("_u") / n
    return every.select(
        FEATURE,
        n.alias("n"),
        (n * common.getField("by") + F.col("_uy")).alias("sxy"),
        F.greatest(square, F.lit(0.0)).alias("sxx"),
        (n * common.getField("yy")).alias("syy"),
    )


def _sparse_ranked(table: SparseClr, metadata, attribute, sample, slice_rows) -> DataFrame:
    """Centred sums of squares and products of ranks: the attribute is ranked once for all features."""
    y = metadata.select(F.col(sample).alias(SAMPLE), F.col(attribute).cast("double").alias("_y"))
    known = stored(table.baseline.join(y, SAMPLE).filter(~is_missing("_y")), "attribute")
    ranks = stored(midranks(known, [], "_y", (), slice_rows), "attribute-ranks")
    centred = F.col("midrank") - (F.col("total") + 1) / 2
    weights = known.join(ranks, "_y").select(SAMPLE, F.lit("").alias("key"), centred.alias("a"))
    keys, features = sparse_rank_sums(table, weights, slice_rows)
    one = keys.agg(F.struct(F.first("n").alias("n"), F.first("base").alias("base"))).scalar()
    squares = ranks.agg(F.sum(F.col("n") * centred * centred)).scalar()
    n = one.getField("n")
    return features.select(
        FEATURE,
        n.alias("n"),
        corrected_sum(F.lit(""), one.getField("base")).alias("sxy"),
        ((n * n * n - n - F.col("ties")) / 12).alias("sxx"),
        squares.alias("syy"),
    ).filter("n IS NOT NULL")


def spearman(
    long: DataFrame | SparseClr, metadata: DataFrame, attribute: str, sample: str = SAMPLE,
    feature: str = FEATURE, value: str = VALUE, slice_rows: int = SLICE_ROWS,
) -> DataFrame:
    """Rank correlation of every feature with a numeric attribute, largest first.

    Ranks are taken over distinct values and joined back to the distinct pairs,
    so a heavily tied value meets one rank row.  A sparse CLR is ranked from its
    stored cells.
    """
    long = _cheaper_form(long, [])
    if isinstance(long, SparseClr):
        return _correlation_result(_sparse_ranked(long, metadata, attribute, sample, slice_rows), FEATURE)
    pairs = _attribute_pairs(long, metadata, attribute, sample, feature, value)
    counted = stored(value_counts(pairs, [feature, "_x", "_y"], "_pairs"), "pairs")

    def centred(column, name):
        ranks = midranks(counted, [feature], column, (), slice_rows, "_pairs")
        return ranks.select(
            feature, column, (F.col("midrank") - (F.col("total") + 1) / 2).alias(name)
        )

    ranked = counted.join(centred("_x", "_rx"), [feature, "_x"]).join(
        centred("_y", "_ry"), [feature, "_y"]
    )
    n = F.col("_pairs").cast("double")
    sums = ranked.groupBy(feature).agg(
        F.sum(n).alias("n"),
        F.sum(n * F.col("_rx") * F.col("_ry")).alias("sxy"),
        F.sum(n * F.col("_rx") * F.col("_rx")).alias("sxx"),
        F.sum(n * F.col("_ry") * F.col("_ry")).alias("syy"),
    )
    return _correlation_result(sums, feature)
