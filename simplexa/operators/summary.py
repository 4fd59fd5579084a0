"""Group summaries, entity aggregates and the tables behind the plots."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from simplexa.functions.expressions import ieee_divide, is_missing
from simplexa.names import FEATURE, SAMPLE, SEPARATOR, VALUE
from simplexa.operators.composition import SparseClr, dense, of_features
from simplexa.operators.hypothesis import SIGNIFICANT
from simplexa.operators.joins import join_metadata
from simplexa.operators.ordered import SLICE_ROWS, exact_quantiles
from simplexa.sources.shared import stored

# Sizes of the reported lists.
PER_TAXON = 3
TOP_LOADINGS = 5
TOP_IMPORTANCE = 20
HEATMAP_FEATURES = 50
FEW_CANDIDATES = 50


def group_summary(
    df: DataFrame, group: str | Sequence[str], value: str = VALUE, slice_rows: int = SLICE_ROWS
) -> DataFrame:
    """N, Mean, Std (n-1), Min, Median, Max and CV% per group, sorted by group.

    The exact median of a group is found across slices, so no task holds a
    whole group.
    """
    groups = [group] if isinstance(group, str) else list(group)
    x = F.col(value).cast("double")
    moments = df.groupBy(*groups).agg(
        F.count(x).alias("N"),
        F.avg(x).alias("Mean"),
        F.stddev_samp(x).alias("Std"),
        F.min(x).alias("Min"),
        F.max(x).alias("Max"),
    )
    medians = exact_quantiles(df, groups, value, {"Median": 0.5}, slice_rows)
    return (
        moments.join(medians, groups, "left")
        .select(
            *groups, "N", "Mean", "Std", "Min", "Median", "Max",
            (ieee_divide("Std", "Mean") * 100).alias("CV%"),
        )
        .orderBy(*groups)
    )


def mini_summary(
    df: DataFrame, group: str, features: Sequence[str], feature: str = FEATURE, value: str = VALUE
) -> DataFrame:
    """Mean and Std per group for a few chosen features."""
    chosen = df.filter(F.col(feature).isin(list(features)))
    return chosen.groupBy(feature, group).agg(
        F.avg(value).alias("Mean"), F.stddev_samp(value).alias("Std")
    )


def box_summary(
    df: DataFrame, group: str | Sequence[str], value: str = VALUE, slice_rows: int = SLICE_ROWS
) -> DataFrame:
    """Minimum, quartiles and maximum per group, linearly interpolated."""
    groups = [group] if isinstance(group, str) else list(group)
    cuts = {"low": 0.0, "q1": 0.25, "median": 0.5, "q3": 0.75, "high": 1.0}
    return exact_quantiles(df, groups, value, cuts, slice_rows).orderBy(*groups)


def aggregate_entity(
    df: DataFrame, where, is_clr: bool, name: str = VALUE, sample: str = SAMPLE, value: str = VALUE
) -> DataFrame:
    """One value per sample over the chosen rows: mean of CLR, sum of counts."""
    how = F.avg if is_clr else F.sum
    return df.filter(where).groupBy(sample).agg(how(value).alias(name))


def of_taxon(taxon: str, feature: str = FEATURE):
    return F.col(feature).startswith(taxon + SEPARATOR)


def of_trait(trait: str, feature: str = FEATURE):
    return F.col(feature).endswith(SEPARATOR + trait)


def entity_scatter(
    df: DataFrame, where_x, where_y, is_clr: bool, metadata: DataFrame | None = None,
    colour: str | None = None, sample: str = SAMPLE, value: str = VALUE,
) -> DataFrame:
    """Value_X and Value_Y per sample that has both, with an optional attribute."""
    x = aggregate_entity(df, where_x, is_clr, "Value_X", sample, value)
    y = aggregate_entity(df, where_y, is_clr, "Value_Y", sample, value)
    points = x.join(y, sample)
    if metadata is None or colour is None:
        return points
    return join_metadata(points, metadata.select(sample, colour).distinct(), [colour], sample, "left")


def significance_tally(tests: DataFrame, alpha: float = SIGNIFICANT) -> DataFrame:
    """One row: features tested, and how many pass on p and on q, with shares."""

    def passed(column):
        return F.count_if(~is_missing(column) & (F.col(column) < alpha))

    tally = tests.agg(
        F.count(F.lit(1)).alias("total"), passed("p_value").alias("n_p"), passed("q_value").alias("n_q")
    )
    return tally.select(
        "total", "n_p", ieee_divide(100 * F.col("n_p"), "total").alias("pct_p"),
        "n_q", ieee_divide(100 * F.col("n_q"), "total").alias("pct_q"),
    )


def diverse_top(
    scored: DataFrame, n: int, per_taxon: int = PER_TAXON, score: str = "variance",
    feature: str = FEATURE,
) -> DataFrame:
    """The n best features with at most ``per_taxon`` per taxon, then backfill.

    Features beyond the quota only fill places the quota leaves empty.  Keys
    without a taxon part are their own taxon, so the quota does not bind.  The
    quota filter runs before the shuffle as well, and both limits are top-n.
    """
    scored = stored(scored.select(feature, score), "scores")  # one row per feature
    taxon = F.substring_index(feature, SEPARATOR, 1)
    order = [F.desc(score), F.asc(feature)]
    within = Window.partitionBy("_taxon").orderBy(*order)
    named = scored.select(feature, score, taxon.alias("_taxon"))
    quota = (
        named.withColumn("_rank", F.row_number().over(within))
        .filter(F.col("_rank") <= per_taxon)
        .drop("_rank")
    )
    first = quota.orderBy(*order).limit(n).withColumn("_tier", F.lit(0))
    # At most n + n places can be decided by the rest.
    rest = (
        named.join(quota.select(feature), feature, "left_anti")
        .orderBy(*order).limit(n).withColumn("_tier", F.lit(1))
    )
    chosen = first.unionByName(rest.select(first.columns))
    chosen = chosen.orderBy("_tier", *order).limit(n)
    place = F.row_number().over(Window.partitionBy(F.lit(0)).orderBy("_tier", *order))
    return chosen.select(feature, score, place.alias("place"))


def top_scores(scores: DataFrame, score: str, n: int = TOP_IMPORTANCE, key: str = "Feature") -> DataFrame:
    """The n largest scores by absolute value."""
    return (
        scores.withColumn("abs_val", F.abs(score)).orderBy(F.desc("abs_val"), key).limit(n)
    )


def top_loadings(loadings: DataFrame, n: int = TOP_LOADINGS, key: str = "Feature") -> DataFrame:
    """The n longest loading vectors on the first two components."""
    length = F.col("PC1") * F.col("PC1") + F.col("PC2") * F.col("PC2")
    return loadings.withColumn("magnitude", length).orderBy(F.desc("magnitude"), key).limit(n)


def report_candidates(tests: DataFrame, alpha: float = SIGNIFICANT, few: int = FEW_CANDIDATES) -> DataFrame:
    """Features with q below alpha, or all features if those are few.

    Both counts come from one scalar subquery inside the plan.
    """
    passes = ~is_missing("q_value") & (F.col("q_value") < alpha)
    found = tests.agg(F.count_if(passes)).scalar()
    return tests.filter(passes | (found < few)).orderBy(F.asc_nulls_last("q_value"), "Feature")


def model_candidates(tests: DataFrame, alpha: float = SIGNIFICANT, n: int | None = None) -> DataFrame:
    """Features with q below alpha, the n smallest if n is given, or every feature if none is."""
    passes = ~is_missing("q_value") & (F.col("q_value") < alpha)
    found = tests.agg(F.count_if(passes)).scalar()
    best = tests.filter(passes)
    if n is not None:
        best = best.orderBy("q_value", "Feature").limit(n)
    return best.unionByName(tests.filter(found == 0))


def volcano(
    tests: DataFrame, p_value: str = "p_value", effect: str = "test_statistic",
    threshold: float = SIGNIFICANT,
) -> DataFrame:
    """Feature, effect, p, -log10 p and significance, for positive p only."""
    kept = tests.filter(~is_missing(p_value) & (F.col(p_value) > 0))
    return kept.select(
        "Feature", effect, p_value,
        (-F.log10(p_value)).alias("log_p"),
        (F.col(p_value) < threshold).alias("Significant"),
    )


def heatmap(
    table: DataFrame | SparseClr, chosen: DataFrame, metadata: DataFrame | None = None,
    group: str | None = None, feature: str = FEATURE, sample: str = SAMPLE,
) -> DataFrame:
    """The cells of the chosen features, with the sample's group.

    Of a sparse table only the chosen features are unpacked.
    """
    if isinstance(table, SparseClr):
        cells = dense(of_features(table, chosen.select(F.col(feature).alias(FEATURE))))
    else:
        cells = table.join(chosen.select(feature), feature, "left_semi")
    if metadata is None or group is None:
        return cells
    return join_metadata(cells, metadata, [group], sample, "left")


def scores_with_group(
    scores: DataFrame, metadata: DataFrame, group: str, sample: str = SAMPLE
) -> DataFrame:
    """Ordination scores or diversity values with the sample's group."""
    return join_metadata(scores, metadata, [group], sample)


def sorted_nulls_last(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.orderBy(*[F.asc_nulls_last(c) for c in columns])


def preview(df: DataFrame, columns: Sequence[str], n: int = 3) -> DataFrame:
    """The first n rows in key order."""
    return sorted_nulls_last(df, columns).limit(n)
