"""One Spark query per operator, over the driver tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from registry.roles import Roles
from simplexa.operators import (
    checks,
    composition,
    diversity,
    filters,
    hypothesis,
    joins,
    keys,
    ordered,
    ordination,
    permanova,
    profile,
    reshape,
    selection,
    summary,
    taxonomy,
)
from simplexa.operators.joins import not_broadcast
from simplexa.plans import composed
from simplexa.sources import delimited, sinks, traits
from simplexa.sources.shared import new_table_path, stored

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(build):
    """Register under the function's name."""

    def run(spark: SparkSession, folder: str) -> DataFrame:
        return build(Roles(spark, folder))

    QUERIES[build.__name__] = run
    return build


def rounded(df: DataFrame, *columns: str, digits: int = 6) -> DataFrame:
    """Round, and fold -0.0 into 0.0, so that engines can be compared."""
    return df.withColumns({c: F.round(c, digits) + F.lit(0.0) for c in columns})


# --- sources and sinks ------------------------------------------------------


@query
def a1_read_table(t: Roles) -> DataFrame:
    """Null tokens of a text table become null, numbers become numbers."""
    path = new_table_path(t.spark, "a1") + ".tsv"
    token = F.get(F.array(*map(F.lit, ["NA", "nan", "null"])), (F.col("s_suppkey") % 3).cast("int"))
    t.table("supplier").select(
        "s_suppkey", F.when(F.col("s_nationkey") > 4, F.col("s_name")).otherwise(token).alias("s_name"),
        F.when(F.col("s_acctbal") > 0, F.col("s_acctbal").cast("string")).otherwise("NA").alias("s_acctbal"),
    ).write.csv(path, sep="\t", header=True)
    return delimited.read_table(t.spark, path)


@query
def a2_exported_counts(t: Roles) -> DataFrame:
    """A banner line and a ``#OTU ID`` header above the numbers."""
    path = new_table_path(t.spark, "a2")
    lines = t.table("part").select(
        (F.col("p_partkey") % 4).alias("file"), F.lit(2).alias("at"),
        F.concat_ws("\t", F.concat(F.lit("P"), "p_partkey"), F.col("p_size").cast("double"),
                    F.col("p_retailprice")).alias("value"),
    )
    tops = lines.select("file").distinct().select(
        "file",
        F.inline(F.array(
            F.struct(F.lit(0).alias("at"), F.lit("# Constructed from biom file").alias("value")),
            F.struct(F.lit(1).alias("at"), F.lit("#OTU ID\tsize\tprice").alias("value")),
        )),
    )
    every = lines.unionByName(tops).repartition(4, "file").sortWithinPartitions("file", "at")
    every.select("value").write.text(path)
    return delimited.read_exported_counts(t.spark, path).withColumnRenamed("#OTU ID", "otu")


@query
def a3_read_predictions(t: Roles) -> DataFrame:
    """Comment lines are skipped and the first column renamed."""
    path = new_table_path(t.spark, "a3")
    wide = t.table("part").select(
        F.when(F.col("p_partkey") % 50 == 7, F.concat(F.lit("#"), "p_name"))
        .otherwise(F.concat(F.lit("P"), "p_partkey")).alias("function"),
        (F.col("p_size") / 2).alias("half"),
    )
    # Another comment mark for the writer, or it would quote the # lines.
    wide.write.option("comment", "~").csv(path, sep="\t", header=True, compression="gzip")
    return delimited.read_predictions(t.spark, path, first_name="KO")


@query
def a4_read_taxonomy(t: Roles) -> DataFrame:
    path = new_table_path(t.spark, "a4")
    t.taxonomy().toDF("#OTU/ASV_ID", "taxonomy", "confidence").write.csv(path, sep="\t", header=True)
    return rounded(delimited.read_taxonomy(t.spark, path).toDF("otu", "taxonomy", "confidence"), "confidence")


@query
def a5_trait_map(t: Roles) -> DataFrame:
    return traits.trait_map(t.raw_map(), "Lv3")


@query
def a6_sorted_text(t: Roles) -> DataFrame:
    path = new_table_path(t.spark, "a6")
    sinks.write_text(t.strat(), path, ["FeatureID", "Sample"], gzip=True)
    back = delimited.read_table(t.spark, path)
    return back.select(F.col("Sample").cast("string"), "FeatureID", "Value")


@query
def a7_by_taxon(t: Roles) -> DataFrame:
    path = new_table_path(t.spark, "a7")
    table = t.strat().withColumn("taxon", F.substring_index("FeatureID", "|", 1))
    sinks.write_by_taxon(table, path, "taxon", ["Sample", "FeatureID"])
    return t.spark.read.parquet(path).groupBy("taxon").agg(
        F.count(F.lit(1)).alias("n"), F.sum("Value").alias("total")
    )


@query
def a8_filtered_csv(t: Roles) -> DataFrame:
    path = new_table_path(t.spark, "a8") + ".csv"
    sinks.write_text(filters.where_in(t.metadata(), "Region", ["ASIA", "EUROPE"]), path, sep=",")
    back = delimited.read_table(t.spark, path)
    return back.select(F.col("Sample").cast("string"), "Region", "acctbal")


@query
def a9_layouts(t: Roles) -> DataFrame:
    """The split wide CLR layout, unpivoted again for comparison."""
    levels = F.split("FeatureID", r"\|")
    table = t.strat().select(levels[0].alias("type"), levels[1].alias("brand"), "Sample", "Value")
    wide = sinks.layouts(table, split=True)["clr_wide_D_N_split"]
    ids = ["Feature_Level_1", "Feature_Level_2"]
    return rounded(reshape.to_long(wide, ids, name="Sample"), "Value")


# --- checks and metadata ----------------------------------------------------


def _region_wide(t: Roles) -> DataFrame:
    named = joins.join_metadata(t.strat(), t.metadata(), ["Region"]).withColumn(
        "Region", F.concat(F.lit("S_"), "Region")
    )
    wide = reshape.to_wide(named, "FeatureID", "Region", "Value")
    return wide.withColumn("depth", F.lit(1.0))


@query
def b2_sample_columns(t: Roles) -> DataFrame:
    wide = _region_wide(t)
    chosen = reshape.sample_columns(wide.columns, "FeatureID", exclude=["depth"])
    return reshape.to_long(wide, "FeatureID", chosen)


@query
def b4_looks_like_clr(t: Roles) -> DataFrame:
    raw = checks.looks_like_clr(t.strat(), "Value").withColumn("what", F.lit("counts"))
    logs = checks.looks_like_clr(t.vectors(), "Value").withColumn("what", F.lit("vectors"))
    return raw.unionByName(logs)


@query
def b5_numeric_check(t: Roles) -> DataFrame:
    columns = ["c_custkey", "c_name", "c_acctbal"]
    text = t.table("customer").select(*[F.col(c).cast("string") for c in columns])
    return checks.non_numeric_cells(text, columns)


@query
def b6_key_depth(t: Roles) -> DataFrame:
    return keys.key_depths(t.strat())


@query
def b7_missing_samples(t: Roles) -> DataFrame:
    rich = t.metadata().filter("acctbal > 0")
    return joins.ids_missing_from(t.strat(), rich, "Sample")


@query
def b8_overlap(t: Roles) -> DataFrame:
    return checks.overlap(t.strat(), t.metadata().filter("acctbal > 0"))


@query
def b9_attribute_kinds(t: Roles) -> DataFrame:
    return checks.attribute_kinds(t.metadata(), ["Region", "acctbal", "nation"])


@query
def b10_merge_metadata(t: Roles) -> DataFrame:
    metadata = t.metadata().withColumnRenamed("Sample", "#SampleID")
    return checks.merge_metadata(t.strat(), metadata, layout="long").table.select(
        "Sample", "FeatureID", "Value", "Region", "acctbal"
    )


# --- filters and keys -------------------------------------------------------


@query
def c1_quality_filter(t: Roles) -> DataFrame:
    return filters.within_nsti(t.marker(), 0.95)


@query
def c2_positive(t: Roles) -> DataFrame:
    return filters.positive(t.vectors().withColumn("Value", F.round("Value", 6)))


@query
def c3_lineage(t: Roles) -> DataFrame:
    return taxonomy.split_lineage(t.taxonomy()).select("ASV_ID", *taxonomy.LINEAGE_LEVELS)


@query
def c4_named_codes(t: Roles) -> DataFrame:
    named = taxonomy.name_codes(taxonomy.split_lineage(t.taxonomy()))
    return named.select("ASV_ID", *taxonomy.LINEAGE_LEVELS)


@query
def c6_unclassified(t: Roles) -> DataFrame:
    kept = taxonomy.unclassified(t.lineage(), "Genus", keep=True)
    dropped = taxonomy.unclassified(t.lineage(), "Genus")
    return kept.withColumn("policy", F.lit("keep")).unionByName(
        dropped.withColumn("policy", F.lit("drop"))
    )


@query
def c7_combined_key(t: Roles) -> DataFrame:
    table = t.table("lineitem").select(
        F.concat_ws("|", "l_returnflag", "l_linestatus").alias("state"),
        F.col("l_linenumber"), F.col("l_suppkey").alias("Sample"), F.col("l_quantity").alias("Value"),
    )
    return keys.combine_key(table).groupBy("FeatureID").agg(F.sum("Value").alias("Value"))


@query
def c8_clean_key(t: Roles) -> DataFrame:
    cleaned = t.strat().withColumn("FeatureID", keys.clean_key("FeatureID"))
    return cleaned.groupBy("FeatureID").agg(F.sum("Value").alias("Value"))


@query
def c9_split_key(t: Roles) -> DataFrame:
    return keys.split_key(t.strat())


@query
def c10_row_filters(t: Roles) -> DataFrame:
    table = joins.join_metadata(t.strat(), t.metadata(), ["Region"])
    chosen = filters.where_in(table, "Region", ["ASIA", "EUROPE"])
    return filters.where_between(chosen, "Value", 50, 120)


@query
def c11_entities(t: Roles) -> DataFrame:
    taxa = filters.entities(t.strat(), "taxon").withColumn("kind", F.lit("taxon"))
    return taxa.unionByName(filters.entities(t.strat(), "trait").withColumn("kind", F.lit("trait")))


@query
def c12_chosen_features(t: Roles) -> DataFrame:
    frequent = t.strat().groupBy("FeatureID").agg(F.sum("Value").alias("s")).filter("s > 10000")
    return filters.features_with_prefix(filters.features_in(t.strat(), frequent), "S")


# --- reshape ----------------------------------------------------------------


@query
def d1_unpivot(t: Roles) -> DataFrame:
    return reshape.to_long(
        t.table("lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_discount", "l_tax"),
        ["l_orderkey", "l_linenumber"], name="measure",
    )


@query
def d2_samples_by_features(t: Roles) -> DataFrame:
    table = t.table("events").select(
        F.col("user_id").cast("string").alias("Sample"), F.col("event_type").alias("FeatureID"),
        F.lit(1.0).alias("Value"),
    )
    return reshape.samples_by_features(table)


@query
def d3_features_by_samples(t: Roles) -> DataFrame:
    return _region_wide(t).drop("depth")


@query
def d4_transpose(t: Roles) -> DataFrame:
    table = t.table("events").groupBy("event_type").pivot("event_type").agg(F.sum("value"))
    flipped = reshape.transpose(table.na.fill(0.0), "event_type", "measure")
    return rounded(flipped, *[c for c in flipped.columns if c != "measure"])


@query
def d6_zero_completion(t: Roles) -> DataFrame:
    return reshape.complete_zeros(t.strat())


# --- joins ------------------------------------------------------------------


def _some_marker(t: Roles) -> DataFrame:
    return filters.within_nsti(t.marker(), 0.95)


@query
def e1_shared_ids(t: Roles) -> DataFrame:
    return joins.shared_ids(
        t.counts(), _some_marker(t), t.copies().filter("copy_num > 1"), key="ASV_ID"
    )


@query
def e2_marker_normalised(t: Roles) -> DataFrame:
    normal = profile.normalise_by_marker(t.counts(), t.marker())
    return normal.groupBy("ASV_ID").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col("Value") == float("inf")).alias("n_inf"),
        F.round(F.sum(F.when(F.col("Value") < 1e300, F.col("Value"))), 4).alias("finite"),
    )


@query
def e3_contributions(t: Roles) -> DataFrame:
    return profile.contributions(t.counts(), t.copies())


@query
def e4_attach_lineage(t: Roles) -> DataFrame:
    named = t.lineage().filter(F.col("Genus").isNotNull())
    return taxonomy.attach_lineage(t.counts(), named, "ASV_ID")


@query
def e5_trait_join(t: Roles) -> DataFrame:
    return profile.trait_copies(t.copies(), traits.trait_map(t.raw_map(), "Lv3"), "Lv3")


@query
def e6_taxon_map(t: Roles) -> DataFrame:
    mapped = t.copies().join(not_broadcast(t.lineage().distinct()), "ASV_ID")
    return mapped.groupBy("Genus", "KO").agg(F.sum("copy_num").alias("copies"))


@query
def e7_null_safe_join(t: Roles) -> DataFrame:
    """Taxon totals met with taxon copies, the missing taxon included."""
    totals = t.counts().join(t.lineage(), "ASV_ID").groupBy("Genus", "Sample").agg(
        F.sum("Value").alias("Value")
    )
    copies = profile.taxon_copies(t.copies(), t.lineage(), "Genus")
    return rounded(
        profile.stratify(totals, copies, traits.trait_map(t.raw_map(), "Lv3"), "Genus", "Lv3"), "Value"
    )


@query
def e8_with_metadata(t: Roles) -> DataFrame:
    return joins.join_metadata(t.strat(), t.metadata(), ["Region", "acctbal"])


@query
def e9_entity_scatter(t: Roles) -> DataFrame:
    return summary.entity_scatter(
        t.strat(), summary.of_taxon("ECONOMY"), summary.of_trait("Brand#1"), False,
        t.metadata(), "Region",
    )


@query
def e10_scores_with_group(t: Roles) -> DataFrame:
    alpha = diversity.alpha_diversity(t.strat())
    return rounded(summary.scores_with_group(alpha, t.metadata(), "Region"), "Value")


# --- aggregations -----------------------------------------------------------


@query
def f1_function_profile(t: Roles) -> DataFrame:
    return profile.function_profile(t.counts(), t.copies())


@query
def f2_trait_profile(t: Roles) -> DataFrame:
    """Trait first: the function-level table is never built."""
    return profile.trait_profile_direct(
        t.counts(), t.copies(), traits.trait_map(t.raw_map(), "Lv3"), "Lv3"
    )


@query
def f2_trait_profile_by_function(t: Roles) -> DataFrame:
    table = profile.function_profile(t.counts(), t.copies())
    return profile.trait_profile(table, traits.trait_map(t.raw_map(), "Lv3"), "Lv3")


@query
def f3_taxon_abundance(t: Roles) -> DataFrame:
    return profile.taxon_abundance(t.counts(), t.lineage(), "Genus", keep_unclassified=True)


@query
def f4_taxon_copies(t: Roles) -> DataFrame:
    return rounded(profile.taxon_copies(t.copies(), t.lineage(), "Genus"), "copy_num")


@query
def f5_stratified_profile(t: Roles) -> DataFrame:
    table = profile.stratified_profile(
        t.counts(), t.copies(), t.lineage(), traits.trait_map(t.raw_map(), "Lv3"), "Genus", "Lv3"
    )
    return rounded(table, "Value")


@query
def f6_group_summary(t: Roles) -> DataFrame:
    table = summary.group_summary(t.table("lineitem"), ["l_returnflag", "l_linestatus"], "l_extendedprice")
    table = table.withColumnRenamed("CV%", "CV")
    return rounded(table, "Mean", "Std", "Min", "Median", "Max", "CV")


@query
def f7_mini_summary(t: Roles) -> DataFrame:
    table = joins.join_metadata(t.strat(), t.metadata(), ["Region"])
    chosen = summary.mini_summary(table, "Region", ["ECONOMY|Brand#1", "SMALL|Brand#2"])
    return rounded(chosen, "Mean", "Std")


@query
def f8_entity_from_keys(t: Roles) -> DataFrame:
    taxon = summary.aggregate_entity(t.strat(), summary.of_taxon("ECONOMY"), False, "counted")
    logs = composition.dense(composition.of_features(composition.clr(t.strat()), summary.of_trait("Brand#1")))
    trait = summary.aggregate_entity(logs, summary.of_trait("Brand#1"), True, "averaged")
    return rounded(taxon.join(trait, "Sample"), "counted", "averaged")


@query
def f9_entity_from_long(t: Roles) -> DataFrame:
    table = profile.stratified_profile(
        t.counts(), t.copies(), t.lineage(), traits.trait_map(t.raw_map(), "Lv3"), "Genus", "Lv3"
    )
    return rounded(summary.aggregate_entity(table, F.col("Lv3") == "T1", False), "Value")


@query
def f10_variance(t: Roles) -> DataFrame:
    """From the stored cells alone."""
    return rounded(composition.feature_variances(composition.clr(t.strat())), "variance")


@query
def f11_box_summary(t: Roles) -> DataFrame:
    table = summary.box_summary(t.table("orders"), "o_orderpriority", "o_totalprice")
    return rounded(table, "low", "q1", "median", "q3", "high", digits=4)


def _region_tests(t: Roles) -> DataFrame:
    return hypothesis.benjamini_hochberg(hypothesis.kruskal_wallis(_grouped(t, "Region"), "Region"))


@query
def f12_significance_tally(t: Roles) -> DataFrame:
    return rounded(summary.significance_tally(_region_tests(t)), "pct_p", "pct_q")


# --- rankings ---------------------------------------------------------------


@query
def g1_diverse_top(t: Roles) -> DataFrame:
    scored = rounded(composition.feature_variances(composition.clr(t.strat())), "variance")
    return summary.diverse_top(scored, 25)


@query
def g2_sorted(t: Roles) -> DataFrame:
    return summary.sorted_nulls_last(t.lineage(), ["Genus", "ASV_ID"])


@query
def g3_top_scores(t: Roles) -> DataFrame:
    scores = t.vectors().groupBy(F.col("FeatureID").alias("Feature")).agg(
        F.round(F.avg("Value"), 6).alias("Importance")
    )
    return summary.top_scores(scores, "Importance", 20)


@query
def g4_top_loadings(t: Roles) -> DataFrame:
    wide = t.vectors().groupBy(F.col("FeatureID").alias("Feature")).agg(
        F.round(F.avg("Value"), 6).alias("PC1"), F.round(F.max("Value"), 6).alias("PC2")
    )
    return rounded(summary.top_loadings(wide), "magnitude")


@query
def g5_candidates(t: Roles) -> DataFrame:
    tests = stored(_region_tests(t))
    report = summary.report_candidates(tests).select("Feature", F.lit("report").alias("pool"))
    model = summary.model_candidates(tests).select("Feature", F.lit("model").alias("pool"))
    return report.unionByName(model)


@query
def g6_volcano(t: Roles) -> DataFrame:
    return rounded(
        summary.volcano(_region_tests(t), "q_value"), "test_statistic", "q_value", "log_p", digits=5
    )


@query
def g7_midranks(t: Roles) -> DataFrame:
    """Tie-averaged ranks of heavily tied quantities."""
    table = t.table("lineitem").select("l_returnflag", "l_quantity")
    return ordered.midranks(table, ["l_returnflag"], "l_quantity")


@query
def g8_preview(t: Roles) -> DataFrame:
    return summary.preview(t.strat(), ["FeatureID", "Sample"], 10)


@query
def g9_heatmap(t: Roles) -> DataFrame:
    sparse = composition.clr(t.strat())
    scored = rounded(composition.feature_variances(sparse), "variance")
    chosen = summary.diverse_top(scored, 20)
    return rounded(summary.heatmap(sparse, chosen, t.metadata(), "Region"), "Value")


# --- set operations ---------------------------------------------------------


@query
def h1_distinct(t: Roles) -> DataFrame:
    return t.table("lineitem").select("l_partkey", "l_suppkey").distinct()


@query
def h2_intersect(t: Roles) -> DataFrame:
    return joins.shared_ids(t.counts(), _some_marker(t), key="ASV_ID")


@query
def h3_except(t: Roles) -> DataFrame:
    return joins.ids_missing_from(t.counts(), _some_marker(t), "ASV_ID")


# --- composition and diversity ----------------------------------------------


@query
def i1_zero_replacement(t: Roles) -> DataFrame:
    return rounded(composition.replace_zeros(t.strat()), "proportion", digits=9)


@query
def i2_clr(t: Roles) -> DataFrame:
    return rounded(composition.dense(composition.clr(t.strat())), "Value")


@query
def i2_clr_sparse(t: Roles) -> DataFrame:
    """Present cells and the per-sample baseline, without the absent cells."""
    sparse = composition.clr(t.strat())
    cells = sparse.cells.select("Sample", "FeatureID", F.col("clr").alias("Value"))
    rest = sparse.baseline.select("Sample", F.lit(None).cast("string").alias("FeatureID"),
                                  F.col("baseline").alias("Value"))
    return rounded(cells.unionByName(rest), "Value")


@query
def i3_clr_sums(t: Roles) -> DataFrame:
    return rounded(composition.clr_sums(composition.clr(t.strat())), "clr_sum")


def _alpha(metric: str):
    def build(t: Roles) -> DataFrame:
        return rounded(diversity.alpha_diversity(t.strat(), [metric]), "Value")

    return build


for _id, _metric in zip(("j1", "j2", "j3", "j4"), ("observed_features", "shannon", "simpson", "pielou_e")):
    _build = _alpha(_metric)
    _build.__name__ = f"{_id}_{_metric}"
    query(_build)


@query
def j5_alpha_long(t: Roles) -> DataFrame:
    return rounded(diversity.alpha_diversity(t.strat()), "Value")


@query
def k1_braycurtis(t: Roles) -> DataFrame:
    return rounded(diversity.beta_diversity(t.strat(), "braycurtis"), "distance")


@query
def k2_jaccard(t: Roles) -> DataFrame:
    return rounded(diversity.beta_diversity(t.strat(), "jaccard"), "distance")


@query
def k3_aitchison(t: Roles) -> DataFrame:
    return rounded(diversity.beta_diversity(composition.clr(t.strat()), "aitchison"), "distance")


def _distances(t: Roles):
    sparse = composition.clr(t.strat())
    return sparse, diversity.beta_diversity(sparse, "aitchison")


@query
def k5_permanova(t: Roles) -> DataFrame:
    result = permanova.permanova(composition.clr(t.strat()), t.metadata(), "Region")
    return rounded(result, "test_statistic", "p_value").select(
        "method", "test_statistic", "p_value", "n_samples", "n_groups"
    )


# --- tests and correlation --------------------------------------------------


def _grouped(t: Roles, group: str) -> composition.SparseClr:
    return hypothesis.grouped_values(composition.clr(t.strat()), t.metadata(), group)


@query
def l1_test_table(t: Roles) -> DataFrame:
    logs = composition.dense(composition.clr(t.strat()))
    return rounded(hypothesis.grouped_values(logs, t.metadata(), "Region"), "Value")


@query
def l2_kruskal_wallis(t: Roles) -> DataFrame:
    return rounded(
        hypothesis.kruskal_wallis(_grouped(t, "Region"), "Region"), "test_statistic", "p_value"
    )


@query
def l2_kruskal_wallis_ties(t: Roles) -> DataFrame:
    """Raw counts, whose zeros are one large tie."""
    grouped = hypothesis.grouped_values(composition.sparse_counts(t.strat()), t.metadata(), "Region")
    return rounded(hypothesis.kruskal_wallis(grouped, "Region"), "test_statistic", "p_value")


@query
def l3_mann_whitney(t: Roles) -> DataFrame:
    tests = hypothesis.mann_whitney(_grouped(t, "Balance"), "Balance", "high", "low")
    return rounded(tests.drop("cliffs_delta"), "test_statistic", "p_value")


@query
def l4_cliffs_delta(t: Roles) -> DataFrame:
    return rounded(
        hypothesis.cliffs_delta(_grouped(t, "Balance"), "Balance", "high", "low"), "cliffs_delta"
    )


@query
def l5_false_discovery(t: Roles) -> DataFrame:
    return rounded(_region_tests(t), "test_statistic", "p_value", "q_value")


@query
def l6_chosen_test(t: Roles) -> DataFrame:
    return rounded(
        hypothesis.group_tests(composition.clr(t.strat()), t.metadata(), "Balance"), "test_statistic", "p_value", "q_value"
    )


@query
def l7_spearman(t: Roles) -> DataFrame:
    table = hypothesis.spearman(composition.clr(t.strat()), t.metadata(), "acctbal")
    return rounded(table, "correlation", "p_value", "q_value", "abs_correlation")


@query
def l8_pearson(t: Roles) -> DataFrame:
    """From the stored cells of the sparse CLR."""
    table = hypothesis.pearson(composition.clr(t.strat()), t.metadata(), "acctbal")
    return rounded(table, "correlation", "p_value", "q_value", "abs_correlation")


@query
def l8_pearson_dense(t: Roles) -> DataFrame:
    """A dense table with negative values, against the first vector position."""
    first = t.vectors().filter("FeatureID = 'e00'").select("Sample", F.col("Value").alias("e00"))
    table = hypothesis.pearson(t.vectors(), first, "e00").filter("Feature <> 'e00'")
    return rounded(table.select("Feature", "n", "correlation", "p_value"), "correlation", "p_value")


@query
def l9_flags(t: Roles) -> DataFrame:
    flagged = hypothesis.with_flags(_region_tests(t))
    return flagged.select("Feature", "p_sig", "q_sig")


# --- ordination and selection -----------------------------------------------


@query
def m1_pca_scores(t: Roles) -> DataFrame:
    return rounded(ordination.pca(composition.clr(t.strat())).scores, "PC1", "PC2")


@query
def m1_pca_loadings(t: Roles) -> DataFrame:
    return rounded(ordination.pca(t.vectors()).loadings, "PC1", "PC2")


@query
def m2_pcoa(t: Roles) -> DataFrame:
    sparse, distances = _distances(t)
    return rounded(ordination.pcoa(distances, 2, sparse.baseline), "PC1", "PC2")


@query
def m3_model_table(t: Roles) -> DataFrame:
    from pyspark.ml.functions import vector_to_array

    table = selection.model_table(composition.clr(t.strat()), t.metadata(), "Region", "classification")
    x = vector_to_array("features")
    return table.rows.select(
        "Sample", "label", F.size(x).alias("width"),
        F.round(F.aggregate(x, F.lit(0.0), lambda a, b: a + b * b), 6).alias("square"),
    )


@query
def m4_forest_importance(t: Roles) -> DataFrame:
    return selection.forest_importance(
        composition.clr(t.strat()), t.metadata(), "Balance", "classification", trees=40
    )


@query
def m5_lasso(t: Roles) -> DataFrame:
    return selection.lasso_selection(t.vectors(), t.vector_targets(), "target", steps=8)


@query
def m6_shadow_selection(t: Roles) -> DataFrame:
    return selection.shadow_selection(t.vectors(), t.vector_targets(), "label")


# --- end to end -------------------------------------------------------------


@query
def n1_functions(t: Roles) -> DataFrame:
    """Zero markers are dropped here, so that every total is finite."""
    _, table = composed.predicted_functions(
        t.counts(), t.marker(), t.copies(), 0.95, on_zero_marker="drop"
    )
    return rounded(table, "Value", digits=4)


@query
def n2_lineage_table(t: Roles) -> DataFrame:
    return composed.lineage_table(t.counts(), t.taxonomy())


@query
def n3_trait_table(t: Roles) -> DataFrame:
    """The wide trait table, unpivoted again for comparison."""
    wide = composed.trait_table(profile.function_profile(t.counts(), t.copies()), t.raw_map(), "Lv3")
    return reshape.to_long(wide, "Lv3")


@query
def n4_stratified_table(t: Roles) -> DataFrame:
    table = composed.stratified_table(
        t.counts(), t.copies(), t.lineage(), t.raw_map(), "Genus", "Lv3", keep_unclassified=True
    )
    return rounded(table, "Value")


@query
def n5_group_analysis(t: Roles) -> DataFrame:
    """All results of the group analysis as (part, key, value) rows."""
    done = composed.group_analysis(t.strat(), t.metadata(), "Region")
    alpha = done.alpha.select(F.col("Metric").alias("part"), F.col("Sample").alias("key"), "Value")
    tests = done.tests.select(F.lit("q").alias("part"), F.col("Feature").alias("key"),
                              F.col("q_value").alias("Value"))
    anova = done.permanova.select(F.lit("permanova").alias("part"), F.lit("F").alias("key"),
                                  F.col("test_statistic").alias("Value"))
    return rounded(alpha.unionByName(tests).unionByName(anova), "Value")
