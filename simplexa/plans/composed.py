"""End-to-end jobs put together from the operators."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from simplexa.names import FEATURE, LINEAGE_LEVELS, SAMPLE, VALUE
from simplexa.operators import composition, diversity, hypothesis, ordination, selection, summary
from simplexa.operators.checks import require_overlap, require_samples
from simplexa.operators.filters import features_with_prefix, within_nsti
from simplexa.operators.joins import reduce_to_shared
from simplexa.operators.permanova import permanova
from simplexa.operators.profile import (
    FUNCTION,
    ITEM,
    function_profile,
    normalise_by_marker,
    stratified_profile,
    trait_profile,
)
from simplexa.operators.reshape import WideBlocks, wide_or_blocks
from simplexa.operators.taxonomy import attach_lineage, name_codes, split_lineage
from simplexa.sources.shared import stored
from simplexa.sources.traits import trait_map


def predicted_functions(
    counts: DataFrame, marker: DataFrame, copies: DataFrame, max_nsti: float = 1.7,
    prefix: str | None = None, on_zero_marker: str = "keep",
) -> tuple[DataFrame, DataFrame]:
    """Normalised counts and the function profile, both long.

    Marker and copy tables are filtered on NSTI where they carry it, all three
    are cut down to shared items, then counts are divided by marker copies and
    multiplied out by function.  The normalised table, which is a result and an
    input, is stored.
    """
    marker = within_nsti(marker, max_nsti)
    copies = within_nsti(copies, max_nsti)
    if prefix:
        copies = features_with_prefix(copies, prefix, FUNCTION)
    counts, marker, copies = reduce_to_shared(counts, marker, copies, key=ITEM)
    normal = stored(
        normalise_by_marker(counts, marker, on_zero_marker=on_zero_marker), "normalised"
    )
    return normal, function_profile(normal, copies)


def lineage_table(normal: DataFrame, taxonomy: DataFrame, item: str = ITEM) -> DataFrame:
    """Item, sample and value with the seven lineage levels in front, sorted."""
    levels = name_codes(split_lineage(taxonomy)).select(item, *LINEAGE_LEVELS)
    merged = attach_lineage(normal, levels, item)
    rest = [c for c in normal.columns if c != item]
    return summary.sorted_nulls_last(
        merged.select(item, *LINEAGE_LEVELS, *rest), [*LINEAGE_LEVELS, item, *rest[:1]]
    )


def trait_table(function_table: DataFrame, raw_map: DataFrame, level: str) -> DataFrame | WideBlocks:
    """Traits by samples, wide, sorted by trait; in blocks of columns where there are too many samples.

    The trait totals are stored, as the samples are counted before they are columns.
    """
    long = stored(trait_profile(function_table, trait_map(raw_map, level), level), "traits")
    wide = wide_or_blocks(long, level, SAMPLE, VALUE)
    if isinstance(wide, WideBlocks):
        return WideBlocks(wide.rows.orderBy(level, "_block"), wide.columns)
    return wide.orderBy(level)


def stratified_table(
    counts: DataFrame, copies: DataFrame, lineage: DataFrame, raw_map: DataFrame,
    taxon_level: str, trait_level: str, keep_unclassified: bool = False,
) -> DataFrame:
    """Taxon x trait x sample, long and sorted; raises if nothing matches."""
    table = stratified_profile(
        counts, copies, lineage, trait_map(raw_map, trait_level), taxon_level, trait_level,
        keep_unclassified=keep_unclassified,
    )
    if table.isEmpty():
        raise ValueError("no functions matched between the copy table and the trait map")
    return summary.sorted_nulls_last(table, [taxon_level, trait_level, SAMPLE])


@dataclass
class Profiles:
    normalised: DataFrame
    functions: DataFrame
    lineage: DataFrame
    traits: DataFrame
    """Trait, Sample, Value, long."""
    stratified: DataFrame | None
    failure: str | None
    """Why there is no stratified table although one was asked for."""


def profiles(
    counts: DataFrame, marker: DataFrame, copies: DataFrame, taxonomy: DataFrame, raw_map: DataFrame,
    trait_level: str, taxon_level: str | None = None, max_nsti: float = 1.7, prefix: str | None = None,
    on_zero_marker: str = "keep", keep_unclassified: bool = False,
) -> Profiles:
    """From counts, predictions and taxonomy to all profiles.

    With a ``taxon_level`` the stratified table is made as well; if nothing in it
    matches, the others are returned all the same, with the reason.
    """
    normal, functions = predicted_functions(counts, marker, copies, max_nsti, prefix, on_zero_marker)
    functions = stored(functions, "functions")
    levels = stored(name_codes(split_lineage(taxonomy)).select(ITEM, *LINEAGE_LEVELS), "levels")
    stratified = failure = None
    if taxon_level is not None:
        try:
            stratified = stratified_table(
                normal, within_nsti(copies, max_nsti), levels, raw_map, taxon_level, trait_level, keep_unclassified)
        except ValueError as error:
            failure = str(error)
    return Profiles(
        normal, functions, lineage_table(normal, taxonomy),
        trait_profile(functions, trait_map(raw_map, trait_level), trait_level), stratified, failure)


@dataclass
class Models:
    importance: DataFrame
    """Feature, Importance of the forest on the pruned features."""
    chosen: DataFrame
    """Lasso coefficients, or the decisions of the shadow test, on all features."""
    heatmap: DataFrame


def models(
    sparse: composition.SparseClr, metadata: DataFrame, target: str, kind: str, group: str | None = None,
    pruned: DataFrame | None = None, top: int = summary.TOP_IMPORTANCE, forest: dict | None = None,
    choice: dict | None = None,
) -> Models:
    """The model branch: a forest on the ``pruned`` features (Feature; all without it), the Lasso of a number or the
    shadow test of a class on all, and the cells of the forest's features by variance, few per taxon.

    ``forest`` and ``choice`` are further settings of the two models.
    """
    keep = None if pruned is None else pruned.select(F.col("Feature").alias(FEATURE))
    importance = stored(
        selection.forest_importance(sparse, metadata, target, kind, keep=keep, **(forest or {})), "importance")
    select = selection.lasso_selection if kind == "regression" else selection.shadow_selection
    seen = importance.select(F.col("Feature").alias(FEATURE))
    scored = composition.feature_variances(sparse).join(seen, FEATURE, "left_semi")
    return Models(
        importance, select(sparse, metadata, target, **(choice or {})),
        summary.heatmap(sparse, summary.diverse_top(scored, top), metadata, group))


@dataclass
class GroupAnalysis:
    clr: composition.SparseClr
    alpha: DataFrame
    distances: DataFrame
    pca: ordination.PcaResult
    permanova: DataFrame
    tests: DataFrame | None
    candidates: DataFrame | None
    model_features: DataFrame | None
    heatmap: DataFrame
    models: Models | None = None


def group_analysis(
    long: DataFrame, metadata: DataFrame, group: str, permutations: int = 999,
    top: int = summary.HEATMAP_FEATURES, target: str | None = None, kind: str = "classification",
    forest: dict | None = None, choice: dict | None = None,
) -> GroupAnalysis:
    """CLR, diversity, distances, ordination, group tests and feature pools.

    With a ``target`` that the metadata have, the models are fitted as well.

    CLR cells and test results are each written once to the shared folder,
    because several of the later plans read them.  Distances are a plan that
    nothing else here reads.
    """
    require_overlap(long, metadata, [group])
    sparse = composition.clr(long)
    sparse = composition.SparseClr(
        stored(sparse.cells, "clr-cells"),
        stored(sparse.baseline, "clr-baseline"),
        stored(sparse.features, "features"),
    )
    require_samples(sparse.baseline, metadata)
    distances = diversity.beta_diversity(sparse, "aitchison")
    tests = hypothesis.group_tests(sparse, metadata, group)
    candidates = model_features = None
    pool = sparse.features
    if tests is not None:
        tests = stored(tests, "tests")
        candidates = summary.report_candidates(tests)
        model_features = summary.model_candidates(tests)
        pool = candidates.select(F.col("Feature").alias(FEATURE))
    scored = composition.feature_variances(sparse).join(pool, FEATURE, "left_semi")
    chosen = summary.diverse_top(scored, top)
    fitted = None
    if target is not None and target in metadata.columns:
        fitted = models(sparse, metadata, target, kind, group, model_features, forest=forest, choice=choice)
    return GroupAnalysis(
        models=fitted,
        clr=sparse,
        alpha=diversity.alpha_diversity(long),
        distances=distances,
        pca=ordination.pca(sparse),
        permanova=permanova(sparse, metadata, group, permutations, check=False),
        tests=tests,
        candidates=candidates,
        model_features=model_features,
        heatmap=summary.heatmap(sparse, chosen, metadata, group),
    )
