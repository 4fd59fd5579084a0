"""SQL twins of the queries, for an independent engine."""

from __future__ import annotations

from registry.roles import CTE

ORACLE: dict[str, str] = {}


def twin(name: str, roles: str, body: str, steps: str = "") -> None:
    """``roles`` names role tables, ``steps`` adds further table expressions."""
    parts = [CTE[r] for r in roles.split()] + ([steps] if steps else [])
    ORACLE[name] = (f"WITH {', '.join(parts)} " if parts else "") + body


# --- sources and sinks ------------------------------------------------------

twin("a1_read_table", "", """
SELECT s_suppkey, CASE WHEN s_nationkey > 4 THEN s_name END AS s_name,
  CASE WHEN s_acctbal > 0 THEN s_acctbal END AS s_acctbal FROM supplier""")
twin("a2_exported_counts", "", """
SELECT 'P' || p_partkey AS otu, CAST(p_size AS DOUBLE) AS size, p_retailprice AS price FROM part""")
twin("a3_read_predictions", "", """
SELECT 'P' || p_partkey AS "KO", p_size / 2.0::DOUBLE AS half FROM part WHERE p_partkey % 50 <> 7""")
twin("a4_read_taxonomy", "taxonomy", """
SELECT "ASV_ID" AS otu, taxonomy, round(confidence, 6) AS confidence FROM taxonomy""")
twin("a5_trait_map", "trait_map", "SELECT * FROM trait_map")
twin("a6_sorted_text", "strat", 'SELECT * FROM strat')
twin("a7_by_taxon", "strat", """
SELECT split_part("FeatureID", '|', 1) AS taxon, count(*) AS n, sum("Value") AS total
FROM strat GROUP BY 1""")
twin("a8_filtered_csv", "metadata", """
SELECT "Sample", "Region", acctbal FROM metadata WHERE "Region" IN ('ASIA', 'EUROPE')""")
twin("a9_layouts", "strat clr", """
SELECT split_part("FeatureID", '|', 1) AS "Feature_Level_1",
  split_part("FeatureID", '|', 2) AS "Feature_Level_2", "Sample",
  round("Value", 6) + 0.0 AS "Value" FROM clr""")

# --- checks and metadata ----------------------------------------------------

_REGION_LONG = """region_long AS (SELECT "FeatureID", 'S_' || r AS "Sample",
  coalesce(sum("Value") FILTER (WHERE "Region" = r), 0) AS "Value"
  FROM strat JOIN metadata USING ("Sample"), (SELECT r_name AS r FROM region)
  GROUP BY "FeatureID", r)"""
twin("b2_sample_columns", "strat metadata", "SELECT * FROM region_long", _REGION_LONG)
twin("b4_looks_like_clr", "strat vectors", """
SELECT 'counts' AS what, min("Value") < 0 OR (max("Value") < 100 AND min("Value") >= -100) AS is_clr
FROM strat UNION ALL
SELECT 'vectors', min("Value") < 0 OR (max("Value") < 100 AND min("Value") >= -100) FROM vectors""")
twin("b5_numeric_check", "", """
SELECT 'c_custkey' AS "column", count(c_custkey) AS present, CAST(0 AS BIGINT) AS not_numeric FROM customer
UNION ALL SELECT 'c_name', count(c_name), count(*) FILTER (WHERE TRY_CAST(c_name AS DOUBLE) IS NULL) FROM customer
UNION ALL SELECT 'c_acctbal', count(c_acctbal), 0 FROM customer""")
twin("b6_key_depth", "strat", """
SELECT min(len(string_split("FeatureID", '|')))::INTEGER AS min_depth,
  max(len(string_split("FeatureID", '|')))::INTEGER AS max_depth FROM strat""")
twin("b7_missing_samples", "strat metadata", """
SELECT DISTINCT "Sample" FROM strat
WHERE "Sample" NOT IN (SELECT "Sample" FROM metadata WHERE acctbal > 0)""")
twin("b8_overlap", "strat metadata", """
SELECT count(DISTINCT "Sample") AS n_samples, count(DISTINCT CASE WHEN "Sample" IN
  (SELECT "Sample" FROM metadata WHERE acctbal > 0) THEN "Sample" END) AS n_matched FROM strat""")
twin("b9_attribute_kinds", "metadata", """
SELECT 'Region' AS "column", count(DISTINCT "Region") AS n_values, false AS is_continuous FROM metadata
UNION ALL SELECT 'acctbal', count(DISTINCT acctbal), count(DISTINCT acctbal) > 10 FROM metadata
UNION ALL SELECT 'nation', count(DISTINCT nation), count(DISTINCT nation) > 10 FROM metadata""")
twin("b10_merge_metadata", "strat metadata", """
SELECT "Sample", "FeatureID", "Value", "Region", acctbal FROM strat JOIN metadata USING ("Sample")""")

# --- filters and keys -------------------------------------------------------

twin("c1_quality_filter", "marker", """
SELECT "ASV_ID", marker_copies FROM marker WHERE "metadata_NSTI" <= 0.95""")
twin("c2_positive", "vectors", """
SELECT "Sample", "FeatureID", round("Value", 6) AS "Value" FROM vectors WHERE round("Value", 6) > 0""")
_LEVELS = """levels AS (SELECT "ASV_ID",
  split_part(split_part(taxonomy, '; ', 1), '__', 2) AS "Kingdom",
  split_part(split_part(taxonomy, '; ', 2), '__', 2) AS "Phylum",
  split_part(split_part(taxonomy, '; ', 3), '__', 2) AS "Class",
  CAST(NULL AS VARCHAR) AS "Order", CAST(NULL AS VARCHAR) AS "Family",
  split_part(split_part(taxonomy, '; ', 6), '__', 2) AS "Genus",
  CAST(NULL AS VARCHAR) AS "Species" FROM taxonomy)"""
_NAMED = _LEVELS + """, named AS (SELECT * REPLACE ("Class" || '-' || "Genus" AS "Genus") FROM levels)"""
twin("c3_lineage", "taxonomy", "SELECT * FROM levels", _LEVELS)
twin("c4_named_codes", "taxonomy", "SELECT * FROM named", _NAMED)
twin("c6_unclassified", "lineage", """
SELECT "ASV_ID", coalesce("Genus", 'Unclassified_Genus') AS "Genus", 'keep' AS policy FROM lineage
UNION ALL SELECT "ASV_ID", "Genus", 'drop' FROM lineage WHERE "Genus" IS NOT NULL""")
twin("c7_combined_key", "", """
SELECT l_returnflag || '_' || l_linestatus || '|' || l_linenumber AS "FeatureID",
  sum(l_quantity) AS "Value" FROM lineitem GROUP BY 1""")
twin("c8_clean_key", "strat", """
SELECT replace("FeatureID", '|', '_') AS "FeatureID", sum("Value") AS "Value" FROM strat GROUP BY 1""")
twin("c9_split_key", "strat", """
SELECT split_part("FeatureID", '|', 1) AS "Feature_Level_1",
  split_part("FeatureID", '|', 2) AS "Feature_Level_2", "Sample", "Value" FROM strat""")
twin("c10_row_filters", "strat metadata", """
SELECT "Sample", "FeatureID", "Value", "Region" FROM strat JOIN metadata USING ("Sample")
WHERE "Region" IN ('ASIA', 'EUROPE') AND "Value" BETWEEN 50 AND 120""")
twin("c11_entities", "strat", """
SELECT DISTINCT split_part("FeatureID", '|', 1) AS entity, 'taxon' AS kind FROM strat
UNION ALL SELECT DISTINCT split_part("FeatureID", '|', 2), 'trait' FROM strat""")
twin("c12_chosen_features", "strat", """
SELECT "Sample", "FeatureID", "Value" FROM strat WHERE "FeatureID" LIKE 'S%' AND "FeatureID" IN
  (SELECT "FeatureID" FROM strat GROUP BY 1 HAVING sum("Value") > 10000)""")

# --- reshape ----------------------------------------------------------------

twin("d1_unpivot", "", """
SELECT l_orderkey, l_linenumber, 'l_quantity' AS measure, l_quantity AS "Value" FROM lineitem
UNION ALL SELECT l_orderkey, l_linenumber, 'l_discount', l_discount FROM lineitem
UNION ALL SELECT l_orderkey, l_linenumber, 'l_tax', l_tax FROM lineitem""")
twin("d2_samples_by_features", "", """
SELECT CAST(user_id AS VARCHAR) AS "Sample", """ + ", ".join(
    f"coalesce(sum(1.0::DOUBLE) FILTER (WHERE event_type = '{e}'), 0) AS \"{e}\""
    for e in ("click", "error", "purchase", "signup", "view")
) + " FROM events GROUP BY 1")
twin("d3_features_by_samples", "strat metadata", 'SELECT "FeatureID", ' + ", ".join(
    f"coalesce(sum(\"Value\") FILTER (WHERE \"Region\" = '{r}'), 0) AS \"S_{r}\""
    for r in ("AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST")
) + ' FROM strat JOIN metadata USING ("Sample") GROUP BY 1')
twin("d4_transpose", "", "SELECT measure, " + ", ".join(
    f"round(coalesce(sum(value) FILTER (WHERE event_type = '{e}' AND measure = '{e}'), 0), 6) AS \"{e}\""
    for e in ("click", "error", "purchase", "signup", "view")
) + " FROM events, (SELECT DISTINCT event_type AS measure FROM events) GROUP BY 1")
twin("d6_zero_completion", "strat", """
SELECT "Sample", "FeatureID", coalesce("Value", 0) AS "Value"
FROM (SELECT DISTINCT "Sample" FROM strat) CROSS JOIN (SELECT DISTINCT "FeatureID" FROM strat)
LEFT JOIN strat USING ("Sample", "FeatureID")""")

# --- joins ------------------------------------------------------------------

twin("e1_shared_ids", "counts marker copies", """
SELECT DISTINCT "ASV_ID" FROM counts
WHERE "ASV_ID" IN (SELECT "ASV_ID" FROM marker WHERE "metadata_NSTI" <= 0.95)
  AND "ASV_ID" IN (SELECT "ASV_ID" FROM copies WHERE copy_num > 1)""")
# Halves are rounded to even, as by rint.
_RINT = """CASE WHEN abs(y * 100 - trunc(y * 100)) = 0.5
  THEN 2 * round(y * 50) ELSE round(y * 100) END / 100"""
twin("e2_marker_normalised", "counts marker", f"""
SELECT "ASV_ID", count(*) AS n, count(*) FILTER (WHERE m = 0) AS n_inf,
  round(sum(CASE WHEN m <> 0 THEN {_RINT} END), 4) AS finite
FROM (SELECT "ASV_ID", marker_copies AS m,
    CASE WHEN marker_copies <> 0 THEN "Value" / marker_copies END AS y
  FROM counts JOIN marker USING ("ASV_ID")) GROUP BY 1""")
twin("e3_contributions", "counts copies", """
SELECT "ASV_ID", "Sample", "KO", "Value" * copy_num AS contribution
FROM counts JOIN copies USING ("ASV_ID") WHERE "Value" > 0 AND copy_num > 0""")
twin("e4_attach_lineage", "counts lineage", """
SELECT "ASV_ID", "Sample", "Value", "Genus" FROM counts LEFT JOIN lineage USING ("ASV_ID")""")
twin("e5_trait_join", "copies trait_map", """
SELECT "ASV_ID", "Lv3", sum(copy_num) AS copy_num FROM copies JOIN trait_map USING ("KO")
WHERE copy_num > 0 GROUP BY 1, 2""")
twin("e6_taxon_map", "copies lineage", """
SELECT "Genus", "KO", sum(copy_num) AS copies FROM copies
JOIN (SELECT DISTINCT * FROM lineage) USING ("ASV_ID") GROUP BY 1, 2""")
_TAXON = """taxon_copies AS (SELECT "Genus", "KO", avg(copy_num) AS copy_num
    FROM copies JOIN lineage USING ("ASV_ID") WHERE copy_num > 0 GROUP BY 1, 2),
  taxon_counts AS (SELECT "Genus", "Sample", sum("Value") AS "Value"
    FROM counts JOIN lineage USING ("ASV_ID") WHERE "Value" > 0 GROUP BY 1, 2)"""
_STRATIFIED = """SELECT a."Genus" AS "Genus", "Lv3", "Sample",
  round(sum("Value" * copy_num), 6) AS "Value" FROM taxon_counts a
  JOIN taxon_copies b ON a."Genus" IS NOT DISTINCT FROM b."Genus"
  JOIN trait_map USING ("KO") {where} GROUP BY 1, 2, 3"""
twin("e7_null_safe_join", "counts copies lineage trait_map", _STRATIFIED.format(where=""), _TAXON)
twin("e8_with_metadata", "strat metadata", """
SELECT "Sample", "FeatureID", "Value", "Region", acctbal FROM strat JOIN metadata USING ("Sample")""")
twin("e9_entity_scatter", "strat metadata", """
SELECT "Sample", "Value_X", "Value_Y", "Region" FROM
  (SELECT "Sample", sum("Value") AS "Value_X" FROM strat WHERE "FeatureID" LIKE 'ECONOMY|%' GROUP BY 1)
  JOIN (SELECT "Sample", sum("Value") AS "Value_Y" FROM strat WHERE "FeatureID" LIKE '%|Brand#1' GROUP BY 1)
  USING ("Sample") LEFT JOIN metadata USING ("Sample")""")

# --- diversity --------------------------------------------------------------

_ALPHA = """sums AS (SELECT "Sample", sum("Value") AS s, sum("Value" * "Value") AS q,
    sum("Value" * log2("Value")) AS l, count(*)::DOUBLE AS r FROM strat GROUP BY 1),
  alpha AS (
    SELECT "Sample", 'observed_features' AS "Metric", r AS "Value" FROM sums UNION ALL
    SELECT "Sample", 'shannon', log2(s) - l / s FROM sums UNION ALL
    SELECT "Sample", 'simpson', 1 - q / (s * s) FROM sums UNION ALL
    SELECT "Sample", 'pielou_e', CASE WHEN r >= 2 THEN (log2(s) - l / s) / log2(r) END FROM sums)"""
for _id, _metric in (("j1", "observed_features"), ("j2", "shannon"), ("j3", "simpson"), ("j4", "pielou_e")):
    twin(f"{_id}_{_metric}", "strat",
         f"""SELECT "Sample", "Metric", round("Value", 6) AS "Value" FROM alpha
         WHERE "Metric" = '{_metric}'""", _ALPHA)
twin("j5_alpha_long", "strat",
     'SELECT "Sample", "Metric", round("Value", 6) AS "Value" FROM alpha', _ALPHA)
twin("e10_scores_with_group", "strat metadata", """
SELECT "Sample", "Metric", round("Value", 6) AS "Value", "Region" FROM alpha JOIN metadata USING ("Sample")""",
     _ALPHA)
_SHARED = """sums AS (SELECT "Sample", sum("Value") AS s, count(*) AS r FROM strat GROUP BY 1),
  pairs AS (SELECT a."Sample" AS sample_i, b."Sample" AS sample_j, a.s AS si, b.s AS sj, a.r AS ri,
    b.r AS rj FROM sums a JOIN sums b ON a."Sample" < b."Sample"),
  shared AS (SELECT a."Sample" AS sample_i, b."Sample" AS sample_j,
    sum(least(a."Value", b."Value")) AS low, count(*) AS c
    FROM strat a JOIN strat b ON a."FeatureID" = b."FeatureID" AND a."Sample" < b."Sample" GROUP BY 1, 2)"""
twin("k1_braycurtis", "strat", """
SELECT sample_i, sample_j, round(1 - 2 * coalesce(low, 0) / (si + sj), 6) AS distance
FROM pairs LEFT JOIN shared USING (sample_i, sample_j)""", _SHARED)
twin("k2_jaccard", "strat", """
SELECT sample_i, sample_j, round(1 - coalesce(c, 0) / (ri + rj - coalesce(c, 0))::DOUBLE, 6) AS distance
FROM pairs LEFT JOIN shared USING (sample_i, sample_j)""", _SHARED)
_AITCHISON = """squares AS (SELECT a."Sample" AS sample_i, b."Sample" AS sample_j,
    sum((a."Value" - b."Value") * (a."Value" - b."Value")) AS d2
    FROM clr a JOIN clr b ON a."FeatureID" = b."FeatureID" AND a."Sample" < b."Sample" GROUP BY 1, 2)"""
twin("k3_aitchison", "strat clr",
     "SELECT sample_i, sample_j, round(sqrt(d2), 6) AS distance FROM squares", _AITCHISON)
_PERMANOVA = _AITCHISON + """,
  layout AS (SELECT "Sample", "Region", row_number() OVER (ORDER BY "Region", "Sample") AS place,
    count(*) OVER (PARTITION BY "Region") AS label_n FROM metadata
    WHERE "Sample" IN (SELECT "Sample" FROM strat)),
  drawn AS (SELECT p, "Sample", row_number() OVER (PARTITION BY p
    ORDER BY substr(md5('42|' || p || '|' || "Sample"), 1, 15), "Sample") AS place
    FROM layout, (SELECT unnest(range(1, 1000)) AS p)),
  labels AS (SELECT 0 AS p, "Sample", "Region", label_n FROM layout UNION ALL
    SELECT p, d."Sample", l."Region", l.label_n FROM drawn d JOIN layout l USING (place)),
  size AS (SELECT count(*)::DOUBLE AS n, count(DISTINCT "Region")::DOUBLE AS k FROM layout),
  within_sums AS (SELECT a.p AS p, sum(d2 / a.label_n) AS w FROM squares
    JOIN labels a ON a."Sample" = sample_i
    JOIN labels b ON b."Sample" = sample_j AND b.p = a.p AND b."Region" = a."Region" GROUP BY 1),
  stats AS (SELECT p, n, k, (((SELECT sum(d2) FROM squares) / n - w) / (k - 1)) / (w / (n - k)) AS f
    FROM within_sums, size)"""
twin("k5_permanova", "strat clr metadata", """
SELECT 'PERMANOVA' AS method, round(max(f) FILTER (WHERE p = 0), 6) AS test_statistic,
  round((count(*) FILTER (WHERE p > 0 AND f >= (SELECT f FROM stats WHERE p = 0) * (1 - 1e-9)) + 1)
    / 1000.0::DOUBLE, 6) AS p_value,
  max(n)::BIGINT AS n_samples, max(k)::BIGINT AS n_groups FROM stats""", _PERMANOVA)

# --- composition ------------------------------------------------------------

twin("i1_zero_replacement", "strat clr",
     'SELECT "Sample", "FeatureID", round(p, 9) AS proportion FROM filled')
twin("i2_clr", "strat clr", 'SELECT "Sample", "FeatureID", round("Value", 6) + 0.0 AS "Value" FROM clr')
twin("i2_clr_sparse", "strat clr", """
SELECT "Sample", "FeatureID", round("Value", 6) + 0.0 AS "Value" FROM clr WHERE x > 0 UNION ALL
SELECT "Sample", NULL, round(coalesce(max("Value") FILTER (WHERE x = 0),
  ln(1.0 / (count(*) * count(*))) - max(ln(p) - "Value")), 6) + 0.0
FROM clr JOIN filled USING ("Sample", "FeatureID", x) GROUP BY 1""")
twin("i3_clr_sums", "strat clr",
     'SELECT "Sample", round(sum("Value"), 6) + 0.0 AS clr_sum FROM clr GROUP BY 1')

# --- aggregations -----------------------------------------------------------

twin("f1_function_profile", "counts copies", """
SELECT "KO", "Sample", sum("Value" * copy_num) AS "Value" FROM counts JOIN copies USING ("ASV_ID")
WHERE "Value" > 0 AND copy_num > 0 GROUP BY 1, 2""")
for _name in ("f2_trait_profile", "f2_trait_profile_by_function", "n3_trait_table"):
    twin(_name, "counts copies trait_map", """
SELECT "Lv3", "Sample", sum("Value" * copy_num) AS "Value" FROM counts JOIN copies USING ("ASV_ID")
JOIN trait_map USING ("KO") WHERE "Value" > 0 AND copy_num > 0 GROUP BY 1, 2""")
twin("f3_taxon_abundance", "counts lineage", """
SELECT coalesce("Genus", 'Unclassified_Genus') AS "Genus", "Sample", sum("Value") AS "Value"
FROM counts JOIN lineage USING ("ASV_ID") WHERE "Value" > 0 GROUP BY 1, 2""")
twin("f4_taxon_copies", "copies lineage", """
SELECT "Genus", "KO", round(avg(copy_num), 6) AS copy_num FROM copies JOIN lineage USING ("ASV_ID")
WHERE copy_num > 0 GROUP BY 1, 2""")
twin("f5_stratified_profile", "counts copies lineage trait_map",
     _STRATIFIED.format(where='WHERE a."Genus" IS NOT NULL'), _TAXON)
twin("n4_stratified_table", "counts copies lineage trait_map",
     _STRATIFIED.format(where="").replace(
         'a."Genus" AS "Genus"', """coalesce(a."Genus", 'Unclassified_Genus') AS "Genus" """), _TAXON)
twin("f6_group_summary", "", """
SELECT l_returnflag, l_linestatus, count(l_extendedprice) AS "N", round(avg(l_extendedprice), 6) AS "Mean",
  round(stddev_samp(l_extendedprice), 6) AS "Std", round(min(l_extendedprice), 6) AS "Min",
  round(median(l_extendedprice), 6) AS "Median", round(max(l_extendedprice), 6) AS "Max",
  round(stddev_samp(l_extendedprice) / avg(l_extendedprice) * 100, 6) AS "CV"
FROM lineitem GROUP BY 1, 2""")
twin("f7_mini_summary", "strat metadata", """
SELECT "FeatureID", "Region", round(avg("Value"), 6) AS "Mean", round(stddev_samp("Value"), 6) AS "Std"
FROM strat JOIN metadata USING ("Sample")
WHERE "FeatureID" IN ('ECONOMY|Brand#1', 'SMALL|Brand#2') GROUP BY 1, 2""")
twin("f8_entity_from_keys", "strat clr", """
SELECT "Sample", counted, round(averaged, 6) + 0.0 AS averaged FROM
  (SELECT "Sample", sum("Value") AS counted FROM strat WHERE "FeatureID" LIKE 'ECONOMY|%' GROUP BY 1)
  JOIN (SELECT "Sample", avg("Value") AS averaged FROM clr WHERE "FeatureID" LIKE '%|Brand#1' GROUP BY 1)
  USING ("Sample")""")
twin("f9_entity_from_long", "counts copies lineage trait_map", """
SELECT "Sample", round(sum(a."Value" * copy_num), 6) AS "Value" FROM taxon_counts a
JOIN taxon_copies b ON a."Genus" = b."Genus" JOIN trait_map USING ("KO") WHERE "Lv3" = 'T1' GROUP BY 1""",
     _TAXON)
_VARIANCE = """scored AS (SELECT "FeatureID", round(var_samp("Value"), 6) AS variance FROM clr GROUP BY 1)"""
twin("f10_variance", "strat clr", "SELECT * FROM scored", _VARIANCE)
twin("f11_box_summary", "", """
SELECT o_orderpriority, round(min(o_totalprice), 4) AS low,
  round(quantile_cont(o_totalprice, 0.25), 4) AS q1, round(median(o_totalprice), 4) AS median,
  round(quantile_cont(o_totalprice, 0.75), 4) AS q3, round(max(o_totalprice), 4) AS high
FROM orders GROUP BY 1""")

# --- rankings ---------------------------------------------------------------

_TOP = _VARIANCE + """, quota AS (SELECT *, row_number() OVER (PARTITION BY split_part("FeatureID", '|', 1)
    ORDER BY variance DESC, "FeatureID") AS r FROM scored),
  placed AS (SELECT "FeatureID", variance,
    row_number() OVER (ORDER BY r > 3, variance DESC, "FeatureID") AS place FROM quota)"""
twin("g1_diverse_top", "strat clr",
     'SELECT "FeatureID", variance, place::INTEGER AS place FROM placed WHERE place <= 25', _TOP)
twin("g2_sorted", "lineage", 'SELECT * FROM lineage ORDER BY "Genus" NULLS LAST, "ASV_ID"')
twin("g3_top_scores", "vectors", """
SELECT "FeatureID" AS "Feature", round(avg("Value"), 6) AS "Importance",
  abs(round(avg("Value"), 6)) AS abs_val FROM vectors GROUP BY 1 ORDER BY 3 DESC, 1 LIMIT 20""")
twin("g4_top_loadings", "vectors", """
SELECT "Feature", "PC1", "PC2", round("PC1" * "PC1" + "PC2" * "PC2", 6) AS magnitude FROM
  (SELECT "FeatureID" AS "Feature", round(avg("Value"), 6) AS "PC1", round(max("Value"), 6) AS "PC2"
   FROM vectors GROUP BY 1) ORDER BY "PC1" * "PC1" + "PC2" * "PC2" DESC, "Feature" LIMIT 5""")
twin("g7_midranks", "", """
SELECT l_returnflag, l_quantity, n, n AS ties, sum(n) OVER (PARTITION BY l_returnflag)::BIGINT AS total,
  sum(n) OVER (PARTITION BY l_returnflag ORDER BY l_quantity)::DOUBLE - (n - 1) / 2.0::DOUBLE AS midrank
FROM (SELECT l_returnflag, l_quantity, count(*) AS n FROM lineitem GROUP BY 1, 2)""")
twin("g8_preview", "strat", 'SELECT * FROM strat ORDER BY "FeatureID", "Sample" LIMIT 10')
twin("g9_heatmap", "strat clr metadata", """
SELECT "Sample", "FeatureID", round("Value", 6) + 0.0 AS "Value", "Region" FROM clr
LEFT JOIN metadata USING ("Sample")
WHERE "FeatureID" IN (SELECT "FeatureID" FROM placed WHERE place <= 20)""", _TOP)

# --- set operations ---------------------------------------------------------

twin("h1_distinct", "", "SELECT DISTINCT l_partkey, l_suppkey FROM lineitem")
twin("h2_intersect", "counts marker", """
SELECT "ASV_ID" FROM counts INTERSECT SELECT "ASV_ID" FROM marker WHERE "metadata_NSTI" <= 0.95""")
twin("h3_except", "counts marker", """
SELECT "ASV_ID" FROM counts EXCEPT SELECT "ASV_ID" FROM marker WHERE "metadata_NSTI" <= 0.95""")

# --- tests and correlation --------------------------------------------------


def _ranked(table: str, group: str) -> str:
    return f"""ranked AS (SELECT "FeatureID", "{group}" AS g, "Value",
      rank() OVER (PARTITION BY "FeatureID" ORDER BY "Value")
      + (count(*) OVER (PARTITION BY "FeatureID", "Value") - 1) / 2.0 AS r,
      count(*) OVER (PARTITION BY "FeatureID", "Value") AS t,
      count(*) OVER (PARTITION BY "FeatureID") AS n
      FROM {table} JOIN metadata USING ("Sample"))"""


# Five groups: the chi-square tail with 4 degrees of freedom is closed.
_KRUSKAL = """group_sums AS (SELECT "FeatureID", g, sum(r) AS rs, count(*) AS m,
      sum(t * t - 1.0) AS ties, max(n)::DOUBLE AS n FROM ranked GROUP BY 1, 2),
    h AS (SELECT "FeatureID", (12 / (max(n) * (max(n) + 1)) * sum(rs * rs / m) - 3 * (max(n) + 1))
      / (1 - sum(ties) / (max(n) * max(n) * max(n) - max(n))) AS h FROM group_sums GROUP BY 1),
    tests AS (SELECT "FeatureID" AS "Feature", h AS test_statistic, exp(-h / 2) * (1 + h / 2) AS p_value FROM h)"""
_BH = """q AS (SELECT *, least(1, min(p_value * m / r) OVER (ORDER BY p_value DESC, r DESC
      ROWS UNBOUNDED PRECEDING)) AS q_value FROM (SELECT *, count(*) OVER () AS m,
      row_number() OVER (ORDER BY p_value) AS r FROM tests))"""
_REGION = f"{_ranked('clr', 'Region')}, {_KRUSKAL}, {_BH}"
twin("l1_test_table", "strat clr metadata", """
SELECT "Sample", "FeatureID", round("Value", 6) + 0.0 AS "Value", "Region"
FROM clr JOIN metadata USING ("Sample")""")
twin("l2_kruskal_wallis", "strat clr metadata", """
SELECT "Feature", round(test_statistic, 6) AS test_statistic, round(p_value, 6) AS p_value FROM tests""",
     _REGION)
twin("l2_kruskal_wallis_ties", "strat clr metadata", """
SELECT "Feature", round(test_statistic, 6) AS test_statistic, round(p_value, 6) AS p_value FROM tests""",
     f"""raw AS (SELECT "Sample", "FeatureID", x AS "Value" FROM full_cells),
     {_ranked('raw', 'Region')}, {_KRUSKAL}""")
twin("l5_false_discovery", "strat clr metadata", """
SELECT "Feature", round(test_statistic, 6) AS test_statistic, round(p_value, 6) AS p_value,
  round(q_value, 6) AS q_value FROM q""", _REGION)
twin("l9_flags", "strat clr metadata", """
SELECT "Feature", p_value < 0.05 AS p_sig, q_value < 0.05 AS q_sig FROM q""", _REGION)
twin("f12_significance_tally", "strat clr metadata", """
SELECT count(*) AS total, count(*) FILTER (WHERE p_value < 0.05) AS n_p,
  round(100.0::DOUBLE * count(*) FILTER (WHERE p_value < 0.05) / count(*), 6) AS pct_p,
  count(*) FILTER (WHERE q_value < 0.05) AS n_q,
  round(100.0::DOUBLE * count(*) FILTER (WHERE q_value < 0.05) / count(*), 6) AS pct_q FROM q""", _REGION)
twin("g5_candidates", "strat clr metadata", """
SELECT "Feature", 'report' AS pool FROM q
WHERE q_value < 0.05 OR (SELECT count(*) FROM q WHERE q_value < 0.05) < 50
UNION ALL SELECT "Feature", 'model' FROM q
WHERE q_value < 0.05 OR (SELECT count(*) FROM q WHERE q_value < 0.05) = 0""", _REGION)
twin("g6_volcano", "strat clr metadata", """
SELECT "Feature", round(test_statistic, 5) AS test_statistic, round(q_value, 5) AS q_value,
  round(-log10(q_value), 5) + 0.0 AS log_p, q_value < 0.05 AS "Significant" FROM q""", _REGION)
# erf by its series of positive terms; (2i+1)!! = (2i+1)! / (2^i i!).
_MANN = _ranked("clr", "Balance") + """,
    sides AS (SELECT "FeatureID", count(*) FILTER (WHERE g = 'high')::DOUBLE AS n1,
      count(*) FILTER (WHERE g = 'low')::DOUBLE AS n2, sum(r) FILTER (WHERE g = 'high') AS r1,
      sum(t * t - 1.0) AS ties FROM ranked GROUP BY 1),
    u AS (SELECT *, r1 - n1 * (n1 + 1) / 2 AS u FROM sides),
    z AS (SELECT *, (greatest(u, n1 * n2 - u) - n1 * n2 / 2 - 0.5) / sqrt(n1 * n2 / 12
      * (n1 + n2 + 1 - ties / ((n1 + n2) * (n1 + n2 - 1)))) AS z FROM u),
    erf AS (SELECT "FeatureID", 2 / sqrt(pi()) * exp(-z * z / 2) * sum(exp(i * ln(2)
      + (2 * i + 1) * ln(greatest(abs(z), 1e-300) / sqrt(2)) - lgamma(2 * i + 2) + i * ln(2) + lgamma(i + 1)))
      * sign(z) AS e FROM z, (SELECT unnest(range(0, 150))::DOUBLE AS i) GROUP BY "FeatureID", z),
    tests AS (SELECT "FeatureID" AS "Feature", u AS test_statistic, least(1, 1 - e) AS p_value,
      2 * u / (n1 * n2) - 1 AS cliffs_delta, n1::BIGINT AS n1, n2::BIGINT AS n2
      FROM z JOIN erf USING ("FeatureID"))"""
twin("l3_mann_whitney", "strat clr metadata", """
SELECT "Feature", round(test_statistic, 6) AS test_statistic, round(p_value, 6) AS p_value, n1, n2
FROM tests""", _MANN)
twin("l4_cliffs_delta", "strat clr metadata", """
SELECT "Feature", round(cliffs_delta, 6) + 0.0 AS cliffs_delta FROM tests""", _MANN)
twin("l6_chosen_test", "strat clr metadata", """
SELECT "Feature", round(test_statistic, 6) AS test_statistic, round(p_value, 6) AS p_value,
  round(q_value, 6) AS q_value FROM q""", f"{_MANN}, {_BH}")
# Two-sided t tail with v degrees of freedom by its finite series, v even or odd.
_T_TAIL = """t AS (SELECT *, n - 2 AS v, r / sqrt(1 - r * r) * sqrt(n - 2) AS t FROM corrs),
    angle AS (SELECT *, abs(t) / sqrt(v + t * t) AS s, v / (v + t * t) AS c2 FROM t),
    series AS (SELECT "FeatureID", n, v, r, s, c2,
      sum(CASE WHEN v % 2 = 0 AND j <= v / 2 - 1
        THEN exp(lgamma(2 * j + 1) - j * ln(4) - 2 * lgamma(j + 1) + j * ln(c2)) ELSE 0 END) AS even,
      sum(CASE WHEN v % 2 = 1 AND j <= (v - 3) / 2
        THEN exp(j * ln(4) + 2 * lgamma(j + 1) - lgamma(2 * j + 2) + j * ln(c2)) ELSE 0 END) AS odd
      FROM angle, (SELECT unnest(range(0, 1200))::DOUBLE AS j) GROUP BY ALL),
    tests AS (SELECT "FeatureID" AS "Feature", n, r AS correlation, CASE WHEN v % 2 = 0
      THEN 1 - s * even ELSE 1 - 2 / pi() * (asin(s) + s * sqrt(c2) * odd) END AS p_value FROM series)"""
_CORRELATION_OUT = """
SELECT "Feature", n, round(correlation, 6) + 0.0 AS correlation, round(p_value, 6) + 0.0 AS p_value,
  round(q_value, 6) + 0.0 AS q_value, p_value < 0.05 AS p_sig, q_value < 0.05 AS q_sig,
  round(abs(correlation), 6) AS abs_correlation FROM q"""
twin("l8_pearson", "strat clr metadata", _CORRELATION_OUT, f"""
corrs AS (SELECT "FeatureID", count(*) AS n, corr("Value", acctbal) AS r
  FROM clr JOIN metadata USING ("Sample") GROUP BY 1), {_T_TAIL}, {_BH}""")
twin("l8_pearson_dense", "vectors", """
SELECT "Feature", n, round(correlation, 6) + 0.0 AS correlation, round(p_value, 6) + 0.0 AS p_value
FROM tests""", f"""
corrs AS (SELECT a."FeatureID", count(*) AS n, corr(a."Value", b."Value") AS r
  FROM vectors a JOIN vectors b ON a."Sample" = b."Sample" AND b."FeatureID" = 'e00'
  WHERE a."FeatureID" <> 'e00' GROUP BY 1), {_T_TAIL}""")
twin("l7_spearman", "strat clr metadata", _CORRELATION_OUT, f"""
pairs AS (SELECT "FeatureID",
    rank() OVER (PARTITION BY "FeatureID" ORDER BY "Value")
      + (count(*) OVER (PARTITION BY "FeatureID", "Value") - 1) / 2.0 AS x,
    rank() OVER (PARTITION BY "FeatureID" ORDER BY acctbal)
      + (count(*) OVER (PARTITION BY "FeatureID", acctbal) - 1) / 2.0 AS y
    FROM clr JOIN metadata USING ("Sample")),
  corrs AS (SELECT "FeatureID", count(*) AS n, corr(x, y) AS r FROM pairs GROUP BY 1), {_T_TAIL}, {_BH}""")

# --- models and end to end --------------------------------------------------

twin("m3_model_table", "strat clr metadata", """
SELECT "Sample", max(code) AS label, count(*)::INTEGER AS width, round(sum("Value" * "Value"), 6) AS square
FROM clr JOIN metadata USING ("Sample") JOIN (SELECT r_name AS "Region",
  (row_number() OVER (ORDER BY r_name) - 1)::DOUBLE AS code FROM region) USING ("Region") GROUP BY 1""")
twin("n1_functions", "counts marker copies", f"""
SELECT "KO", "Sample", round(sum(({_RINT}) * copy_num), 4) AS "Value" FROM
  (SELECT "ASV_ID", "Sample", "Value" / marker_copies AS y FROM counts JOIN marker USING ("ASV_ID")
   WHERE marker_copies <> 0 AND "metadata_NSTI" <= 0.95)
JOIN copies USING ("ASV_ID") WHERE copy_num > 0 GROUP BY 1, 2""")
twin("n2_lineage_table", "counts taxonomy", """
SELECT "ASV_ID", "Kingdom", "Phylum", "Class", "Order", "Family", "Genus", "Species", "Sample", "Value"
FROM counts LEFT JOIN named USING ("ASV_ID")""", _NAMED)
twin("n5_group_analysis", "strat clr metadata", """
SELECT "Metric" AS part, "Sample" AS key, round("Value", 6) AS "Value" FROM alpha UNION ALL
SELECT 'q', "Feature", round(q_value, 6) FROM q UNION ALL
SELECT 'permanova', 'F', round(f, 6) FROM stats WHERE p = 0""",
     f"{_ALPHA}, {_PERMANOVA}, {_ranked('clr', 'Region')}, {_KRUSKAL}, {_BH}")


# --- ordination -------------------------------------------------------------


def _components(table: str, squarings: int = 14) -> str:
    """Two leading eigenvectors of the covariance matrix by repeated squaring.

    A high power of the matrix has all its columns along the first eigenvector;
    the second comes from the matrix with the first taken out.
    """
    steps = [
        f"""middle AS MATERIALIZED (SELECT "Sample", "FeatureID" AS f,
          "Value" - avg("Value") OVER (PARTITION BY "FeatureID") AS x FROM {table})""",
        """cov1 AS MATERIALIZED (SELECT a.f AS i, b.f AS j, sum(a.x * b.x) AS c
          FROM middle a JOIN middle b USING ("Sample") GROUP BY 1, 2)""",
    ]
    for k in (1, 2):
        steps.append(f"""p{k}_0 AS MATERIALIZED (SELECT i, j, c / (SELECT sum(c) FROM cov{k} WHERE i = j) AS c
          FROM cov{k})""")
        for n in range(1, squarings + 1):
            last = f"p{k}_{n - 1}"
            steps.append(f"""p{k}_{n} AS MATERIALIZED (SELECT i, j, c / sum(c) FILTER (WHERE i = j) OVER () AS c
              FROM (SELECT a.i AS i, b.j AS j, sum(a.c * b.c) AS c FROM {last} a JOIN {last} b ON a.j = b.i
              GROUP BY 1, 2))""")
        steps.append(f"""v{k} AS MATERIALIZED (SELECT f, v * sign(arg_max(v, abs(v)) OVER ()) AS v FROM
          (SELECT i AS f, c / sqrt(sum(c * c) OVER ()) AS v FROM p{k}_{squarings} WHERE j =
          (SELECT i FROM p{k}_{squarings} WHERE i = j ORDER BY c DESC, i LIMIT 1)))""")
        if k == 1:
            steps.append("""size1 AS (SELECT sum(a.v * c * b.v) AS s FROM cov1 JOIN v1 a ON a.f = i
              JOIN v1 b ON b.f = j)""")
            steps.append("""cov2 AS MATERIALIZED (SELECT i, j, c - (SELECT s FROM size1) * a.v * b.v AS c
              FROM cov1 JOIN v1 a ON a.f = i JOIN v1 b ON b.f = j)""")
    steps.append("""scores AS MATERIALIZED (SELECT "Sample", sum(x * v1.v) AS a, sum(x * v2.v) AS b
      FROM middle JOIN v1 USING (f) JOIN v2 USING (f) GROUP BY 1)""")
    return ", ".join(steps)


twin("m1_pca_scores", "strat clr", """
SELECT "Sample", round(a, 6) + 0.0 AS "PC1", round(b, 6) + 0.0 AS "PC2" FROM scores""", _components("clr"))
twin("m1_pca_loadings", "vectors", """
SELECT f AS "Feature", round(v1.v, 6) + 0.0 AS "PC1", round(v2.v, 6) + 0.0 AS "PC2"
FROM v1 JOIN v2 USING (f)""", _components("vectors"))
# With Euclidean distances the principal coordinates are the component scores,
# except that here the largest coordinate is the positive one.
twin("m2_pcoa", "strat clr", """
SELECT "Sample", round(a * sign(arg_max(a, abs(a)) OVER ()), 6) + 0.0 AS "PC1",
  round(b * sign(arg_max(b, abs(b)) OVER ()), 6) + 0.0 AS "PC2" FROM scores""", _components("clr"))
