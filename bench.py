"""Time the headline queries and print one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from registry.queries import QUERIES  # noqa: E402
from simplexa import local_session  # noqa: E402

HEADLINE = (
    "f5_stratified_profile", "f1_function_profile", "f2_trait_profile", "e2_marker_normalised",
    "n2_lineage_table", "i2_clr", "i2_clr_sparse", "j5_alpha_long", "k1_braycurtis", "k2_jaccard",
    "k3_aitchison", "k5_permanova", "l2_kruskal_wallis", "l3_mann_whitney", "l5_false_discovery",
    "l7_spearman", "l8_pearson", "f6_group_summary", "f11_box_summary", "g1_diverse_top",
    "g7_midranks", "m1_pca_scores",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cpus)
    names = sys.argv[1:] or HEADLINE
    # One untimed query pays for start-up of the JVM and the Python workers.
    QUERIES["k3_aitchison"](spark, folder).write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in names:
        start = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    print(json.dumps({
        "metric": "headline queries, total wall time",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": folder.rstrip("/").rsplit("sf", 1)[-1],
        "cpus": cpus,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
