"""Benchmark: run the headline queries and print ONE JSON line.

    BENCH_SF_DIR  (default /root/testdata/sf0.1)
    BENCH_CPUS    (default 8)         -> local[BENCH_CPUS]
    BENCH_QUERIES (optional, comma separated subset)

Each query is executed fully with the ``noop`` sink (no driver collect), once,
after one warm-up query that starts the JVM; ``value`` is the sum of the
per-query wall times.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "grid_zscore",            # bins -> counts -> z (the density core, lineitem)
    "hotspots",
    "facility_grid_stats",    # full density job on the facility binding
    "suburb_stats",
    "cell_features",          # one (cell, suburb) aggregate, three roll-ups, window, joins
    "facility_features",
    "dedupe_by_key",
    "upsert_latest",
    "upsert_composite_key",
    "contract_pk_violations",
    "stratified_split",
    "regression_metrics",
    "roc_auc",
    "pr_roc_curves",
    "feature_statistics",
    "gap_histogram",
    "incremental_upsert",
    "logreg_baseline_metrics",  # pyspark.ml fits
    "scaled_glm_metrics",
    "mlp_classifier_metrics",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    names = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n] or HEADLINE

    from gridlens.session import build_session
    from gridlens.plans.registry import all_queries

    spark = build_session(
        f"local[{cpus}]",
        app_name="gridlens-bench",
        shuffle_partitions=cpus,
        extra={"spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false",
               "spark.driver.memory": "16g"},
    )
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="gridlens-bench-"))
    queries = all_queries()
    # warm-up: JVM start, class loading, first codegen
    queries["grid_counts"](spark, sf_dir).write.format("noop").mode("overwrite").save()

    times: dict[str, float] = {}
    for name in names:
        t0 = time.perf_counter()
        queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({
        "metric": "headline_queries_total",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(sf) if sf.replace(".", "").isdigit() else sf,
        "cpus": cpus,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
