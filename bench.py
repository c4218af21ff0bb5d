"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Prints ONE JSON line: {"metric", "value", "unit", "queries", "sf", ...}.
Each query is forced end to end with a ``noop`` write (full execution, no
collect to the driver); fitted-constant jobs inside a query are timed too.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from clickscope.plans import registry  # noqa: E402
from clickscope.session import build_session  # noqa: E402

# The headline queries, one per operator family.
HEADLINE = (
    "click_rate_by_category", "clean_sessions", "describe_numeric", "missing_report",
    "crosstab_margins", "corr_matrix", "histogram30", "boxplot_stats", "validate_split",
    "standardize", "stratified_split", "stratified_folds", "roc_auc", "pr_curve",
    "subgroup_metrics", "auc_drop_weekly", "drift_mean_shift", "drift_ks", "drift_chi2",
    "drift_psi", "drift_pvalue_summary", "cached_scoring", "rf_train_score", "stream_drift_windows", "stream_scoring_state",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    only = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q]
    spark = build_session(master=f"local[{cpus}]", app="clickscope-bench",
                          shuffle_partitions=int(cpus))
    registry.load_all()
    # warm-up (JVM, code paths), not timed
    registry.QUERIES["table_counts"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    times, errors = {}, {}
    for name in (only or HEADLINE):
        t0 = time.perf_counter()
        try:
            df = registry.QUERIES[name](spark, sf_dir)
            df.write.format("noop").mode("overwrite").save()
            times[name] = round(time.perf_counter() - t0, 3)
        except Exception as e:  # noqa: BLE001 - report, keep benchmarking
            errors[name] = f"{type(e).__name__}: {str(e)[:200]}"
    m = re.search(r"sf([0-9.]+)$", sf_dir)
    out = {"metric": "headline_total_seconds", "value": round(sum(times.values()), 3),
           "unit": "sec", "queries": times, "sf": float(m.group(1)) if m else sf_dir,
           "cpus": int(cpus), "n_queries": len(times)}
    if errors:
        out["errors"] = errors
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
