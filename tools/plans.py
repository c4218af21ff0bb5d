"""Write PLANS.md: physical plans of key operators at a given scale.

Usage: python tools/plans.py [sf_dir]
"""

from __future__ import annotations

import io
import os
import sys
from contextlib import redirect_stdout

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from clickscope.plans import registry  # noqa: E402
from clickscope.plans.fixtures import sessions_from_events  # noqa: E402
from clickscope.session import build_session  # noqa: E402
from clickscope.sources.tables import read_table  # noqa: E402

NOTES = {
    "sessions (ingest stage)": "events aggregated per (user, day) with partial aggregation "
    "before the only shuffle; customer pruned to 2 columns and joined after the aggregate; "
    "one window per user over at most one row per day.",
    "click_rate_by_category": "flagship: reads the session stage table (Parquet) with pruned "
    "columns; one GROUPING SETS aggregate (Expand + partial/final HashAggregate).",
    "roc_auc": "distinct scores by partial aggregation; running totals as a window "
    "(checked-small input) or per-bucket offsets beyond 2M rows.",
    "drift_psi": "reference deciles (one row per feature, broadcast by code bound); "
    "(feature, bin, side) counts by partial aggregation.",
    "drift_chi2": "every category kept: (feature, category, side) counts by partial "
    "aggregation; side totals and dof from a one-row-per-feature aggregate (broadcast by code "
    "bound) instead of a window over all categories of a feature; exact any-dof p-value "
    "folded JVM-side.",
    "rowcount_deviation": "scan reads only ts; the single-partition window runs on one row "
    "per day.",
}


def plan_text(df) -> str:
    buf = io.StringIO()
    with redirect_stdout(buf):
        df.explain()
    return buf.getvalue().strip()


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = build_session(app="clickscope-plans")
    registry.load_all()
    plans = {"sessions (ingest stage)": sessions_from_events(
        read_table(spark, sf_dir, "events"), read_table(spark, sf_dir, "customer"))}
    for q in ("click_rate_by_category", "roc_auc", "drift_psi", "drift_chi2",
              "rowcount_deviation"):
        plans[q] = registry.QUERIES[q](spark, sf_dir)
    out = ["# Physical plans (generated by tools/plans.py at " + os.path.basename(sf_dir) + ")", ""]
    for name, df in plans.items():
        out += [f"## {name}", "", NOTES[name], "", "```", plan_text(df), "```", ""]
    with open(os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))),
                           "PLANS.md"), "w") as f:
        f.write("\n".join(out))
    spark.stop()


if __name__ == "__main__":
    main()
