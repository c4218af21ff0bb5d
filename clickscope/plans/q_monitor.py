"""Queries: monitoring roll-ups over the drift summary and table counts."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import functions as F

from clickscope.operators import drift as D
from clickscope.operators import monitor as MON
from clickscope.plans.q_drift import FEATURES, TAGGED_CTES, _mean_shift_sql, tagged_sessions
from clickscope.plans.oracle import CLEAN_CTES, with_ctes
from clickscope.plans.q_clean import processed_sessions
from clickscope.plans.fixtures import raw_sessions
from clickscope.plans.registry import register
from clickscope.session import durable_dir

# The tables the pipeline depends on.
WATCHED = ("events", "customer", "labels", "documents")


@register("table_counts", "\nUNION ALL\n".join(
    f"SELECT '{t}' AS table_name, COUNT(*) AS n_rows FROM {t}" for t in WATCHED))
def q_table_counts(spark, sf_dir):
    return MON.table_counts(spark, sf_dir, WATCHED)


@register("health_rollup", "SELECT bool_and(n_rows > 0) AS all_healthy, "
          "COUNT(*) FILTER (WHERE NOT n_rows > 0) AS n_unhealthy, COUNT(*) AS n_components FROM ("
          + "\nUNION ALL\n".join(f"SELECT COUNT(*) AS n_rows FROM {t}" for t in WATCHED) + ")")
def q_health_rollup(spark, sf_dir):
    status = MON.table_counts(spark, sf_dir, WATCHED).withColumn("healthy", F.col("n_rows") > 0)
    return MON.health_rollup(status)


def _report_sql():
    ms = _mean_shift_sql()
    cut = ms.index("\nSELECT feature, ROUND(rm")
    return ms[:cut] + """
SELECT feature, format('{:,.2f}', rm) AS ref_mean_text, format('{:,.2f}', cm) AS curr_mean_text,
       CASE WHEN rm IS NULL OR cm IS NULL THEN 'NOT COMPUTED' WHEN rs > 0 AND ABS(cm - rm) > 0.1 * rs THEN 'DRIFT' ELSE 'OK' END AS status FROM ms"""


@register("drift_report", _report_sql())
def q_drift_report(spark, sf_dir):
    """formatted drift table (report presentation rows)."""
    return MON.drift_report_rows(D.mean_shift(tagged_sessions(spark, sf_dir), FEATURES))


def _report_empty_sql():
    return with_ctes(TAGGED_CTES, "\nUNION ALL\n".join(
        f"SELECT '{c}' AS feature, format('{{:,.2f}}', AVG({c})) AS ref_mean_text, CAST(NULL AS VARCHAR) AS curr_mean_text, 'NOT COMPUTED' AS status FROM tagged WHERE side = 'reference'"
        for c in FEATURES))


@register("drift_report_stored", _report_empty_sql())
def q_drift_report_stored(spark, sf_dir):
    """S7 + F14 + F16: the drift summary written, stamped and read back; without
    a current side (that is the feature) nothing was computed, which is not OK."""
    path = os.path.join(durable_dir(spark), "reports", uuid.uuid4().hex)
    ref = tagged_sessions(spark, sf_dir).where(F.col("side") == D.REF)
    MON.write_summary(MON.stamped(D.mean_shift(ref, FEATURES)), path)
    stored = spark.read.parquet(path)
    assert stored.where(F.to_timestamp("generated_at", "yyyy-MM-dd HH:mm:ss").isNull()).isEmpty()
    return MON.drift_report_rows(stored)


@register("stage_row_counts", with_ctes(CLEAN_CTES, """
SELECT 'raw_sessions' AS table_name, COUNT(*) AS n_rows FROM raw
UNION ALL SELECT 'processed_sessions' AS table_name, COUNT(*) AS n_rows FROM processed"""))
def q_stage_row_counts(spark, sf_dir):
    """A1 as the reference's database probe: raw and processed stage rows
    (the difference is the unlabelled rows dropped by P3)."""
    return MON.frame_counts({"raw_sessions": raw_sessions(spark, sf_dir),
                             "processed_sessions": processed_sessions(spark, sf_dir)})
