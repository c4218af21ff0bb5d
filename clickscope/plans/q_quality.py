"""Queries: validation, quarantine and ingest row-count checks."""

from __future__ import annotations

from pyspark.sql import functions as F

from clickscope.operators import quality as Q
from clickscope.plans.fixtures import SESSION_FEATURES, dirty_sessions
from clickscope.plans.oracle import SESSIONS_CTES, with_ctes
from clickscope.plans.registry import register
from clickscope.sources.tables import read_table

_COLS = ", ".join(SESSION_FEATURES)


def _sub(col, expr):
    return ", ".join(expr if c == col else c for c in SESSION_FEATURES)


DIRTY_CTES = SESSIONS_CTES + [f"""dirty AS (
  SELECT session_id, session_date, {_COLS} FROM sessions
  UNION ALL SELECT session_id, session_date, {_sub('ad_clicked', '2.0 AS ad_clicked')}
            FROM sessions WHERE day(session_date) = 1
  UNION ALL SELECT session_id + 50, session_date, {_sub('age', '12.0 AS age')}
            FROM sessions WHERE day(session_date) = 2
  UNION ALL SELECT session_id + 60, session_date, {_sub('age', '101.0 AS age')}
            FROM sessions WHERE day(session_date) = 3)""",
                                """flagged AS (
  SELECT d.*, concat_ws(',',
           CASE WHEN d.session_id IN (SELECT session_id FROM dirty GROUP BY session_id HAVING COUNT(*) > 1)
                THEN 'unique_id' END,
           CASE WHEN d.ad_clicked NOT IN (0, 1) THEN 'target_binary' END,
           CASE WHEN NOT (d.age BETWEEN 13 AND 100) THEN 'age_range' END) AS failed
  FROM dirty d)"""]


def _flagged(spark, sf_dir):
    return Q.flag_rules(dirty_sessions(spark, sf_dir))


@register("validate_split", with_ctes(DIRTY_CTES, """
SELECT COUNT(*) AS n_rows, COUNT(*) FILTER (WHERE failed = '') AS n_passed,
       COUNT(*) FILTER (WHERE failed <> '') AS n_quarantined,
       COUNT(*) FILTER (WHERE failed LIKE '%unique_id%') AS n_unique_id,
       COUNT(*) FILTER (WHERE failed LIKE '%target_binary%') AS n_target_binary,
       COUNT(*) FILTER (WHERE failed LIKE '%age_range%') AS n_age_range
FROM flagged"""))
def q_validate_split(spark, sf_dir):
    return Q.rule_summary(_flagged(spark, sf_dir))


@register("quarantine", with_ctes(DIRTY_CTES, """
SELECT session_id, ROUND(age, 6) AS age, ad_clicked, failed AS failed_rules
FROM flagged WHERE failed <> ''"""))
def q_quarantine(spark, sf_dir):
    _, bad = Q.split_valid(_flagged(spark, sf_dir))
    return bad.select("session_id", F.round("age", 6).alias("age"), "ad_clicked",
                      F.concat_ws(",", "failed_rules").alias("failed_rules"))


@register("rowcount_deviation", """
SELECT ingest_date, n_rows, prev_rows, ROUND(ABS(n_rows - prev_rows) / prev_rows, 6) AS deviation,
       COALESCE(ABS(n_rows - prev_rows) / prev_rows > 0.1, FALSE) AS alert
FROM (SELECT ingest_date, n_rows, LAG(n_rows) OVER (ORDER BY ingest_date) AS prev_rows
      FROM (SELECT CAST(ts AS DATE) AS ingest_date, COUNT(*) AS n_rows FROM events GROUP BY 1))""")
def q_rowcount_deviation(spark, sf_dir):
    ev = read_table(spark, sf_dir, "events").select(F.to_date("ts").alias("ingest_date"))
    return Q.rowcount_deviation(ev, "ingest_date", 0.10)
