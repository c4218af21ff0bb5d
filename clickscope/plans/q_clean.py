"""Queries: cleaning, encoding and the flagship click-rate slice."""

from __future__ import annotations

from pyspark.sql import functions as F

from clickscope.functions.columns import r6
from clickscope.functions.quantiles import quantile_columns
from clickscope.operators import clean as C
from clickscope.operators import profile as P
from clickscope.plans.fixtures import SESSION_FEATURES, TARGET, raw_sessions
from clickscope.plans.oracle import CLEAN_CTES, with_ctes
from clickscope.plans.registry import register

NOMINAL = ("gender", "device_type")
PROCESSED_COLS = tuple(SESSION_FEATURES)


def filled_sessions(spark, sf_dir):
    """Raw sessions after P4/P5/P3 (no encoding), id kept."""
    df, _, _ = C.clean_sessions(raw_sessions(spark, sf_dir), id_col=None, encode=False)
    return df


def processed_sessions(spark, sf_dir, keep_id: bool = False):
    """The processed table: P1, P4, P5 (median before the target filter), P3, F2."""
    df, _, _ = C.clean_sessions(raw_sessions(spark, sf_dir),
                                id_col=None if keep_id else "session_id")
    return df


def _round_all(df):
    return df.select(*[r6(c).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes])


@register("clean_sessions", with_ctes(CLEAN_CTES, "SELECT " + ", ".join(
    f"ROUND({c}, 6) AS {c}" if c not in NOMINAL else c for c in PROCESSED_COLS)
    + " FROM processed"))
def q_clean_sessions(spark, sf_dir):
    return _round_all(processed_sessions(spark, sf_dir))


@register("label_encode", with_ctes(CLEAN_CTES, "SELECT feature, label, code FROM labels"))
def q_label_encode(spark, sf_dir):
    return C.label_code_table(filled_sessions(spark, sf_dir), list(NOMINAL))


@register("click_rate_by_category", with_ctes(CLEAN_CTES + ["""long AS (
  SELECT 'gender' AS feature, gender AS category, ad_clicked AS y FROM filled
  UNION ALL SELECT 'device_type', device_type, ad_clicked FROM filled)"""], """
SELECT feature, CASE WHEN GROUPING(category) = 1 THEN 'All' ELSE category END AS category,
       COUNT(*) AS n, CAST(SUM(y) AS BIGINT) AS positives, ROUND(SUM(y) / COUNT(*), 6) AS rate
FROM long GROUP BY GROUPING SETS ((feature, category), (feature))"""))
def q_click_rate_by_category(spark, sf_dir):
    """Flagship: events x customer -> sessions -> clean (fill, median, drop
    unlabelled) -> click rate per category with margins."""
    return P.class_rate_by_category(filled_sessions(spark, sf_dir), list(NOMINAL), TARGET)


@register("median_fill", with_ctes(CLEAN_CTES,
                                   "SELECT ROUND(m, 6) AS avg_session_time_median FROM med"))
def q_median_fill(spark, sf_dir):
    """A4/P5: the fitted median (over all rows, before the target filter)."""
    raw = raw_sessions(spark, sf_dir)
    med = quantile_columns(raw, ["avg_session_time"], [0.5])["avg_session_time"][0]
    return raw.agg(r6(med).alias("avg_session_time_median"))
