"""Queries: profiling of the raw session table (the EDA notebook)."""

from __future__ import annotations

from pyspark.sql import functions as F

from clickscope.functions.columns import numeric_columns
from clickscope.operators import profile as P
from clickscope.plans.fixtures import SESSION_FEATURES, TARGET, raw_sessions
from clickscope.plans.oracle import RAW_CTE, SESSIONS_CTES, with_ctes
from clickscope.plans.registry import register

NOMINAL = ("gender", "device_type")
NUMERIC = tuple(c for c in SESSION_FEATURES if c not in NOMINAL)
# The six features of the box-plot panel.
BOX_FEATURES = ("age", "time_on_site", "pages_viewed", "previous_purchases",
                "avg_session_time", "bounce_rate")
RAW_CTES = SESSIONS_CTES + [RAW_CTE]
LAB_CTES = RAW_CTES + ["lab AS (SELECT * FROM raw WHERE ad_clicked IS NOT NULL)"]


def _raw(spark, sf_dir):
    return raw_sessions(spark, sf_dir)


def _numeric(df):
    return numeric_columns(df, exclude=("session_id",))


def _union(parts):
    return "\nUNION ALL\n".join(parts)


@register("describe_numeric", with_ctes(RAW_CTES, _union([
    f"""SELECT '{c}' AS feature, COUNT({c}) AS count, ROUND(AVG({c}), 6) AS mean,
       ROUND(STDDEV_SAMP({c}), 6) AS std, ROUND(MIN({c}), 6) AS min,
       ROUND(quantile_cont({c}, 0.25), 6) AS p25, ROUND(quantile_cont({c}, 0.5), 6) AS p50,
       ROUND(quantile_cont({c}, 0.75), 6) AS p75, ROUND(MAX({c}), 6) AS max FROM raw"""
    for c in NUMERIC])))
def q_describe_numeric(spark, sf_dir):
    df = _raw(spark, sf_dir)
    return P.describe(df, _numeric(df))


@register("missing_report", with_ctes(RAW_CTES, "SELECT * FROM (" + _union([
    f"""SELECT '{c}' AS "column", COUNT(*) FILTER (WHERE {c} IS NULL) AS missing_count,
       ROUND(COUNT(*) FILTER (WHERE {c} IS NULL) * 100.0 / COUNT(*), 6) AS missing_percent FROM raw"""
    for c in ("session_id",) + SESSION_FEATURES]) + ") WHERE missing_count > 0"))
def q_missing_report(spark, sf_dir):
    return P.missing_report(_raw(spark, sf_dir))


@register("missing_by_class", with_ctes(LAB_CTES, _union([
    f"""SELECT '{c}' AS feature, ad_clicked, ROUND(AVG(CAST({c} IS NULL AS DOUBLE)), 6) AS missing_rate
       FROM lab GROUP BY ad_clicked""" for c in SESSION_FEATURES if c != TARGET])))
def q_missing_by_class(spark, sf_dir):
    return P.missing_by_class(_raw(spark, sf_dir),
                              [c for c in SESSION_FEATURES if c != TARGET], TARGET)


@register("value_counts", with_ctes(RAW_CTES, "SELECT feature, value, COUNT(*) AS n FROM (" + _union([
    f"SELECT '{c}' AS feature, CAST({c} AS VARCHAR) AS value FROM raw"
    for c in ("gender", "device_type")]
    + ["SELECT 'ad_clicked', CASE WHEN ad_clicked IS NULL THEN NULL "
       "WHEN ad_clicked = 1 THEN '1.0' ELSE '0.0' END FROM raw"]) + ") GROUP BY feature, value"))
def q_value_counts(spark, sf_dir):
    return P.value_counts(_raw(spark, sf_dir), ["gender", "device_type", TARGET])


@register("value_counts_nonnull", with_ctes(RAW_CTES, "SELECT feature, value, COUNT(*) AS n FROM (" + _union([
    f"SELECT '{c}' AS feature, CAST({c} AS VARCHAR) AS value FROM raw"
    for c in ("gender", "device_type")]) + ") WHERE value IS NOT NULL GROUP BY feature, value"))
def q_value_counts_nonnull(spark, sf_dir):
    """Value counts without the null key."""
    return P.value_counts(_raw(spark, sf_dir), ["gender", "device_type"], dropna=True)


_SELECTED = ("age", "time_on_site", "avg_session_time", "pages_viewed")
_RANKS = (0.0, 0.01, 0.05, 0.5, 0.95, 0.99, 1.0)


@register("quantiles_selected", with_ctes(RAW_CTES, _union([
    f"SELECT ad_clicked, '{c}' AS feature, {p} AS p, ROUND(quantile_cont({c}, {p}), 6) AS value FROM raw GROUP BY ad_clicked"
    for c in _SELECTED for p in _RANKS])))
def q_quantiles_selected(spark, sf_dir):
    """Quantiles per class, all columns, classes (null included) and
    ranks by one distributed selection, whatever their number of distinct
    values."""
    from clickscope.functions.quantiles import quantile_columns
    df = _raw(spark, sf_dir).select(TARGET, *_SELECTED)
    q = quantile_columns(df, _SELECTED, _RANKS, group=TARGET, distinct_limit=0)
    cells = [F.struct(F.lit(c).alias("feature"), F.lit(p).alias("p"), F.round(F.col(c)[i], 6).alias("value")) for c in _SELECTED for i, p in enumerate(_RANKS)]
    return df.groupBy(TARGET).agg(*[q[c].alias(c) for c in _SELECTED]).select(TARGET, F.inline(F.array(*cells)))


@register("value_shares", with_ctes(RAW_CTES, """
SELECT value, n, ROUND(n * 100.0 / SUM(n) OVER (), 6) AS percent FROM (
  SELECT CASE WHEN ad_clicked IS NULL THEN NULL WHEN ad_clicked = 1 THEN '1.0' ELSE '0.0' END AS value,
         COUNT(*) AS n FROM raw GROUP BY 1)"""))
def q_value_shares(spark, sf_dir):
    return P.value_shares(_raw(spark, sf_dir), TARGET)


_CT_LONG = """ct AS (
  SELECT 'gender' AS feature, gender AS category, ad_clicked AS y FROM lab WHERE gender IS NOT NULL
  UNION ALL SELECT 'device_type', device_type, ad_clicked FROM lab WHERE device_type IS NOT NULL)"""


@register("crosstab_margins", with_ctes(LAB_CTES + [_CT_LONG], """
SELECT feature, CASE WHEN GROUPING(category) = 1 THEN 'All' ELSE category END AS category,
       COUNT(*) FILTER (WHERE y = 0) AS n_0, COUNT(*) FILTER (WHERE y = 1) AS n_1, COUNT(*) AS n_all
FROM ct GROUP BY GROUPING SETS ((feature, category), (feature))"""))
def q_crosstab_margins(spark, sf_dir):
    return P.crosstab_margins(_raw(spark, sf_dir), list(NOMINAL), TARGET)


@register("class_counts", with_ctes(RAW_CTES, """
SELECT n_rows, n_missing_target, n_labelled, n_positive, n_negative,
       ROUND(n_positive * 100.0 / n_labelled, 6) AS pct_positive,
       ROUND(n_negative * 100.0 / n_labelled, 6) AS pct_negative
FROM (SELECT COUNT(*) AS n_rows, COUNT(*) FILTER (WHERE ad_clicked IS NULL) AS n_missing_target,
             COUNT(ad_clicked) AS n_labelled, COUNT(*) FILTER (WHERE ad_clicked = 1) AS n_positive,
             COUNT(*) FILTER (WHERE ad_clicked = 0) AS n_negative FROM raw)"""))
def q_class_counts(spark, sf_dir):
    return P.class_counts(_raw(spark, sf_dir), TARGET)


@register("corr_target", with_ctes(LAB_CTES, _union([
    f"SELECT '{c}' AS feature, ROUND(CASE WHEN isnan(corr({c}, ad_clicked)) THEN NULL "
    f"ELSE corr({c}, ad_clicked) END, 6) AS corr FROM lab" for c in NUMERIC])))
def q_corr_target(spark, sf_dir):
    df = _raw(spark, sf_dir)
    return P.corr_with_target(df, _numeric(df), TARGET)


@register("corr_matrix", with_ctes(LAB_CTES, _union([
    f"SELECT '{a}' AS feature_a, '{b}' AS feature_b, ROUND(CASE WHEN isnan(corr({a}, {b})) "
    f"THEN NULL ELSE corr({a}, {b}) END, 6) AS corr FROM lab"
    for a in NUMERIC for b in NUMERIC])))
def q_corr_matrix(spark, sf_dir):
    df = _raw(spark, sf_dir)
    lab = df.filter(F.col(TARGET).isNotNull())
    return P.corr_matrix(lab, _numeric(df))


@register("top_corr", with_ctes(LAB_CTES, "SELECT feature, corr, abs(corr) AS abs_corr FROM (" + _union([
    f"SELECT '{c}' AS feature, ROUND(corr({c}, ad_clicked), 6) AS corr FROM lab"
    for c in NUMERIC if c != TARGET]) + ") WHERE corr IS NOT NULL AND NOT isnan(corr) "
    "ORDER BY abs(corr) DESC, feature LIMIT 5"))
def q_top_corr(spark, sf_dir):
    df = _raw(spark, sf_dir)
    return P.top_corr(df, _numeric(df), TARGET, 5)


def _hist_sql(cols, bins=30):
    parts = []
    for c in cols:
        parts.append(f"""SELECT '{c}' AS feature, b.bin,
       ROUND(e.lo + (e.hi - e.lo) / {bins} * b.bin, 6) AS bin_lo,
       ROUND(e.lo + (e.hi - e.lo) / {bins} * (b.bin + 1), 6) AS bin_hi,
       (SELECT COUNT(*) FROM raw WHERE {c} IS NOT NULL AND
          CAST(least(floor(({c} - e.lo) / (e.hi - e.lo) * {bins}), {bins - 1}) AS INTEGER) = b.bin) AS n
FROM (SELECT CASE WHEN MIN({c}) = MAX({c}) THEN MIN({c}) - 0.5 ELSE MIN({c}) END AS lo,
             CASE WHEN MIN({c}) = MAX({c}) THEN MAX({c}) + 0.5 ELSE MAX({c}) END AS hi FROM raw) e,
     (SELECT CAST(range AS INTEGER) AS bin FROM range({bins})) b""")
    return _union(parts)


@register("histogram30", with_ctes(RAW_CTES, _hist_sql(NUMERIC)))
def q_histogram30(spark, sf_dir):
    df = _raw(spark, sf_dir)
    return P.histogram(df, _numeric(df), 30)


@register("boxplot_stats", with_ctes(LAB_CTES, _union([f"""
SELECT '{c}' AS feature, l.ad_clicked, COUNT(l.{c}) AS n, ROUND(q.q1, 6) AS q1,
       ROUND(q.med, 6) AS median, ROUND(q.q3, 6) AS q3,
       ROUND(MIN(l.{c}) FILTER (WHERE l.{c} >= q.q1 - 1.5 * (q.q3 - q.q1)), 6) AS whisker_low,
       ROUND(MAX(l.{c}) FILTER (WHERE l.{c} <= q.q3 + 1.5 * (q.q3 - q.q1)), 6) AS whisker_high,
       COUNT(*) FILTER (WHERE l.{c} < q.q1 - 1.5 * (q.q3 - q.q1) OR l.{c} > q.q3 + 1.5 * (q.q3 - q.q1)) AS n_outliers
FROM lab l JOIN (SELECT ad_clicked, quantile_cont({c}, 0.25) AS q1, quantile_cont({c}, 0.5) AS med,
                        quantile_cont({c}, 0.75) AS q3 FROM lab GROUP BY ad_clicked) q
  ON l.ad_clicked = q.ad_clicked
GROUP BY l.ad_clicked, q.q1, q.med, q.q3""" for c in BOX_FEATURES])))
def q_boxplot_stats(spark, sf_dir):
    return P.boxplot_stats(_raw(spark, sf_dir), list(BOX_FEATURES), TARGET)


@register("head_rows", with_ctes(RAW_CTES, "SELECT session_id, " + ", ".join(
    c if c in NOMINAL else f"ROUND({c}, 6) AS {c}" for c in SESSION_FEATURES)
    + " FROM raw ORDER BY session_id LIMIT 5"))
def q_head_rows(spark, sf_dir):
    """O1: first rows under a total order (floats rounded: sums may differ in
    the last bit between engines)."""
    df = P.head_rows(_raw(spark, sf_dir), ["session_id"], 5)
    return df.select("session_id", *[F.col(c) if c in NOMINAL else F.round(c, 6).alias(c)
                                     for c in SESSION_FEATURES])


@register("table_shape", with_ctes(RAW_CTES,
                                   f"SELECT COUNT(*) AS n_rows, {len(SESSION_FEATURES) + 1} AS n_columns FROM raw"))
def q_table_shape(spark, sf_dir):
    return P.shape(_raw(spark, sf_dir))
