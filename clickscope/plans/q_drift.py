"""Queries: drift between the reference (70 %) and current (30 %) sides of a
seeded random split of the processed sessions (the reference's own caller)."""

from __future__ import annotations

import os



from clickscope.operators import drift as D
from clickscope.operators import profile as P
from clickscope.operators import split as S
from clickscope.plans.fixtures import SESSION_FEATURES, TARGET, load_sessions
from clickscope.plans.q_clean import processed_sessions
from clickscope.plans.q_split import RANKED_CTES
from clickscope.plans.oracle import SESSIONS_CTES, with_ctes
from clickscope.plans.registry import register
from clickscope.session import stage_table

FEATURES = tuple(c for c in SESSION_FEATURES if c != TARGET)
NOMINAL = ("gender", "device_type")
NUMERIC = tuple(c for c in FEATURES if c not in NOMINAL)

TAGGED_CTES = RANKED_CTES + ["""tagged AS (
  SELECT p.*, CASE WHEN r.rk_all <= ceil(0.3 * r.n_all - 1e-9) THEN 'current' ELSE 'reference' END AS side
  FROM processed p JOIN ranked r USING (session_id))"""]


def tagged_sessions(spark, sf_dir):
    """Processed sessions tagged reference/current, written once to the shared
    checkpoint folder (the drift statistics read them in several passes)."""
    return stage_table(spark, ("drift_sides", os.path.abspath(sf_dir)),
                       lambda: S.random_split(processed_sessions(spark, sf_dir, keep_id=True),
                                              "session_id", 0.3, 42))


def _mean_shift_sql():
    parts = []
    for c in FEATURES:
        parts.append(f"""SELECT '{c}' AS feature,
  AVG({c}) FILTER (WHERE side = 'reference') AS rm, AVG({c}) FILTER (WHERE side = 'current') AS cm,
  STDDEV_SAMP({c}) FILTER (WHERE side = 'reference') AS rs FROM tagged""")
    return with_ctes(TAGGED_CTES + ["ms AS (" + "\nUNION ALL\n".join(parts) + ")"], """
SELECT feature, ROUND(rm, 6) AS ref_mean, ROUND(cm, 6) AS curr_mean, ROUND(ABS(cm - rm), 6) AS mean_diff,
       ROUND(rs, 6) AS ref_std, CASE WHEN rm IS NULL OR cm IS NULL THEN NULL WHEN rs > 0 THEN ABS(cm - rm) > 0.1 * rs
       ELSE FALSE END AS drift_detected, 'distance' AS direction FROM ms""")


@register("drift_mean_shift", _mean_shift_sql())
def q_drift_mean_shift(spark, sf_dir):
    return D.mean_shift(tagged_sessions(spark, sf_dir), FEATURES)


def _ks_ctes(cols):
    long = "\nUNION ALL\n".join(
        f"SELECT '{c}' AS feature, CAST({c} AS DOUBLE) AS value, side FROM tagged WHERE {c} IS NOT NULL"
        for c in cols)
    return [
        f"kl AS ({long})",
        """kd AS (SELECT feature, value, COUNT(*) FILTER (WHERE side = 'reference') AS n_r,
                  COUNT(*) FILTER (WHERE side = 'current') AS n_c FROM kl GROUP BY feature, value)""",
        """kc AS (SELECT feature, value,
                  SUM(n_r) OVER (PARTITION BY feature ORDER BY value ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum_r,
                  SUM(n_c) OVER (PARTITION BY feature ORDER BY value ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum_c,
                  SUM(n_r) OVER (PARTITION BY feature) AS N_r, SUM(n_c) OVER (PARTITION BY feature) AS N_c FROM kd)""",
        """ks AS (SELECT feature, MAX(ABS(cum_r / N_r - cum_c / N_c)) AS ks_stat,
                  CAST(MAX(N_r) AS DOUBLE) AS n_ref, CAST(MAX(N_c) AS DOUBLE) AS n_cur FROM kc GROUP BY feature)""",
        """kp AS (SELECT *, (sqrt(n_ref * n_cur / (n_ref + n_cur)) + 0.12
                  + 0.11 / sqrt(n_ref * n_cur / (n_ref + n_cur))) * ks_stat AS lam FROM ks)"""]


def _ks_sql():
    return with_ctes(TAGGED_CTES + _ks_ctes(NUMERIC),
        f"""SELECT feature, CAST(n_ref AS BIGINT) AS n_ref, CAST(n_cur AS BIGINT) AS n_cur,
       ROUND(ks_stat, 6) AS ks_stat, ROUND({D.ks_pvalue_sql('lam')}, 6) AS p_value,
       {D.ks_pvalue_sql('lam')} < 0.05 AS drift_detected, 'p_value' AS direction FROM kp""")


@register("drift_ks", _ks_sql())
def q_drift_ks(spark, sf_dir):
    return D.ks_test(tagged_sessions(spark, sf_dir), NUMERIC)


def _chi2_ctes(cols):
    long = "\nUNION ALL\n".join(
        f"SELECT '{c}' AS feature, CAST({c} AS VARCHAR) AS category, side FROM tagged WHERE {c} IS NOT NULL"
        for c in cols)
    return [
        f"cl AS ({long})",
        """cc AS (SELECT feature, category, COUNT(*) FILTER (WHERE side = 'reference') AS o_r,
                  COUNT(*) FILTER (WHERE side = 'current') AS o_c FROM cl GROUP BY feature, category)""",
        """ce AS (SELECT *, SUM(o_r) OVER (PARTITION BY feature) AS R, SUM(o_c) OVER (PARTITION BY feature) AS C
                  FROM cc)""",
        """cs AS (SELECT feature,
                  SUM(power(o_r - (o_r + o_c) * R / (R + C), 2) / ((o_r + o_c) * R / (R + C))
                    + power(o_c - (o_r + o_c) * C / (R + C), 2) / ((o_r + o_c) * C / (R + C))) AS chi2,
                  COUNT(*) - 1 AS dof FROM ce GROUP BY feature)"""]


def _chi2_sql():
    return with_ctes(TAGGED_CTES + _chi2_ctes(NOMINAL),
        f"""SELECT feature, ROUND(chi2, 6) AS chi2, CAST(dof AS BIGINT) AS dof,
       ROUND({D.chi2_pvalue_duck('chi2', 'dof')}, 6) AS p_value,
       {D.chi2_pvalue_duck('chi2', 'dof')} < 0.05 AS drift_detected, 'p_value' AS direction FROM cs""")


@register("drift_chi2", _chi2_sql())
def q_drift_chi2(spark, sf_dir):
    return D.chi2_test(tagged_sessions(spark, sf_dir), NOMINAL)


def _psi_sql():
    probs = "[" + ", ".join(str(p) for p in D.PSI_PROBS) + "]"
    edges = "\nUNION ALL\n".join(
        f"SELECT '{c}' AS feature, quantile_cont({c}, {probs}) AS edges FROM tagged WHERE side = 'reference'"
        for c in NUMERIC)
    long = "\nUNION ALL\n".join(
        f"SELECT '{c}' AS feature, CAST({c} AS DOUBLE) AS value, side FROM tagged WHERE {c} IS NOT NULL"
        for c in NUMERIC)
    return with_ctes(TAGGED_CTES + [
        f"pe AS ({edges})", f"pl AS ({long})",
        """pb AS (SELECT l.feature, l.side, len(list_filter(e.edges, lambda x: x < l.value)) AS bin
                  FROM pl l JOIN pe e USING (feature))""",
        """pc AS (SELECT feature, bin, COUNT(*) FILTER (WHERE side = 'reference') AS n_r,
                  COUNT(*) FILTER (WHERE side = 'current') AS n_c FROM pb GROUP BY feature, bin)""",
        f"""pg AS (SELECT e.feature, CAST(b.range AS BIGINT) AS bin FROM pe e, range(0, {len(D.PSI_PROBS) + 1}) b)""",
        """pf AS (SELECT g.feature, g.bin, COALESCE(c.n_r, 0) AS n_r, COALESCE(c.n_c, 0) AS n_c
                  FROM pg g LEFT JOIN pc c ON g.feature = c.feature AND g.bin = c.bin)""",
        f"""ps AS (SELECT feature, greatest(n_r * 1.0 / SUM(n_r) OVER (PARTITION BY feature), {D.PSI_FLOOR}) AS r,
                  greatest(n_c * 1.0 / SUM(n_c) OVER (PARTITION BY feature), {D.PSI_FLOOR}) AS c FROM pf)"""],
        f"""SELECT feature, ROUND(SUM((c - r) * ln(c / r)), 6) AS psi, SUM((c - r) * ln(c / r)) > {D.PSI_ALERT}
       AS drift_detected, 'distance' AS direction FROM ps GROUP BY feature""")


@register("drift_psi", _psi_sql())
def q_drift_psi(spark, sf_dir):
    return D.psi(tagged_sessions(spark, sf_dir), NUMERIC)


def _rollup_sql():
    ms = _mean_shift_sql()
    body = "SELECT COUNT(*) AS n_features, COUNT(*) FILTER (WHERE drift_detected) AS n_drifted, " \
           "bool_or(drift_detected) AS any_drift FROM (" + ms[ms.index("\nSELECT feature, ROUND(rm"):] + ")"
    return ms[:ms.index("\nSELECT feature, ROUND(rm")] + body


@register("drift_rollup", _rollup_sql())
def q_drift_rollup(spark, sf_dir):
    """Roll-up of the mean-shift summary."""
    return D.drift_rollup(D.mean_shift(tagged_sessions(spark, sf_dir), FEATURES))


def _side_describe_sql():
    parts = [f"""SELECT side, '{c}' AS feature, COUNT({c}) AS count, ROUND(AVG({c}), 6) AS mean,
       ROUND(STDDEV_SAMP({c}), 6) AS std, ROUND(MIN({c}), 6) AS min,
       ROUND(quantile_cont({c}, 0.25), 6) AS p25, ROUND(quantile_cont({c}, 0.5), 6) AS p50,
       ROUND(quantile_cont({c}, 0.75), 6) AS p75, ROUND(MAX({c}), 6) AS max FROM tagged GROUP BY side"""
             for c in FEATURES]
    return with_ctes(TAGGED_CTES, "\nUNION ALL\n".join(parts))


@register("drift_side_describe", _side_describe_sql())
def q_drift_side_describe(spark, sf_dir):
    """Sizes and descriptive tables of both sides in one grouped pass."""
    return P.describe(tagged_sessions(spark, sf_dir), FEATURES, group="side")




# The 0/1 columns of the processed table, tested as categories by D2.
BINARY = ("discount_seen", "returning_user", "bounce_rate", "purchase")
D2_NUMERIC = tuple(c for c in NUMERIC if c not in BINARY)
D2_CATEGORICAL = (*NOMINAL, *BINARY, TARGET)


def _pvalue_summary_sql():
    means = "\nUNION ALL\n".join(
        f"""SELECT '{c}' AS feature, AVG({c}) FILTER (WHERE side = 'reference') AS rm,
  AVG({c}) FILTER (WHERE side = 'current') AS cm FROM tagged""" for c in (*D2_NUMERIC, *D2_CATEGORICAL))
    ks_p = D.ks_pvalue_sql("lam")
    chi_p = D.chi2_pvalue_duck("chi2", "dof")
    return with_ctes(TAGGED_CTES + _ks_ctes(D2_NUMERIC) + _chi2_ctes(D2_CATEGORICAL) + [
        f"""tests AS (SELECT feature, 'ks' AS method, {ks_p} AS p FROM kp
                  UNION ALL SELECT feature, 'chi2' AS method, {chi_p} AS p FROM cs)""",
        f"dm AS ({means})"],
        """SELECT t.feature, t.method, ROUND(rm, 6) AS ref_mean, ROUND(cm, 6) AS curr_mean,
       ROUND(ABS(cm - rm), 6) AS mean_diff, ROUND(p, 6) AS p_value,
       p < 0.05 AS drift_detected, 'p_value' AS direction
FROM tests t JOIN dm USING (feature)""")


@register("drift_pvalue_summary", _pvalue_summary_sql())
def q_drift_pvalue_summary(spark, sf_dir):
    """Per-column p-value drift record over every processed column,
    target included (KS numeric, chi-square nominal and 0/1)."""
    return D.pvalue_summary(tagged_sessions(spark, sf_dir), D2_NUMERIC, D2_CATEGORICAL)


def _empty_side_sql():
    """Every statistic of a comparison with an empty current side is null."""
    rows = [f"SELECT 'mean_shift' AS test, '{c}' AS feature FROM one" for c in FEATURES]
    rows += [f"SELECT '{t}', '{c}' FROM one" for t in ("ks", "psi") for c in NUMERIC]
    rows += [f"SELECT 'chi2', '{c}' FROM one" for c in NOMINAL]
    return with_ctes(TAGGED_CTES + ["one AS (SELECT 1 FROM tagged WHERE side = 'reference' LIMIT 1)"],
                     "SELECT test, feature, CAST(NULL AS DOUBLE) AS value, CAST(NULL AS BOOLEAN) AS drift_detected FROM ("
                     + "\nUNION ALL\n".join(rows) + ")")


@register("drift_empty_side", _empty_side_sql())
def q_drift_empty_side(spark, sf_dir):
    """All tests against a current side without rows (that is the feature):
    not computed, so null, never an error and never "no drift"."""
    from pyspark.sql import functions as F
    ref = tagged_sessions(spark, sf_dir).where(F.col("side") == D.REF)
    parts = [(D.mean_shift(ref, FEATURES), "mean_shift", "mean_diff"), (D.ks_test(ref, NUMERIC), "ks", "p_value"),
             (D.psi(ref, NUMERIC), "psi", "psi"), (D.chi2_test(ref, NOMINAL), "chi2", "p_value")]
    rows = [df.select(F.lit(t).alias("test"), "feature", F.col(v).cast("double").alias("value"), "drift_detected") for df, t, v in parts]
    out = rows[0]
    for r in rows[1:]:
        out = out.unionByName(r)
    return out


_HALVES = SESSIONS_CTES + [
    "mid AS (SELECT CAST(floor(median(session_date - DATE '1970-01-01')) AS INTEGER) AS d FROM sessions)",
    "halves AS (SELECT s.*, CASE WHEN session_date - DATE '1970-01-01' <= mid.d THEN 'reference' ELSE 'current' END AS side FROM sessions s, mid)"]


@register("drift_two_frames", with_ctes(_HALVES + ["ms AS (" + "\nUNION ALL\n".join(
    f"""SELECT '{c}' AS feature, AVG({c}) FILTER (WHERE side = 'reference') AS rm, AVG({c}) FILTER (WHERE side = 'current') AS cm,
  STDDEV_SAMP({c}) FILTER (WHERE side = 'reference') AS rs FROM halves""" for c in NUMERIC) + ")"], """
SELECT feature, ROUND(rm, 6) AS ref_mean, ROUND(cm, 6) AS curr_mean, ROUND(ABS(cm - rm), 6) AS mean_diff,
       ROUND(rs, 6) AS ref_std, CASE WHEN rm IS NULL OR cm IS NULL THEN NULL WHEN rs > 0 THEN ABS(cm - rm) > 0.1 * rs
       ELSE FALSE END AS drift_detected, 'distance' AS direction FROM ms"""))
def q_drift_two_frames(spark, sf_dir):
    """U2 + D1: two frames, the sessions up to the median day and those after
    it, tagged and stacked, then compared."""
    from pyspark.sql import functions as F
    s = load_sessions(spark, sf_dir)
    mid = s.agg(F.floor(F.median(F.unix_date("session_date"))).cast("int")).first()[0]
    early = F.unix_date("session_date") <= F.lit(mid)
    cols = [c for c in s.columns if c in NUMERIC]
    return D.mean_shift(D.stack_sides(s.where(early).select(*cols), s.where(~early).select(*reversed(cols))), NUMERIC)
