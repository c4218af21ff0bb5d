"""Queries: classification metrics over the ``scored`` fixture."""

from __future__ import annotations

import datetime
import os
import uuid

from pyspark.sql import functions as F

from clickscope.operators import metrics as M
from clickscope.operators import quality as Q
from clickscope.operators import runlog as RL
from clickscope.plans.fixtures import load_sessions, scored_documents
from clickscope.plans.oracle import SCORED_CTES, SESSIONS_CTES, with_ctes
from clickscope.plans.registry import register
from clickscope.session import durable_dir

_COUNTS = """COUNT(*) AS n,
       COUNT(*) FILTER (WHERE label = 1 AND prediction = 1) AS tp,
       COUNT(*) FILTER (WHERE label = 0 AND prediction = 1) AS fp,
       COUNT(*) FILTER (WHERE label = 0 AND prediction = 0) AS tn,
       COUNT(*) FILTER (WHERE label = 1 AND prediction = 0) AS fn"""
_RATES = """ROUND(CASE WHEN n <> 0 THEN (tp + tn) * 1.0 / n ELSE 0 END, 6) AS accuracy,
       ROUND(CASE WHEN tp + fp <> 0 THEN tp * 1.0 / (tp + fp) ELSE 0 END, 6) AS precision,
       ROUND(CASE WHEN tp + fn <> 0 THEN tp * 1.0 / (tp + fn) ELSE 0 END, 6) AS recall,
       ROUND(CASE WHEN 2 * tp + fp + fn <> 0 THEN 2.0 * tp / (2 * tp + fp + fn) ELSE 0 END, 6) AS f1"""
STEPS_CTES = SCORED_CTES + [
    """d AS (SELECT score, COUNT(*) FILTER (WHERE label = 1) AS pos,
                 COUNT(*) FILTER (WHERE label = 0) AS neg FROM scored_p GROUP BY score)""",
    """steps AS (SELECT score, pos, neg,
       COALESCE(SUM(pos) OVER (ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS pos_below,
       COALESCE(SUM(neg) OVER (ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS neg_below,
       SUM(pos) OVER () AS P, SUM(neg) OVER () AS N FROM d)"""]


def _scored(spark, sf_dir):
    return scored_documents(spark, sf_dir)


@register("confusion", with_ctes(SCORED_CTES, """
SELECT label AS actual, prediction AS predicted, COUNT(s.doc_id) AS n
FROM (SELECT 0 AS label UNION ALL SELECT 1) a CROSS JOIN (SELECT 0 AS prediction UNION ALL SELECT 1) p
LEFT JOIN scored_p s USING (label, prediction) GROUP BY label, prediction"""))
def q_confusion(spark, sf_dir):
    return M.confusion(_scored(spark, sf_dir))


@register("binary_metrics", with_ctes(SCORED_CTES, f"""
SELECT n, tp, fp, tn, fn, {_RATES} FROM (SELECT {_COUNTS} FROM scored_p)"""))
def q_binary_metrics(spark, sf_dir):
    return M.binary_metrics(_scored(spark, sf_dir))


@register("subgroup_metrics", with_ctes(SCORED_CTES, f"""
SELECT subgroup, n, tp, fp, tn, fn, {_RATES} FROM (
  SELECT CASE WHEN GROUPING(subgroup) = 1 THEN 'All' ELSE subgroup END AS subgroup, {_COUNTS}
  FROM scored_p GROUP BY GROUPING SETS ((subgroup), ()))"""))
def q_subgroup_metrics(spark, sf_dir):
    return M.subgroup_metrics(_scored(spark, sf_dir), "subgroup")


def _div(a, b):
    return f"(CASE WHEN ({b}) <> 0 THEN ({a}) * 1.0 / ({b}) ELSE 0 END)"


@register("class_report", with_ctes(SCORED_CTES + [f"c AS (SELECT {_COUNTS} FROM scored_p)", f"""m AS (
  SELECT n, {_div('tp', 'tp + fp')} AS p1, {_div('tp', 'tp + fn')} AS r1, {_div('2 * tp', '2 * tp + fp + fn')} AS f1_1,
         {_div('tn', 'tn + fn')} AS p0, {_div('tn', 'tn + fp')} AS r0, {_div('2 * tn', '2 * tn + fn + fp')} AS f1_0,
         tp + fn AS s1, tn + fp AS s0, {_div('tp + tn', 'n')} AS acc FROM c)"""], """
SELECT '0' AS class, ROUND(p0, 6) AS precision, ROUND(r0, 6) AS recall, ROUND(f1_0, 6) AS f1, s0 AS support FROM m
UNION ALL SELECT '1', ROUND(p1, 6), ROUND(r1, 6), ROUND(f1_1, 6), s1 FROM m
UNION ALL SELECT 'accuracy', NULL, NULL, ROUND(acc, 6), n FROM m
UNION ALL SELECT 'macro avg', ROUND((p0 + p1) / 2, 6), ROUND((r0 + r1) / 2, 6), ROUND((f1_0 + f1_1) / 2, 6), n FROM m
UNION ALL SELECT 'weighted avg', ROUND((p0 * s0 + p1 * s1) / n, 6), ROUND((r0 * s0 + r1 * s1) / n, 6),
                 ROUND((f1_0 * s0 + f1_1 * s1) / n, 6), n FROM m"""))
def q_class_report(spark, sf_dir):
    return M.class_report(_scored(spark, sf_dir))


@register("roc_auc", with_ctes(STEPS_CTES, """
SELECT ROUND(CASE WHEN MAX(P) > 0 AND MAX(N) > 0
             THEN SUM(pos * (neg_below + neg / 2.0)) / (MAX(P) * 1.0 * MAX(N)) END, 6) AS auc,
       CAST(MAX(P) AS BIGINT) AS n_pos, CAST(MAX(N) AS BIGINT) AS n_neg FROM steps"""))
def q_roc_auc(spark, sf_dir):
    return M.roc_auc(_scored(spark, sf_dir))


@register("roc_curve", with_ctes(STEPS_CTES, """
SELECT score AS threshold, CAST(P - pos_below AS BIGINT) AS tp, CAST(N - neg_below AS BIGINT) AS fp,
       ROUND(CASE WHEN P <> 0 THEN (P - pos_below) * 1.0 / P END, 6) AS tpr,
       ROUND(CASE WHEN N <> 0 THEN (N - neg_below) * 1.0 / N END, 6) AS fpr FROM steps
UNION ALL SELECT NULL, 0, 0, 0.0, 0.0"""))
def q_roc_curve(spark, sf_dir):
    return M.roc_curve(_scored(spark, sf_dir))


@register("pr_curve", with_ctes(STEPS_CTES, """
SELECT score AS threshold,
       ROUND(CASE WHEN (P - pos_below) + (N - neg_below) <> 0
             THEN (P - pos_below) * 1.0 / ((P - pos_below) + (N - neg_below)) ELSE 0 END, 6) AS precision,
       ROUND(CASE WHEN P <> 0 THEN (P - pos_below) * 1.0 / P ELSE 0 END, 6) AS recall FROM steps
UNION ALL SELECT NULL, 1.0, 0.0"""))
def q_pr_curve(spark, sf_dir):
    return M.pr_curve(_scored(spark, sf_dir))


@register("average_precision", with_ctes(STEPS_CTES, """
SELECT ROUND(CASE WHEN MAX(P) > 0 THEN SUM(pos * CASE WHEN (P - pos_below) + (N - neg_below) <> 0
             THEN (P - pos_below) * 1.0 / ((P - pos_below) + (N - neg_below)) ELSE 0 END) / MAX(P) END, 6)
       AS average_precision FROM steps"""))
def q_average_precision(spark, sf_dir):
    return M.average_precision(_scored(spark, sf_dir))


_WEEK = "DATE '1970-01-01' + CAST(floor((session_date - DATE '1970-01-01') / 7) * 7 AS INTEGER)"


_WEEKLY_AUC = [
    f"""ws AS (SELECT {_WEEK} AS week_start, ad_clicked AS label, time_on_site AS score
             FROM sessions WHERE ad_clicked IS NOT NULL AND time_on_site IS NOT NULL)""",
    """wd AS (SELECT week_start, score, COUNT(*) FILTER (WHERE label = 1) AS pos,
                  COUNT(*) FILTER (WHERE label = 0) AS neg FROM ws GROUP BY 1, 2)""",
    """wc AS (SELECT *, COALESCE(SUM(neg) OVER (PARTITION BY week_start ORDER BY score
                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS neg_below FROM wd)""",
    """wa AS (SELECT week_start, ROUND(CASE WHEN SUM(pos) > 0 AND SUM(neg) > 0 THEN
                  SUM(pos * (neg_below + neg / 2.0)) / (SUM(pos) * 1.0 * SUM(neg)) END, 6) AS auc
             FROM wc GROUP BY week_start)""",
    "wn AS (SELECT week_start, COUNT(*) AS n FROM ws GROUP BY week_start)"]


@register("auc_drop_weekly", with_ctes(SESSIONS_CTES + _WEEKLY_AUC + ["wb AS (SELECT auc AS base FROM wa ORDER BY week_start LIMIT 1)"], """
SELECT wa.week_start, wn.n, wa.auc, wb.base AS baseline_auc, ROUND(wb.base - wa.auc, 6) AS auc_drop,
       ROUND(wb.base - wa.auc, 6) > 0.05 AS alert
FROM wa JOIN wn USING (week_start), wb"""))
def q_auc_drop_weekly(spark, sf_dir):
    """E8 on labelled sessions, with time on site as a fixed-formula score,
    against the first week."""
    return M.weekly_auc_drop(_weekly_scores(spark, sf_dir), "session_date", "label", "score", 0.05)


def _weekly_scores(spark, sf_dir):
    return (load_sessions(spark, sf_dir)
            .filter(F.col("ad_clicked").isNotNull() & F.col("time_on_site").isNotNull())
            .select("session_date", F.col("ad_clicked").alias("label"), F.col("time_on_site").alias("score")))


def log_training_runs(spark, sf_dir) -> str:
    """A run log of the given tables: a training run starts on the second day of
    every other week (from the first on) and records the AUC, the rows and the
    share of clicks of that week's sessions."""
    week = F.date_from_unix_date((F.floor(F.unix_date("session_date") / 7) * 7).cast("int"))
    s = _weekly_scores(spark, sf_dir).withColumn("week_start", week)
    facts = M.roc_auc(s, groups=["week_start"]).join(s.groupBy("week_start").agg(F.count(F.lit(1)).alias("n"), F.avg("label").alias("rate")), "week_start")
    root = os.path.join(durable_dir(spark), "runs", uuid.uuid4().hex)
    rows = facts.where(F.floor(F.unix_date("week_start") / 7) % 2 == 1).collect()          # a row a week
    for _ in range(2):                                                                     # a repeated run adds nothing
        for r in rows:
            name, day = f"train-{r['week_start']:%Y%m%d}", r["week_start"]
            RL.log_run(spark, root, name, datetime.datetime(day.year, day.month, day.day) + datetime.timedelta(days=1), {"algorithm": "fixed", "week": str(day)},
                       {"eval_roc_auc": r["auc"], "eval_rows": r["n"], "eval_click_rate": r["rate"]})
    return root


RUNS_CTES = SESSIONS_CTES + _WEEKLY_AUC + ["""runs AS (SELECT week_start, week_start + INTERVAL 1 DAY AS started_at, wa.auc, wn.n, r.rate
  FROM wa JOIN wn USING (week_start) JOIN (SELECT week_start, AVG(label) AS rate FROM ws GROUP BY 1) r USING (week_start)
  WHERE floor((week_start - DATE '1970-01-01') / 7) % 2 = 1)"""]


@register("auc_drop_vs_training", with_ctes(RUNS_CTES, """
SELECT wa.week_start, wn.n, wa.auc, runs.auc AS baseline_auc, ROUND(runs.auc - wa.auc, 6) AS auc_drop, ROUND(runs.auc - wa.auc, 6) > 0.05 AS alert
FROM wa JOIN wn USING (week_start) ASOF LEFT JOIN runs ON wa.week_start >= runs.started_at"""))
def q_auc_drop_vs_training(spark, sf_dir):
    """E8 against the run log: each week's AUC against that of the training run
    that was live when the week began; a week before any run has none."""
    runs = RL.read_runs(spark, log_training_runs(spark, sf_dir))
    base = runs.where("kind = 'metric' and key = 'eval_roc_auc'").select("started_at", F.col("value").alias("auc"))
    return M.weekly_auc_drop(_weekly_scores(spark, sf_dir), "session_date", "label", "score", 0.05, base)


@register("latest_run_metrics", with_ctes(RUNS_CTES, """
SELECT unnest(['ROC_AUC', 'ROWS', 'CLICK_RATE']) AS metric, ROUND(unnest([auc, CAST(n AS DOUBLE), rate]), 4) AS value
FROM (SELECT * FROM runs ORDER BY started_at DESC LIMIT 1)"""))
def q_latest_run_metrics(spark, sf_dir):
    """S6 + O4 + F10/F11: the latest run's metrics, names without 'eval_' and
    upper-cased, rounded to 4 places (the fitted forest's own record is
    ``model_run_log``)."""
    return RL.latest_run_metrics(RL.read_runs(spark, log_training_runs(spark, sf_dir)))


@register("run_metrics_map", with_ctes(RUNS_CTES, """
SELECT 'train-' || strftime(week_start, '%Y%m%d') AS run_id, 3 AS n_metrics, ROUND(auc, 4) AS auc, ROUND(rate, 4) AS click_rate, CAST(n AS BIGINT) AS n_rows FROM runs"""))
def q_run_metrics_map(spark, sf_dir):
    """a map of metrics per run."""
    m = RL.metrics_map(RL.read_runs(spark, log_training_runs(spark, sf_dir)))
    return m.select("run_id", F.size("metrics").alias("n_metrics"), F.col("metrics")["eval_roc_auc"].alias("auc"),
                    F.col("metrics")["eval_click_rate"].alias("click_rate"), F.col("metrics")["eval_rows"].cast("long").alias("n_rows"))


@register("rowcount_vs_log", with_ctes(RUNS_CTES, """
SELECT COUNT(*) AS n_rows, prev AS prev_rows, ROUND(ABS(COUNT(*) - prev) / prev, 6) AS deviation, ABS(COUNT(*) - prev) / prev > 0.1 AS alert
FROM ws, (SELECT CAST(n AS BIGINT) AS prev FROM runs ORDER BY started_at DESC LIMIT 1) WHERE ws.week_start = (SELECT max(week_start) FROM ws) GROUP BY prev"""))
def q_rowcount_vs_log(spark, sf_dir):
    """V5: rows of the last week against those that the last run recorded."""
    runs = RL.read_runs(spark, log_training_runs(spark, sf_dir))
    week = F.floor(F.unix_date("session_date") / 7)
    s = _weekly_scores(spark, sf_dir).withColumn("w", week)
    last = s.agg(F.max("w")).first()[0]
    now = F.lit(datetime.datetime(1970, 1, 1) + datetime.timedelta(days=7 * (last or 0) + 7))
    return Q.rowcount_against_log(s.where(F.col("w") == last), runs, now, "eval_rows")
