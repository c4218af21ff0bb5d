"""Classification metrics as DataFrame queries.

Inputs are a ``(label, score, prediction[, group])`` table.  Threshold
metrics are single aggregates.  Ranking metrics first collapse to one row per
distinct (group, score) (partial aggregation), then take exact "score below"
totals with :func:`running_totals` over approximate-quantile buckets, so no
single-task global window is needed at any size.

Conventions (scikit-learn's): 0/0 -> 0 for precision/recall/F1; AUC is null
when a class is absent; AP = sum over thresholds of (R_n - R_{n-1}) * P_n.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickscope.functions.columns import r6, safe_div
from clickscope.functions.windows import SINGLE_TASK_ROWS, running_totals, search_bucket
from clickscope.operators.runlog import asof_join
from clickscope.session import cut_lineage

#: Most cut points of a running total (two buckets for each task's worth of rows).
MOST_BUCKETS = 4096


def _counts(label: Column, pred: Column) -> list[Column]:
    return [F.count(F.lit(1)).alias("n"),
            F.count_if((label == 1) & (pred == 1)).alias("tp"),
            F.count_if((label == 0) & (pred == 1)).alias("fp"),
            F.count_if((label == 0) & (pred == 0)).alias("tn"),
            F.count_if((label == 1) & (pred == 0)).alias("fn")]


def _rates() -> list[Column]:
    tp, fp, tn, fn = (F.col(c) for c in ("tp", "fp", "tn", "fn"))
    precision = safe_div(tp, tp + fp)
    recall = safe_div(tp, tp + fn)
    f1 = safe_div(2 * tp, 2 * tp + fp + fn)
    return [r6(safe_div(tp + tn, F.col("n"))).alias("accuracy"), r6(precision).alias("precision"),
            r6(recall).alias("recall"), r6(f1).alias("f1")]


def confusion(scored: DataFrame, label: str = "label", pred: str = "prediction") -> DataFrame:
    """The four cells (actual, predicted, n), zero cells included."""
    c = scored.agg(*_counts(F.col(label), F.col(pred)))
    cells = [(0, 0, "tn"), (0, 1, "fp"), (1, 0, "fn"), (1, 1, "tp")]
    return c.select(F.inline(F.array(*[
        F.struct(F.lit(a).alias("actual"), F.lit(p).alias("predicted"), F.col(v).alias("n"))
        for a, p, v in cells])))


def binary_metrics(scored: DataFrame, label: str = "label", pred: str = "prediction") -> DataFrame:
    """Accuracy, precision, recall, F1 of class 1 (one aggregate)."""
    c = scored.agg(*_counts(F.col(label), F.col(pred)))
    return c.select("n", "tp", "fp", "tn", "fn", *_rates())


def subgroup_metrics(scored: DataFrame, group: str, label: str = "label",
                     pred: str = "prediction") -> DataFrame:
    """E2 inside each subgroup plus the overall row ('All'), one
    GROUPING SETS pass."""
    g = scored.groupingSets([[group], []], group).agg(
        *_counts(F.col(label), F.col(pred)), F.grouping(group).alias("__g"))
    return g.select(F.when(F.col("__g") == 1, F.lit("All")).otherwise(F.col(group)).alias(group),
                    "n", "tp", "fp", "tn", "fn", *_rates())


def class_report(scored: DataFrame, label: str = "label", pred: str = "prediction") -> DataFrame:
    """Per-class precision/recall/F1/support, accuracy, macro and
    weighted averages (five rows, from one aggregate)."""
    c = scored.agg(*_counts(F.col(label), F.col(pred)))
    tp, fp, tn, fn, n = (F.col(x) for x in ("tp", "fp", "tn", "fn", "n"))
    # class 1 is positive as is; class 0 swaps roles
    p1, r1, f1_1 = safe_div(tp, tp + fp), safe_div(tp, tp + fn), safe_div(2 * tp, 2 * tp + fp + fn)
    p0, r0, f1_0 = safe_div(tn, tn + fn), safe_div(tn, tn + fp), safe_div(2 * tn, 2 * tn + fn + fp)
    s1, s0 = tp + fn, tn + fp

    def row(name, p, r, f, s):
        return F.struct(F.lit(name).alias("class"), r6(p).alias("precision"),
                        r6(r).alias("recall"), r6(f).alias("f1"), s.cast("long").alias("support"))

    return c.select(F.inline(F.array(
        row("0", p0, r0, f1_0, s0),
        row("1", p1, r1, f1_1, s1),
        row("accuracy", F.lit(None).cast("double"), F.lit(None).cast("double"),
            safe_div(tp + tn, n), n),
        row("macro avg", (p0 + p1) / 2, (r0 + r1) / 2, (f1_0 + f1_1) / 2, n),
        row("weighted avg", safe_div(p0 * s0 + p1 * s1, n), safe_div(r0 * s0 + r1 * s1, n),
            safe_div(f1_0 * s0 + f1_1 * s1, n), n))))


def score_steps(scored: DataFrame, label: str = "label", score: str = "score",
                groups: Sequence[str] = (), n_buckets: int | None = None,
                single_task_rows: int = SINGLE_TASK_ROWS) -> DataFrame:
    """One row per distinct (group, score) with pos/neg counts, exact totals
    strictly below the score (``pos_below``/``neg_below``) and group totals
    ``P``/``N``.  The basis of ROC, PR, AUC and AP."""
    g = list(groups)
    d = (scored.filter(F.col(score).isNotNull() & F.col(label).isNotNull())
         .groupBy(*g, score).agg(F.count_if(F.col(label) == 1).alias("pos"),
                                 F.count_if(F.col(label) == 0).alias("neg")))
    d = cut_lineage(d, "score-steps")              # read for its size, its cut points and its totals
    t = d.agg(F.count(F.lit(1)).alias("rows"), F.sum("pos").alias("P"), F.sum("neg").alias("N")).first()
    bucket = None
    if (t["rows"] or 0) > single_task_rows:
        n = n_buckets or min(MOST_BUCKETS, 2 * -(-t["rows"] // max(1, single_task_rows)))
        q = d.agg(F.percentile_approx(score, [i / n for i in range(1, n)] or [0.5], 10 * n)).first()[0]
        bucket = "__b"
        d = d.withColumn("__b", search_bucket(F.col(score), sorted(set(q or []))))
    r = running_totals(d, g, bucket, [score], {"pos_below": F.col("pos"),
                                               "neg_below": F.col("neg")}, inclusive=False)
    if g:
        tot = d.groupBy(*g).agg(F.sum("pos").alias("P"), F.sum("neg").alias("N"))
        r = r.join(tot, g)  # one row per group; AQE broadcasts after measuring
    else:
        r = r.withColumn("P", F.lit(t["P"] or 0)).withColumn("N", F.lit(t["N"] or 0))
    return r.drop("__b") if bucket else r


def roc_auc(scored: DataFrame, label: str = "label", score: str = "score",
            groups: Sequence[str] = (), n_buckets: int | None = None,
            single_task_rows: int = SINGLE_TASK_ROWS) -> DataFrame:
    """Exact ROC-AUC (ties count one half), rank-sum form."""
    s = score_steps(scored, label, score, groups, n_buckets, single_task_rows)
    g = list(groups)
    agg = s.groupBy(*g).agg(
        F.sum(F.col("pos") * (F.col("neg_below") + F.col("neg") / 2.0)).alias("__num"),
        F.first("P").alias("n_pos"), F.first("N").alias("n_neg"))
    auc = F.when((F.col("n_pos") > 0) & (F.col("n_neg") > 0),
                 F.col("__num") / (F.col("n_pos").cast("double") * F.col("n_neg")))
    return agg.select(*g, r6(auc).alias("auc"), F.col("n_pos").cast("long").alias("n_pos"),
                      F.col("n_neg").cast("long").alias("n_neg"))


def roc_curve(scored: DataFrame, label: str = "label", score: str = "score",
              n_buckets: int | None = None,
              single_task_rows: int = SINGLE_TASK_ROWS) -> DataFrame:
    """E5: one point per distinct score (predict 1 when score >= threshold)
    plus the origin (threshold null)."""
    s = score_steps(scored, label, score, (), n_buckets, single_task_rows)
    tp = (F.col("P") - F.col("pos_below")).cast("long")
    fp = (F.col("N") - F.col("neg_below")).cast("long")
    pts = s.select(F.col(score).alias("threshold"), tp.alias("tp"), fp.alias("fp"),
                   r6(safe_div(tp, F.col("P"), None)).alias("tpr"),
                   r6(safe_div(fp, F.col("N"), None)).alias("fpr"))
    origin = scored.sparkSession.range(1).select(
        F.lit(None).cast("double").alias("threshold"), F.lit(0).cast("long").alias("tp"),
        F.lit(0).cast("long").alias("fp"), F.lit(0.0).alias("tpr"), F.lit(0.0).alias("fpr"))
    return pts.unionByName(origin)


def pr_curve(scored: DataFrame, label: str = "label", score: str = "score",
             n_buckets: int | None = None,
             single_task_rows: int = SINGLE_TASK_ROWS) -> DataFrame:
    """E6 points: precision/recall per distinct threshold plus the end point
    (recall 0, precision 1, threshold null)."""
    s = score_steps(scored, label, score, (), n_buckets, single_task_rows)
    tp = F.col("P") - F.col("pos_below")
    fp = F.col("N") - F.col("neg_below")
    pts = s.select(F.col(score).alias("threshold"),
                   r6(safe_div(tp, tp + fp)).alias("precision"),
                   r6(safe_div(tp, F.col("P"))).alias("recall"))
    end = scored.sparkSession.range(1).select(
        F.lit(None).cast("double").alias("threshold"), F.lit(1.0).alias("precision"),
        F.lit(0.0).alias("recall"))
    return pts.unionByName(end)


def average_precision(scored: DataFrame, label: str = "label", score: str = "score",
                      groups: Sequence[str] = (), n_buckets: int | None = None,
                      single_task_rows: int = SINGLE_TASK_ROWS) -> DataFrame:
    """AP = sum over distinct thresholds of (pos_at_threshold / P) * precision."""
    s = score_steps(scored, label, score, groups, n_buckets, single_task_rows)
    g = list(groups)
    tp = F.col("P") - F.col("pos_below")
    fp = F.col("N") - F.col("neg_below")
    prec = safe_div(tp, tp + fp)
    agg = s.groupBy(*g).agg(F.sum(F.col("pos") * prec).alias("__s"), F.first("P").alias("__p"))
    return agg.select(*g, r6(F.when(F.col("__p") > 0, F.col("__s") / F.col("__p")))
                      .alias("average_precision"))


def weekly_auc_drop(scored: DataFrame, date_col: str, label: str, score: str,
                    max_drop: float = 0.05, baselines: DataFrame | None = None) -> DataFrame:
    """AUC per 7-day window (epoch-aligned) against a training AUC; alert
    when the drop exceeds ``max_drop``.

    ``baselines``: ``started_at, auc`` of the training runs (the run log); each
    week is compared with the last run started by its first day, a week before
    any run with none.  Without it the first week's AUC is the baseline."""
    week = F.date_from_unix_date((F.floor(F.unix_date(F.col(date_col)) / 7) * 7).cast("int"))
    weekly = scored.withColumn("week_start", week)
    n = weekly.groupBy("week_start").agg(F.count(F.lit(1)).alias("n"))
    per = roc_auc(weekly, label, score, ["week_start"]).join(n, "week_start").select("week_start", "n", "auc")
    if baselines is None:
        per = cut_lineage(per, "weekly-auc")
        baselines = per.orderBy("week_start").limit(1).select(F.col("week_start").alias("started_at"), "auc")
    base = baselines.select("started_at", F.col("auc").alias("baseline_auc"))
    out = asof_join(per, base, "week_start", "started_at", ["baseline_auc"]).withColumn("auc_drop", r6(F.col("baseline_auc") - F.col("auc")))
    # without a baseline or an AUC nothing was compared: null
    return out.withColumn("alert", F.col("auc_drop") > max_drop)
