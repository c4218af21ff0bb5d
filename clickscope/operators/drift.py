"""Drift between a reference and a current side.

Every operator takes ONE frame tagged with a side column (``stack_sides``
builds it from two frames), so each statistic is one grouped pass over the
data instead of one pass per side and per feature.  p-values are closed-form
expressions evaluated in SQL (identical text in Spark and in the DuckDB
oracle); each output row says which direction means drift.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clickscope.functions.columns import r6
from clickscope.functions.quantiles import quantile_columns
from clickscope.functions.windows import grouped_quantile_bucket, running_totals
from clickscope.session import cut_lineage

REF, CUR = "reference", "current"
# Decile probabilities of the PSI bins, share floor, alert level.
PSI_PROBS = (0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9)
PSI_FLOOR = 1e-4
PSI_ALERT = 0.2


def stack_sides(ref: DataFrame, cur: DataFrame, side_col: str = "side") -> DataFrame:
    """Tag and stack two frames (by column name)."""
    return (ref.withColumn(side_col, F.lit(REF))
            .unionByName(cur.withColumn(side_col, F.lit(CUR)), allowMissingColumns=True))


def _side_moments(tagged: DataFrame, cols: Sequence[str], side_col: str) -> DataFrame:
    wide = tagged.groupBy(side_col).agg(*[x for c in cols for x in (
        F.avg(c).alias(f"{c}__m"), F.stddev_samp(c).alias(f"{c}__s"), F.count(c).alias(f"{c}__n"))])
    return wide.select(side_col, F.inline(F.array(*[
        F.struct(F.lit(c).alias("feature"), F.col(f"{c}__m").cast("double").alias("mean"),
                 F.col(f"{c}__s").cast("double").alias("std"), F.col(f"{c}__n").alias("n"))
        for c in cols])))


def mean_shift(tagged: DataFrame, cols: Sequence[str], side_col: str = "side",
               threshold: float = 0.1) -> DataFrame:
    """Drift iff |mean_cur - mean_ref| > threshold * std_ref; a zero or
    null reference std means no drift, a side without values null.  One aggregate for both sides; the
    sides meet on the tiny (feature) frame (J4)."""
    m = _side_moments(tagged, cols, side_col)
    p = m.groupBy("feature").agg(
        F.max(F.when(F.col(side_col) == REF, F.col("mean"))).alias("ref_mean"),
        F.max(F.when(F.col(side_col) == CUR, F.col("mean"))).alias("curr_mean"),
        F.max(F.when(F.col(side_col) == REF, F.col("std"))).alias("ref_std"))
    diff = F.abs(F.col("curr_mean") - F.col("ref_mean"))
    # a side without values: not computed, which is null and never "no drift"
    drift = F.when(diff.isNull(), F.lit(None).cast("boolean")).when(
        F.col("ref_std") > 0, diff > F.lit(threshold) * F.col("ref_std")).otherwise(F.lit(False))
    return p.select("feature", r6("ref_mean").alias("ref_mean"), r6("curr_mean").alias("curr_mean"),
                    r6(diff).alias("mean_diff"), r6("ref_std").alias("ref_std"),
                    drift.alias("drift_detected"),
                    F.lit("distance").alias("direction"))


def ks_pvalue_sql(lam: str = "lam", terms: int = 100) -> str:
    """Asymptotic two-sample KS p-value Q(lam) = 2 sum (-1)^(k-1) exp(-2 k^2 lam^2)
    as SQL text (same in Spark and DuckDB); 1 for lam < 0.05, clamped to [0, 1]."""
    series = f"exp(-2.0 * {lam} * {lam})"
    for k in range(2, terms + 1):
        series += f" {'-' if k % 2 == 0 else '+'} exp(-{2 * k * k}.0 * {lam} * {lam})"
    return f"CASE WHEN {lam} < 0.05 THEN 1.0 ELSE least(greatest(2.0 * ({series}), 0.0), 1.0) END"


def ks_test(tagged: DataFrame, cols: Sequence[str], side_col: str = "side",
            alpha: float = 0.05, n_buckets: int | None = None,
            single_task_rows: int | None = None) -> DataFrame:
    """D3: two-sample Kolmogorov-Smirnov per numeric column.

    (feature, value) pairs are pre-aggregated to per-side counts (map-side
    combine), then exact ECDFs via running totals over per-feature quantile
    buckets, D = max |F_ref - F_cur|.
    """
    long = (tagged.select(side_col, F.inline(F.array(*[
        F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("value")) for c in cols])))
        .filter(F.col("value").isNotNull()))
    d = long.groupBy("feature", "value").agg(
        F.count_if(F.col(side_col) == REF).alias("n_r"),
        F.count_if(F.col(side_col) == CUR).alias("n_c"))
    d = cut_lineage(d, "ks-values")                # read for its cut points, its totals and its sums
    b = grouped_quantile_bucket(d, "feature", "value", n_buckets,
                                single_task_rows=single_task_rows)
    if b is not None:
        d = d.withColumn("__b", b)
    r = running_totals(d, ["feature"], "__b" if b is not None else None, ["value"],
                       {"cum_r": F.col("n_r"), "cum_c": F.col("n_c")})
    # Spark names are case-insensitive: totals must not be called N_r/N_c
    tot = d.groupBy("feature").agg(F.sum("n_r").alias("tot_r"), F.sum("n_c").alias("tot_c"))
    gap = F.abs(F.try_divide("cum_r", "tot_r") - F.try_divide("cum_c", "tot_c"))
    stat = (r.join(F.broadcast(tot), "feature")  # one row per feature
            .groupBy("feature").agg(F.max(gap).alias("ks_stat"),
                                    F.first("tot_r").alias("n_ref"), F.first("tot_c").alias("n_cur")))
    en = F.sqrt(F.col("n_ref") * F.col("n_cur") / (F.col("n_ref") + F.col("n_cur")))
    lam = (en + 0.12 + F.try_divide(F.lit(0.11), en)) * F.col("ks_stat")
    out = stat.withColumn("lam", lam).withColumn("p_value", F.when(F.col("lam").isNotNull(), F.expr(ks_pvalue_sql("lam"))))
    return out.select("feature", F.col("n_ref").cast("long").alias("n_ref"),
                      F.col("n_cur").cast("long").alias("n_cur"),
                      r6("ks_stat").alias("ks_stat"), r6("p_value").alias("p_value"),
                      (F.col("p_value") < alpha).alias("drift_detected"),
                      F.lit("p_value").alias("direction"))


_ERFC_COEF = (-1.26551223, 1.00002368, 0.37409196, 0.09678418, -0.18628806,
              0.27886807, -1.13520398, 1.48851587, -0.82215223, 0.17087277)


def erfc_sql(z: str) -> str:
    """Complementary error function for z >= 0 (Chebyshev fit, fractional
    error < 1.2e-7), as SQL text."""
    t = f"(1.0 / (1.0 + 0.5 * {z}))"
    poly = repr(_ERFC_COEF[-1])
    for c in reversed(_ERFC_COEF[:-1]):
        poly = f"({c!r} + {t} * {poly})"
    # poly now starts with the constant term
    return f"({t} * exp(-({z}) * ({z}) + {poly}))"


#: Degrees of freedom up to which the tail is summed; beyond, its uniform
#: expansion is off by under 1e-6, at most this many steps before it.
SERIES_DOF = 20_000
# First coefficients of the expansion's correction around 0.
_NEAR_ONE = (-1 / 3, 1 / 12, -2 / 135, 1 / 864, 1 / 2835)


def chi2_tail_large_sql(x: str = "chi2", k: str = "dof") -> str:
    """Upper tail for many degrees of freedom, in constant steps: the uniform
    asymptotic expansion of the incomplete gamma function,
    ``erfc(eta sqrt(a / 2)) / 2`` plus one correction, with ``a = dof / 2``,
    ``mu = x / dof - 1`` and ``eta^2 / 2 = mu - ln(1 + mu)``."""
    a, mu = f"(CAST({k} AS DOUBLE) / 2.0)", f"(CAST({x} AS DOUBLE) / CAST({k} AS DOUBLE) - 1.0)"
    eta = f"(sign({mu}) * sqrt(greatest(2.0 * ({mu} - log1p({mu})), 0.0)))"
    z = f"(abs({eta}) * sqrt({a} / 2.0))"
    near = repr(_NEAR_ONE[-1])
    for c in reversed(_NEAR_ONE[:-1]):
        near = f"({c!r} + {eta} * {near})"
    correction = f"(CASE WHEN abs({eta}) < 0.05 THEN {near} ELSE 1.0 / {mu} - 1.0 / {eta} END)"
    normal = f"(CASE WHEN {eta} >= 0 THEN 0.5 * {erfc_sql(z)} ELSE 1.0 - 0.5 * {erfc_sql(z)} END)"
    return f"({normal} + exp(-{z} * {z}) / sqrt({2 * math.pi!r} * {a}) * {correction})"


def chi2_pvalue_sql(x: str = "chi2", k: str = "dof") -> str:
    """Upper tail Q(k/2, x/2) of the chi-square distribution for any integer
    dof, as Spark SQL text.  Up to ``SERIES_DOF`` the closed-form series (even
    dof: Poisson sum; odd dof: erfc plus half-integer terms) folded with
    ``aggregate`` over ``sequence``: each term is the previous one times h/i in
    log space, so no log-gamma function is needed and nothing overflows.
    Beyond, :func:`chi2_tail_large_sql`: constant time and memory."""
    h = f"(CAST({x} AS DOUBLE) / 2.0)"
    m_even = f"CAST({k} DIV 2 AS INT)"
    m_odd = f"CAST(({k} - 1) DIV 2 AS INT)"
    step = "named_struct('lt', a.lt + ln({h}) - ln({d}), 's', a.s + exp(a.lt))"
    even = (f"aggregate(sequence(1, {m_even}), named_struct('lt', -{h}, 's', CAST(0 AS DOUBLE)), "
            f"(a, i) -> {step.format(h=h, d='i')}, a -> a.s)")
    odd_start = f"-{h} + 0.5 * ln({h}) - {math.lgamma(1.5)!r}"
    odd = (f"CASE WHEN {k} < 3 THEN CAST(0 AS DOUBLE) ELSE "
           f"aggregate(sequence(1, {m_odd}), named_struct('lt', {odd_start}, 's', CAST(0 AS DOUBLE)), "
           f"(a, i) -> {step.format(h=h, d='i + 0.5')}, a -> a.s) END")
    return (f"CASE WHEN {k} IS NULL OR {k} < 1 OR {x} IS NULL THEN NULL WHEN {x} <= 0 THEN 1.0 "
            f"WHEN {k} > {SERIES_DOF} THEN least(greatest({chi2_tail_large_sql(x, k)}, 0.0), 1.0) "
            f"WHEN {k} % 2 = 0 THEN least(greatest({even}, 0.0), 1.0) "
            f"ELSE least(greatest({erfc_sql(f'sqrt({h})')} + {odd}, 0.0), 1.0) END")


def chi2_pvalue_duck(x: str = "chi2", k: str = "dof") -> str:
    """The same upper tail as DuckDB SQL for the oracle, written
    independently: each series term from ``lgamma`` directly."""
    h = f"(CAST({x} AS DOUBLE) / 2.0)"
    even = (f"list_sum(list_transform(range(0, CAST({k} // 2 AS BIGINT)), "
            f"lambda i: exp(-{h} + i * ln({h}) - lgamma(i + 1))))")
    odd = (f"coalesce(list_sum(list_transform(range(1, CAST(({k} - 1) // 2 + 1 AS BIGINT)), "
           f"lambda i: exp(-{h} + (i - 0.5) * ln({h}) - lgamma(i + 0.5)))), 0.0)")
    return (f"CASE WHEN {k} IS NULL OR {k} < 1 OR {x} IS NULL THEN NULL WHEN {x} <= 0 THEN 1.0 "
            f"WHEN {k} % 2 = 0 THEN least(greatest({even}, 0.0), 1.0) "
            f"ELSE least(greatest({erfc_sql(f'sqrt({h})')} + {odd}, 0.0), 1.0) END")


def chi2_test(tagged: DataFrame, cols: Sequence[str], side_col: str = "side",
              alpha: float = 0.05) -> DataFrame:
    """Chi-square test of category x side per nominal column, over every
    category (no pooling, no cap).

    (feature, category) counts are aggregated map-side; per-feature side
    totals come from a second aggregate of one row per feature (a size fixed
    by the caller's column list, so broadcasting it is bounded); the
    statistic is a plain grouped sum, so no task ever holds a feature's
    whole category list.
    """
    long = tagged.select(side_col, F.inline(F.array(*[
        F.struct(F.lit(c).alias("feature"), F.col(c).cast("string").alias("category"))
        for c in cols]))).filter(F.col("category").isNotNull())
    cnt = long.groupBy("feature", "category").agg(
        F.count_if(F.col(side_col) == REF).alias("o_r"),
        F.count_if(F.col(side_col) == CUR).alias("o_c"))
    tot = cnt.groupBy("feature").agg(F.sum("o_r").alias("R"), F.sum("o_c").alias("C"),
                                     (F.count(F.lit(1)) - 1).alias("dof"))
    e = cnt.join(F.broadcast(tot), "feature").withColumn("t", F.col("o_r") + F.col("o_c"))
    e = (e.withColumn("e_r", F.col("t") * F.col("R") / (F.col("R") + F.col("C")))
          .withColumn("e_c", F.col("t") * F.col("C") / (F.col("R") + F.col("C"))))
    term = (F.try_divide((F.col("o_r") - F.col("e_r")) ** 2, "e_r")
            + F.try_divide((F.col("o_c") - F.col("e_c")) ** 2, "e_c"))
    s = e.groupBy("feature", "R", "C", "dof").agg(F.sum(term).alias("chi2")).select(
        "feature", "dof", F.when((F.col("R") > 0) & (F.col("C") > 0), F.col("chi2")).alias("chi2"))
    s = s.withColumn("p_value", F.expr(chi2_pvalue_sql("chi2", "dof")))
    return s.select("feature", r6("chi2").alias("chi2"), F.col("dof").cast("long").alias("dof"),
                    r6("p_value").alias("p_value"),
                    (F.col("p_value") < alpha).alias("drift_detected"),
                    F.lit("p_value").alias("direction"))


def pvalue_summary(tagged: DataFrame, numeric: Sequence[str], categorical: Sequence[str],
                   side_col: str = "side", alpha: float = 0.05) -> DataFrame:
    """One p-value test per column -- two-sample KS for ``numeric``,
    chi-square for ``categorical`` (nominal codes and 0/1 columns, the target
    and a model's prediction included) -- in the reference's record shape:
    feature, ref_mean, curr_mean, mean_diff, drift_detected (p < alpha; null
    without a p-value), plus the method and the p-value itself.

    The two tests and the side means are the grouped passes of
    :func:`ks_test`, :func:`chi2_test` and one wide aggregate; they meet on
    frames of one row per feature.
    """
    tests = []
    if numeric:
        tests.append(ks_test(tagged, numeric, side_col, alpha)
                     .select("feature", F.lit("ks").alias("method"), "p_value", "drift_detected"))
    if categorical:
        tests.append(chi2_test(tagged, categorical, side_col, alpha)
                     .select("feature", F.lit("chi2").alias("method"), "p_value", "drift_detected"))
    t = tests[0]
    for x in tests[1:]:
        t = t.unionByName(x)
    m = _side_moments(tagged, [*numeric, *categorical], side_col)
    means = m.groupBy("feature").agg(
        F.max(F.when(F.col(side_col) == REF, F.col("mean"))).alias("ref_mean"),
        F.max(F.when(F.col(side_col) == CUR, F.col("mean"))).alias("curr_mean"))
    diff = F.abs(F.col("curr_mean") - F.col("ref_mean"))
    return t.join(means, "feature").select(
        "feature", "method", r6("ref_mean").alias("ref_mean"), r6("curr_mean").alias("curr_mean"),
        r6(diff).alias("mean_diff"), "p_value",
        "drift_detected", F.lit("p_value").alias("direction"))


def psi(tagged: DataFrame, cols: Sequence[str], side_col: str = "side",
        alert: float = PSI_ALERT, floor: float = PSI_FLOOR, exact: bool = True) -> DataFrame:
    """Population stability index over reference-side decile bins.

    Bin = number of reference edges strictly below the value (0..9).  Shares
    are floored at ``floor``; PSI = sum (c - r) * ln(c / r).
    """
    ref = tagged.filter(F.col(side_col) == REF)
    dec = quantile_columns(ref, cols, PSI_PROBS, exact=exact)
    edges_wide = ref.agg(*[dec[c].alias(c) for c in cols])
    edges = cut_lineage(edges_wide.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("feature"), F.col(c).alias("edges")) for c in cols]))), "psi-edges")
    long = (tagged.select(side_col, F.inline(F.array(*[
        F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("value")) for c in cols])))
        .filter(F.col("value").isNotNull()))
    # one row per feature (a bound fixed by the caller's column list)
    binned = long.join(F.broadcast(edges), "feature").withColumn(
        "bin", F.size(F.filter("edges", lambda x: x < F.col("value"))))
    cnt = binned.groupBy("feature", "bin").agg(
        F.count_if(F.col(side_col) == REF).alias("n_r"),
        F.count_if(F.col(side_col) == CUR).alias("n_c"))
    grid = edges.select("feature", F.explode(F.sequence(F.lit(0), F.lit(len(PSI_PROBS))))
                        .alias("bin"))
    full = grid.join(cnt, ["feature", "bin"], "left").fillna(0, ["n_r", "n_c"])
    w = Window.partitionBy("feature")
    # a side without values has no shares: null, not the floor
    r, c = (F.when(F.sum(n).over(w) > 0, F.greatest(F.try_divide(F.col(n), F.sum(n).over(w)), F.lit(floor))) for n in ("n_r", "n_c"))
    out = (full.withColumn("term", (c - r) * F.log(c / r))
           .groupBy("feature").agg(F.sum("term").alias("psi")))
    return out.select("feature", r6("psi").alias("psi"), (F.col("psi") > alert).alias("drift_detected"),
                      F.lit("distance").alias("direction"))


def drift_rollup(summary: DataFrame) -> DataFrame:
    """Number of features, drifted count, any-alert flag.  An empty
    summary (drift not computed) gives nulls, never 'no drift'."""
    return summary.agg(F.count(F.lit(1)).alias("n_features"),
                       F.count_if(F.col("drift_detected")).alias("n_drifted"),
                       F.bool_or("drift_detected").alias("any_drift"))
