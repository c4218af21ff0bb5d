"""Column profiling.

Pattern everywhere: ONE wide aggregate over the table (partial aggregation in
every task, a tiny final merge), then reshape the one-row / few-row result
to long form.  Never unpivot the big table before aggregating, except where
(feature, value) pairs are the point (histograms, value counts), and there
the explode feeds a map-side partial aggregate in the same stage.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickscope.functions.columns import r6
from clickscope.functions.quantiles import quantile_columns

QUARTILES = (0.25, 0.5, 0.75)


def _inline(df: DataFrame, structs: list[Column]) -> DataFrame:
    """Turn one wide row into long rows (small frames only)."""
    return df.select(F.inline(F.array(*structs)))


def shape(df: DataFrame) -> DataFrame:
    """(n_rows, n_columns) as a one-row frame; dtypes come from the schema."""
    return df.agg(F.count(F.lit(1)).alias("n_rows")).withColumn(
        "n_columns", F.lit(len(df.columns)))


def head_rows(df: DataFrame, order_by: Sequence[str], n: int = 5) -> DataFrame:
    """O1: first n rows under a total order (TakeOrderedAndProject)."""
    return df.orderBy(*order_by).limit(n)


def describe(df: DataFrame, cols: Sequence[str], exact: bool = True,
             group: str | None = None) -> DataFrame:
    """A5: count, mean, std (n-1), min, quartiles (linear interpolation), max,
    optionally per group (D6: per drift side) in the same single pass.

    Not ``df.summary()``: its quartiles are approximate.
    """
    quart = quantile_columns(df, cols, QUARTILES, group=group, exact=exact)
    aggs = []
    for c in cols:
        aggs += [F.count(c).alias(f"{c}__n"), F.avg(c).alias(f"{c}__mean"),
                 F.stddev_samp(c).alias(f"{c}__std"), F.min(c).alias(f"{c}__min"),
                 quart[c].alias(f"{c}__q"), F.max(c).alias(f"{c}__max")]
    wide = df.groupBy(group).agg(*aggs) if group else df.agg(*aggs)
    lead = [F.col(group)] if group else []
    return wide.select(*lead, F.inline(F.array(*[F.struct(
        F.lit(c).alias("feature"),
        F.col(f"{c}__n").cast("long").alias("count"),
        r6(F.col(f"{c}__mean").cast("double")).alias("mean"),
        r6(F.col(f"{c}__std").cast("double")).alias("std"),
        r6(F.col(f"{c}__min").cast("double")).alias("min"),
        r6(F.col(f"{c}__q")[0].cast("double")).alias("p25"),
        r6(F.col(f"{c}__q")[1].cast("double")).alias("p50"),
        r6(F.col(f"{c}__q")[2].cast("double")).alias("p75"),
        r6(F.col(f"{c}__max").cast("double")).alias("max")) for c in cols])))


def missing_report(df: DataFrame, cols: Sequence[str] | None = None,
                   only_missing: bool = True) -> DataFrame:
    """A6 + P11 + O2: null count and percent per column, descending."""
    cols = list(cols or df.columns)
    wide = df.agg(F.count(F.lit(1)).alias("__n"),
                  *[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    long = _inline(wide, [F.struct(F.lit(c).alias("column"),
                                   F.col(c).cast("long").alias("missing_count"),
                                   F.col("__n").alias("n")) for c in cols])
    out = long.select("column", "missing_count",
                      r6(F.when(F.col("n") > 0, F.col("missing_count") * 100.0 / F.col("n")))
                      .alias("missing_percent"))
    if only_missing:
        out = out.filter(F.col("missing_count") > 0)
    return out.orderBy(F.desc("missing_count"), "column")


def missing_by_class(df: DataFrame, cols: Sequence[str], target: str) -> DataFrame:
    """Share of nulls per column inside each labelled class."""
    wide = (df.filter(F.col(target).isNotNull()).groupBy(target)
            .agg(*[F.avg(F.col(c).isNull().cast("double")).alias(c) for c in cols]))
    return _inline(wide, [F.struct(F.lit(c).alias("feature"),
                                   F.col(target).alias(target),
                                   r6(F.col(c)).alias("missing_rate")) for c in cols])


def value_counts(df: DataFrame, cols: Sequence[str], dropna: bool = False) -> DataFrame:
    """Counts per (feature, value), null key kept unless ``dropna``.

    The explode to (feature, value) feeds a partial hash aggregate in the
    same stage, so only (task x distinct value) rows are shuffled.
    """
    pairs = df.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("feature"), F.col(c).cast("string").alias("value"))
        for c in cols])))
    if dropna:
        pairs = pairs.filter(F.col("value").isNotNull())
    return (pairs.groupBy("feature", "value").agg(F.count(F.lit(1)).alias("n"))
            .orderBy("feature", F.desc("n"), "value"))


def value_shares(df: DataFrame, col: str, dropna: bool = False) -> DataFrame:
    """Relative frequency x 100; the ratio window runs on the aggregated
    frame (one row per distinct value), never on the table."""
    counts = df.groupBy(F.col(col).cast("string").alias("value")).agg(
        F.count(F.lit(1)).alias("n"))
    if dropna:
        counts = counts.filter(F.col("value").isNotNull())
    # the total is one fitted scalar: no window over all distinct values
    total = counts.agg(F.sum("n")).first()[0] or 0
    return counts.select("value", "n", r6(F.col("n") * 100.0 / F.lit(total)).alias("percent"))


def crosstab_margins(df: DataFrame, cat_cols: Sequence[str], target: str) -> DataFrame:
    """A10: crosstab of each category column against a binary target with
    row/column/grand totals ('All').  Null categories and unlabelled rows
    drop out, as in a pandas crosstab.

    One pass: GROUPING SETS ((feature, category), (feature)) with conditional
    counts replaces CUBE + PIVOT (no second shuffle).
    """
    long = (df.filter(F.col(target).isNotNull())
            .select(F.inline(F.array(*[
                F.struct(F.lit(c).alias("feature"), F.col(c).cast("string").alias("category"),
                         F.col(target).cast("double").alias("y")) for c in cat_cols])))
            .filter(F.col("category").isNotNull()))
    g = long.groupingSets([["feature", "category"], ["feature"]], "feature", "category").agg(
        F.count_if(F.col("y") == 0).alias("n_0"),
        F.count_if(F.col("y") == 1).alias("n_1"),
        F.count(F.lit(1)).alias("n_all"),
        F.grouping("category").alias("g"))
    return g.select("feature",
                    F.when(F.col("g") == 1, F.lit("All")).otherwise(F.col("category"))
                    .alias("category"), "n_0", "n_1", "n_all")


def class_rate_by_category(df: DataFrame, cat_cols: Sequence[str], target: str) -> DataFrame:
    """Positive rate per category of each nominal column plus a per-column
    margin 'All' (= the overall rate), GROUPING SETS in one pass."""
    long = (df.filter(F.col(target).isNotNull())
            .select(F.inline(F.array(*[
                F.struct(F.lit(c).alias("feature"), F.col(c).cast("string").alias("category"),
                         F.col(target).cast("double").alias("y")) for c in cat_cols]))))
    g = long.groupingSets([["feature", "category"], ["feature"]], "feature", "category").agg(
        F.count(F.lit(1)).alias("n"), F.sum("y").alias("positives"),
        F.grouping("category").alias("g"))
    return g.select(
        "feature",
        F.when(F.col("g") == 1, F.lit("All")).otherwise(F.col("category")).alias("category"),
        "n", F.col("positives").cast("long").alias("positives"),
        r6(F.col("positives") / F.col("n")).alias("rate"))


def class_counts(df: DataFrame, target: str) -> DataFrame:
    """Rows, positives, negatives and percent of each class."""
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(F.col(target).isNull()).alias("n_missing_target"),
        F.count(target).alias("n_labelled"),
        F.count_if(F.col(target) == 1).alias("n_positive"),
        F.count_if(F.col(target) == 0).alias("n_negative"),
    ).select("*",
             r6(F.try_divide(F.col("n_positive") * F.lit(100.0), F.col("n_labelled"))).alias("pct_positive"),
             r6(F.try_divide(F.col("n_negative") * F.lit(100.0), F.col("n_labelled"))).alias("pct_negative"))


def _nan_null(c: Column) -> Column:
    return F.nanvl(c, F.lit(None).cast("double"))


def corr_with_target(df: DataFrame, cols: Sequence[str], target: str) -> DataFrame:
    """Pearson r of each column with the target, pairwise-complete rows,
    labelled rows only; sorted descending."""
    lab = df.filter(F.col(target).isNotNull())
    wide = lab.agg(*[F.corr(c, target).alias(c) for c in cols])
    return (_inline(wide, [F.struct(F.lit(c).alias("feature"),
                                    r6(_nan_null(F.col(c))).alias("corr")) for c in cols])
            .orderBy(F.desc_nulls_last("corr"), "feature"))


def _pair_moments(cols: Sequence[str]):
    """Per task: for every pair the rows with both values, the mean of the
    first over them, and the (co)moments, as d x d matrix products of the
    masked columns; batches are merged by the pairwise update formula."""
    d = len(cols)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, mean, own, co = (np.zeros((d, d)) for _ in range(4))
        for b in batches:
            if not b.num_rows:
                continue
            x = np.stack([b.column(c).to_numpy(zero_copy_only=False).astype(np.float64) for c in cols], axis=1)
            has = ~np.isnan(x)
            mask = has.astype(np.float64)
            # about one of the values: small differences, and 0 for a constant
            shift = np.where(has.any(axis=0), x[has.argmax(axis=0), np.arange(d)], 0.0)
            x = np.where(has, x - shift, 0.0)
            m = mask.T @ mask
            one = np.maximum(m, 1)
            s = (x.T @ mask) / one                                # [i, j]: mean of i where j is there
            c = x.T @ x - m * s * s.T
            q = (x * x).T @ mask - m * s * s
            s = s + shift[:, None]
            total = np.maximum(n + m, 1)
            step = np.where(n > 0, s - mean, 0.0)
            weight = n * m / total
            own, co = own + q + step * step * weight, co + c + step * step.T * weight
            mean = np.where(n > 0, mean + (s - mean) * m / total, s)
            n = n + m
        i, j = np.nonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(v) for v in (i.astype(np.int32), j.astype(np.int32), n[i, j], mean[i, j], mean[j, i], own[i, j], own[j, i], co[i, j])],
                                         ["i", "j", "n", "mx", "my", "xx", "yy", "xy"])

    return run


def corr_matrix(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Full pairwise-complete correlation matrix in long form (nulls and
    NaN are absent).

    Each task adds up its rows' moments of all pairs by matrix products and
    returns one row per pair; those few rows (tasks x pairs) are merged per
    pair by the same update formula, free of cancellation.  Not
    ``ml.stat.Correlation``, which needs complete rows.
    """
    kind = "i int, j int, n double, mx double, my double, xx double, yy double, xy double"
    parts = df.select(*[F.col(c).cast("double").alias(c) for c in cols]).mapInArrow(_pair_moments(cols), kind)

    def merge(a, p):
        n = a["n"] + p["n"]
        dx, dy, w = p["mx"] - a["mx"], p["my"] - a["my"], a["n"] * p["n"] / n
        return F.struct(n.alias("n"), (a["mx"] + dx * p["n"] / n).alias("mx"), (a["my"] + dy * p["n"] / n).alias("my"), (a["xx"] + p["xx"] + dx * dx * w).alias("xx"),
                        (a["yy"] + p["yy"] + dy * dy * w).alias("yy"), (a["xy"] + p["xy"] + dx * dy * w).alias("xy"))

    moments = parts.groupBy("i", "j").agg(F.array_sort(F.collect_list(F.struct("n", "mx", "my", "xx", "yy", "xy"))).alias("l"))
    total = F.aggregate(F.slice("l", 2, F.size("l")), F.col("l")[0], merge)
    corr = F.when((F.col("t.xx") > 0) & (F.col("t.yy") > 0), F.greatest(F.lit(-1.0), F.least(F.lit(1.0), F.col("t.xy") / F.sqrt(F.col("t.xx") * F.col("t.yy")))))
    found = moments.select("i", "j", total.alias("t")).select("i", "j", r6(_nan_null(corr)).alias("corr"))
    names = df.sparkSession.createDataFrame([(i, j, a, b) for i, a in enumerate(cols) for j, b in enumerate(cols)], "i int, j int, feature_a string, feature_b string")
    return names.join(found, ["i", "j"], "left").select("feature_a", "feature_b", "corr")


def top_corr(df: DataFrame, cols: Sequence[str], target: str, k: int = 5) -> DataFrame:
    """O3: k strongest correlations with the target (by |r|), target excluded,
    signed value kept; feature name breaks ties."""
    c = corr_with_target(df, [x for x in cols if x != target], target)
    return (c.filter(F.col("corr").isNotNull())
            .orderBy(F.desc(F.abs("corr")), "feature").limit(k)
            .select("feature", "corr", F.abs("corr").alias("abs_corr")))


def histogram(df: DataFrame, cols: Sequence[str], bins: int = 30) -> DataFrame:
    """Equal-width bins over [min, max] per column, nulls dropped, last
    bin closed, empty bins present.  A constant column gets the range
    [v-0.5, v+0.5] (so it lands in the middle bin).

    Two passes: min/max (one aggregate), then bin index per value, exploded
    to (feature, bin) into a partial aggregate; empty bins from a
    ``sequence`` of the tiny per-feature frame.
    """
    mm = df.agg(*[x for c in cols for x in (F.min(c).alias(f"{c}__lo"),
                                            F.max(c).alias(f"{c}__hi"))]).first()
    edges = {}
    for c in cols:
        lo, hi = mm[f"{c}__lo"], mm[f"{c}__hi"]
        if lo is None:
            continue
        lo, hi = float(lo), float(hi)
        if lo == hi:
            lo, hi = lo - 0.5, hi + 0.5
        edges[c] = (lo, hi)
    if not edges:
        raise ValueError("histogram: no column has a value")
    structs = []
    for c, (lo, hi) in edges.items():
        # least() skips nulls in Spark: guard, or null values land in the last bin
        idx = F.when(F.col(c).isNotNull(), F.least(
            F.floor((F.col(c) - F.lit(lo)) / F.lit(hi - lo) * bins), F.lit(bins - 1)))
        structs.append(F.struct(F.lit(c).alias("feature"), idx.cast("int").alias("bin")))
    counts = (df.select(F.inline(F.array(*structs)))
              .filter(F.col("bin").isNotNull())
              .groupBy("feature", "bin").agg(F.count(F.lit(1)).alias("n")))
    spark = df.sparkSession
    frame = spark.createDataFrame([(c, lo, hi) for c, (lo, hi) in edges.items()],
                                  "feature string, lo double, hi double")
    all_bins = frame.select("feature", "lo", "hi",
                            F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
    step = (F.col("hi") - F.col("lo")) / bins
    return (all_bins.join(counts, ["feature", "bin"], "left")
            .select("feature", "bin",
                    r6(F.col("lo") + step * F.col("bin")).alias("bin_lo"),
                    r6(F.col("lo") + step * (F.col("bin") + 1)).alias("bin_hi"),
                    F.coalesce(F.col("n"), F.lit(0)).cast("long").alias("n")))


def boxplot_stats(df: DataFrame, cols: Sequence[str], target: str,
                  whisker: float = 1.5, exact: bool = True) -> DataFrame:
    """Per (feature, class): quartiles, IQR whiskers (most extreme data
    point inside q1-1.5*IQR / q3+1.5*IQR), outlier count.

    Pass 1: wide ``percentile`` per class.  Pass 2: join the per-class stats
    (one row per class) back and take conditional min/max/count in another
    wide aggregate.  Unpivot only the few result rows.
    """
    lab = df.filter(F.col(target).isNotNull())
    quart = quantile_columns(lab, cols, QUARTILES, group=target, exact=exact)
    q = lab.groupBy(target).agg(*[quart[c].alias(f"{c}__q") for c in cols])
    j = lab.join(q, target)  # one row per class; AQE broadcasts it after measuring
    aggs = []
    for c in cols:
        q1, q3 = F.col(f"{c}__q")[0], F.col(f"{c}__q")[2]
        lo = q1 - F.lit(whisker) * (q3 - q1)
        hi = q3 + F.lit(whisker) * (q3 - q1)
        x = F.col(c)
        # numeric buffers only (the quartile arrays rejoin after the aggregate)
        aggs += [F.min(F.when(x >= lo, x)).alias(f"{c}__wlo"),
                 F.max(F.when(x <= hi, x)).alias(f"{c}__whi"),
                 F.count_if((x < lo) | (x > hi)).alias(f"{c}__out"),
                 F.count(x).alias(f"{c}__n")]
    wide = j.groupBy(target).agg(*aggs).join(q, target)
    return _inline(wide, [F.struct(
        F.lit(c).alias("feature"), F.col(target).alias(target),
        F.col(f"{c}__n").cast("long").alias("n"),
        r6(F.col(f"{c}__q")[0]).alias("q1"), r6(F.col(f"{c}__q")[1]).alias("median"),
        r6(F.col(f"{c}__q")[2]).alias("q3"),
        r6(F.col(f"{c}__wlo")).alias("whisker_low"), r6(F.col(f"{c}__whi")).alias("whisker_high"),
        F.col(f"{c}__out").cast("long").alias("n_outliers")) for c in cols])
