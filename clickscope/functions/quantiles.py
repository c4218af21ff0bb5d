"""Exact quantiles that scale.

Spark's exact ``percentile`` / ``median`` keep a map of every distinct value
of a group and merge it in one task: right for discrete columns, an
out-of-memory for a continuous column over billions of rows.  Here:

* an ``approx_count_distinct`` pre-pass (one cheap job for all columns and
  groups) sends columns with at most ``DISTINCT_LIMIT`` distinct values per
  group to the built-in exact aggregate (its map is bounded);
* all other columns go through one exact *selection* together, for all groups
  and ranks at once (:func:`select_ranks`): approximate-quantile cut points per
  (group, column), value counts between them, and only the buckets that hold a
  wanted rank go on to the next level.  A level is a fixed number of jobs, and
  cuts a bucket to about a ``BUCKETS``-th, so the jobs depend on the rows'
  logarithm alone, not on the columns, groups or probabilities.

The interpolation is the linear one of pandas / DuckDB ``quantile_cont`` /
Spark ``percentile``.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickscope.session import cut_lineage

DISTINCT_LIMIT = 1_000_000   # distinct values an exact percentile map may hold
READ_LIMIT = 100_000         # a bucket of at most so many rows is sorted in one task
BUCKETS = 1000
KEYS = ["g", "c", "b"]       # group (as JSON text), column number, bucket path


def _place(x: Column, cuts: Column) -> Column:
    """``2j`` for a value between cut ``j - 1`` and cut ``j`` (of the sorted
    array), ``2j + 1`` for one equal to cut ``j``: binary search."""
    size = F.size(cuts)
    at = lambda i: F.element_at(cuts, F.least(i, size - 1) + 1)

    def halve(s, _):
        mid = F.floor((s["lo"] + s["hi"]) / 2).cast("int")
        below = at(mid) < x
        return F.struct(F.when((s["lo"] < s["hi"]) & below, mid + 1).otherwise(s["lo"]).alias("lo"),
                        F.when((s["lo"] < s["hi"]) & ~below, mid).otherwise(s["hi"]).alias("hi"))

    steps = F.array_repeat(F.lit(0), BUCKETS.bit_length() + 1)
    j = F.aggregate(steps, F.struct(F.lit(0).alias("lo"), size.alias("hi")), halve)["lo"]
    return (2 * j + ((j < size) & (at(j) == x)).cast("int")).cast("long")


def _picked(counts: DataFrame, by: list[str], order: str, wanted: DataFrame) -> DataFrame:
    """The wanted ranks (``at``, from 0 inside ``by``) with the row of
    ``counts`` (``by``, ``order``, ``n``) that holds each, and ``start``."""
    w = Window.partitionBy(*by).orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = counts.withColumn("end", F.sum("n").over(w)).withColumn("start", F.col("end") - F.col("n"))
    return placed.join(wanted, by).where("at >= start and at < end")


def select_ranks(values: DataFrame, ranks: Column, read_limit: int | None = None) -> DataFrame:
    """``g, c, rank, x``: exact order statistics of ``x`` per (``g``, ``c``).

    ``ranks``: array of 0-based ranks, an expression of ``n`` (rows of the
    group and column)."""
    limit = READ_LIMIT if read_limit is None else read_limit
    probs = [i / BUCKETS for i in range(1, BUCKETS)]
    level, wanted, done = values.withColumn("b", F.lit(0).cast("long")), None, []
    while True:
        stats = cut_lineage(level.groupBy(*KEYS).agg(
            F.count(F.lit(1)).alias("n"), F.min("x").alias("lo"), F.max("x").alias("hi"),
            F.array_sort(F.array_distinct(F.percentile_approx("x", probs, 10 * BUCKETS))).alias("cuts")), "quantile-cuts")
        if wanted is None:
            wanted = stats.select(*KEYS, F.explode(F.array_distinct(ranks)).alias("rank")).withColumn("at", F.col("rank"))
            wanted = cut_lineage(wanted, "quantile-ranks")
        flat = stats.where("lo = hi")
        done.append(wanted.join(flat.select(*KEYS, F.col("lo").alias("x")), KEYS).select("g", "c", "rank", "x"))
        most = stats.where("lo < hi").agg(F.max("n")).first()[0] or 0
        rest = stats.where("lo < hi").select(*KEYS, "cuts")
        wanted = wanted.join(rest.select(*KEYS), KEYS, "left_semi")
        if most <= limit:
            counts = level.join(rest.select(*KEYS), KEYS, "left_semi").groupBy(*KEYS, "x").agg(F.count(F.lit(1)).alias("n"))
            done.append(_picked(counts, KEYS, "x", wanted).select("g", "c", "rank", "x"))
            out = done[0]
            for d in done[1:]:
                out = out.unionByName(d)
            return out
        placed = level.join(rest, KEYS).withColumn("k", _place(F.col("x"), F.col("cuts"))).drop("cuts")
        counts = placed.groupBy(*KEYS, "k").agg(F.count(F.lit(1)).alias("n"))
        path = (F.col("b") * (4 * BUCKETS) + F.col("k") + 1).alias("b")
        wanted = cut_lineage(_picked(counts, KEYS, "k", wanted).select("g", "c", path, "rank", (F.col("at") - F.col("start")).alias("at")), "quantile-ranks")
        kept = placed.select("g", "c", path, "x").join(wanted.select(*KEYS).distinct(), KEYS, "left_semi")
        level = cut_lineage(kept, "quantile-level")


def quantile_values(df: DataFrame, cols: Sequence[str], probs: Sequence[float], group: str | None = None,
                    read_limit: int | None = None) -> dict[tuple, list[float | None]]:
    """Linear-interpolated exact quantiles by (group value, column); nulls are
    ignored.  The result is as large as groups x columns x probabilities."""
    key = F.to_json(F.struct(F.col(group).alias("g"))) if group else F.lit("{}")
    long = df.select(key.alias("g"), F.inline(F.array(*[
        F.struct(F.lit(i).alias("c"), F.col(c).cast("double").alias("x")) for i, c in enumerate(cols)]))).where("x is not null")
    pos = [F.lit(float(p)) * (F.col("n") - 1) for p in probs]
    found = select_ranks(long, F.array(*[f(p).cast("long") for p in pos for f in (F.floor, F.ceil)]), read_limit)
    got: dict[tuple, dict[int, float]] = {}
    for r in found.collect():
        got.setdefault((r["g"], r["c"]), {})[r["rank"]] = r["x"]
    sizes = {(r["g"], r["c"]): r["n"] for r in long.groupBy("g", "c").agg(F.count(F.lit(1)).alias("n")).collect()}
    groups = {r["g"]: r["v"] for r in df.select(key.alias("g"), (F.col(group) if group else F.lit(None)).alias("v")).distinct().collect()}
    out = {}
    for g, v in groups.items():
        for i, c in enumerate(cols):
            x, n = got.get((g, i), {}), sizes.get((g, i), 0)
            out[v, c] = [None if not n else _between(x, p * (n - 1)) for p in probs]
    return out


def _between(x: dict[int, float], q: float) -> float:
    lo, hi = math.floor(q), math.ceil(q)
    return x[lo] if lo == hi else (hi - q) * x[lo] + (q - lo) * x[hi]


def quantile_columns(df: DataFrame, cols: Sequence[str], probs: Sequence[float],
                     group: str | None = None, exact: bool = True,
                     distinct_limit: int | None = None,
                     distinct_counts: dict[str, int] | None = None) -> dict[str, Column]:
    """Aggregate expressions (array<double> of ``probs``) per column, to be
    used in ``df.agg`` / ``df.groupBy(group).agg``.

    ``exact=False``: ``percentile_approx``.  ``exact=True``: the built-in
    exact ``percentile`` where the pre-pass shows a bounded number of distinct
    values per group, otherwise values selected exactly beforehand and placed
    as literals (per group value; groups must be few, e.g. classes or sides).
    """
    probs = list(probs)
    if not exact:
        return {c: F.percentile_approx(c, probs, 10000).cast("array<double>") for c in cols}
    limit = DISTINCT_LIMIT if distinct_limit is None else distinct_limit
    if distinct_counts is not None and group is None:
        pre = [distinct_counts]   # computed by the caller in one of its own jobs
    else:
        pre = (df.groupBy(group) if group else df.groupBy()).agg(
            *[F.approx_count_distinct(c).alias(c) for c in cols]).collect()
    large = [c for c in cols if not all((r[c] or 0) <= limit for r in pre)]
    out = {c: F.percentile(c, probs).cast("array<double>") for c in cols if c not in large}   # bounded exact map
    values = quantile_values(df, large, probs, group) if large else {}
    for c in large:
        # constants (no aggregate buffer: the wide aggregate stays hash-based),
        # or an expression of the grouping column only
        expr = F.lit(None).cast("array<double>")
        for (g, name), q in values.items():
            if name == c:
                same = F.lit(True) if group is None else F.col(group).eqNullSafe(F.lit(g))
                expr = F.when(same, F.array(*[F.lit(v).cast("double") for v in q])).otherwise(expr)
        out[c] = expr
    return {c: out[c] for c in cols}
