"""Exact running totals and ranks without a single-partition window.

A window ``ORDER BY x`` with no ``PARTITION BY`` (or with a hot partition)
runs in ONE task.  Every ordered operator here (exact splits, ROC/PR curves,
AUC, KS) instead uses a two-level plan:

1. a *bucket* column that is monotone in the order (the leading bits of a
   uniform hash, or approximate-quantile splits of a score);
2. per-(group, bucket) totals -> exclusive prefix offsets with a window over
   the small bucket table (``#groups x #buckets`` rows);
3. the offsets joined back on (group, bucket) and a window partitioned by
   (group, bucket): each task sorts only its bucket.

The result is exact: bucket boundaries only decide which task does the work.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Below this many rows per window partition one sorted task is cheaper than
# the two-level plan (a size-checked strategy choice, like a broadcast limit).
SINGLE_TASK_ROWS = 2_000_000


def search_bucket(x: Column, splits: Sequence[float]) -> Column:
    """Number of ``splits`` strictly below ``x`` as a balanced CASE tree
    (log2(len) comparisons, stays inside whole-stage codegen)."""
    splits = sorted(set(float(s) for s in splits))

    def build(lo: int, hi: int) -> Column:
        # answer lies in [lo, hi]; splits[lo:hi] undecided
        if lo == hi:
            return F.lit(lo)
        mid = (lo + hi) // 2
        return F.when(x > F.lit(splits[mid]), build(mid + 1, hi)).otherwise(build(lo, mid))

    if not splits:
        return F.lit(0)
    return build(0, len(splits))


def grouped_quantile_bucket(df: DataFrame, group_col: str, col: str, n_buckets: int | None = None,
                            accuracy: int = 10000,
                            single_task_rows: int | None = None) -> Column | None:
    """Bucket expression with per-group quantile splits (few groups, e.g. the
    features of a drift report): ``CASE group WHEN g THEN tree_g END``.
    ``None`` (no buckets) when every group fits one task; else as many buckets
    as the largest group asks for, unless given."""
    limit = SINGLE_TASK_ROWS if single_task_rows is None else single_task_rows
    most = df.groupBy(group_col).count().agg(F.max("count")).first()[0] or 0
    n = n_buckets or min(4096, 2 * -(-most // max(1, limit)))
    if n <= 1 or most <= limit:
        return None
    rows = df.groupBy(group_col).agg(F.percentile_approx(col, [i / n for i in range(1, n)], max(accuracy, 10 * n)).alias("q")).collect()
    expr = F.lit(0)
    for r in rows:
        expr = F.when(F.col(group_col) == F.lit(r[0]),
                      search_bucket(F.col(col), r["q"] or [])).otherwise(expr)
    return expr


def running_totals(df: DataFrame, partition_cols: Sequence[str], bucket: str | None,
                   order_cols: Sequence[Column | str], sums: dict[str, Column],
                   inclusive: bool = True, row_number: str | None = None) -> DataFrame:
    """Add exact running sums (and optionally a 1-based row number) in
    ``order_cols`` order within ``partition_cols``.

    ``bucket`` must be non-decreasing along ``order_cols`` inside each
    partition.  ``sums`` maps output name -> per-row value column.  With
    ``inclusive=False`` the current row is excluded (``< x`` totals).
    """
    pcols = list(partition_cols)
    vals = dict(sums)
    if row_number:
        vals[row_number] = F.lit(1)
    if bucket is None:
        # checked-small input: one window per partition group, no offsets
        w = Window.partitionBy(*pcols).orderBy(*order_cols)
        frame = (w.rowsBetween(Window.unboundedPreceding, Window.currentRow) if inclusive
                 else w.rowsBetween(Window.unboundedPreceding, -1))
        return df.select("*", *[F.coalesce(F.sum(c).over(frame), F.lit(0)).alias(k)
                                for k, c in vals.items()])
    base = df.select("*", *[c.alias(f"__v_{k}") for k, c in vals.items()])
    per_bucket = base.groupBy(*pcols, bucket).agg(
        *[F.sum(f"__v_{k}").alias(f"__t_{k}") for k in vals])
    w_off = Window.partitionBy(*pcols).orderBy(bucket).rowsBetween(
        Window.unboundedPreceding, -1)
    offsets = per_bucket.select(*pcols, bucket, *[
        F.coalesce(F.sum(f"__t_{k}").over(w_off), F.lit(0)).alias(f"__o_{k}") for k in vals])
    # null-safe: a null partition value is a partition of its own
    keys = [*pcols, bucket]
    renamed = offsets.select(*[F.col(c).alias(f"__k{i}") for i, c in enumerate(keys)], *[f"__o_{k}" for k in vals])
    same = F.lit(True)
    for i, c in enumerate(keys):
        same = same & base[c].eqNullSafe(renamed[f"__k{i}"])
    joined = base.join(renamed, same).drop(*[f"__k{i}" for i in range(len(keys))])
    w_in = Window.partitionBy(*pcols, bucket).orderBy(*order_cols)
    frame = (w_in.rowsBetween(Window.unboundedPreceding, Window.currentRow) if inclusive
             else w_in.rowsBetween(Window.unboundedPreceding, -1))
    out = joined.select("*", *[
        (F.col(f"__o_{k}") + F.coalesce(F.sum(f"__v_{k}").over(frame), F.lit(0))).alias(k)
        for k in vals])
    return out.drop(*[f"__v_{k}" for k in vals], *[f"__o_{k}" for k in vals])
