"""Deterministic splits and folds (SP1-SP4, U1).

Row order inside a stratum is ``md5(key:seed)`` (ties broken by the key), so
the same split is reproducible in any SQL engine.  The exact mode ranks rows
with :func:`running_totals` over 2**bits hash buckets: the per-class window
of a naive ``row_number`` (two tasks for a binary target, at any data size)
becomes ``#classes x 2**bits`` independent sorts.  ``mode="hash"`` is the
fully parallel threshold form (sizes within sampling error).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickscope.functions.columns import hash_bucket, hash_order_key
from clickscope.functions.windows import SINGLE_TASK_ROWS, running_totals

DEFAULT_BITS = 8
#: Counted strata up to which their sizes are broadcast.
BROADCAST_STRATA = 100_000


def _ranked(df: DataFrame, key: str, strata: list[str], seed: int, bits: int,
            single_task_rows: int = SINGLE_TASK_ROWS) -> DataFrame:
    """Adds ``__rank`` (1-based, hash order inside the stratum) and ``__n``
    (stratum size).  The strata are counted and the counts joined back
    (null-safe, any number of strata).  The largest stratum decides how the
    ranks are computed: one sorted task per stratum while it is small, hash
    buckets, as many as the stratum's rows ask for, beyond that; both give
    the same ranks."""
    base = df.withColumn("__h", hash_order_key(key, seed))
    counts = base.groupBy(*strata).agg(F.count(F.lit(1)).alias("__n"))
    n_strata, n_max = counts.agg(F.count(F.lit(1)), F.coalesce(F.max("__n"), F.lit(0))).first()
    bucket = None
    if n_max > single_task_rows:
        bits = min(16, max(bits, (int(n_max) // max(1, single_task_rows)).bit_length() + 1))
        base = base.withColumn("__b", hash_bucket(F.col("__h"), bits))
        bucket = "__b"
    ranked = running_totals(base, strata, bucket, ["__h", key], {}, row_number="__rank")
    sizes = counts.select(*[F.col(c).alias(f"__s{i}") for i, c in enumerate(strata)], "__n")
    if n_strata <= BROADCAST_STRATA:               # keeps the ranked rows' order too
        sizes = F.broadcast(sizes)
    same = F.lit(True)
    for i, c in enumerate(strata):
        same = same & ranked[c].eqNullSafe(sizes[f"__s{i}"])
    return (ranked.join(sizes, same) if strata else ranked.crossJoin(F.broadcast(sizes))).drop(*[f"__s{i}" for i in range(len(strata))])


def stratified_split(df: DataFrame, key: str, label: str, test_fraction: float = 0.2,
                     seed: int = 42, mode: str = "exact", bits: int = DEFAULT_BITS,
                     split_col: str = "split",
                     single_task_rows: int = SINGLE_TASK_ROWS) -> DataFrame:
    """SP1: per class, the first ``floor(f * n_class + 0.5)`` rows in hash
    order are 'test', the rest 'train'."""
    if mode == "hash":
        u = _unit(hash_order_key(key, seed))
        return df.withColumn(split_col, F.when(u < test_fraction, "test").otherwise("train"))
    r = _ranked(df, key, [label], seed, bits, single_task_rows)
    cut = F.floor(F.lit(test_fraction) * F.col("__n") + F.lit(0.5))
    return (r.withColumn(split_col, F.when(F.col("__rank") <= cut, "test").otherwise("train"))
            .drop("__h", "__b", "__rank", "__n"))


def random_split(df: DataFrame, key: str, fraction: float = 0.3, seed: int = 42,
                 names: tuple[str, str] = ("reference", "current"), mode: str = "exact",
                 bits: int = DEFAULT_BITS, side_col: str = "side",
                 single_task_rows: int = SINGLE_TASK_ROWS) -> DataFrame:
    """SP2: not stratified; the first ``ceil(fraction * n)`` rows in hash order
    form the second side (``names[1]``), the rest the first."""
    if mode == "hash":
        u = _unit(hash_order_key(key, seed))
        return df.withColumn(side_col, F.when(u < fraction, names[1]).otherwise(names[0]))
    r = _ranked(df, key, [], seed, bits, single_task_rows)
    cut = F.ceil(F.lit(fraction) * F.col("__n") - F.lit(1e-9))
    return (r.withColumn(side_col, F.when(F.col("__rank") <= cut, names[1]).otherwise(names[0]))
            .drop("__h", "__b", "__rank", "__n"))


def stratified_folds(df: DataFrame, key: str, label: str, k: int = 3, seed: int = 42,
                     bits: int = DEFAULT_BITS, fold_col: str = "fold",
                     single_task_rows: int = SINGLE_TASK_ROWS, mode: str = "exact") -> DataFrame:
    """SP3: ``fold = (rank - 1) mod k`` inside each class in hash order, so
    every fold holds each class within one row of its share; ``mode="hash"``
    (SP4): by the hash alone."""
    if mode == "hash":
        return df.withColumn(fold_col, (_leading(hash_order_key(key, seed)) % k).cast("int"))
    r = _ranked(df, key, [label], seed, bits, single_task_rows)
    return (r.withColumn(fold_col, ((F.col("__rank") - 1) % k).cast("int"))
            .drop("__h", "__b", "__rank", "__n"))


def _leading(order_key: Column) -> Column:
    """The leading 32 bits of the hash."""
    return F.conv(F.substring(order_key, 1, 8), 16, 10).cast("long")


def _unit(order_key: Column) -> Column:
    """SP4: the leading 32 bits of the hash as a number in [0, 1)."""
    return _leading(order_key).cast("double") / float(2 ** 32)
