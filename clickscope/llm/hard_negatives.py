"""Hard negatives by an exact matrix product in residue number systems.

Components are whole numbers.  A block of anchors is multiplied with a block of
rows once for each of several small primes: both matrices are reduced to signed
residues, so that a float32 product of up to ``MOST_DIMS`` components is exact
(below 2**24), and the residues of the scores give the signed scores by Chinese
remaindering in mixed radix.  A block takes as many primes as its own norms
need (no score exceeds the product of the largest norms).

Anchors, a stated share of the rows, meet all rows block by block: every block
pair is one group of bounded size.  Positives come from blocks of the anchor's
own label, negatives from all blocks; a block pair returns the first few of each
anchor (and window), a window function over those picks the final ones.

Defined cases: rows with a null id, label or vector, or a null or non-finite
component take no part; a shorter vector is filled with zeros, an empty one has
the score 0; repeated rows are one row; rows of one id with different labels or
vectors are rows of their own (ties go to the smaller row hash); a component
beyond ``MOST`` or a block whose scores could exceed ``MOST_SCORE`` is an error; an
empty table, or one without anchors, gives an empty result; a label may hold any
share of the rows; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clickscope.session import cut_lineage

# Primes below 256, largest first; residues reach 125.
PRIMES = (251, 241, 239, 233, 229, 227, 223, 211, 199, 197)
MOST_DIMS = 1000             # 1000 * 125 ** 2 < 2 ** 24
MOST, MOST_SCORE = 2**31 - 1, 2**55      # of a component; 100 scores fit a long
ANCHOR_ROWS, BLOCK_ROWS = 4096, 16_384
STEP_SCORES = 1 << 22        # scores held at once


def whole_vectors(df: DataFrame, id_col: str, vector: str, label: str, scale: float) -> DataFrame:
    """``id, label, q`` (little-endian 32-bit ``floor(scale * x)``) of the rows
    that take part."""
    src = df.select(F.col(id_col).cast("long").alias("id"), F.col(label).cast("long").alias("label"), F.col(vector).alias("v")).dropna()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            col = b.column("v")
            x = col.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False)
            at = col.offsets.to_numpy() - col.offsets[0].as_py()
            bad = np.concatenate([[0], np.cumsum(~np.isfinite(x))])
            ok = np.flatnonzero(bad[at[1:]] == bad[at[:-1]])
            q = np.floor(np.where(np.isfinite(x), scale * x, 0))
            for i in ok:
                if at[i + 1] > at[i] and np.abs(q[at[i]:at[i + 1]]).max() > MOST:
                    raise ValueError("a component is too large for an exact product")
            packed = [q[at[i]:at[i + 1]].astype("<i4").tobytes() for i in ok]
            yield pa.RecordBatch.from_arrays([b.column("id").take(pa.array(ok)), b.column("label").take(pa.array(ok)), pa.array(packed, pa.binary())], ["id", "label", "q"])

    return src.mapInArrow(run, "id long, label long, q binary")


def primes_for(bound: int) -> tuple[int, ...]:
    """The fewest primes that tell all numbers from ``-bound`` to ``bound``."""
    product = 1
    for k, p in enumerate(PRIMES):
        product *= p
        if product > 2 * bound:
            return PRIMES[:k + 1]
    raise ValueError("too few primes")


def _signed(x: np.ndarray, p: int) -> np.ndarray:
    """Residues of whole float64 numbers from ``-(p - 1) / 2`` to ``(p - 1) / 2``."""
    return x - p * np.floor(x / p + 0.5)


def residue_product(a: np.ndarray, b: np.ndarray, p: int) -> np.ndarray:
    """``a @ b.T`` modulo ``p`` as signed residues, by float32 products."""
    out = np.zeros((len(a), len(b)))
    ra, rb = (_signed(x.astype(np.float64), p).astype(np.float32) for x in (a, b))
    for d in range(0, a.shape[1], MOST_DIMS):
        out = _signed(out + ra[:, d:d + MOST_DIMS] @ rb[:, d:d + MOST_DIMS].T, p)
    return out


def exact_product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """``a @ b.T`` of whole numbers, exactly, as 64-bit integers."""
    norms = [max((int(n) + 1 for n in np.square(x.astype(np.float64)).sum(axis=1) * (1 + 1e-9)), default=0) for x in (a, b)]
    bound = math.isqrt(norms[0] * norms[1]) + 1
    if bound >= MOST_SCORE:
        raise ValueError("scores are too large for exact windows")
    out, product = np.zeros((len(a), len(b)), np.int64), 1
    for p in primes_for(bound):
        r = residue_product(a, b, p)
        if product > 1:
            # the next digit: what is missing, divided by the product so far
            r = _signed(_signed(r - np.mod(out, p), p) * pow(product, -1, p), p)
        out += r.astype(np.int64) * product
        product *= p
    return out


def _matrix(col: pa.ChunkedArray, dims: int) -> np.ndarray:
    parts = [np.frombuffer(x.as_py(), "<i4") for x in col]
    if all(len(x) == dims for x in parts):
        return np.concatenate(parts).reshape(-1, dims) if parts else np.zeros((0, dims), np.int32)
    out = np.zeros((len(parts), dims), np.int32)
    for i, x in enumerate(parts):
        out[i, :len(x)] = x
    return out


def _sides(left: pa.Table, right: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    dims = max([0, *(len(x.as_py()) // 4 for t in (left, right) for x in t.column("q"))])
    return _matrix(left.column("q"), dims), _matrix(right.column("q"), dims)


def _first_of(owner: np.ndarray, score: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Indices of the first ``k`` of each owner by score (high first) and id."""
    order = np.lexsort((ids, -score, owner))
    o = owner[order]
    start = np.flatnonzero(np.append(True, o[1:] != o[:-1])) if len(o) else np.empty(0, np.int64)
    rank = np.arange(len(o)) - np.repeat(start, np.diff(np.append(start, len(o))))
    return order[rank < k]


def _column(t: pa.Table, name: str) -> np.ndarray:
    return t.column(name).to_numpy()


def _positives(k: int):
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        a, b = _sides(left, right)
        ids, keys = _column(right, "id"), _column(right, "key")
        found = [np.empty((0, 3), np.int64)]
        step = max(1, STEP_SCORES // max(1, len(b)))
        for lo in range(0, len(a), step):
            score = exact_product(a[lo:lo + step], b)
            same = (_column(left, "key")[lo:lo + step, None] == keys[None, :]) & (_column(left, "id")[lo:lo + step, None] == ids[None, :])
            i, j = np.nonzero(~same)
            pick = _first_of(i, score[i, j], ids[j], k)
            found.append(np.stack([i[pick] + lo, j[pick], score[i[pick], j[pick]]], axis=1))
        i, j, s = np.concatenate(found).T
        take = pa.array(i)
        return pa.table([left.column("id").take(take), left.column("key").take(take), pa.array(ids[j], pa.int64()), pa.array(keys[j], pa.int64()), pa.array(s)],
                        names=["anchor_id", "anchor_key", "positive_id", "positive_key", "positive_score"])

    return run


def _negatives(k: int, low: int, high: int):
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        a, b = _sides(left, right)
        ids, labels = _column(right, "id"), _column(right, "label")
        # windows low <= 100 * score / positive score <= high, as whole numbers
        scores = left.column("scores").to_pylist()
        tops = [np.array([[-(-low * p // 100), high * p // 100] for p in s], np.int64).reshape(-1, 2) for s in scores]
        found = [np.empty((0, 4), np.int64)]
        step = max(1, STEP_SCORES // max(1, len(b)))
        mine = _column(left, "label")
        for lo in range(0, len(a), step):
            part = tops[lo:lo + step]
            score = exact_product(a[lo:lo + step], b)
            least = np.array([t[:, 0].min() for t in part])[:, None]
            most = np.array([t[:, 1].max() for t in part])[:, None]
            i, j = np.nonzero((score >= least) & (score <= most) & (mine[lo:lo + step, None] != labels[None, :]))
            order = np.lexsort((ids[j], -score[i, j], i))
            i, j = i[order], j[order]
            s = score[i, j]
            edge = np.searchsorted(i, np.arange(len(part) + 1))
            for x, t in enumerate(part):
                own = -s[edge[x]:edge[x + 1]]
                for w in np.unique(t, axis=0):
                    first = int(np.searchsorted(own, -w[1]))
                    end = min(first + k, int(np.searchsorted(own, -w[0], side="right")))
                    for y in range(edge[x] + first, edge[x] + end):
                        found.append(np.array([[x + lo, w[1], j[y], s[y]]]))
        i, w, j, s = np.concatenate(found).T
        take = pa.array(i)
        return pa.table([left.column("id").take(take), left.column("key").take(take), pa.array(w), pa.array(ids[j], pa.int64()), pa.array(_column(right, "key")[j], pa.int64()), pa.array(s)],
                        names=["anchor_id", "anchor_key", "top", "negative_id", "negative_key", "negative_score"])

    return run


def _first_rows(df: DataFrame, by: list[str], score: str, ids: list[str], k: int) -> DataFrame:
    w = Window.partitionBy(*by).orderBy(F.desc(score), *ids)
    return df.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def mine(df: DataFrame, id_col: str = "vec_id", vector: str = "embedding", label: str = "label", scale: float = 256.0, every: int = 50,
         positives: int = 5, negatives: int = 3, low: int = 50, high: int = 95,
         anchor_rows: int = ANCHOR_ROWS, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score,
    negative_score``: for each anchor (id divisible by ``every``) and each of
    its first ``positives`` of the same label, the first ``negatives`` of other
    labels whose score is ``low`` to ``high`` percent of the positive's."""
    rows = whole_vectors(df, id_col, vector, label, scale).distinct().withColumn("key", F.xxhash64("id", "label", "q"))
    rows = cut_lineage(rows, "vectors")
    is_anchor = F.col("id") % every == 0
    per_label = rows.groupBy("label").agg(F.ceil(F.count(F.lit(1)) / F.lit(float(block_rows))).cast("int").alias("blocks"),
                                          F.ceil(F.count(F.when(is_anchor, 1)) / F.lit(float(anchor_rows))).cast("int").alias("groups"))
    per_label = cut_lineage(per_label, "labels")
    spread = lambda n: F.explode(F.sequence(F.lit(0), n - 1))
    part = lambda n: F.pmod(F.xxhash64("key", F.lit(3)), n).cast("int")

    # positives: the anchors' groups and the rows' blocks of each label
    sized = rows.join(per_label.where("groups > 0"), "label")
    # toDF: columns of their own, as both sides of a cogroup come from one table
    left = sized.where(is_anchor).select("id", "key", "q", "label", part(F.col("groups")).alias("g"), spread(F.col("blocks")).alias("b"))
    left = left.toDF(*left.columns)
    right = sized.select("id", "key", "q", "label", part(F.col("blocks")).alias("b"), spread(F.col("groups")).alias("g"))
    near = left.groupBy("label", "g", "b").cogroup(right.groupBy("label", "g", "b")).applyInArrow(
        _positives(positives), "anchor_id long, anchor_key long, positive_id long, positive_key long, positive_score long")
    chosen = cut_lineage(_first_rows(near, ["anchor_id", "anchor_key"], "positive_score", ["positive_id", "positive_key"], positives).drop("rank"), "positives")

    # negatives: all blocks of all labels
    n_anchors, n_rows = chosen.select("anchor_id", "anchor_key").distinct().count(), rows.count()
    groups, blocks = -(-n_anchors // anchor_rows) or 1, -(-n_rows // block_rows) or 1
    wanted = chosen.groupBy(F.col("anchor_id").alias("id"), F.col("anchor_key").alias("key")).agg(F.collect_set("positive_score").alias("scores"))
    left = rows.where(is_anchor).join(wanted, ["id", "key"]).select("id", "key", "q", "label", "scores", part(F.lit(groups)).alias("g"), spread(F.lit(blocks)).alias("b"))
    left = left.toDF(*left.columns)
    right = rows.select("id", "key", "q", "label", part(F.lit(blocks)).alias("b"), spread(F.lit(groups)).alias("g"))
    hard = left.groupBy("g", "b").cogroup(right.groupBy("g", "b")).applyInArrow(
        _negatives(negatives, low, high), "anchor_id long, anchor_key long, top long, negative_id long, negative_key long, negative_score long")
    best = _first_rows(hard, ["anchor_id", "anchor_key", "top"], "negative_score", ["negative_id", "negative_key"], negatives)
    tops = chosen.withColumn("top", F.expr(f"(positive_score * {high} - pmod(positive_score * {high}, 100)) div 100"))
    return tops.join(best, ["anchor_id", "anchor_key", "top"]).select(
        "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score", "negative_score")
