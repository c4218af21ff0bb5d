"""Scoring through a time-limited result cache.

Semantics (the request/response service re-aimed at tables): a request's
cache key is ``'prediction:' + md5(canonical JSON of its fields)``.  The first
request of a key is scored and its answer written with time ``t``; every
later request of the key with time < t + TTL gets the stored answer
(``cached = true``); the first one at or after t + TTL is scored again and
re-anchors the key.  The TTL counts from the write and is not refreshed by
hits; this holds inside one batch too.

Plan: a window per key cuts its requests where one comes a TTL or more after
the one before (or is a cache entry): whatever was live before has expired, so
each stretch starts with an anchor of its own, and a stretch shorter than the
TTL has no other.  Those are settled by that window, JVM-side.  Only longer
stretches are folded in ``mapInPandas``, carrying (stretch, anchor) between
Arrow batches, so memory is bounded whatever a key's size.  Misses are scored by
a DataFrame function (a model transform), hits take their anchor's answer by an
equi-join on (key, anchor).
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickscope.functions.columns import epoch_micros, r6
from clickscope.session import cut_lineage

PREFIX = "prediction:"
CACHE_SCHEMA = "cache_key string, written_at_us long, probability double, prediction int"


def cache_key(cols: Sequence[str], model_version: str | None = None) -> Column:
    """F8: canonical JSON (keys sorted) -> md5 -> 'prediction:' prefix.
    ``model_version`` (default in the library) keeps stale answers of an older
    model out of the cache; ``None`` reproduces the version-less key."""
    named = {c: F.col(c) for c in cols}
    if model_version is not None:
        named["model_version"] = F.lit(model_version)
    fields = [named[n].alias(n) for n in sorted(named)]
    return F.concat(F.lit(PREFIX), F.md5(F.to_json(F.struct(*fields))))


def _fold(ttl_us: int) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    """Anchors of long stretches, ordered by (key, stretch, time): each begins
    with its first anchor and holds no other cache entry."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        at, anchor = None, None
        for b in batches:
            t, anchors = b["t_us"].to_numpy(), np.empty(len(b), np.int64)
            cached = np.ones(len(b), dtype=bool)
            cut = np.flatnonzero(np.append(True, (b["cache_key"].to_numpy()[1:] != b["cache_key"].to_numpy()[:-1])
                                           | (b["stretch"].to_numpy()[1:] != b["stretch"].to_numpy()[:-1])))
            for lo, hi in zip(cut, np.append(cut[1:], len(b))):
                name = (b["cache_key"].iat[lo], b["stretch"].iat[lo])
                if name != at:
                    at, anchor = name, None
                i = lo
                while i < hi:                      # a step an anchor, not a request
                    if anchor is None or t[i] >= anchor + ttl_us:
                        anchor, cached[i] = int(t[i]), False
                    end = i + max(1, int(np.searchsorted(t[i:hi], anchor + ttl_us)))
                    anchors[i:end] = anchor
                    i = end
            yield pd.DataFrame({"request_id": b["request_id"], "cache_key": b["cache_key"], "t_us": t,
                                "cached": cached, "anchor_us": anchors, "is_seed": b["is_seed"]})
    return run


def stretches(req: DataFrame, ttl_us: int) -> DataFrame:
    """``req`` with ``stretch`` (number in its key), ``first_us`` and ``long``
    (spans a TTL or more), and whether the row ``starts`` it."""
    w = Window.partitionBy("cache_key").orderBy("t_us", F.desc("is_seed"), "request_id")
    starts = F.col("is_seed") | F.coalesce(F.col("t_us") - F.lag("t_us").over(w) >= ttl_us, F.lit(True))
    whole = Window.partitionBy("cache_key", "stretch")
    return (req.withColumn("starts", starts).withColumn("stretch", F.sum(F.col("starts").cast("int")).over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
            .withColumn("first_us", F.min("t_us").over(whole)).withColumn("long", F.max("t_us").over(whole) - F.col("first_us") >= ttl_us))


def anchor_requests(requests: DataFrame, key_col: str, time_us_col: str, id_col: str,
                    ttl_seconds: int = 3600, cache: DataFrame | None = None,
                    partitions: int | None = None,
                    hot_key_rows: int | None = 1_000_000) -> DataFrame:
    """K2: (request_id, cache_key, t_us, cached, anchor_us) for every request.

    ``cache`` (may be None: empty) holds live entries
    ``(cache_key, written_at_us, ...)`` that act as anchors written earlier.

    Keys with more than ``hot_key_rows`` requests (and at most one cache entry,
    not later than their first request) take the exact parallel path of
    :mod:`clickscope.operators.cache_hot`; all others are cut into stretches
    (:func:`stretches`), of which the long ones are folded.  The result is read
    from written tables.
    """
    req = requests.select(F.col(id_col).cast("long").alias("request_id"),
                          F.col(key_col).alias("cache_key"),
                          F.col(time_us_col).cast("long").alias("t_us"),
                          F.lit(False).alias("is_seed"))
    if cache is not None:
        seeds = cache.select(F.lit(None).cast("long").alias("request_id"), "cache_key",
                             F.col("written_at_us").alias("t_us"), F.lit(True).alias("is_seed"))
        req = req.unionByName(seeds)
    ttl_us = ttl_seconds * 1_000_000
    hot = None
    if hot_key_rows is not None:
        stats = req.groupBy("cache_key").agg(
            F.count_if(~F.col("is_seed")).alias("n"), F.count_if("is_seed").alias("n_seed"),
            F.min(F.when(~F.col("is_seed"), F.col("t_us"))).alias("first_t"),
            F.max(F.when(F.col("is_seed"), F.col("t_us"))).alias("seed_t"))
        # at most (rows / hot_key_rows) keys: a small frame by construction
        hot = stats.filter((F.col("n") > hot_key_rows) & (
            (F.col("n_seed") == 0) | ((F.col("n_seed") == 1) & (F.col("seed_t") <= F.col("first_t"))))
        ).select("cache_key")
        if hot.limit(1).count() == 0:
            hot = None
    cold = req if hot is None else req.join(hot, "cache_key", "left_anti")
    cut = cut_lineage(stretches(cold, ttl_us), "cache-stretches")
    names = ["request_id", "cache_key", "t_us", "cached", "anchor_us"]
    out = cut.where("not long and not is_seed").select("request_id", "cache_key", "t_us", (~F.col("starts")).alias("cached"), F.col("first_us").alias("anchor_us"))
    rest = cut.where("long")
    if not rest.isEmpty():
        # without a number the partition count stays adaptive
        dealt = rest.repartition(partitions, "cache_key", "stretch") if partitions else rest.repartition("cache_key", "stretch")
        folded = (dealt.sortWithinPartitions("cache_key", "stretch", "t_us", F.desc("is_seed"), "request_id")
                  .select("request_id", "cache_key", "t_us", "is_seed", "stretch")
                  .mapInPandas(_fold(ttl_us), "request_id long, cache_key string, t_us long, cached boolean, anchor_us long, is_seed boolean"))
        out = out.unionByName(cut_lineage(folded.where("not is_seed").select(*names), "cache-fold"))
    if hot is not None:
        from clickscope.operators.cache_hot import anchor_parallel
        out = out.unionByName(cut_lineage(anchor_parallel(req.join(hot, "cache_key", "left_semi"), ttl_us).select(*names), "cache-hot"))
    return out


def cached_scoring(requests: DataFrame, key_cols: Sequence[str], ts_col: str, id_col: str,
                   score: Callable[[DataFrame], DataFrame], ttl_seconds: int = 3600,
                   cache: DataFrame | None = None, model_version: str | None = "v1",
                   cache_available: bool = True) -> tuple[DataFrame, DataFrame]:
    """K1: score requests through the cache.

    ``score(df)`` must add ``probability`` (double) and ``prediction`` (int)
    to the rows it gets (only the misses reach it).  Returns
    ``(responses, new_cache)``: responses are (request_id, cache_key, cached,
    probability, prediction); ``new_cache`` is the latest entry per key.
    ``cache_available=False`` (K3): no lookup and no write, so every request
    is scored, ``cached`` is false throughout and the new cache is empty.
    """
    keyed = (requests.withColumn("cache_key", cache_key(key_cols, model_version))
             .withColumn("t_us", epoch_micros(ts_col)))
    if not cache_available:
        own = score(keyed).select(F.col(id_col).cast("long").alias("request_id"), "cache_key", F.lit(False).alias("cached"),
                                  F.col("probability").cast("double").alias("probability"), F.col("prediction").cast("int").alias("prediction"))
        return own, requests.sparkSession.createDataFrame([], CACHE_SCHEMA)
    anchored = anchor_requests(keyed, "cache_key", "t_us", id_col, ttl_seconds, cache)
    # Misses only are scored (the fold already separated them)
    misses = anchored.filter(~F.col("cached")).select("request_id")
    scored = score(keyed.join(misses, keyed[id_col] == misses["request_id"], "left_semi"))
    answers = scored.select(F.col("cache_key"), F.col("t_us").alias("anchor_us"),
                            F.col("probability").cast("double").alias("probability"),
                            F.col("prediction").cast("int").alias("prediction"))
    if cache is not None:
        answers = answers.unionByName(cache.select(
            "cache_key", F.col("written_at_us").alias("anchor_us"), "probability", "prediction"))
    # Every request meets the answer written by its anchor
    resp = anchored.join(answers, ["cache_key", "anchor_us"], "left").select(
        "request_id", "cache_key", "cached", "probability", "prediction")
    new_cache = answers.groupBy("cache_key").agg(
        F.max("anchor_us").alias("written_at_us"),
        F.max_by("probability", "anchor_us").alias("probability"),
        F.max_by("prediction", "anchor_us").alias("prediction"))
    return resp, new_cache


def live_entries(new_cache: DataFrame, now_us: Column, ttl_seconds: int = 3600) -> DataFrame:
    """K4: number of cache entries alive at ``now`` (written within the TTL)."""
    alive = (F.col("written_at_us") <= now_us) & (now_us < F.col("written_at_us") + ttl_seconds * 1_000_000)
    return new_cache.agg(F.count_if(alive & F.col("cache_key").startswith(PREFIX)).alias("n_live"))


def logistic_score(value_col: str, center: float = 25.0, scale: float = 10.0) -> Callable[[DataFrame], DataFrame]:
    """Fixed-formula stand-in model: p = 1 / (1 + exp(-(x - center) / scale))."""
    def score(df: DataFrame) -> DataFrame:
        p = 1.0 / (1.0 + F.exp(-(F.col(value_col) - center) / scale))
        return df.withColumn("probability", p).withColumn("prediction", (p >= 0.5).cast("int"))
    return score


def response_json(resp: DataFrame) -> DataFrame:
    """the response record as JSON text (and back with ``from_json``)."""
    return resp.select("request_id", F.to_json(F.struct(
        F.col("probability").alias("ad_clicked_probability"),
        F.col("prediction").alias("ad_clicked"), "cached")).alias("response"))


def rounded(resp: DataFrame) -> DataFrame:
    return resp.withColumn("probability", r6("probability"))
