"""Queries: cached scoring of event requests (key = (user_id, event_type),
requested_at = ts, TTL 3600 s, fixed-formula stand-in model on ``value``)."""

from __future__ import annotations

from pyspark.sql import functions as F

from clickscope.functions.columns import epoch_micros, r6
from clickscope.operators import scoring as K
from clickscope.plans.registry import register
from clickscope.sources.tables import read_table

TTL = 3600
KEY_SQL = ("'prediction:' || md5('{\"event_type\":\"' || event_type || '\",\"user_id\":' "
           "|| CAST(user_id AS VARCHAR) || '}')")
FOLD_SQL = f"""WITH RECURSIVE req AS (
  SELECT event_id, {KEY_SQL} AS cache_key, epoch_us(ts) AS t, value FROM events),
ord AS (SELECT *, row_number() OVER (PARTITION BY cache_key ORDER BY t, event_id) AS rn FROM req),
fold(cache_key, rn, event_id, t, anchor, miss) AS (
  SELECT cache_key, rn, event_id, t, t, TRUE FROM ord WHERE rn = 1
  UNION ALL
  SELECT o.cache_key, o.rn, o.event_id, o.t,
         CASE WHEN o.t >= f.anchor + {TTL * 1_000_000} THEN o.t ELSE f.anchor END,
         o.t >= f.anchor + {TTL * 1_000_000}
  FROM fold f JOIN ord o ON o.cache_key = f.cache_key AND o.rn = f.rn + 1),
answers AS (
  SELECT f.cache_key, f.t AS anchor, 1.0 / (1.0 + exp(-(r.value - 25.0) / 10.0)) AS p
  FROM fold f JOIN req r ON r.event_id = f.event_id WHERE f.miss)
"""


def _requests(spark, sf_dir):
    return read_table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "ts",
                                                       "value")


def _run(spark, sf_dir):
    return K.cached_scoring(_requests(spark, sf_dir), ["event_type", "user_id"], "ts", "event_id",
                            K.logistic_score("value"), TTL, cache=None, model_version=None)


@register("cached_scoring", FOLD_SQL + """
SELECT f.event_id AS request_id, f.cache_key, NOT f.miss AS cached, ROUND(a.p, 6) AS probability,
       CAST(a.p >= 0.5 AS INTEGER) AS prediction
FROM fold f JOIN answers a ON a.cache_key = f.cache_key AND a.anchor = f.anchor""")
def q_cached_scoring(spark, sf_dir):
    resp, _ = _run(spark, sf_dir)
    return resp.withColumn("probability", r6("probability"))


@register("live_cache_count", FOLD_SQL + f"""
SELECT COUNT(*) AS n_live FROM (SELECT cache_key, MAX(anchor) AS w FROM answers GROUP BY cache_key)
WHERE w <= (SELECT MAX(t) FROM req) AND (SELECT MAX(t) FROM req) < w + {TTL * 1_000_000}""")
def q_live_cache_count(spark, sf_dir):
    _, cache = _run(spark, sf_dir)
    now = read_table(spark, sf_dir, "events").agg(F.max(epoch_micros("ts"))).first()[0]
    return K.live_entries(cache, F.lit(now), TTL)


@register("cache_hit_rate", FOLD_SQL + """
SELECT r.event_type, COUNT(*) AS n_requests, COUNT(*) FILTER (WHERE NOT f.miss) AS n_cached
FROM fold f JOIN (SELECT event_id, event_type FROM events) r USING (event_id) GROUP BY r.event_type""")
def q_cache_hit_rate(spark, sf_dir):
    resp, _ = _run(spark, sf_dir)
    ev = read_table(spark, sf_dir, "events").select(F.col("event_id").alias("request_id"),
                                                      "event_type")
    return (resp.join(ev, "request_id").groupBy("event_type")
            .agg(F.count(F.lit(1)).alias("n_requests"), F.count_if("cached").alias("n_cached")))


CUT_SQL = "(SELECT (MIN(t) + MAX(t)) // 2 FROM req)"


@register("cached_scoring_warm", FOLD_SQL + f"""
SELECT f.event_id AS request_id, f.cache_key, NOT f.miss AS cached, ROUND(a.p, 6) AS probability,
       CAST(a.p >= 0.5 AS INTEGER) AS prediction
FROM fold f JOIN answers a ON a.cache_key = f.cache_key AND a.anchor = f.anchor WHERE f.t >= {CUT_SQL}""")
def q_cached_scoring_warm(spark, sf_dir):
    """Requests of the later half of the time span against the cache that the
    earlier half left."""
    req = _requests(spark, sf_dir).withColumn("t", epoch_micros("ts"))
    lo, hi = req.agg(F.min("t"), F.max("t")).first()
    cut = F.lit((lo + hi) // 2) if lo is not None else F.lit(0)
    keys, score = ["event_type", "user_id"], K.logistic_score("value")
    _, cache = K.cached_scoring(req.where(F.col("t") < cut).drop("t"), keys, "ts", "event_id", score, TTL, None, None)
    resp, _ = K.cached_scoring(req.where(F.col("t") >= cut).drop("t"), keys, "ts", "event_id", score, TTL, cache, None)
    return resp.withColumn("probability", r6("probability"))


@register("scoring_no_cache", f"""
SELECT event_id AS request_id, {KEY_SQL} AS cache_key, FALSE AS cached,
       ROUND(1.0 / (1.0 + exp(-(value - 25.0) / 10.0)), 6) AS probability,
       CAST(1.0 / (1.0 + exp(-(value - 25.0) / 10.0)) >= 0.5 AS INTEGER) AS prediction FROM events""")
def q_scoring_no_cache(spark, sf_dir):
    """K3: the cache cannot be reached: every request is scored."""
    resp, _ = K.cached_scoring(_requests(spark, sf_dir), ["event_type", "user_id"], "ts", "event_id",
                               K.logistic_score("value"), TTL, model_version=None, cache_available=False)
    return resp.withColumn("probability", r6("probability"))
