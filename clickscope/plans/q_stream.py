"""Queries: streaming forms (checked against the batch SQL)."""

from __future__ import annotations

from pyspark.sql import functions as F

from clickscope.functions.columns import r6
from clickscope.operators import scoring as K
from clickscope.plans.q_scoring import FOLD_SQL, TTL
from clickscope.plans.registry import register
from clickscope.sources.tables import read_table
from clickscope.streaming import pipelines as ST

_WEEK = "DATE '1970-01-01' + CAST(floor((CAST(ts AS DATE) - DATE '1970-01-01') / 7) * 7 AS INTEGER)"


@register("stream_drift_windows", f"""
WITH w AS (SELECT {_WEEK} AS window_start, event_type, value FROM events),
ref AS (SELECT event_type, AVG(value) AS ref_mean, STDDEV_SAMP(value) AS ref_std FROM w
        WHERE window_start = (SELECT MIN(window_start) FROM w) GROUP BY event_type),
m AS (SELECT window_start, event_type, COUNT(*) AS n, AVG(value) AS mean_value,
             STDDEV_SAMP(value) AS std_value FROM w GROUP BY window_start, event_type)
SELECT m.window_start, m.event_type, m.n, ROUND(m.mean_value, 6) AS mean_value,
       ROUND(m.std_value, 6) AS std_value,
       CASE WHEN ABS(m.mean_value - ref.ref_mean) IS NULL THEN NULL WHEN ref.ref_std > 0 THEN ABS(m.mean_value - ref.ref_mean) > 0.1 * ref.ref_std
            ELSE FALSE END AS drift_detected, CAST(0 AS BIGINT) AS n_late_dropped
FROM m JOIN ref USING (event_type)""")
def q_stream_drift_windows(spark, sf_dir):
    """Weekly window moments from the event stream vs the first week
    (static reference side); the events arrive in four files in time order."""
    moments, late = ST.window_moments(spark, ST.arrival_files(spark, sf_dir), "7 days", "1 day")
    first = moments.agg(F.min("window_start")).first()[0]
    ev = read_table(spark, sf_dir, "events")
    week = F.date_from_unix_date((F.floor(F.unix_date(F.to_date("ts")) / 7) * 7).cast("int"))
    reference = ev.filter(week == F.lit(first))
    d = ST.window_drift(moments, reference)
    return d.select("window_start", "event_type", "n", r6("mean_value").alias("mean_value"),
                    r6("std_value").alias("std_value"), "drift_detected", F.lit(late).cast("long").alias("n_late_dropped"))


@register("stream_scoring", FOLD_SQL + """
SELECT f.event_id AS request_id, f.cache_key, NOT f.miss AS cached, ROUND(a.p, 6) AS probability,
       CAST(a.p >= 0.5 AS INTEGER) AS prediction
FROM fold f JOIN answers a ON a.cache_key = f.cache_key AND a.anchor = f.anchor""")
def q_stream_scoring(spark, sf_dir):
    """K5: micro-batch scoring through the cache table; equals K1."""
    resp = ST.stream_scoring(spark, ST.arrival_files(spark, sf_dir), ["event_type", "user_id"], K.logistic_score("value"),
                             TTL, model_version=None)
    return resp.withColumn("probability", r6("probability"))


@register("stream_scoring_state", FOLD_SQL + """
SELECT f.event_id AS request_id, f.cache_key, NOT f.miss AS cached, ROUND(a.p, 6) AS probability,
       CAST(a.p >= 0.5 AS INTEGER) AS prediction
FROM fold f JOIN answers a ON a.cache_key = f.cache_key AND a.anchor = f.anchor""")
def q_stream_scoring_state(spark, sf_dir):
    """K5 with keyed streaming state (applyInPandasWithState, event-time
    timeout); equals K1."""
    resp = ST.stream_scoring_stateful(spark, ST.arrival_files(spark, sf_dir), ["event_type", "user_id"],
                                      K.logistic_score("value"), TTL, model_version=None)
    return resp.withColumn("probability", r6("probability"))


@register("stream_validate", f"""
SELECT COUNT(*) AS n_rows,
       COUNT(*) FILTER (WHERE value >= 0 AND event_type IN ({", ".join(repr(t) for t in ST.KNOWN_EVENT_TYPES)}))
         AS n_passed,
       COUNT(*) FILTER (WHERE NOT (value >= 0 AND event_type IN ({", ".join(repr(t) for t in ST.KNOWN_EVENT_TYPES)})))
         AS n_quarantined,
       CAST(0 AS BIGINT) AS n_late_dropped
FROM (SELECT DISTINCT ON (event_id) * FROM events)""")
def q_stream_validate(spark, sf_dir):
    """Deduplicated, validated ingest summary, with the rows dropped as
    later than the watermark.  The events arrive in four files in time order,
    so none is late here (0 in the oracle); the late path is tested with
    time-shuffled files in tests/test_streaming.py."""
    return ST.stream_validate(spark, ST.arrival_files(spark, sf_dir))
