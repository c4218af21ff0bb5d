"""Queries: the request side of the scoring service, and serving labels."""

from __future__ import annotations

from pyspark.sql import functions as F

from clickscope.functions.columns import r6
from clickscope.operators import quality as Q
from clickscope.operators import scoring as K
from clickscope.operators.encoder import SessionEncoder
from clickscope.plans.fixtures import load_sessions, session_requests
from clickscope.plans.oracle import SESSIONS_CTES, with_ctes
from clickscope.plans.registry import register
from clickscope.session import cut_lineage

ANSWER = "request_id long, response string"
ANSWER_FIELDS = "ad_clicked_probability double, ad_clicked int, cached boolean, detail array<string>"


def _missing(c, bad="FALSE"):
    word = f"WHEN {bad} THEN '{c}:not_a_number' " if bad != "FALSE" else ""
    return f"CASE {word}WHEN {c} IS NULL THEN '{c}:missing' END"


# "age" is a word where the null rule leaves it in; a rule-made bad value is
# put in for nulls too
_FAULTS = ", ".join([_missing("age", "user_id % 13 = 5"), *[_missing(c) for c in Q.REQUEST_NUMBERS[1:]],
                     "CASE WHEN user_id % 17 = 4 AND gender IS NOT NULL THEN 'gender:not_a_string' END"])


@register("request_parse", with_ctes(SESSIONS_CTES, f"""
SELECT session_id AS request_id, CASE WHEN user_id % 11 = 3 THEN 'body:not_json' ELSE concat_ws(';', {_FAULTS}) END AS errors,
       CASE WHEN errors = '' THEN ROUND(1.0 / (1.0 + exp(-(time_on_site - 25.0) / 10.0)), 6) END AS probability,
       CASE WHEN errors = '' THEN CAST(1.0 / (1.0 + exp(-(time_on_site - 25.0) / 10.0)) >= 0.5 AS INTEGER) END AS prediction,
       CASE WHEN errors = '' THEN FALSE END AS cached
FROM sessions""".replace("user_id % 13 = 5", "user_id % 13 = 5 AND age IS NOT NULL")))
def q_request_parse(spark, sf_dir):
    """V6 + F9: JSON bodies to typed requests, the good ones scored, the others
    answered with the fault of each field; every answer goes through its JSON
    text and back."""
    typed = cut_lineage(Q.type_requests(session_requests(spark, sf_dir), "body", ("session_id",)), "typed")
    good = K.logistic_score("time_on_site")(typed.where("size(errors) = 0")).select(
        F.col("session_id").alias("request_id"), "probability", "prediction", F.lit(False).alias("cached"))
    bad = typed.where("size(errors) > 0").select(F.col("session_id").alias("request_id"), F.to_json(F.struct(F.col("errors").alias("detail"))).alias("response"))
    answer = F.from_json("response", ANSWER_FIELDS)
    return K.response_json(good).unionByName(bad).select("request_id", answer.alias("a")).select(
        "request_id", F.coalesce(F.concat_ws(";", "a.detail"), F.lit("")).alias("errors"), r6("a.ad_clicked_probability").alias("probability"),
        F.col("a.ad_clicked").alias("prediction"), F.col("a.cached").alias("cached"))


@register("unseen_label", with_ctes(SESSIONS_CTES + [
    "fitted AS (SELECT * FROM sessions WHERE session_date < DATE '2024-01-15' AND coalesce(device_type, '') <> 'Tablet')",
    """seen AS (SELECT DISTINCT 'gender' AS feature, coalesce(gender, 'Unknown') AS label FROM fitted
       UNION SELECT DISTINCT 'device_type', coalesce(device_type, 'Unknown') FROM fitted
       UNION SELECT 'gender', 'Unknown' UNION SELECT 'device_type', 'Unknown')""",
    "codes AS (SELECT feature, label, CAST(row_number() OVER (PARTITION BY feature ORDER BY label) - 1 AS INTEGER) AS code FROM seen)",
    "med AS (SELECT median(age) AS age, median(avg_session_time) AS t FROM fitted)"], """
SELECT s.session_id, coalesce(g.code, gu.code) AS gender, coalesce(d.code, du.code) AS device_type,
       ROUND(coalesce(s.age, med.age), 6) AS age, ROUND(coalesce(s.avg_session_time, med.t), 6) AS avg_session_time
FROM sessions s CROSS JOIN med
LEFT JOIN codes g ON g.feature = 'gender' AND g.label = s.gender
LEFT JOIN codes d ON d.feature = 'device_type' AND d.label = s.device_type
JOIN codes gu ON gu.feature = 'gender' AND gu.label = 'Unknown'
JOIN codes du ON du.feature = 'device_type' AND du.label = 'Unknown'"""))
def q_unseen_label(spark, sf_dir):
    """F2 + F3 + P5: an encoder fitted on the first two weeks without one
    device, saved and loaded, applied to all sessions: the device it never saw
    is 'Unknown'."""
    import os
    import uuid

    from clickscope.operators.encoder import SessionEncoderModel
    from clickscope.session import durable_dir
    s = load_sessions(spark, sf_dir)
    early = s.where((F.col("session_date") < F.lit("2024-01-15").cast("date")) & (F.coalesce("device_type", F.lit("")) != "Tablet"))
    path = os.path.join(durable_dir(spark), "encoders", uuid.uuid4().hex)
    SessionEncoder(nominal=["gender", "device_type"], numeric=["age", "avg_session_time"]).fit(early).write().overwrite().save(path)
    out = SessionEncoderModel.load(path).transform(s)
    return out.select("session_id", F.col("gender__x").alias("gender"), F.col("device_type__x").alias("device_type"),
                      r6("age__x").alias("age"), r6("avg_session_time__x").alias("avg_session_time"))
