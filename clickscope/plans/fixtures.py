"""Derived input tables (the stand-ins of FIXTURES.md section 2).

``sessions`` has the schema of a raw session table: one row per
(user, calendar day) of ``events``, with ``customer`` supplying the first
nominal column.  Everything is a declarative DataFrame plan, so Catalyst
prunes the scans to the six event columns and two customer columns.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from clickscope.session import stage_table
from clickscope.sources.tables import read_table

# Raw session columns in schema order (null-rule position = index).
SESSION_FEATURES = ("age", "gender", "device_type", "time_on_site", "pages_viewed",
                    "previous_purchases", "cart_items", "discount_seen", "returning_user",
                    "avg_session_time", "bounce_rate", "purchase", "ad_clicked")
# Device labels chosen by the first event's props.k mod 3.
DEVICES = ("Desktop", "Mobile", "Tablet")
TARGET = "ad_clicked"
# Fixed value: decision cut of the scored fixture.
SCORE_CUT = 0.05
ID = "session_id"


def sessions_from_events(events: DataFrame, customer: DataFrame,
                         with_nulls: bool = True) -> DataFrame:
    """events x customer -> one row per (user_id, day).

    Plan: partial+final *hash* aggregate on (user_id, day) (map-side combine
    makes a hot user cheap; every buffer is fixed-width), then the customer join on the aggregated rows
    (the optimizer broadcasts customer only when its measured size is below
    ``autoBroadcastJoinThreshold``), then one window per user over at most
    one row per day.
    """
    et = F.col("event_type")
    # the device index is parsed per row so that the aggregation buffer holds
    # only fixed-width values (min_by over a string forces a sort-based
    # aggregate: a full sort of the events before the partial aggregation)
    per_day = (events
               .select("event_id", "user_id", "event_type", "value",
                       (F.get_json_object("props", "$.k").cast("long") % 3).alias("dev_idx"),
                       F.to_date("ts").alias("session_date"))
               .groupBy("user_id", "session_date")
               .agg(F.sum("value").alias("time_on_site"),
                    F.avg("value").alias("avg_session_time"),
                    F.count_if(et == "view").alias("n_view"),
                    F.count_if(et == "signup").alias("n_signup"),
                    F.count_if(et == "purchase").alias("n_purchase"),
                    F.count_if(et == "error").alias("n_error"),
                    F.count_if(et == "click").alias("n_click"),
                    F.count(F.lit(1)).alias("n_events"),
                    F.min_by("dev_idx", "event_id").alias("dev_idx")))
    cust = customer.select(F.col("c_custkey").alias("user_id"),
                           F.col("c_mktsegment").alias("gender"))
    by_user = Window.partitionBy("user_id").orderBy("session_date")
    earlier = by_user.rowsBetween(Window.unboundedPreceding, -1)
    dev = F.element_at(F.array(*[F.lit(d) for d in DEVICES]), (F.col("dev_idx") + 1).cast("int"))
    s = (per_day.join(cust, "user_id", "left")  # an unknown customer keeps its sessions
         .select(
             (F.col("user_id") * 100_000_000 + F.date_format("session_date", "yyyyMMdd").cast("long")).alias(ID),
             "user_id", "session_date",
             (F.lit(13) + F.col("user_id") % 88).cast("double").alias("age"),
             "gender",
             dev.alias("device_type"),
             F.col("time_on_site").cast("double").alias("time_on_site"),
             F.col("n_view").cast("double").alias("pages_viewed"),
             F.coalesce(F.sum("n_purchase").over(earlier), F.lit(0)).cast("double")
              .alias("previous_purchases"),
             F.col("n_signup").cast("double").alias("cart_items"),
             (F.col("n_error") > 0).cast("double").alias("discount_seen"),
             (F.row_number().over(by_user) > 1).cast("double").alias("returning_user"),
             F.col("avg_session_time").cast("double").alias("avg_session_time"),
             (F.col("n_events") == 1).cast("double").alias("bounce_rate"),
             (F.col("n_purchase") > 0).cast("double").alias("purchase"),
             (F.col("n_click") > 0).cast("double").alias(TARGET)))
    if not with_nulls:
        return s
    rule = (F.col("user_id") * 31 + F.dayofmonth("session_date") * 7) % 50
    return s.select(ID, "user_id", "session_date",
                    *[F.when(rule != j, F.col(c)).alias(c)
                      for j, c in enumerate(SESSION_FEATURES)])


def load_sessions(spark: SparkSession, sf_dir: str, with_nulls: bool = True) -> DataFrame:
    """The session table as an ingest-stage output: derived from the events
    once per application and written to the shared checkpoint folder, so the
    profiling/cleaning/drift stages (several jobs each) never re-aggregate the
    events."""
    return stage_table(spark, ("sessions", os.path.abspath(sf_dir), with_nulls),
                       lambda: sessions_from_events(read_table(spark, sf_dir, "events"),
                                                    read_table(spark, sf_dir, "customer"),
                                                    with_nulls))


def raw_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw table of the reference's shape: id + 13 columns (``user_id`` of the
    session table = ``session_id``)."""
    s = load_sessions(spark, sf_dir)
    return s.select(F.col(ID), *SESSION_FEATURES)


def dirty_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quarantine fixture: sessions plus bad copies derived from them.

    * day-1 sessions again, target 2      (repeated id + bad target)
    * day-2 sessions, new id (+50), age 12 (age below range)
    * day-3 sessions, new id (+60), age 101 (age above range)
    Rows are derived from the data, so the fixture grows with the tables.
    """
    s = load_sessions(spark, sf_dir)
    day = F.dayofmonth("session_date")
    cols = [ID, "session_date", *SESSION_FEATURES]
    dup = s.filter(day == 1).withColumn(TARGET, F.lit(2.0)).select(*cols)
    young = (s.filter(day == 2).withColumn(ID, F.col(ID) + 50)
             .withColumn("age", F.lit(12.0)).select(*cols))
    old = (s.filter(day == 3).withColumn(ID, F.col(ID) + 60)
           .withColumn("age", F.lit(101.0)).select(*cols))
    return s.select(*cols).unionByName(dup).unionByName(young).unionByName(old)


def session_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every session as a JSON request body (``session_id, requested_at,
    body``).  A null column is left out of the body.  Some bodies are bad, by
    the user's number: cut short (11 k + 3), ``age`` a word (13 k + 5),
    ``gender`` a number (17 k + 4), ``device_type`` unknown to the service
    (19 k + 6)."""
    s, user = load_sessions(spark, sf_dir), F.col("user_id")
    value = {c: F.col(c) for c in SESSION_FEATURES if c != TARGET}
    value["age"] = F.when(user % 13 == 5, F.lit('"young"')).otherwise(F.to_json(F.array("age")))
    value["gender"] = F.when(user % 17 == 4, F.lit("7")).otherwise(F.to_json(F.array("gender")))
    value["device_type"] = F.when(user % 19 == 6, F.lit('"Watch"')).otherwise(F.to_json(F.array("device_type")))
    text = [F.when(F.col(c).isNotNull(), F.concat(F.lit(f'"{c}":'), F.regexp_replace(v if c in ("age", "gender", "device_type") else F.to_json(F.array(c)), r"^\[|\]$", "")))
            for c, v in value.items()]
    body = F.concat(F.lit("{"), F.concat_ws(",", *text), F.lit("}"))
    out = s.select("session_id", "user_id", F.col("session_date").cast("timestamp_ntz").alias("requested_at"), body.alias("b"))
    return out.select("session_id", "requested_at", F.when(user % 11 == 3, F.expr("left(b, length(b) - 1)")).otherwise(F.col("b")).alias("body"))


def scored_documents(spark: SparkSession, sf_dir: str, label: str = "quality",
                     cut: float = SCORE_CUT) -> DataFrame:
    """``scored`` fixture: (doc_id, label, score, prediction, subgroup).

    label = ``labels.<label>``, score = ``n_chars / max(n_chars)`` over the
    labelled documents, prediction = ``score >= cut``, subgroup = ``lang``.
    The maximum is one fitted scalar (one tiny aggregate job), so no
    un-partitioned window is needed.
    """
    joined = (read_table(spark, sf_dir, "labels").select("doc_id", F.col(label).alias("label"))
              .join(read_table(spark, sf_dir, "documents").select("doc_id", "lang", "n_chars"),
                    "doc_id"))
    top = joined.agg(F.max("n_chars")).first()[0]
    score = F.col("n_chars").cast("double") / F.lit(float(top or 1))
    return joined.select("doc_id", F.col("label").cast("int").alias("label"),
                         score.alias("score"),
                         (score >= F.lit(cut)).cast("int").alias("prediction"),
                         F.col("lang").alias("subgroup"))
