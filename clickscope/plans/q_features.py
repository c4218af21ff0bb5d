"""Queries: engineered features of the written design."""

from __future__ import annotations

from pyspark.sql import functions as F

from clickscope.functions.columns import numeric_columns, r6
from clickscope.operators import clean as C
from clickscope.operators import features as X
from clickscope.plans.fixtures import DEVICES, SESSION_FEATURES
from clickscope.plans.oracle import CLEAN_CTES, with_ctes
from clickscope.plans.q_clean import filled_sessions
from clickscope.plans.registry import register

NOMINAL = ("gender", "device_type")
NUMERIC = tuple(c for c in SESSION_FEATURES if c not in NOMINAL)
# The five standardised columns of the written design.
SCALED = ("age", "time_on_site", "pages_viewed", "previous_purchases", "cart_items")

IMPUTED_CTES = CLEAN_CTES + [
    "meds AS (SELECT " + ", ".join(f"median({c}) AS m_{c}" for c in NUMERIC) + " FROM filled)",
    "imputed AS (SELECT session_id, gender, device_type, "
    + ", ".join(f"COALESCE({c}, m_{c}) AS {c}" for c in NUMERIC) + " FROM filled, meds)",
]


def imputed_sessions(spark, sf_dir):
    """Every numeric column median-filled (medians of the labelled rows)."""
    df = filled_sessions(spark, sf_dir)
    cols = numeric_columns(df, exclude=("session_id",))
    return C.fill_medians(df, C.fit_medians(df, cols))


@register("median_impute", with_ctes(IMPUTED_CTES, "SELECT session_id, "
                                     + ", ".join(f"ROUND({c}, 6) AS {c}" for c in NUMERIC)
                                     + " FROM imputed"))
def q_median_impute(spark, sf_dir):
    df = imputed_sessions(spark, sf_dir)
    return df.select("session_id", *[r6(c).alias(c) for c in NUMERIC])


@register("one_hot", with_ctes(CLEAN_CTES, """
SELECT f.session_id, CAST((SELECT COUNT(*) FROM labels) AS INTEGER) AS size,
       CAST(g.code AS VARCHAR) || ',' || CAST(d.code + (SELECT COUNT(*) FROM labels WHERE feature = 'gender') AS VARCHAR) AS places,
       f.gender || ',' || f.device_type AS names
FROM filled f JOIN labels g ON g.feature = 'gender' AND g.label = f.gender JOIN labels d ON d.feature = 'device_type' AND d.label = f.device_type"""))
def q_one_hot(spark, sf_dir):
    """a sparse vector of the fitted labels' flags per session, shown as
    its size, its places and the names of those."""
    df = filled_sessions(spark, sf_dir)
    codes = C.fit_label_codes(df, list(NOMINAL))
    hot = X.one_hot_vector(df.select("session_id", *NOMINAL), codes, NOMINAL).drop(*NOMINAL)
    # as JSON: a sparse vector has size, indices, values; a dense one values only
    v = F.from_json(F.to_json(F.struct("hot")), "hot struct<size int, indices array<int>, values array<double>>")["hot"]
    ones = F.filter(F.transform(v["values"], lambda x, i: F.when(x == 1, i)), lambda i: i.isNotNull())
    rows = hot.select("session_id", F.coalesce(v["size"], F.size(v["values"])).alias("size"), F.coalesce(v["indices"], ones).alias("places"))
    names = X.one_hot_names(codes, NOMINAL).groupBy().agg(F.map_from_entries(F.collect_list(F.struct("place", "label"))).alias("m"))
    # one row: the names of the fitted labels
    return rows.join(F.broadcast(names), F.lit(True)).select(
        "session_id", "size", F.concat_ws(",", F.transform("places", lambda i: i.cast("string"))).alias("places"),
        F.concat_ws(",", F.transform("places", lambda i: F.element_at("m", i))).alias("names"))


@register("standardize", with_ctes(IMPUTED_CTES + [
    "st AS (SELECT " + ", ".join(f"AVG({c}) AS m_{c}, STDDEV_POP({c}) AS s_{c}" for c in SCALED)
    + " FROM imputed)"],
    "SELECT session_id, " + ", ".join(
        f"ROUND(CASE WHEN s_{c} > 0 THEN ({c} - m_{c}) / s_{c} ELSE 0 END, 6) AS {c}_z"
        for c in SCALED) + " FROM imputed, st"))
def q_standardize(spark, sf_dir):
    df = imputed_sessions(spark, sf_dir)
    out = X.standardize(df, X.fit_standard(df, SCALED), suffix="_z")
    return out.select("session_id", *[r6(f"{c}_z").alias(f"{c}_z") for c in SCALED])


@register("engagement", with_ctes(IMPUTED_CTES, """
SELECT session_id, ROUND(pages_viewed * time_on_site / (cart_items + 1), 6) AS engagement_score,
       ROUND(age * discount_seen, 6) AS age_x_discount_seen FROM imputed"""))
def q_engagement(spark, sf_dir):
    df = X.interaction(X.engagement_score(imputed_sessions(spark, sf_dir)), "age", "discount_seen")
    return df.select("session_id", r6("engagement_score").alias("engagement_score"),
                     r6("age_x_discount_seen").alias("age_x_discount_seen"))


# The labels that have columns in the written design's table.
_SEGMENTS = ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY", "Unknown")
_DEVICE_LABELS = (*DEVICES, "Unknown")


@register("session_obt", with_ctes(IMPUTED_CTES, "SELECT session_id AS user_id, CAST(trunc(age) AS INTEGER) AS age, "
          + ", ".join(f"CAST(gender = '{g}' AS TINYINT) AS \"gender_{g}\"" for g in _SEGMENTS) + ", "
          + ", ".join(f"CAST(device_type = '{d}' AS TINYINT) AS \"device_{d}\"" for d in _DEVICE_LABELS) + """,
       ROUND(time_on_site, 2) AS time_on_site, CAST(trunc(pages_viewed) AS INTEGER) AS pages_viewed, CAST(trunc(previous_purchases) AS INTEGER) AS previous_purchases,
       CAST(trunc(cart_items) AS INTEGER) AS cart_items, CAST(trunc(discount_seen) AS TINYINT) AS discount_seen,
       ROUND(CAST(CAST(pages_viewed * time_on_site / (cart_items + 1) AS FLOAT) AS DOUBLE), 1) AS engagement_score, CAST(ad_clicked AS TINYINT) AS ad_clicked,
       'obt-run' AS pipeline_run_id, CAST('2024-02-01' AS TIMESTAMP) AS ingestion_ts FROM imputed"""))
def q_session_obt(spark, sf_dir):
    """The one-big-table with its lineage columns (a stated ingestion time,
    single precision shown rounded)."""
    df = imputed_sessions(spark, sf_dir)
    out = X.session_obt(df, _SEGMENTS, _DEVICE_LABELS, "obt-run", F.lit("2024-02-01").cast("timestamp_ntz"))
    return out.withColumn("time_on_site", F.round(F.col("time_on_site").cast("double"), 2)).withColumn("engagement_score", F.round(F.col("engagement_score").cast("double"), 1))
