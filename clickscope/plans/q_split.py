"""Queries: deterministic splits and folds (SP1-SP3, U1)."""

from __future__ import annotations

from pyspark.sql import functions as F

from clickscope.operators import split as S
from clickscope.plans.oracle import CLEAN_CTES, with_ctes
from clickscope.plans.q_clean import processed_sessions
from clickscope.plans.registry import register

H = "md5(concat_ws(':', CAST(session_id AS VARCHAR), '42'))"
RANKED_CTES = CLEAN_CTES + [f"""ranked AS (
  SELECT session_id, ad_clicked,
         row_number() OVER (PARTITION BY ad_clicked ORDER BY {H}, session_id) AS rk,
         COUNT(*) OVER (PARTITION BY ad_clicked) AS n_class,
         row_number() OVER (ORDER BY {H}, session_id) AS rk_all,
         COUNT(*) OVER () AS n_all
  FROM processed)"""]


def _proc(spark, sf_dir):
    return processed_sessions(spark, sf_dir, keep_id=True)


@register("stratified_split", with_ctes(RANKED_CTES, """
SELECT session_id, ad_clicked,
       CASE WHEN rk <= floor(0.2 * n_class + 0.5) THEN 'test' ELSE 'train' END AS split
FROM ranked"""))
def q_stratified_split(spark, sf_dir):
    return S.stratified_split(_proc(spark, sf_dir), "session_id", "ad_clicked", 0.2, 42) \
        .select("session_id", "ad_clicked", "split")


@register("random_split", with_ctes(RANKED_CTES, """
SELECT session_id, CASE WHEN rk_all <= ceil(0.3 * n_all - 1e-9) THEN 'current' ELSE 'reference' END AS side
FROM ranked"""))
def q_random_split(spark, sf_dir):
    return S.random_split(_proc(spark, sf_dir), "session_id", 0.3, 42).select("session_id", "side")


@register("stratified_folds", with_ctes(RANKED_CTES, """
SELECT session_id, ad_clicked, CAST((rk - 1) % 3 AS INTEGER) AS fold FROM ranked"""))
def q_stratified_folds(spark, sf_dir):
    return S.stratified_folds(_proc(spark, sf_dir), "session_id", "ad_clicked", 3, 42) \
        .select("session_id", "ad_clicked", "fold")


@register("split_balance", with_ctes(RANKED_CTES, """
SELECT split, ad_clicked, COUNT(*) AS n FROM (
  SELECT ad_clicked, CASE WHEN rk <= floor(0.2 * n_class + 0.5) THEN 'test' ELSE 'train' END AS split
  FROM ranked) GROUP BY split, ad_clicked"""))
def q_split_balance(spark, sf_dir):
    """Sizes per (side, class); sides are disjoint and cover the input."""
    s = S.stratified_split(_proc(spark, sf_dir), "session_id", "ad_clicked", 0.2, 42)
    return s.groupBy("split", "ad_clicked").agg(F.count(F.lit(1)).alias("n"))


@register("hash_split", with_ctes(RANKED_CTES, f"""
SELECT session_id, CASE WHEN CAST('0x' || {H}[1:8] AS BIGINT) / 4294967296.0 < 0.2 THEN 'test' ELSE 'train' END AS split,
       CASE WHEN CAST('0x' || {H}[1:8] AS BIGINT) / 4294967296.0 < 0.3 THEN 'current' ELSE 'reference' END AS side,
       CAST(CAST('0x' || {H}[1:8] AS BIGINT) % 5 AS INTEGER) AS fold FROM ranked"""))
def q_hash_split(spark, sf_dir):
    """SP4: the fully parallel forms of SP1-SP3, by the hash alone (no sort, no
    shuffle)."""
    df = S.stratified_split(_proc(spark, sf_dir), "session_id", "ad_clicked", 0.2, 42, mode="hash")
    df = S.random_split(df, "session_id", 0.3, 42, mode="hash")
    return S.stratified_folds(df, "session_id", "ad_clicked", 5, 42, mode="hash").select("session_id", "split", "side", "fold")
