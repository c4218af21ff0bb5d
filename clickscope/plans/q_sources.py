"""Queries: landing-folder listing with provenance checksums."""

from __future__ import annotations

from pyspark.sql import functions as F

import os
import uuid

from clickscope.functions.columns import r6, string_columns
from clickscope.operators import quality as Q
from clickscope.plans.fixtures import SESSION_FEATURES, dirty_sessions, load_sessions, raw_sessions
from clickscope.plans.oracle import SESSIONS_CTES, with_ctes
from clickscope.plans.q_quality import DIRTY_CTES
from clickscope.plans.registry import register
from clickscope.session import durable_dir
from clickscope.sources.tables import landing_listing, read_csv_folder, read_written, write_table


# The oracle needs the folder path, which the driver's SQL does not know:
# tests/test_sources.py checks it against DuckDB's read_blob instead.
@register("landing_listing")
def q_landing_listing(spark, sf_dir):
    """Files of the landing folder with size and SHA-256: small ones by the
    ``binaryFile`` source, the hash computed JVM-side; large ones a part per
    task."""
    files = landing_listing(spark, sf_dir, "*.parquet")
    return files.select(F.regexp_extract("path", r"([^/]+)$", 1).alias("file_name"),
                        "length", "sha256")


_VALUES = ", ".join(f"ROUND({c}, 6) AS {c}" if c not in ("gender", "device_type") else c for c in SESSION_FEATURES)


@register("csv_roundtrip", with_ctes(SESSIONS_CTES, f"""
SELECT session_id AS user_id, {_VALUES} FROM sessions"""))
def q_csv_roundtrip(spark, sf_dir):
    """S1 + S2 + F1: the sessions as header CSV in several files, nulls spelled
    as the markers the reader knows ('NA', 'NaN'), read back under the explicit
    schema, then written (replace, append) and read as a table."""
    base = os.path.join(durable_dir(spark), "csv", uuid.uuid4().hex)
    raw = raw_sessions(spark, sf_dir).withColumnRenamed("session_id", "user_id")
    spelled = raw.select(*[F.coalesce(F.col(c), F.lit("NA")).alias(c) if c in string_columns(raw) else
                           F.coalesce(F.col(c).cast("string"), F.lit("NaN")).alias(c) for c in raw.columns])
    spelled.write.option("header", True).csv(os.path.join(base, "landing"))
    back = read_csv_folder(spark, os.path.join(base, "landing"))
    even = F.col("user_id") % 2 == 0
    write_table(back.where(even), os.path.join(base, "table"))
    write_table(back.where(~even), os.path.join(base, "table"), "append")
    return spark.read.parquet(os.path.join(base, "table")).select("user_id", *[r6(c).alias(c) if c not in ("gender", "device_type") else F.col(c) for c in SESSION_FEATURES])


@register("quarantine_sink", with_ctes(DIRTY_CTES, """
SELECT CASE WHEN failed = '' THEN 'passed' ELSE 'quarantined' END AS verdict, failed AS failed_rules, COUNT(*) AS n,
       ROUND(SUM(age), 6) AS sum_age FROM flagged GROUP BY 1, 2"""))
def q_quarantine_sink(spark, sf_dir):
    """S10 + S2: one pass writes the passed and the quarantined rows of a run to
    their partitions; a repeated run replaces its own; both are read back."""
    path = os.path.join(durable_dir(spark), "validated", uuid.uuid4().hex)
    flagged = Q.flag_rules(dirty_sessions(spark, sf_dir))
    for run in ("run-1", "run-2", "run-2"):
        Q.write_verdicts(flagged if run == "run-2" else flagged.where("passed"), path, run)
    kept = read_written(spark, path).where("run_id = 'run-2'")
    return kept.groupBy("verdict", "failed_rules").agg(F.count(F.lit(1)).alias("n"), r6(F.sum("age")).alias("sum_age"))
