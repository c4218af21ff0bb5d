"""Monitoring roll-ups and report tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickscope.sources.tables import read_table


def table_counts(spark: SparkSession, sf_dir: str, names: Sequence[str]) -> DataFrame:
    """A1: row count per table (Parquet footers answer ``count(*)``); a table
    that is not there counts 0, any other failure is raised."""
    parts = []
    for n in names:
        try:
            df = read_table(spark, sf_dir, n)
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            parts.append(spark.range(1).select(F.lit(n).alias("table_name"),
                                               F.lit(0).cast("long").alias("n_rows")))
            continue
        parts.append(df.agg(F.count(F.lit(1)).alias("n_rows"))
                     .select(F.lit(n).alias("table_name"), "n_rows"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def frame_counts(frames: dict) -> DataFrame:
    """A1 over stage tables: row count per named frame; ``None`` (a stage that
    was never written) counts 0, as a missing table does in the reference.
    One aggregate per frame; each is a footer/partial-count job."""
    spark = SparkSession.getActiveSession()
    parts = []
    for name, df in frames.items():
        if df is None:
            parts.append(spark.range(1).select(F.lit(name).alias("table_name"),
                                               F.lit(0).cast("long").alias("n_rows")))
        else:
            parts.append(df.agg(F.count(F.lit(1)).alias("n_rows"))
                         .select(F.lit(name).alias("table_name"), "n_rows"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def health_rollup(status: DataFrame, ok_col: str = "healthy") -> DataFrame:
    """All components healthy (AND); count of unhealthy ones."""
    return status.agg(F.bool_and(ok_col).alias("all_healthy"),
                      F.count_if(~F.col(ok_col)).alias("n_unhealthy"),
                      F.count(F.lit(1)).alias("n_components"))


def drift_report_rows(summary: DataFrame) -> DataFrame:
    """F12 + F14: presentation rows of a drift summary (fixed-point text with
    thousands separators; a comparison that was not made is never `OK`)."""
    return summary.select(
        "feature",
        F.format_number("ref_mean", 2).alias("ref_mean_text"),
        F.format_number("curr_mean", 2).alias("curr_mean_text"),
        F.when(F.col("drift_detected"), F.lit("DRIFT")).when(F.col("drift_detected").isNull(), F.lit("NOT COMPUTED"))
        .otherwise(F.lit("OK")).alias("status"))


def stamped(df: DataFrame) -> DataFrame:
    """F16: generation time formatted as text."""
    return df.withColumn("generated_at",
                         F.date_format(F.current_timestamp(), "yyyy-MM-dd HH:mm:ss"))


def write_summary(df: DataFrame, path: str) -> None:
    """Drift / monitor result sink (Parquet, replaced each run)."""
    df.write.mode("overwrite").parquet(path)
