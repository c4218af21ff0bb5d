"""Run log (S6, E7, F15, O4): parameters and metrics of every run, once.

One folder a run and kind under the log's root, written in one commit and only
if it is not there yet: a task, stage or driver that repeats a run adds
nothing, and a folder without its commit marker is written anew.
"""

from __future__ import annotations

import json
import os
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickscope.session import path_exists

SCHEMA = "run_id string, started_at timestamp_ntz, kind string, key string, value double, text string"
# The kinds of records.
KINDS = ("param", "metric")


def log_frame(records: DataFrame, root: str, run_id: str) -> bool:
    """Commits ``records`` (:data:`SCHEMA`) as the run's folder; False if the
    run is in the log already."""
    path = os.path.join(root, f"run={run_id}")
    if path_exists(records.sparkSession, os.path.join(path, "_SUCCESS")):
        return False
    fields = T._parse_datatype_string(SCHEMA) if isinstance(SCHEMA, str) else SCHEMA
    records.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in fields]).coalesce(1).write.mode("overwrite").parquet(path)
    return True


def log_run(spark: SparkSession, root: str, run_id: str, started_at, params: Mapping | None = None, metrics: Mapping | None = None) -> bool:
    """Parameters (numbers as numbers, all as JSON text) and metrics of a run."""
    number = lambda v: float(v) if isinstance(v, (int, float)) and not isinstance(v, bool) else None
    rows = [(run_id, started_at, "param", k, number(v), json.dumps(v, sort_keys=True)) for k, v in (params or {}).items()]
    rows += [(run_id, started_at, "metric", k, float(v), None) for k, v in (metrics or {}).items() if v is not None]
    return log_frame(spark.createDataFrame(rows, SCHEMA), root, run_id)


def read_runs(spark: SparkSession, root: str) -> DataFrame:
    """All committed records (an empty log has none)."""
    if not path_exists(spark, root):
        return spark.createDataFrame([], SCHEMA)
    return spark.read.schema(SCHEMA).option("recursiveFileLookup", True).parquet(root)


def asof_join(left: DataFrame, right: DataFrame, left_time: str, right_time: str, values: list[str], by: list[str] | None = None) -> DataFrame:
    """``left`` with ``values`` of the last row of ``right`` at or before
    ``left_time`` (null if there is none): both sides in one ordered window per
    ``by``, so no pair of rows is ever made.  Without ``by`` the window is one
    task: both sides must be aggregates (a row a week, a row a run)."""
    by = by or []
    l = left.select(*by, F.col(left_time).cast("timestamp_ntz").alias("__t"), F.lit(1).alias("__side"), F.struct(*left.columns).alias("__row"),
                    *[F.lit(None).cast(right.schema[v].dataType).alias(f"__{v}") for v in values], F.lit(False).alias("__has"))
    r = right.select(*by, F.col(right_time).cast("timestamp_ntz").alias("__t"), F.lit(0).alias("__side"), F.lit(None).cast(l.schema["__row"].dataType).alias("__row"),
                     *[F.col(v).alias(f"__{v}") for v in values], F.lit(True).alias("__has"))
    w = Window.partitionBy(*by).orderBy("__t", "__side").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    last = lambda v: F.last(F.when(F.col("__has"), F.struct(F.col(f"__{v}").alias("v"))), ignorenulls=True).over(w)["v"]
    found = l.unionByName(r).select("__side", "__row", *[last(v).alias(v) for v in values])
    return found.where("__side = 1").select("__row.*", *values)


def latest_run(runs: DataFrame) -> DataFrame:
    """The run with the latest start time (of equal times the larger id)."""
    return runs.agg(F.max_by("run_id", F.struct("started_at", "run_id")).alias("run_id"))


def latest_run_metrics(runs: DataFrame, places: int = 4) -> DataFrame:
    """O4 + F10 + F11: metrics of the latest run, names without 'eval_' and
    upper-cased, values rounded."""
    metrics = runs.where("kind = 'metric'")
    return (metrics.join(F.broadcast(latest_run(metrics)), "run_id", "left_semi")
            .select(F.upper(F.regexp_replace("key", "^eval_", "")).alias("metric"), F.round("value", places).alias("value")))


def metrics_map(runs: DataFrame, places: int = 4) -> DataFrame:
    """one map<string,double> per run from its metric records."""
    return runs.where("kind = 'metric'").groupBy("run_id").agg(
        F.transform_values(F.map_from_entries(F.array_sort(F.collect_list(F.struct("key", "value")))), lambda k, v: F.round(v, places)).alias("metrics"))
