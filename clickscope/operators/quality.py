"""Validation and quarantine.

Rules return a per-row array of failed rule names; ``passed`` is an empty
array.  Both sides come from one plan, so writing passed rows and the
quarantine is two filters over the same (optionally persisted) frame.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickscope.sources.tables import write_table

# Rule names in report order.
RULES = ("unique_id", "target_binary", "age_range")


def duplicate_keys(df: DataFrame, key: str) -> DataFrame:
    """Keys that occur more than once (partial aggregation first: only
    (task x distinct key) rows reach the shuffle)."""
    return (df.groupBy(key).agg(F.count(F.lit(1)).alias("__c"))
            .filter(F.col("__c") > 1).select(key, F.lit(True).alias("__dup")))


def flag_rules(df: DataFrame, key: str = "session_id", target: str = "ad_clicked",
               age: str = "age", age_range: tuple[float, float] = (13, 100)) -> DataFrame:
    """V1-V4: add ``failed_rules`` (array<string>, rule order) and ``passed``.

    V1 is a left join with the (normally tiny) set of duplicated keys; a hot
    duplicated key is split by AQE's skew-join handling.  Null target and null
    age pass V2/V3 (they are handled by the cleaning stage).
    """
    dups = duplicate_keys(df, key)
    j = df.join(dups, key, "left")
    lo, hi = age_range
    checks = F.array_compact(F.array(
        F.when(F.col("__dup"), F.lit(RULES[0])),
        F.when(~F.col(target).isin(0, 1), F.lit(RULES[1])),
        F.when(~F.col(age).between(lo, hi), F.lit(RULES[2]))))
    return (j.withColumn("failed_rules", checks).drop("__dup")
            .withColumn("passed", F.size("failed_rules") == 0))


def split_valid(flagged: DataFrame) -> tuple[DataFrame, DataFrame]:
    """V4: (passed rows, quarantined rows with the rule names)."""
    return (flagged.filter(F.col("passed")).drop("failed_rules", "passed"),
            flagged.filter(~F.col("passed")))


def write_verdicts(flagged: DataFrame, path: str, run_id: str) -> None:
    """Passed and quarantined rows of one run from one pass over them, as
    partitions of one table (run, verdict); a repeated run replaces its own
    partitions and leaves the others."""
    verdict = F.when(F.col("passed"), F.lit("passed")).otherwise(F.lit("quarantined"))
    rows = flagged.withColumn("run_id", F.lit(run_id)).withColumn("verdict", verdict).withColumn("failed_rules", F.concat_ws(",", "failed_rules"))
    write_table(rows.drop("passed"), path, partition_by=["run_id", "verdict"], replace_partitions=True)


def rule_summary(flagged: DataFrame) -> DataFrame:
    """Counts per rule plus passed / quarantined totals, one aggregate."""
    fr = F.col("failed_rules")
    return flagged.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(F.col("passed")).alias("n_passed"),
        F.count_if(~F.col("passed")).alias("n_quarantined"),
        *[F.count_if(F.array_contains(fr, r)).alias(f"n_{r}") for r in RULES])


def rowcount_deviation(df: DataFrame, period_col: str, threshold: float = 0.10) -> DataFrame:
    """V5: rows per ingest period vs the previous period; alert when
    ``|n - prev| / prev > threshold``.  Every period has a verdict: without
    anything to compare (the first one) ``deviation`` is null and no alert is
    raised.  The lag window runs on the per-period counts (one row per period), never on
    the rows."""
    counts = df.groupBy(period_col).agg(F.count(F.lit(1)).alias("n_rows"))
    prev = F.lag("n_rows").over(Window.orderBy(period_col))
    return _deviation(counts.withColumn("prev_rows", prev), threshold).withColumn("alert", F.coalesce("alert", F.lit(False)))


def rowcount_against_log(df: DataFrame, runs: DataFrame, started_at: Column, key: str = "n_rows", threshold: float = 0.10) -> DataFrame:
    """V5 against the run log: the rows of this ingest and those that the last
    run started before ``started_at`` recorded as ``key`` (null without one)."""
    before = runs.where((F.col("key") == key) & (F.col("started_at") < started_at))
    last = before.agg(F.max_by("value", F.struct("started_at", "run_id")).cast("long").alias("prev_rows"))
    # one row each
    return _deviation(df.agg(F.count(F.lit(1)).alias("n_rows")).join(F.broadcast(last), F.lit(True)), threshold)


def _deviation(counts: DataFrame, threshold: float) -> DataFrame:
    dev = F.abs(F.col("n_rows") - F.col("prev_rows")) / F.col("prev_rows")
    return counts.withColumn("deviation", F.round(dev, 6)).withColumn("alert", dev > threshold)


# The request's fields; labels default to 'Unknown'.
REQUEST_NUMBERS = ("age", "time_on_site", "pages_viewed", "previous_purchases", "cart_items", "discount_seen",
                   "returning_user", "avg_session_time", "bounce_rate", "purchase")
REQUEST_LABELS = ("gender", "device_type")


def type_requests(raw: DataFrame, body: str = "body", keep: Sequence[str] = (), numbers: Sequence[str] = REQUEST_NUMBERS,
                  labels: Sequence[str] = REQUEST_LABELS) -> DataFrame:
    """V6: ``keep``, the typed fields and ``errors`` (one text a faulty field;
    empty for a good request).

    The body is parsed once to a VARIANT.  ``body:not_json`` and
    ``body:not_an_object`` stand alone; a required number that is not there is
    ``<field>:missing``, one of another type ``<field>:not_a_number`` (text of a
    number is one); a label that is not there is 'Unknown', one of another type
    ``<field>:not_a_string``.  Fields the request doesn't know are ignored."""
    v = F.col("__v")
    parsed = raw.select(*keep, F.try_parse_json(F.col(body)).alias("__v"))
    is_object = F.schema_of_variant(v).startswith("OBJECT")
    kind = lambda c: F.schema_of_variant(F.try_variant_get(v, f"$.{c}", "variant"))
    number = {c: F.try_variant_get(v, f"$.{c}", "double") for c in numbers}
    faults = [F.when(kind(c).isNull(), F.lit(f"{c}:missing")).when(number[c].isNull() | F.isnan(number[c]) | kind(c).isin("BOOLEAN", "VOID"), F.lit(f"{c}:not_a_number")) for c in numbers]
    faults += [F.when(kind(c).isNotNull() & (kind(c) != "STRING"), F.lit(f"{c}:not_a_string")) for c in labels]
    errors = (F.when(v.isNull(), F.array(F.lit("body:not_json"))).when(~is_object, F.array(F.lit("body:not_an_object")))
              .otherwise(F.array_compact(F.array(*faults))))
    return parsed.select(*keep, *[number[c].alias(c) for c in numbers],
                         *[F.coalesce(F.try_variant_get(v, f"$.{c}", "string"), F.lit("Unknown")).alias(c) for c in labels], errors.alias("errors"))
