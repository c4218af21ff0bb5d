"""Structured Streaming forms of the batch operators.

All sources are file streams with an explicit schema; all sinks are
``foreachBatch`` writers into the session's shared checkpoint folder, so a
restarted query resumes from its checkpoint and executor loss only replays a
micro-batch.  ``availableNow`` drains what is there and stops (tests, bench);
the same plans run continuously with ``processingTime`` triggers.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Sequence

import numpy as np
import pandas as pd

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickscope.functions.columns import epoch_micros
from clickscope.operators import scoring as K
from clickscope.session import ensure_checkpoint_dir

EVENTS_SCHEMA = T.StructType([
    T.StructField("event_id", T.LongType()),
    T.StructField("ts", T.TimestampNTZType()),
    T.StructField("user_id", T.LongType()),
    T.StructField("event_type", T.StringType()),
    T.StructField("value", T.DoubleType()),
    T.StructField("props", T.StringType()),
])
# Event types accepted by the ingest validation.
KNOWN_EVENT_TYPES = ("view", "click", "purchase", "signup", "error")
# Fixed value: rows of a delivered file (one task reads it), about.
FILE_ROWS = 2_000_000


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint directory."""
    return os.path.join(ensure_checkpoint_dir(spark), "clickscope-stream",
                        f"{name}-{uuid.uuid4().hex[:12]}")


def read_events_stream(spark: SparkSession, sf_dir: str, files_per_trigger: int = 1) -> DataFrame:
    """Event files as a stream; ``event_time`` is a TIMESTAMP built from the
    zone-free wall clock (``withWatermark`` refuses TIMESTAMP_NTZ)."""
    s = (spark.readStream.format("parquet").schema(EVENTS_SCHEMA)
         .option("maxFilesPerTrigger", files_per_trigger)
         .load(os.path.join(sf_dir, "events*.parquet")))
    return s.withColumn("event_time", F.timestamp_micros(epoch_micros("ts")))


def _batch_path(root: str, batch_id: int) -> str:
    """Per-batch output folder: a replayed micro-batch overwrites its own
    output (idempotent sink), readers see ``batch_id`` as a partition column."""
    return os.path.join(root, f"batch_id={batch_id}")


def _read_if_present(spark: SparkSession, path: str) -> DataFrame | None:
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(path)
    return spark.read.parquet(path) if p.getFileSystem(conf).exists(p) else None


def _run(stream_writer, trigger_available_now: bool = True) -> int:
    """Runs the query to its end, however long the input is; returns the rows
    that its stateful operators dropped as later than the watermark.  The
    counts are taken per batch while the query runs: progress reports are kept
    for the last batches only."""
    q = (stream_writer.trigger(availableNow=True) if trigger_available_now
         else stream_writer).start()
    late: dict[int, int] = {}
    most = 0
    ended = False
    while not ended:
        ended = q.awaitTermination(0.2)
        reports = q.recentProgress
        if late and reports and min(p.batchId for p in reports) > most + 1:
            raise RuntimeError("progress reports were dropped before they were read; raise "
                               "spark.sql.streaming.numRecentProgressUpdates")
        for p in reports:
            late[p.batchId] = sum(op.numRowsDroppedByWatermark for op in p.stateOperators)
            most = max(most, p.batchId)
    if q.exception():
        raise q.exception()
    return sum(late.values())


def _refuse_late(late: int, watermark: str) -> None:
    if late:
        raise RuntimeError(f"{late} rows arrived later than the {watermark} watermark; "
                           "raise `watermark` to the largest lateness of the source")


def window_moments(spark: SparkSession, sf_dir: str, window: str = "7 days",
                   watermark: str = "1 day", value_col: str = "value") -> tuple[DataFrame, int]:
    """Per tumbling window and event type: n, mean and std of ``value``;
    and the number of rows dropped as later than the watermark.

    Update mode + watermark keeps state bounded; each micro-batch appends its
    updated window rows with the batch id, and the answer is the last version
    of every window (a keyed upsert log, no complete-mode state).  A late row
    never stops the stream: it is counted, and its window stays as it was.
    """
    log = scratch(spark, "moments-log")
    agg = (read_events_stream(spark, sf_dir)
           .withWatermark("event_time", watermark)
           .groupBy(F.window("event_time", window), "event_type")
           .agg(F.count(F.lit(1)).alias("n"), F.avg(value_col).alias("mean_value"),
                F.stddev_samp(value_col).alias("std_value")))

    def sink(batch: DataFrame, batch_id: int) -> None:
        (batch.select(F.date_from_unix_date((F.unix_micros(F.col("window.start"))
                                             / 86_400_000_000).cast("int")).alias("window_start"),
                      "event_type", "n", "mean_value", "std_value")
         .write.mode("overwrite").parquet(_batch_path(log, batch_id)))

    # the rows that the sources sent, and those the windows took: progress
    # reports count late groups after the partial aggregate, not rows
    _run(agg.writeStream.outputMode("update").foreachBatch(sink)
         .option("checkpointLocation", scratch(spark, "moments-ckpt")))
    # each update carries the full aggregate of its window: keep the last one
    last = spark.read.parquet(log).groupBy("window_start", "event_type").agg(
        *[F.max_by(c, "batch_id").alias(c) for c in ("n", "mean_value", "std_value")])
    sent = spark.read.schema(EVENTS_SCHEMA).parquet(os.path.join(sf_dir, "events*.parquet")).where("ts is not null").count()
    return last, sent - (last.agg(F.sum("n")).first()[0] or 0)


def arrival_files(spark: SparkSession, sf_dir: str, n: int = 4, file_rows: int = FILE_ROWS) -> str:
    """The events of ``sf_dir`` as files in time order, one after the other, as
    a source would deliver them: a stream over them takes several batches.

    One file an arrival, ``n`` of them or, where those would hold more than
    about ``file_rows`` rows, as many as the rows ask for.  The events are cut
    by ranges of time in one pass (however many files they come from); the
    ranges are then delivered in order, as a stream takes files by their age."""
    out, ranges = scratch(spark, "arrivals"), scratch(spark, "arrival-ranges")
    ev = spark.read.schema(EVENTS_SCHEMA).parquet(os.path.join(sf_dir, "events.parquet"))
    n = max(n, -(-ev.count() // file_rows))
    ev.repartitionByRange(n, epoch_micros("ts"), "event_id").write.parquet(ranges)
    # one name a file, numbered in the order of the ranges
    names = sorted(r[0] for r in spark.read.parquet(ranges).select("_metadata.file_name").distinct().collect())
    for i, name in enumerate(names or [""]):
        part = spark.read.schema(EVENTS_SCHEMA).parquet(os.path.join(ranges, name))
        part.coalesce(1).write.parquet(os.path.join(out, f"events-{i:06d}.parquet"))
    return out


def window_drift(moments: DataFrame, reference: DataFrame, value_col: str = "value",
                 threshold: float = 0.1) -> DataFrame:
    """T1 drift flag: each window's mean against a static reference side per
    event type (D1 rule)."""
    ref = reference.groupBy("event_type").agg(F.avg(value_col).alias("ref_mean"),
                                              F.stddev_samp(value_col).alias("ref_std"))
    j = moments.join(ref, "event_type")  # one row per event type
    diff = F.abs(F.col("mean_value") - F.col("ref_mean"))
    return j.withColumn("drift_detected", F.when(diff.isNull(), F.lit(None).cast("boolean")).when(
        F.col("ref_std") > 0, diff > threshold * F.col("ref_std")).otherwise(F.lit(False)))


def stream_scoring(spark: SparkSession, sf_dir: str, key_cols: Sequence[str],
                   score, ttl_seconds: int = 3600, model_version: str | None = "v1",
                   lateness_seconds: int = 3600) -> DataFrame:
    """Every micro-batch is scored through the cache table left by the
    previous batches (K1 with ``cache=``), responses appended, and a new cache
    version written (latest entry per key).  Equals the batch answer when
    files arrive in time order.

    Entries that expired more than ``lateness_seconds`` before the batch's
    latest request are not carried into the next version, so the cache table
    holds the keys live within TTL + lateness, not every key ever seen.
    (:func:`stream_scoring_stateful` keeps the same entries in the state
    store, updated incrementally instead of rewritten per batch.)"""
    out = scratch(spark, "responses")
    cache_root = scratch(spark, "cache")

    def sink(batch: DataFrame, batch_id: int) -> None:
        # the cache left by the previous batch is found on the shared file
        # system, so a restarted query (replaying batch_id) sees the same state
        cache = _read_if_present(spark, os.path.join(cache_root, f"v{batch_id - 1}"))
        resp, new_cache = K.cached_scoring(batch, key_cols, "ts", "event_id", score,
                                           ttl_seconds, cache, model_version)
        resp.write.mode("overwrite").parquet(_batch_path(out, batch_id))
        # so is the latest request time up to the batch before
        mark = _read_if_present(spark, os.path.join(cache_root, f"latest{batch_id - 1}"))
        before = mark.first()[0] if mark is not None else None
        latest, oldest = batch.agg(F.max(epoch_micros("ts")), F.min(epoch_micros("ts"))).first()
        if before is not None and oldest is not None and oldest < before - lateness_seconds * 1_000_000:
            raise RuntimeError(f"requests of batch {batch_id} arrived more than {lateness_seconds} s late; "
                               "raise `lateness_seconds` to the largest lateness of the source")
        if latest is not None:
            horizon = latest - (lateness_seconds + ttl_seconds) * 1_000_000
            new_cache = new_cache.filter(F.col("written_at_us") > F.lit(horizon))
        spark.createDataFrame([(max((x for x in (latest, before) if x is not None), default=None),)], "latest long").coalesce(1).write.mode("overwrite").parquet(
            os.path.join(cache_root, f"latest{batch_id}"))
        new_cache.write.mode("overwrite").parquet(os.path.join(cache_root, f"v{batch_id}"))

    _run(read_events_stream(spark, sf_dir).writeStream.foreachBatch(sink)
         .option("checkpointLocation", scratch(spark, "scoring-ckpt")))
    return spark.read.parquet(out).drop("batch_id")


STATE_SCHEMA = "cache_key array<string>, anchor_us array<long>, probability array<double>, prediction array<int>"
RESPONSE_SCHEMA = ("request_id long, cache_key string, t_us long, cached boolean, "
                   "probability double, prediction int")


def _anchor_state_fn(ttl_us: int):
    """Fold of one micro-batch of a bucket of keys against the bucket's state.

    State = the live cache entries of the bucket's keys (anchor time, stored
    answer).  A request at or after anchor + TTL (or with no anchor) is a miss:
    it keeps its own answer and becomes the new anchor; otherwise it is a hit
    and gets the stored answer.  Entries expired by the watermark are left out
    of the new state, and the event-time timeout (watermark past the last
    expiry) removes it, so the state store holds live cache entries only.
    """
    def fn(key, pdfs, state):
        if state.hasTimedOut:
            state.remove()
            return
        rows = pd.concat(list(pdfs), ignore_index=True).sort_values(["cache_key", "t_us", "request_id"], kind="stable", ignore_index=True)
        live = {k: (a, p, c) for k, a, p, c in zip(*state.get)} if state.exists else {}
        keys, t = rows["cache_key"].to_numpy(), rows["t_us"].to_numpy()
        own_p, own_c = rows["probability"].to_numpy(), rows["prediction"].to_numpy()
        probs, preds, cached = own_p.astype("float64"), own_c.astype("int32"), np.zeros(len(t), dtype=bool)
        cut = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
        for lo, hi in zip(cut.tolist(), [*cut[1:].tolist(), len(t)]):
            entry, i = live.get(keys[lo]), lo
            while i < hi:
                if entry is None or t[i] >= entry[0] + ttl_us:
                    entry = (int(t[i]), float(own_p[i]), int(own_c[i]))
                    i += 1
                    continue
                # older than the live entry (arrived out of order): answered by
                # the model, the entry is kept
                first = i + int(np.searchsorted(t[i:hi], entry[0]))
                end = i + int(np.searchsorted(t[i:hi], entry[0] + ttl_us))
                cached[first:end], probs[first:end], preds[first:end] = True, entry[1], entry[2]
                i = end
            live[keys[lo]] = entry
        mark = state.getCurrentWatermarkMs()
        kept = [(k, *e) for k, e in live.items() if (e[0] + ttl_us) // 1000 > mark]
        if kept:
            state.update(tuple(map(list, zip(*kept))))
            state.setTimeoutTimestamp(max(e[1] for e in kept) // 1000 + ttl_us // 1000 + 1)
        elif state.exists:
            state.remove()
        yield pd.DataFrame({"request_id": rows["request_id"], "cache_key": keys, "t_us": t,
                            "cached": cached, "probability": probs, "prediction": preds})
    return fn


def stream_scoring_stateful(spark: SparkSession, sf_dir: str, key_cols: Sequence[str],
                            score, ttl_seconds: int = 3600, model_version: str | None = "v1",
                            watermark: str = "1 hour", files_per_trigger: int = 1, buckets: int = 256) -> DataFrame:
    """K5 with keyed streaming state: ``applyInPandasWithState`` over ``buckets``
    hash buckets of the cache keys (a Python call a bucket and batch, not one a
    key; a fixed number for the life of a checkpoint).

    The state store (partitioned by bucket across executors, checkpointed
    incrementally) holds the live entries and drops them once the watermark
    passes their expiry, so state grows with the keys live within TTL +
    watermark, not with the stream.  The model scores
    rows before the state operator (a JVM-side transform, no round trip);
    the state step only chooses between a row's own answer (miss) and the
    stored one (hit), which gives exactly the K1 responses for time-ordered
    files.  A bucket's rows within one micro-batch meet in one group, bounded by
    ``files_per_trigger``.  The sink is the exactly-once Parquet file sink.
    Requests later than ``watermark`` would be dropped by Spark before the
    state step; the run fails if that happened (none is lost silently).
    """
    from pyspark.sql.streaming.state import GroupStateTimeout
    out = scratch(spark, "responses-state")
    keyed = (read_events_stream(spark, sf_dir, files_per_trigger)
             .withWatermark("event_time", watermark)
             .withColumn("cache_key", K.cache_key(key_cols, model_version))
             .withColumn("t_us", epoch_micros("ts")))
    scored = score(keyed).select(
        F.col("event_id").alias("request_id"), "cache_key", "t_us", "event_time",
        F.col("probability").cast("double").alias("probability"),
        F.col("prediction").cast("int").alias("prediction"))
    bucketed = scored.withColumn("bucket", F.pmod(F.xxhash64("cache_key"), F.lit(buckets)))
    resp = bucketed.groupBy("bucket").applyInPandasWithState(
        _anchor_state_fn(ttl_seconds * 1_000_000), RESPONSE_SCHEMA, STATE_SCHEMA,
        "append", GroupStateTimeout.EventTimeTimeout)
    late = _run(resp.writeStream.format("parquet").option("path", out)
             .option("checkpointLocation", scratch(spark, "scoring-state-ckpt"))
             .outputMode("append"))
    # a request must never vanish: requests later than the watermark are not
    # answered by the stateful operator, so fail loudly
    _refuse_late(late, watermark)
    return spark.read.parquet(out).select("request_id", "cache_key", "cached",
                                          "probability", "prediction")


def stream_validate(spark: SparkSession, sf_dir: str, watermark: str = "1 hour") -> DataFrame:
    """Ingest validation: duplicates of ``event_id`` inside the watermark
    are dropped, rows failing a rule go to the quarantine side; the summary
    counts both sides over all micro-batches."""
    out = scratch(spark, "validated")
    s = (read_events_stream(spark, sf_dir).withWatermark("event_time", watermark)
         .dropDuplicatesWithinWatermark(["event_id"]))
    rules = F.array_compact(F.array(
        F.when(~(F.col("value") >= 0), F.lit("value_non_negative")),
        F.when(~F.col("event_type").isin(*KNOWN_EVENT_TYPES), F.lit("known_event_type"))))
    flagged = s.withColumn("failed_rules", rules).withColumn("passed", F.size("failed_rules") == 0)

    def sink(batch: DataFrame, batch_id: int) -> None:
        batch.select("event_id", "passed", F.concat_ws(",", "failed_rules").alias("failed_rules")) \
            .write.mode("overwrite").parquet(_batch_path(out, batch_id))

    late = _run(flagged.writeStream.foreachBatch(sink)
             .option("checkpointLocation", scratch(spark, "validate-ckpt")))
    v = spark.read.parquet(out)
    return v.agg(F.count(F.lit(1)).alias("n_rows"), F.count_if("passed").alias("n_passed"),
                 F.count_if(~F.col("passed")).alias("n_quarantined")
                 ).withColumn("n_late_dropped", F.lit(late).cast("long"))

