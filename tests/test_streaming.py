"""Streaming K5 with keyed state: several micro-batches equal the batch K1."""

import pyarrow.parquet as pq
import pytest

from clickscope.operators import scoring as K
from clickscope.streaming import pipelines as ST

KEYS = ["event_type", "user_id"]


@pytest.fixture(scope="module")
def split_events(tmp_path_factory, sf_dir):
    """The sf0.001 events cut into four time-ordered files (four micro-batches)."""
    t = pq.read_table(f"{sf_dir}/events.parquet").sort_by([("ts", "ascending"),
                                                            ("event_id", "ascending")])
    d = tmp_path_factory.mktemp("events4")
    step = -(-t.num_rows // 4)
    for i in range(4):
        pq.write_table(t.slice(i * step, step), str(d / f"events-{i:03d}.parquet"))
    return str(d)


@pytest.mark.parametrize("ttl", [3600, 86400 * 30])
def test_stateful_stream_scoring_equals_batch(spark, split_events, ttl):
    got = ST.stream_scoring_stateful(spark, split_events, KEYS, K.logistic_score("value"),
                                     ttl, None, watermark="1 hour")
    ev = spark.read.parquet(split_events)
    want, _ = K.cached_scoring(ev, KEYS, "ts", "event_id", K.logistic_score("value"), ttl,
                               None, None)
    want = want.select(*got.columns)
    assert got.count() == ev.count()
    assert got.exceptAll(want).count() == 0
    assert want.exceptAll(got).count() == 0
    if ttl > 86400:
        # with a 30-day TTL, later micro-batches must hit entries written by earlier ones
        assert got.filter("cached").count() > 0


def test_foreach_batch_stream_scoring_equals_batch(spark, split_events):
    ttl = 86400 * 30
    got = ST.stream_scoring(spark, split_events, KEYS, K.logistic_score("value"), ttl, None)
    ev = spark.read.parquet(split_events)
    want, _ = K.cached_scoring(ev, KEYS, "ts", "event_id", K.logistic_score("value"), ttl,
                               None, None)
    want = want.select(*got.columns)
    assert got.exceptAll(want).count() == 0
    assert want.exceptAll(got).count() == 0


def test_window_moments_over_several_files_equal_batch(spark, split_events):
    from pyspark.sql import functions as F
    got, late = ST.window_moments(spark, split_events, "7 days", "1 day")
    assert late == 0
    ev = spark.read.parquet(split_events)
    week = F.date_from_unix_date((F.floor(F.unix_date(F.to_date("ts")) / 7) * 7).cast("int"))
    want = ev.groupBy(week.alias("window_start"), "event_type").agg(
        F.count(F.lit(1)).alias("n"), F.avg("value").alias("mean_value"),
        F.stddev_samp("value").alias("std_value"))
    r = lambda df: df.select("window_start", "event_type", "n",
                             F.round("mean_value", 6).alias("m"), F.round("std_value", 6).alias("s"))
    assert r(got).exceptAll(r(want)).count() == 0
    assert r(want).exceptAll(r(got)).count() == 0


def test_stream_validate_counts_rows_later_than_the_watermark(spark, sf_dir, tmp_path):
    """Files 0 and 1 hold the later half of the events, file 2 (read last)
    the earlier half.  Spark filters late rows against the watermark of the
    previous batch, so rows of file 2 older than (max seen in files 0-1) -
    1 hour are dropped in batch 2 and counted; all others are validated."""
    import datetime as dt
    import os

    import pyarrow.compute as pc
    t = pq.read_table(f"{sf_dir}/events.parquet").sort_by([("ts", "ascending"),
                                                           ("event_id", "ascending")])
    half = t.num_rows // 2
    q = half // 2
    late_part, first = t.slice(0, half), t.slice(half)
    parts = [t.slice(half, q), t.slice(half + q), late_part]
    for i, part in enumerate(parts):
        f = tmp_path / f"events-{i:03d}.parquet"
        pq.write_table(part, str(f))
        os.utime(f, (1_000_000 * (i + 1), 1_000_000 * (i + 1)))   # read in this order
    watermark = pc.max(first["ts"]).as_py() - dt.timedelta(hours=1)
    n_late = sum(1 for v in late_part["ts"].to_pylist() if v <= watermark)
    assert n_late > 0
    got = ST.stream_validate(spark, str(tmp_path)).first()
    assert got["n_late_dropped"] == n_late
    assert got["n_rows"] == t.num_rows - n_late


def test_late_rows_are_counted_and_do_not_stop_the_windows(spark, sf_dir, tmp_path):
    """Three files in time order, then one with rows of the first day: those
    are dropped and counted, every other row is in its window."""
    import datetime as dt
    import os
    t = pq.read_table(f"{sf_dir}/events.parquet").sort_by([("ts", "ascending"), ("event_id", "ascending")])
    first = sum(1 for v in t["ts"].to_pylist() if v.date() == dt.date(2024, 1, 1))
    assert first
    q = -(-t.num_rows // 3)
    for i, part in enumerate([t.slice(0, q), t.slice(q, q), t.slice(2 * q), t.slice(0, first)]):
        f = tmp_path / f"events-{i:03d}.parquet"
        pq.write_table(part, str(f))
        os.utime(f, (1_000_000 * (i + 1), 1_000_000 * (i + 1)))
    got, late = ST.window_moments(spark, str(tmp_path), "7 days", "1 day")
    assert late == first
    assert got.agg({"n": "sum"}).first()[0] == t.num_rows


def test_stateful_scoring_fails_instead_of_losing_late_requests(spark, sf_dir, tmp_path):
    import os
    t = pq.read_table(f"{sf_dir}/events.parquet").sort_by([("ts", "ascending"),
                                                           ("event_id", "ascending")])
    half = t.num_rows // 2
    q = half // 2
    for i, part in enumerate([t.slice(half, q), t.slice(half + q), t.slice(0, half)]):
        f = tmp_path / f"events-{i:03d}.parquet"
        pq.write_table(part, str(f))
        os.utime(f, (1_000_000 * (i + 1), 1_000_000 * (i + 1)))
    with pytest.raises(RuntimeError, match="later than"):
        ST.stream_scoring_stateful(spark, str(tmp_path), KEYS, K.logistic_score("value"),
                                   3600, None, watermark="1 hour")


def test_arrivals_of_a_many_file_source_come_in_time_order(spark, tmp_path):
    """The source's files each span the whole time: an arrival is one file of
    one range of time, none is lost, and scoring them equals the batch answer."""
    import datetime
    rows = [(i, datetime.datetime(2024, 1, 1) + datetime.timedelta(minutes=37 * (i * 61 % 400)), i % 7, "view", float(i % 50), None) for i in range(400)]
    rows.append((400, None, 1, "view", 1.0, None))
    ev = spark.createDataFrame(rows, ST.EVENTS_SCHEMA)
    ev.repartition(6, "event_id").write.parquet(str(tmp_path / "events.parquet"))
    for file_rows, at_least in ((1000, 4), (50, 9)):
        out = ST.arrival_files(spark, str(tmp_path), file_rows=file_rows)
        parts = sorted(spark.read.schema(ST.EVENTS_SCHEMA).parquet(out + "/events*.parquet").selectExpr("_metadata.file_path p", "ts").groupBy("p").agg({"ts": "min", "p": "count"}).withColumnsRenamed({"min(ts)": "lo", "count(p)": "n"}).collect(), key=lambda r: r["p"].split("/")[-2])
        assert len({r["p"].split("/")[-2] for r in parts}) == len(parts) >= at_least // 2 and sum(r["n"] for r in parts) == 401
        assert [r["lo"] for r in parts] == sorted(r["lo"] for r in parts)
        ends = spark.read.parquet(out + "/events*.parquet").selectExpr("_metadata.file_path p", "ts").groupBy("p").agg({"ts": "max"}).collect()
        hi = {r["p"]: r["max(ts)"] for r in ends}
        assert all(hi[a["p"]] < b["lo"] for a, b in zip(parts, parts[1:]))
    got = ST.stream_scoring(spark, ST.arrival_files(spark, str(tmp_path)), KEYS, K.logistic_score("value"), 86400, None).where("request_id < 400")
    want = K.cached_scoring(ev.where("ts is not null"), KEYS, "ts", "event_id", K.logistic_score("value"), 86400, None, None)[0].select(*got.columns)
    assert got.count() == 400 and got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
