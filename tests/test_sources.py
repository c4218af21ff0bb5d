"""Sources and sinks: CSV scan with schema, landing listing, request typing,
response JSON, metrics map."""

import gzip
import hashlib
import os
import random
import tempfile

import duckdb
from pyspark.sql import functions as F

import __spark_entry__ as E
from clickscope.functions import checksums as C
from clickscope.operators import quality as Q
from clickscope.operators import runlog as RL
from clickscope.operators import scoring as K
from clickscope.plans.fixtures import raw_sessions
from clickscope.sources import tables as S


def test_landing_listing_matches_duckdb_read_blob(spark, sf_dir):
    got = {(r["file_name"], r["length"], r["sha256"])
           for r in E.queries()["landing_listing"](spark, sf_dir).collect()}
    want = set(duckdb.connect().execute(
        f"SELECT parse_filename(filename), size, sha256(content) FROM read_blob('{sf_dir}/*.parquet')"
    ).fetchall())
    assert got == want and len(got) == len(S.TABLES)


def _sha256_of(folder):
    return {(str(p), p.stat().st_size, hashlib.sha256(p.read_bytes()).hexdigest()) for p in folder.iterdir()}


def test_landing_listing_hashes_large_files_by_parts_of_any_length(spark, tmp_path):
    for n in (1, 999, 1000, 1001, 1999, 2000, 2001, 2113, 4242, 7919):
        (tmp_path / f"{n}.csv").write_bytes(random.Random(n).randbytes(n))
    (tmp_path / "a, b{c}[d]*?.csv").write_bytes(b"\xef\xbb\xbfx\r\n\0" * 1500)
    (tmp_path / "packed.csv.gz").write_bytes(gzip.compress(random.Random(7).randbytes(5000)))
    listing = S.landing_listing(spark, str(tmp_path), "*", part=1000)
    assert {(r["path"].removeprefix("file:"), r["length"], r["sha256"]) for r in listing.collect()} == _sha256_of(tmp_path)
    assert listing.count() == 12 and listing.columns == ["path", "length", "modificationTime", "sha256"]
    assert listing.schema == S.landing_listing(spark, str(tmp_path), "*").schema


def test_no_partition_of_a_large_file_is_over_a_part():
    for n in (1001, 64_000_001, 645_567_096, 5_599_000_003, 10**13 + 7):
        part = min(n - 1, C.PART)
        (_, size, _, parts), (record, tenth, first, end), (_, _, last, _) = C.cut(n, part)
        rest = n - last * tenth
        assert size <= part and size == 10 * tenth and size % record == tenth % record == 0
        assert first == 10 * parts and end == last and 0.1 * tenth < rest < 1.2 * tenth


def test_landing_listing_of_a_file_over_2_gb(spark, tmp_path):
    size = 2**31 + 12_345
    with open(tmp_path / "big.parquet", "wb") as f:
        f.truncate(size)
    want = hashlib.sha256()
    for n in [10**6] * (size // 10**6) + [size % 10**6]:
        want.update(bytes(n))
    assert [tuple(r) for r in E.queries()["landing_listing"](spark, str(tmp_path)).collect()] == [("big.parquet", size, want.hexdigest())]


def test_csv_folder_scan_reads_every_file_with_null_markers(spark, sf_dir):
    raw = raw_sessions(spark, sf_dir).withColumnRenamed("session_id", "user_id")
    d = tempfile.mkdtemp(prefix="csv-", dir="/tmp")
    # two part files: the scan must read the whole folder, not the first file
    raw.repartition(2).write.mode("overwrite").option("header", True) \
        .option("nullValue", "NA").csv(d)
    back = S.read_csv_folder(spark, d)
    assert back.count() == raw.count()
    assert back.filter(F.col("gender").isNull()).count() == raw.filter(F.col("gender").isNull()).count()
    assert back.schema == S.RAW_SESSION_SCHEMA
    assert len([f for f in os.listdir(d) if f.endswith(".csv")]) == 2


def test_request_typing_names_the_fault_of_each_field(spark):
    bodies = ['{"age":"12","x":1.5}', '{"age":"old","x":1}', '{"x":2}', '{"age":null,"x":true}', '{"age":3,"x":1,"gender":7}', '[1]', 'null', None,
              '{"age":3', '{"age":3,"x":1,"gender":null}', '{"age":3,"x":1,"gender":"F","more":[]}']
    df = spark.createDataFrame([(i, b, "k") for i, b in enumerate(bodies)], "i int, body string, other string")
    got = {r["i"]: r for r in Q.type_requests(df, "body", ("i",), ("age", "x"), ("gender",)).collect()}
    assert {i: r["errors"] for i, r in got.items()} == {
        0: [], 1: ["age:not_a_number"], 2: ["age:missing"], 3: ["age:not_a_number", "x:not_a_number"], 4: ["gender:not_a_string"],
        5: ["body:not_an_object"], 6: ["body:not_an_object"], 7: ["body:not_json"], 8: ["body:not_json"], 9: ["gender:not_a_string"], 10: []}
    assert (got[0]["age"], got[0]["x"], got[0]["gender"], got[10]["gender"]) == (12.0, 1.5, "Unknown", "F")


def test_verdicts_replace_their_own_run_only(spark, tmp_path):
    rows = spark.createDataFrame([(1, ["age"], False), (2, [], True)], "id int, failed_rules array<string>, passed boolean")
    for run in ("a", "b", "b"):
        Q.write_verdicts(rows, str(tmp_path / "v"), run)
    got = sorted(tuple(r) for r in S.read_written(spark, str(tmp_path / "v")).select("run_id", "verdict", "id", "failed_rules").collect())
    assert got == [("a", "passed", 2, ""), ("a", "quarantined", 1, "age"), ("b", "passed", 2, ""), ("b", "quarantined", 1, "age")]


def test_runs_are_logged_once_and_weeks_meet_the_live_run(spark, tmp_path):
    import datetime as dt
    root = str(tmp_path / "runs")
    day = lambda d: dt.datetime(2024, 1, d)
    assert RL.read_runs(spark, root).count() == 0
    assert RL.log_run(spark, root, "r1", day(3), {"trees": 100, "features": ["a"]}, {"eval_auc": 0.7, "none": None})
    assert not RL.log_run(spark, root, "r1", day(4), {}, {"eval_auc": 0.9})
    assert RL.log_run(spark, root, "r2", day(9), {}, {"eval_auc": 0.6})
    runs = RL.read_runs(spark, root)
    assert sorted((r["run_id"], r["kind"], r["key"], r["value"], r["text"]) for r in runs.collect()) == [
        ("r1", "metric", "eval_auc", 0.7, None), ("r1", "param", "features", None, '["a"]'), ("r1", "param", "trees", 100.0, "100"), ("r2", "metric", "eval_auc", 0.6, None)]
    assert [tuple(r) for r in RL.latest_run_metrics(runs).collect()] == [("AUC", 0.6)]
    weeks = spark.createDataFrame([(day(d).date(), d) for d in (1, 3, 8, 9, 15)], "w date, x int")
    got = RL.asof_join(weeks, runs.where("key = 'eval_auc'").withColumnRenamed("value", "base"), "w", "started_at", ["base"])
    assert sorted((r["x"], r["base"]) for r in got.collect()) == [(1, None), (3, 0.7), (8, 0.7), (9, 0.6), (15, 0.6)]
    keyed = RL.asof_join(weeks.withColumn("k", F.col("x") % 2), runs.where("key = 'eval_auc'").select(F.lit(1).alias("k"), "started_at", "value"), "w", "started_at", ["value"], ["k"])
    assert {r["x"]: r["value"] for r in keyed.collect()} == {1: None, 3: 0.7, 8: None, 9: 0.6, 15: 0.6}


def test_response_json_and_metrics_map(spark):
    resp = spark.createDataFrame([(1, 0.123456789, 0, True)],
                                 "request_id long, probability double, prediction int, cached boolean")
    js = K.response_json(resp).first()["response"]
    assert js == '{"ad_clicked_probability":0.123456789,"ad_clicked":0,"cached":true}'
    runs = spark.createDataFrame([("r1", "metric", "eval_auc", 0.123456), ("r1", "metric", "eval_f1", 0.5), ("r1", "param", "trees", 5.0)],
                                 "run_id string, kind string, key string, value double")
    m = RL.metrics_map(runs).first()["metrics"]
    assert m == {"eval_auc": 0.1235, "eval_f1": 0.5}
