"""Property tests (hypothesis): splits, ranks, running totals, metrics, cache fold."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from clickscope.functions.windows import running_totals, search_bucket
from clickscope.operators import drift as D
from clickscope.operators import metrics as M
from clickscope.operators import scoring as K
from clickscope.operators import split as S

SETTINGS = settings(max_examples=8, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture])


@SETTINGS
@given(st.lists(st.integers(0, 1), min_size=2, max_size=60))
def test_stratified_split_disjoint_cover_and_balanced(spark, labels):
    df = spark.createDataFrame([(i, y) for i, y in enumerate(labels)], "k long, y int")
    out = S.stratified_split(df, "k", "y", 0.2, 7, bits=3, single_task_rows=0).collect()
    assert sorted(r["k"] for r in out) == list(range(len(labels)))  # disjoint + covers
    for cls in (0, 1):
        n = labels.count(cls)
        t = sum(1 for r in out if r["y"] == cls and r["split"] == "test")
        assert t == int(0.2 * n + 0.5)


@SETTINGS
@given(st.lists(st.integers(0, 1), min_size=3, max_size=60))
def test_folds_cover_and_balance(spark, labels):
    df = spark.createDataFrame([(i, y) for i, y in enumerate(labels)], "k long, y int")
    out = S.stratified_folds(df, "k", "y", 3, 42, bits=2, single_task_rows=0).collect()
    assert len(out) == len(labels)
    for cls in (0, 1):
        sizes = [sum(1 for r in out if r["y"] == cls and r["fold"] == f) for f in range(3)]
        assert max(sizes) - min(sizes) <= 1


@SETTINGS
@given(st.lists(st.tuples(st.integers(0, 3), st.integers(-5, 5)), min_size=1, max_size=40),
       st.integers(1, 5))
def test_running_totals_equal_brute_force(spark, rows, nb):
    df = spark.createDataFrame([(i, g, float(v)) for i, (g, v) in enumerate(rows)],
                               "i long, g int, v double")
    splits = sorted({float(v) for _, v in rows})[::max(1, nb)]
    d = df.withColumn("b", search_bucket(F.col("v"), splits))
    got = {r["i"]: (r["s"], r["rn"]) for r in
           running_totals(d, ["g"], "b", ["v", "i"], {"s": F.col("v")}, row_number="rn").collect()}
    for i, (g, v) in enumerate(rows):
        before = [(vv, j) for j, (gg, vv) in enumerate(rows) if gg == g and (vv, j) <= (v, i)]
        assert got[i] == (sum(x for x, _ in before), len(before))


@SETTINGS
@given(st.lists(st.tuples(st.integers(0, 1), st.integers(0, 6)), min_size=2, max_size=50))
def test_auc_symmetry_and_confusion_sum(spark, rows):
    df = spark.createDataFrame([(l, float(s), int(s > 3)) for l, s in rows],
                               "label int, score double, prediction int")
    a = M.roc_auc(df, n_buckets=3, single_task_rows=0).first()["auc"]
    b = M.roc_auc(df.withColumn("score", -F.col("score")), n_buckets=3, single_task_rows=0).first()["auc"]
    if a is None:
        assert b is None
    else:
        assert abs(a + b - 1.0) < 2e-6
    assert sum(r["n"] for r in M.confusion(df).collect()) == len(rows)


@SETTINGS
@given(st.lists(st.floats(-100, 100, allow_nan=False), min_size=2, max_size=40),
       st.lists(st.floats(-100, 100, allow_nan=False), min_size=2, max_size=40))
def test_ks_in_unit_interval_and_psi_self_zero(spark, a, b):
    df = spark.createDataFrame([(x, D.REF) for x in a] + [(x, D.CUR) for x in b], "x double, side string")
    r = D.ks_test(df, ["x"], n_buckets=3, single_task_rows=0).first()
    assert 0.0 <= r["ks_stat"] <= 1.0 and 0.0 <= r["p_value"] <= 1.0
    same = spark.createDataFrame([(x, s) for x in a for s in (D.REF, D.CUR)], "x double, side string")
    assert D.psi(same, ["x"]).first()["psi"] == 0.0


def _replay(events, ttl):
    anchor, out = {}, {}
    for rid, key, t in sorted(events, key=lambda e: (e[1], e[2], e[0])):
        a = anchor.get(key)
        if a is None or t >= a + ttl:
            anchor[key] = t
            out[rid] = False
        else:
            out[rid] = True
    return out


@SETTINGS
@given(st.lists(st.tuples(st.sampled_from("abc"), st.integers(0, 20_000)), min_size=1, max_size=60))
def test_cache_fold_equals_brute_force_replay(spark, reqs):
    events = [(i, k, t * 1_000_000) for i, (k, t) in enumerate(reqs)]
    df = spark.createDataFrame(events, "rid long, cache_key string, t_us long")
    got = {r["request_id"]: r["cached"] for r in
           K.anchor_requests(df, "cache_key", "t_us", "rid", 3600, partitions=3).collect()}
    assert got == _replay(events, 3600 * 1_000_000)


@SETTINGS
@given(st.lists(st.tuples(st.sampled_from("ab"), st.integers(0, 30_000)), min_size=1, max_size=60),
       st.booleans())
def test_parallel_hot_key_anchoring_equals_replay(spark, reqs, with_seed):
    """Every key forced through the pointer-doubling path (hot_key_rows=0)."""
    events = [(i, k, t * 1_000_000) for i, (k, t) in enumerate(reqs)]
    df = spark.createDataFrame(events, "rid long, cache_key string, t_us long")
    cache = None
    replay_in = list(events)
    if with_seed:
        first = min(t for _, k, t in events if k == reqs[0][0])
        seed_t = max(0, first - 1_800_000_000)
        cache = spark.createDataFrame([(reqs[0][0], seed_t, 0.5, 1)], K.CACHE_SCHEMA)
        replay_in = [(-1, reqs[0][0], seed_t)] + events
    got = {r["request_id"]: r["cached"] for r in
           K.anchor_requests(df, "cache_key", "t_us", "rid", 3600, cache=cache,
                             hot_key_rows=0).collect()}
    want = _replay(replay_in, 3600 * 1_000_000)
    want.pop(-1, None)
    assert got == want


def test_null_strata_survive_forced_buckets(spark):
    """Bucketed ranks keep every row, null strata included, and agree with the
    one-task plan."""
    from pyspark.sql import functions as F

    from clickscope.operators import split as S
    df = spark.range(1000).select("id", F.when(F.col("id") % 10 != 0, F.col("id") % 3).alias("label"))
    for make in (lambda n: S.stratified_split(df, "id", "label", 0.2, 7, single_task_rows=n),
                 lambda n: S.stratified_folds(df, "id", "label", 3, 7, single_task_rows=n)):
        one, many = (sorted(make(n).collect(), key=lambda r: r["id"]) for n in (1_000_000, 1))
        assert len(one) == 1000 and one == many


def test_many_strata(spark):
    from pyspark.sql import functions as F

    from clickscope.operators import split as S
    df = spark.range(24_000).select("id", (F.col("id") % 12_000).alias("label"))
    got = S.stratified_split(df, "id", "label", 0.5, 7).groupBy("split").count().collect()
    assert {r["split"]: r["count"] for r in got} == {"train": 12_000, "test": 12_000}


def test_empty_sides_are_null_not_errors(spark):
    from pyspark.sql import functions as F

    from clickscope.operators import drift as D
    from clickscope.operators import profile as P
    base = spark.range(50).select(F.col("id").cast("double").alias("x"), (F.col("id") % 3).cast("string").alias("c"))
    for side in (D.REF, D.CUR):
        t = base.withColumn("side", F.lit(side))
        for out in (D.mean_shift(t, ["x"]), D.ks_test(t, ["x"]), D.psi(t, ["x"]), D.chi2_test(t, ["c"]),
                    D.pvalue_summary(t.withColumn("c", F.col("c").cast("double")), ["x"], ["c"])):
            assert all(r["drift_detected"] is None for r in out.collect())
    r = P.class_counts(base.withColumn("y", F.lit(None).cast("double")), "y").first()
    assert r["n_labelled"] == 0 and r["pct_positive"] is None


def test_stage_follows_its_source(spark, tmp_path):
    from clickscope.session import stage_table
    d = str(tmp_path)
    spark.range(10).write.parquet(f"{d}/t.parquet")
    build = lambda: spark.read.parquet(f"{d}/t.parquet")
    assert stage_table(spark, ("s", d), build).count() == 10
    spark.range(20).write.mode("append").parquet(f"{d}/t.parquet")
    assert stage_table(spark, ("s", d), build).count() == 30


def test_unavailable_cache_scores_everything(spark):
    import datetime as dt

    from clickscope.operators import scoring as K
    rows = [(i, 1, dt.datetime(2024, 1, 1, 0, 0, i), 3.0) for i in range(3)]
    req = spark.createDataFrame(rows, "event_id long, user_id long, ts timestamp_ntz, value double")
    resp, cache = K.cached_scoring(req, ["user_id"], "ts", "event_id", K.logistic_score("value"), cache_available=False)
    assert [r["cached"] for r in resp.collect()] == [False] * 3 and cache.count() == 0
