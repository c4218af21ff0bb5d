"""Golden micro-frames worked by hand for each null/NaN/tie/zero-division rule."""

import math

import pytest
from pyspark.sql import functions as F

from clickscope.functions.columns import normalise_missing
from clickscope.operators import clean as C
from clickscope.operators import drift as D
from clickscope.operators import metrics as M
from clickscope.operators import profile as P
from clickscope.operators import scoring as K


def test_nan_and_null_become_null(spark):
    df = spark.createDataFrame([(1.0, "a"), (float("nan"), "NA"), (None, None), (3.0, "x")],
                               "x double, s string")
    out = normalise_missing(df).agg(F.avg("x").alias("m"), F.count("x").alias("n"),
                                    F.count("s").alias("ns")).first()
    assert out["m"] == 2.0 and out["n"] == 2 and out["ns"] == 2


def test_median_even_odd_and_before_target_filter(spark):
    # medians over ALL rows (before dropping the unlabelled one): [1, 2, 10, 20] -> 6.0
    df = spark.createDataFrame([(1, None, 1.0, "M"), (2, 2.0, None, None), (3, 10.0, 0.0, "F"),
                                (4, 20.0, 1.0, "F"), (5, 1.0, 0.0, None)],
                               "session_id long, avg_session_time double, ad_clicked double, gender string")
    med = C.fit_medians(df, ["avg_session_time"])
    assert med["avg_session_time"] == 6.0
    out, enc, _ = C.clean_sessions(df, unknown_cols=("gender",))
    rows = out.orderBy("avg_session_time").collect()
    assert len(rows) == 4  # unlabelled row dropped after fitting the median
    assert sorted(r["avg_session_time"] for r in rows) == [1.0, 6.0, 10.0, 20.0]
    assert enc["gender"] == ["F", "M", "Unknown"]
    odd = spark.createDataFrame([(1.0,), (5.0,), (3.0,)], "v double")
    assert C.fit_medians(odd, ["v"])["v"] == 3.0


def test_unseen_category_maps_to_unknown(spark):
    df = spark.createDataFrame([("Male",), ("Female",), ("Other",), (None,)], "gender string")
    enc = {"gender": ["Female", "Male", "Unknown"]}
    codes = [r[0] for r in C.encode_labels(df, enc).collect()]
    assert codes == [1, 0, 2, 2]


def test_histogram_constant_column_and_last_bin(spark):
    const = spark.createDataFrame([(5.0,), (5.0,), (None,)], "v double")
    h = {r["bin"]: r["n"] for r in P.histogram(const, ["v"], 30).collect()}
    assert h[15] == 2 and sum(h.values()) == 2
    lin = spark.createDataFrame([(0.0,), (1.0,), (2.0,), (3.0,), (None,)], "v double")
    h = {r["bin"]: r["n"] for r in P.histogram(lin, ["v"], 3).collect()}
    assert h == {0: 1, 1: 1, 2: 2}  # maximum lands in the closed last bin; null dropped


def test_auc_ties_single_class_and_no_positive_prediction(spark):
    tied = spark.createDataFrame([(1, 0.5, 0), (0, 0.5, 0), (1, 0.5, 0), (0, 0.5, 0)],
                                 "label int, score double, prediction int")
    assert M.roc_auc(tied).first()["auc"] == 0.5
    one = spark.createDataFrame([(1, 0.2, 1), (1, 0.9, 1)], "label int, score double, prediction int")
    assert M.roc_auc(one).first()["auc"] is None
    b = M.binary_metrics(tied).first()
    assert b["precision"] == 0.0 and b["recall"] == 0.0 and b["f1"] == 0.0 and b["accuracy"] == 0.5


def test_auc_matches_pairwise_definition(spark):
    rows = [(1, 0.9), (0, 0.8), (1, 0.8), (0, 0.1), (1, 0.4), (0, 0.4), (0, 0.95)]
    df = spark.createDataFrame([(l, s, 0) for l, s in rows], "label int, score double, prediction int")
    pos = [s for l, s in rows if l == 1]
    neg = [s for l, s in rows if l == 0]
    want = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))
    assert M.roc_auc(df, n_buckets=3, single_task_rows=0).first()["auc"] == round(want, 6)


def test_ttl_anchoring_is_counted_from_the_write(spark):
    # requests at 1, 5, 3650, 3700, 9000 s -> miss, hit, miss, hit, miss
    ts = [1, 5, 3650, 3700, 9000]
    df = spark.createDataFrame([(i, "k", t * 1_000_000) for i, t in enumerate(ts)],
                               "rid long, cache_key string, t_us long")
    got = {r["request_id"]: r["cached"] for r in
           K.anchor_requests(df, "cache_key", "t_us", "rid", 3600).collect()}
    assert [got[i] for i in range(5)] == [False, True, False, True, False]


def test_psi_identical_sides_is_zero_and_empty_bin_is_floored(spark):
    vals = [float(v) for v in range(20)]
    same = spark.createDataFrame([(v, s) for v in vals for s in (D.REF, D.CUR)], "x double, side string")
    assert D.psi(same, ["x"]).first()["psi"] == 0.0
    shifted = spark.createDataFrame([(v, D.REF) for v in vals] + [(100.0 + v, D.CUR) for v in vals],
                                    "x double, side string")
    r = D.psi(shifted, ["x"]).first()
    assert r["psi"] > 0.2 and r["drift_detected"]
    assert math.isfinite(r["psi"])


def test_mean_shift_constant_column_and_rollup_not_computed(spark):
    df = spark.createDataFrame([(1.0, D.REF), (1.0, D.REF), (5.0, D.CUR)], "x double, side string")
    r = D.mean_shift(df, ["x"]).first()
    assert r["drift_detected"] is False  # std 0 -> no drift
    empty = D.mean_shift(df, ["x"]).filter("false")
    roll = D.drift_rollup(empty).first()
    assert roll["n_features"] == 0 and roll["any_drift"] is None  # not computed, not "no drift"


def test_ks_statistic_and_pvalue(spark):
    a = [float(v) for v in range(10)]
    b = [float(v) + 5 for v in range(10)]
    df = spark.createDataFrame([(v, D.REF) for v in a] + [(v, D.CUR) for v in b], "x double, side string")
    r = D.ks_test(df, ["x"], n_buckets=4, single_task_rows=0).first()
    assert r["ks_stat"] == 0.5
    assert 0.0 <= r["p_value"] <= 1.0


def test_chi2_pvalue_formula_matches_known_values(spark):
    # chi-square upper tail: Q(3.841459, 1) = 0.05, Q(5.991465, 2) = 0.05, Q(7.814728, 3) = 0.05
    df = spark.createDataFrame([(3.841459, 1), (5.991465, 2), (7.814728, 3), (11.0705, 5)],
                               "chi2 double, dof long")
    got = [r[0] for r in df.select(F.expr(D.chi2_pvalue_sql("chi2", "dof"))).collect()]
    for g in got:
        assert abs(g - 0.05) < 1e-5


def test_crosstab_margins_drop_null_categories(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 0.0), ("b", 1.0), (None, 1.0), ("b", None)],
                               "g string, y double")
    rows = {r["category"]: (r["n_0"], r["n_1"], r["n_all"])
            for r in P.crosstab_margins(df, ["g"], "y").collect()}
    assert rows == {"a": (1, 1, 2), "b": (0, 1, 1), "All": (1, 2, 3)}


@pytest.mark.parametrize("n,frac", [(10, 0.3), (7, 0.3), (1, 0.3)])
def test_random_split_size(spark, n, frac):
    from clickscope.operators import split as S
    df = spark.range(n).withColumnRenamed("id", "k")
    got = S.random_split(df, "k", frac, 42).filter(F.col("side") == "current").count()
    assert got == math.ceil(frac * n - 1e-9)


def test_label_codes_follow_byte_order(spark):
    vals = ["b", "a", "ab", "Z", "é", "a", None, "zz", "Unknown"]
    df = spark.createDataFrame([(v,) for v in vals], "c string")
    got = {r["label"]: r["code"] for r in C.label_code_table(df, ["c"]).collect()}
    labels = sorted({v for v in vals if v is not None} | {"Unknown"},
                    key=lambda x: x.encode("utf-8"))
    assert got == {lab: i for i, lab in enumerate(labels)}


def test_chi2_uses_every_category(spark):
    import numpy as np
    rng = np.random.default_rng(7)
    counts = {f"c{i:03d}": (int(rng.integers(1, 40)), int(rng.integers(1, 40))) for i in range(120)}
    rows = [(cat, side) for cat, (r, c) in counts.items()
            for side, n in ((D.REF, r), (D.CUR, c)) for _ in range(n)]
    df = spark.createDataFrame(rows, "g string, side string")
    got = D.chi2_test(df, ["g"]).first()
    obs = np.array(list(counts.values()), dtype=float)
    exp = obs.sum(1, keepdims=True) * obs.sum(0, keepdims=True) / obs.sum()
    stat = float(((obs - exp) ** 2 / exp).sum())
    assert got["dof"] == 119
    assert abs(got["chi2"] - round(stat, 6)) < 1e-6
    assert abs(got["p_value"] - _chi2_tail_by_integration(stat, 119)) < 1e-6


def _chi2_tail_by_integration(x, k):
    """Brute force: integrate the chi-square density from x outwards."""
    import numpy as np
    t = np.linspace(x, x + 40 * math.sqrt(2 * k) + 200, 400001)
    logpdf = (k / 2 - 1) * np.log(t) - t / 2 - (k / 2) * math.log(2) - math.lgamma(k / 2)
    return float(np.trapezoid(np.exp(logpdf), t))


@pytest.mark.parametrize("x,k", [(0.5, 1), (2.0, 2), (7.3, 3), (30.0, 40), (95.0, 101),
                                 (1030.0, 1000), (4950.0, 5001)])
def test_chi2_pvalue_any_dof_matches_integration(spark, x, k):
    df = spark.createDataFrame([(x, k)], "chi2 double, dof long")
    got = df.select(F.expr(D.chi2_pvalue_sql("chi2", "dof"))).first()[0]
    assert abs(got - _chi2_tail_by_integration(x, k)) < 1e-6


def test_chi2_pvalue_duckdb_form_agrees(spark):
    import duckdb
    pairs = [(3.841459, 1), (5.991465, 2), (7.3, 3), (95.0, 101), (1030.0, 1000), (0.0, 4)]
    df = spark.createDataFrame(pairs, "chi2 double, dof long")
    got = [r[0] for r in df.select(F.expr(D.chi2_pvalue_sql("chi2", "dof"))).collect()]
    con = duckdb.connect()
    for (x, k), g in zip(pairs, got):
        d = con.execute(f"SELECT {D.chi2_pvalue_duck('chi2', 'dof')} FROM "
                        f"(SELECT {x}::DOUBLE AS chi2, {k}::BIGINT AS dof)").fetchone()[0]
        assert abs(g - d) < 1e-9


def test_chi2_tail_of_many_degrees(spark):
    """Beyond the series: against the summed tail, and in constant memory."""
    def tail(x, k):                                # even k: Poisson sum
        h = x / 2
        return sum(math.exp(-h + i * math.log(h) - math.lgamma(i + 1)) for i in range(k // 2))
    pairs = [(k * (1 + z * math.sqrt(2 / k)), k) for k in (402, 20_000, 20_002, 300_000) for z in (-4.0, -1.0, -0.001, 0.0, 0.5, 2.0, 4.0, 8.0)]
    df = spark.createDataFrame([(float(x), k) for x, k in pairs], "chi2 double, dof long")
    got = [r[0] for r in df.select(F.expr(D.chi2_pvalue_sql())).collect()]
    assert max(abs(g - tail(x, k)) for g, (x, k) in zip(got, pairs)) < 1e-6
    big = spark.createDataFrame([(1e9 + 44721.0, 10**9), (1e9, 10**9 + 1)], "chi2 double, dof long")
    one, half = [r[0] for r in big.select(F.expr(D.chi2_pvalue_sql())).collect()]
    assert abs(one - 0.158655) < 1e-4 and abs(half - 0.5) < 1e-4


def test_stretches_equal_the_greedy_fold(spark):
    """Random timelines with cache entries anywhere, against a plain loop; only
    stretches of a TTL or more are folded."""
    import random
    rng = random.Random(4)
    rows, seeds = [], []
    for k in range(40):
        t = 0
        for _ in range(rng.randrange(1, 30)):
            t += rng.choice([0, 1, 3, 9, 10, 11, 40]) * 1_000_000
            (seeds if rng.random() < 0.1 else rows).append((f"k{k}", t))
    rows = [(i, *r) for i, r in enumerate(rows)]
    seeds = list(dict.fromkeys(seeds))
    want, live = {}, {}
    for key, t, _, i in sorted([(k, t, 0, None) for k, t in seeds] + [(k, t, 1, i) for i, k, t in rows]):
        if i is None:
            live[key] = t
        elif key not in live or t >= live[key] + 10_000_000:
            live[key], want[i] = t, (False, t)
        else:
            want[i] = (True, live[key])
    req = spark.createDataFrame(rows, "i long, k string, t long").repartition(5)
    cache = spark.createDataFrame(seeds, "cache_key string, written_at_us long")
    got = {r["request_id"]: (r["cached"], r["anchor_us"]) for r in K.anchor_requests(req, "k", "t", "i", 10, cache).collect()}
    assert got == want
    spans = K.stretches(req.select(F.col("i").alias("request_id"), F.col("k").alias("cache_key"), F.col("t").alias("t_us"), F.lit(False).alias("is_seed")), 10_000_000)
    assert 0 < spans.where("long").count() < len(rows)


def test_distributed_exact_quantiles_match_interpolation(spark, monkeypatch):
    import random

    from clickscope.functions import quantiles as QN
    monkeypatch.setattr(QN, "READ_LIMIT", 7)   # force several selection levels
    monkeypatch.setattr(QN, "BUCKETS", 4)
    rng = random.Random(3)
    vals = [round(rng.uniform(-50, 50), 3) for _ in range(300)] + [1.5] * 40 + [None] * 5
    df = spark.createDataFrame([(v, i % 2) for i, v in enumerate(vals)], "x double, g int")
    probs = [0.0, 0.1, 0.25, 0.5, 0.75, 0.9, 1.0]

    def brute(xs):
        xs = sorted(xs)
        out = []
        for p in probs:
            q = p * (len(xs) - 1)
            lo, hi = math.floor(q), math.ceil(q)
            out.append(xs[lo] + (xs[hi] - xs[lo]) * (q - lo))
        return out

    got = QN.quantile_values(df, ["x"], probs)[None, "x"]
    want = brute([v for v in vals if v is not None])
    assert all(abs(a - b) < 1e-9 for a, b in zip(got, want))
    # grouped, forced through the selection path, vs the built-in exact map
    q = QN.quantile_columns(df, ["x"], probs, group="g", distinct_limit=0)
    ref = QN.quantile_columns(df, ["x"], probs, group="g")
    a = {r["g"]: r["q"] for r in df.groupBy("g").agg(q["x"].alias("q")).collect()}
    b = {r["g"]: r["q"] for r in df.groupBy("g").agg(ref["x"].alias("q")).collect()}
    for g in a:
        assert all(abs(x - y) < 1e-9 for x, y in zip(a[g], b[g]))


def test_quantiles_of_all_columns_and_groups_at_once(spark, monkeypatch):
    """Null groups, empty columns, heavy ties, one value; and the jobs do not
    grow with columns, groups or probabilities."""
    import random

    from clickscope.functions import quantiles as QN
    monkeypatch.setattr(QN, "READ_LIMIT", 5)
    monkeypatch.setattr(QN, "BUCKETS", 8)
    rng = random.Random(11)
    rows = [(rng.choice(["a", "b", None]), rng.gauss(0, 1) if rng.random() < .9 else None, float(rng.randrange(3)), None if i % 3 else 1e6 * rng.random(), None) for i in range(400)]
    rows += [("lone", 4.5, None, None, None)]
    df = spark.createDataFrame(rows, "g string, x double, ties double, y double, none double")
    probs = [i / 20 for i in range(21)]
    cols = ["x", "ties", "y", "none"]
    got = QN.quantile_values(df, cols, probs, "g")
    for g in ("a", "b", None, "lone"):
        for c, i in zip(cols, range(1, 5)):
            xs = sorted(r[i] for r in rows if r[0] == g and r[i] is not None)
            want = [None] * 21 if not xs else [xs[math.floor(p * (len(xs) - 1))] + (xs[math.ceil(p * (len(xs) - 1))] - xs[math.floor(p * (len(xs) - 1))]) * (p * (len(xs) - 1) % 1) for p in probs]
            assert got[g, c] == want or all(abs(a - b) < 1e-6 for a, b in zip(got[g, c], want))

    written = []
    real = QN.cut_lineage
    monkeypatch.setattr(QN, "cut_lineage", lambda *a, **k: written.append(1) or real(*a, **k))
    QN.quantile_values(df, ["x"], [0.5])
    few = len(written)
    QN.quantile_values(df, ["x", "ties", "y"], probs, "g")
    assert len(written) <= 2 * few


def test_corr_matrix_by_moments_over_many_batches(spark):
    import random
    rng = random.Random(5)
    rows = []
    for i in range(600):
        x = rng.gauss(1e7, 1)                             # large mean, small spread
        rows.append((x, None if i % 7 == 0 else 2 * x + rng.gauss(0, 1), float("nan") if i % 5 == 0 else rng.random(), 3.0, None))
    df = spark.createDataFrame(rows, "a double, b double, c double, k double, z double").repartition(7)
    cols = ["a", "b", "c", "k", "z"]
    got = {(r[0], r[1]): r[2] for r in P.corr_matrix(df, cols).collect()}
    assert len(got) == 25
    for i, a in enumerate(cols):
        for j, b in enumerate(cols):
            xy = [(r[i], r[j]) for r in rows if r[i] is not None and r[j] is not None and r[i] == r[i] and r[j] == r[j]]
            want = None
            if xy and a not in "kz" and b not in "kz":
                mx, my = sum(x for x, _ in xy) / len(xy), sum(y for _, y in xy) / len(xy)
                xx, yy = sum((x - mx) ** 2 for x, _ in xy), sum((y - my) ** 2 for _, y in xy)
                want = sum((x - mx) * (y - my) for x, y in xy) / math.sqrt(xx * yy)
            assert got[a, b] == want or abs(got[a, b] - want) < 2e-6


def test_pvalue_summary_record_per_column(spark):
    rows = ([(float(i), i % 2, D.REF) for i in range(40)]
            + [(float(i) + 30.0, 1, D.CUR) for i in range(40)])
    df = spark.createDataFrame(rows, "x double, flag int, side string")
    got = {r["feature"]: r for r in D.pvalue_summary(df, ["x"], ["flag"]).collect()}
    assert set(got) == {"x", "flag"}
    assert (got["x"]["method"], got["flag"]["method"]) == ("ks", "chi2")
    assert got["x"]["ref_mean"] == 19.5 and got["x"]["curr_mean"] == 49.5
    assert got["x"]["mean_diff"] == 30.0
    # shifted by 30 of 40 values and a flag that is always 1 on the current side
    assert got["x"]["drift_detected"] and got["flag"]["drift_detected"]
    same = D.pvalue_summary(df.filter(F.col("side") == D.REF).unionByName(
        df.filter(F.col("side") == D.REF).withColumn("side", F.lit(D.CUR))), ["x"], ["flag"])
    assert not any(r["drift_detected"] for r in same.collect())


def test_frame_counts_missing_stage_is_zero(spark):
    from clickscope.operators import monitor as MON
    got = {r["table_name"]: r["n_rows"] for r in
           MON.frame_counts({"a": spark.range(7), "b": None}).collect()}
    assert got == {"a": 7, "b": 0}


def test_parse_params_round_trip():
    from clickscope.operators import model as ML
    assert ML.parse_params("maxDepth=5,numTrees=10,stepSize=0.1,x=a") == \
        {"maxDepth": 5, "numTrees": 10, "stepSize": 0.1, "x": "a"}


def test_every_period_has_a_rowcount_verdict(spark):
    from clickscope.operators import quality as Q
    df = spark.createDataFrame([(d,) for d, n in (("2024-01-01", 10), ("2024-01-02", 20), ("2024-01-04", 21)) for _ in range(n)], "day string")
    got = [(r["day"], r["prev_rows"], r["deviation"], r["alert"]) for r in Q.rowcount_deviation(df, "day").orderBy("day").collect()]
    assert got == [("2024-01-01", None, None, False), ("2024-01-02", 10, 1.0, True), ("2024-01-04", 20, 0.05, False)]
