"""Queries: learning stage (rows-only checks: model outputs have no SQL oracle)."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import functions as F

from clickscope.operators import clean as C
from clickscope.operators import metrics as M
from clickscope.operators import model as ML
from clickscope.operators import quality as Q
from clickscope.operators import runlog as RL
from clickscope.operators import scoring as K
from clickscope.operators import split as S
from clickscope.plans.fixtures import SESSION_FEATURES, TARGET, load_sessions, session_requests
from clickscope.plans.registry import register
from clickscope.session import cut_lineage, durable_dir, stage_table

FEATURES = [c for c in SESSION_FEATURES if c != TARGET]


def _split(spark, sf_dir):
    """Labelled raw sessions, split before anything is fitted, written once to
    the shared checkpoint folder: fitting and cross-validation run many jobs
    over it, and none of them should re-run the session derivation."""
    def build():
        raw = load_sessions(spark, sf_dir).select("session_id", "session_date", *SESSION_FEATURES)
        return S.stratified_split(ML.with_label(C.keep_labelled(raw, TARGET), TARGET), "session_id", TARGET, 0.2, 42)
    return stage_table(spark, ("model_split", os.path.abspath(sf_dir)), build)


def _train_test(spark, sf_dir):
    s = _split(spark, sf_dir)
    return s.filter(F.col("split") == "train"), s.filter(F.col("split") == "test")


_MODELS: dict = {}


def _fit(spark, sf_dir, params=None):
    """The training stage's artefact (encoder, medians, feature order, forest),
    fitted on the training side once per application and saved (S5);
    evaluation, drift and the scoring path load it, as the reference's stages
    hand over the saved files."""
    train, test = _train_test(spark, sf_dir)
    k = (spark.sparkContext.applicationId, os.path.abspath(sf_dir),
         repr(sorted((params or {}).items())))
    path = _MODELS.get(k)
    if path is None:
        path = os.path.join(durable_dir(spark), "models", f"rf-{uuid.uuid4().hex}")
        ML.save_model(ML.fit(train, FEATURES, "random_forest", params), path)
        _MODELS[k] = path
    return ML.load_model(path), test


@register("rf_train_score")
def q_rf_train_score(spark, sf_dir):
    """M2 + M6: forest fitted on the training side, scored on the test side."""
    model, test = _fit(spark, sf_dir)
    return ML.score(model, test, keep=["session_id"])


@register("model_eval")
def q_model_eval(spark, sf_dir):
    """E2 + E4 + AP on held-out rows of the fitted forest."""
    model, test = _fit(spark, sf_dir)
    # each metric passes over the scores: the forest answers once
    scored = cut_lineage(ML.score(model, ML.spread(test), keep=["session_id"]), "scored")
    b = M.binary_metrics(scored)
    a = M.roc_auc(scored).select("auc")
    ap = M.average_precision(scored)
    return b.select("n", "accuracy", "precision", "recall", "f1") \
        .withColumn("roc_auc", F.lit(a.first()["auc"])) \
        .withColumn("average_precision", F.lit(ap.first()["average_precision"]))


@register("cv_tune")
def q_cv_tune(spark, sf_dir):
    """M1: grid preset (10 trees, depth 5), 3 stratified folds of the training side."""
    train, _ = _train_test(spark, sf_dir)
    folds = cut_lineage(S.stratified_folds(train.drop("split"), "session_id", TARGET, 3, 42))
    return ML.grid_search(folds, FEATURES, ML.GRID_PRESET, "random_forest")


@register("tuned_train_score")
def q_tuned_train_score(spark, sf_dir):
    """The training pipeline chained as the reference's stages run: grid
    search over 3 stratified folds (M1) -> best parameters -> forest fitted
    on the training side with them (M2) -> test-side scores (M6)."""
    train, test = _train_test(spark, sf_dir)
    folds = cut_lineage(S.stratified_folds(train.drop("split"), "session_id", TARGET, 3, 42))
    best = ML.grid_search(folds, FEATURES, ML.GRID_PRESET, "random_forest").first()
    model = ML.fit(train, FEATURES, "random_forest", ML.parse_params(best["params"]))
    return ML.score(model, test, keep=["session_id"])


@register("random_search")
def q_random_search(spark, sf_dir):
    """M5: five seeded points per algorithm (logistic, forest, boosted trees), 5 folds."""
    train, _ = _train_test(spark, sf_dir)
    folds = cut_lineage(S.stratified_folds(train.drop("split"), "session_id", TARGET, 5, 42))
    return ML.random_search(folds, FEATURES, n_iter=5)


@register("feature_importance")
def q_feature_importance(spark, sf_dir):
    """M7: ranked impurity importances of the fitted forest."""
    model, _ = _fit(spark, sf_dir)
    return ML.feature_importances(model, FEATURES)


def _log_training(spark, sf_dir) -> str:
    """S6 + E7: the training run's parameters, its AUC on the training side and
    its metrics on the test side, logged once under the model's name."""
    model, test = _fit(spark, sf_dir)
    train, _ = _train_test(spark, sf_dir)
    scored = cut_lineage(ML.score(model, ML.spread(test), keep=["session_id"]), "scored")
    trained = cut_lineage(ML.score(model, ML.spread(train)), "train-scored")
    b = M.binary_metrics(scored).first()
    forest, encoder = model.stages[-1], model.stages[0]
    metrics = {f"eval_{k}": b[k] for k in ("accuracy", "precision", "recall", "f1")}
    metrics |= {"eval_roc_auc": M.roc_auc(scored).first()["auc"], "train_auc": M.roc_auc(trained).first()["auc"]}
    params = ML.RF_DEFAULTS | {"algorithm": "random_forest", "seed": ML.SEED, "features": FEATURES, "medians": encoder.medians, "trees": forest.getNumTrees}
    started = train.agg(F.min("session_date").cast("timestamp_ntz")).first()[0]
    root = os.path.join(durable_dir(spark), "runs", forest.uid)
    RL.log_run(spark, root, forest.uid, started, params, metrics)
    return root


@register("model_run_log")
def q_model_run_log(spark, sf_dir):
    """S5 + S6 + E7: the fitted forest's run record; logging it again (a
    retried task) adds nothing."""
    root = _log_training(spark, sf_dir)
    assert _log_training(spark, sf_dir) == root
    return RL.read_runs(spark, root).select("kind", "key", F.round("value", 4).alias("value"), "text")


@register("model_auc_drop")
def q_model_auc_drop(spark, sf_dir):
    """E8 of the served model: weekly AUC of its scores on all labelled
    sessions against the training AUC in its run record."""
    runs = RL.read_runs(spark, _log_training(spark, sf_dir))
    base = runs.where("kind = 'metric' and key = 'train_auc'").select("started_at", F.col("value").alias("auc"))
    model, _ = _fit(spark, sf_dir)
    scored = cut_lineage(ML.score(model, ML.spread(_split(spark, sf_dir)), keep=["session_date"]), "all-scored")
    return M.weekly_auc_drop(scored, "session_date", "label", "score", 0.05, base)


@register("drift_prediction_summary")
def q_drift_prediction_summary(spark, sf_dir):
    """D2 as the reference runs it: the fitted forest predicts both drift
    sides, and the model's ``prediction`` column is tested with the data
    columns and the target (p-value per column, reference record shape)."""
    from clickscope.operators import drift as D
    from clickscope.plans.q_drift import D2_CATEGORICAL, D2_NUMERIC, tagged_sessions
    model, _ = _fit(spark, sf_dir)
    predicted = ML.score(model, _split(spark, sf_dir), keep=["session_id"]).select("session_id", "prediction")
    # the forest's output feeds several grouped passes: write it once
    scored = cut_lineage(tagged_sessions(spark, sf_dir).join(predicted, "session_id"), "drift-scored")
    return D.pvalue_summary(scored, D2_NUMERIC, (*D2_CATEGORICAL, "prediction"))


@register("model_request_scoring")
def q_model_request_scoring(spark, sf_dir):
    """The scoring service path (E-2) over every session as a JSON request:
    typed fields and defaults (V6), then one loaded artefact with the codes and
    medians of the training side (S5; unseen labels are 'Unknown', F3), scored
    through the TTL result cache keyed on the request fields (F8, K1/K2; only
    misses reach the model).  Requests that fail the typing are answered with
    their reasons.  Nothing is fitted here."""
    from pyspark.ml.functions import vector_to_array

    model, _ = _fit(spark, sf_dir)
    typed = cut_lineage(Q.type_requests(session_requests(spark, sf_dir), "body", ("session_id", "requested_at")), "typed")

    def score(df):
        out = model.transform(df)
        return (out.withColumn("probability", vector_to_array("probability")[1])
                .withColumn("prediction", F.col("prediction").cast("int")))

    resp, _ = K.cached_scoring(typed.where("size(errors) = 0"), FEATURES, "requested_at", "session_id", score,
                               ttl_seconds=3600, cache=None, model_version=model.uid)
    answers = K.response_json(K.rounded(resp))
    refused = typed.where("size(errors) > 0").select(F.col("session_id").alias("request_id"), F.to_json(F.struct(F.col("errors").alias("detail"))).alias("response"))
    return answers.unionByName(refused)
