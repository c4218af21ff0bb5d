"""Every registered query with an oracle matches DuckDB on sf0.001 (the driver
checks sf0.01 the same way)."""

import pytest

import __spark_entry__ as E
from tools.check_oracle import compare, duck

ORACLE = E.oracle_sql()
NAMES = sorted(ORACLE)


@pytest.fixture(scope="module")
def con(sf_dir):
    return duck(sf_dir)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, sf_dir, con, name):
    df = E.queries()[name](spark, sf_dir)
    problems = compare(name, df, con, ORACLE[name])
    assert not problems, "\n".join(problems)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["feature", "category", "n", "positives", "rate"]


def test_every_query_has_oracle_or_is_model_or_lineage():
    llm = set(E.llm_queries.QUERIES) | {"pipeline"} if E.llm_queries else set()
    rows_only = set(E.queries()) - set(ORACLE) - llm
    assert rows_only <= {"rf_train_score", "model_eval", "cv_tune", "random_search", "model_run_log", "model_auc_drop",
                         "feature_importance", "drift_prediction_summary",
                         "tuned_train_score", "model_request_scoring",
                         "landing_listing"}
