"""Every registered query against its DuckDB oracle on the smallest tables,
plus rows-only smoke for queries without one, and the entry contract."""

import pytest

import __spark_entry__ as E
from conftest import SF_SMALL
from demandspark.sources import fixtures as FX
from oracle_compare import compare, type_diffs

QUERIES = E.queries()
ORACLE = E.oracle_sql()
# 150 rounds on a fold of all rows; cv_evaluate_linear runs the same job here
SLOW = {"cv_evaluate", "cv_evaluate_facts"}


def test_entry(spark):
    df = E.entry(spark)
    assert df.count() == FX.train_test(spark, E.SMOKE_DIR)[1].count() > 0
    assert df.columns[0] == "id"


def test_every_query_has_oracle_or_is_model():
    missing = set(QUERIES) - set(ORACLE)
    for k in missing:  # what has no SQL has a query of facts that does (text operators have their own tests)
        assert f"{k}_facts" in ORACLE or k.startswith("op") or k == "pipeline", k


@pytest.mark.parametrize("key", sorted(set(ORACLE) - SLOW))
def test_oracle(spark, key):
    df = QUERIES[key](spark, SF_SMALL)
    ok, msg = compare(df, ORACLE[key], SF_SMALL)
    assert ok, msg
    assert not type_diffs(df, ORACLE[key], SF_SMALL)
    plan = df._jdf.queryExecution().executedPlan().toString()
    for node in ("EvalPython", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert node not in plan, node


@pytest.mark.parametrize("key", sorted(set(QUERIES) - set(ORACLE) - SLOW))
def test_rows_only(spark, key):
    assert QUERIES[key](spark, SF_SMALL).count() > 0


def test_stacking_properties(spark):
    oof = QUERIES["stack_oof"](spark, SF_SMALL)
    tr = E.queries()["build_features_train"](spark, SF_SMALL)
    n_models = oof.select("model").distinct().count()
    # one out-of-fold prediction per train row and model
    assert oof.count() == tr.count() * n_models
    assert oof.groupBy("row_id", "model").count().where("count > 1").count() == 0
    sub = QUERIES["stack_submission"](spark, SF_SMALL)
    assert sub.where("demand < 0").count() == 0
    assert sub.select("id").distinct().count() == sub.count()
