"""Plan-shape checks for the scale claims: no Cartesian or nested-loop joins,
shuffle joins when tables are large, no broadcast hints, filters and pruning at
the parquet scan."""

import re

import pytest

import __spark_entry__ as E
from conftest import SF_SMALL
from demandspark.operators import features as FE
from demandspark.operators import products as PR
from demandspark.operators import target_means as TM
from demandspark.sources import fixtures as FX


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def no_auto_broadcast(spark):
    """Statistic tables as large as at scale: the planner may not broadcast
    them on size estimates."""
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield spark
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_fallback_chain_plan(no_auto_broadcast):
    spark = no_auto_broadcast
    p = _plan(E.queries()["fallback_chain"](spark, SF_SMALL))
    assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p
    assert len(re.findall(r"SortMergeJoin .*LeftOuter", p)) == 6
    # the split filter reaches the scans as pushed parquet filters
    assert "LessThan(period,72)" in p and "GreaterThanOrEqual(period,72)" in p


def test_feature_plan_hints_no_broadcast(no_auto_broadcast):
    spark = no_auto_broadcast
    train, test = FX.train_test(spark, SF_SMALL)
    prods = PR.product_features(PR.prepare_products(FX.products(spark, SF_SMALL)))
    locs = PR.location_features(PR.prepare_locations(FX.locations(spark, SF_SMALL)))
    tr, _ = FE.build_features(train, test, prods, locs)
    p = _plan(tr)
    assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p
    # without a byte threshold no side is broadcast: nothing overrides the planner
    assert "BroadcastHashJoin" not in p
    assert len(re.findall(r"SortMergeJoin .*LeftOuter", p)) == 6


def test_statistic_scan_is_pruned(spark):
    train, _ = FX.train_test(spark, SF_SMALL, with_row_id=False)
    p = _plan(TM.level_mean(train, "lm_client"))
    schemas = re.findall(r"struct<[^>]*>", p)
    lineitem = [s for s in schemas if "l_quantity" in s]
    assert lineitem, schemas
    # only the columns the statistic needs are read from lineitem
    for unused in ("l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus"):
        assert all(unused not in s for s in lineitem), lineitem


def test_no_cross_joins_anywhere(spark):
    bad = []
    for k in ["unique_counts_filled", "constant_baselines", "standard_scale", "kfold_exact",
              "test_fold_mean", "describe_numeric", "product_imputed", "natural_self_join"]:
        p = _plan(E.queries()[k](spark, SF_SMALL))
        if "CartesianProduct" in p or "BroadcastNestedLoopJoin" in p:
            bad.append(k)
    assert not bad, bad
