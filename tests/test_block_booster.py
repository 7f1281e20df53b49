"""Boosted trees on blocks against Spark's own, whole stacking and evaluation, and the shuffle that writes once."""

import numpy as np
import pytest
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import functions as F

from demandspark.operators import block_booster as BB
from demandspark.operators import models as M
from demandspark.operators import splits as SP
from demandspark.operators import stacking as ST
from demandspark.operators import tree_blocks as TB

COLS = ["a", "b", "c", "d", "e"]


@pytest.fixture(scope="module")
def rows(spark):
    r, n = np.random.default_rng(0), 1500
    x = np.column_stack([r.normal(size=n), r.integers(0, 7, n), r.random(n) * 100, r.integers(0, 2, n), np.zeros(n)])
    y = x[:, 0] * 3 + x[:, 1] + (x[:, 2] > 50) * 4 + r.normal(size=n)
    told = [(i, *map(float, x[i]), float(y[i]), float(y[i] > 6), i % 2, i % 3 + 1) for i in range(n)]
    return spark.createDataFrame(told, "id long, a double, b double, c double, d double, e double, demand double, "
                                       "label double, chunk int, fold int").repartition(3).cache()


def predicted(model, data, col="prediction"):
    return {r.id: r[col] for r in model.transform(data).collect()}


@pytest.mark.parametrize("few", [0, 10 ** 9])
def test_equal_to_sparks_trees_without_draws(rows, monkeypatch, few):
    """One job a level and one task for all rounds give Spark's own trees, for numbers and for two classes."""
    monkeypatch.setattr(BB, "FEW_ROWS", few)
    kw = dict(maxIter=4, maxDepth=3, stepSize=0.2, subsamplingRate=1.0, featureSubsetStrategy="all", minInstancesPerNode=7)
    data = M.assemble(rows, COLS).withColumn("_label", F.col("demand")).withColumn("_class", F.col("label"))
    got, want = M.gbt_regressor(**kw).fit(data), GBTRegressor(featuresCol="features", labelCol="_label", **kw).fit(data)
    a, b = predicted(got, data), predicted(want, data)
    assert max(abs(a[i] - b[i]) for i in b) < 1e-5 and got.getNumTrees == 4 and got.treeWeights == want.treeWeights
    assert np.allclose(got.featureImportances.toArray(), want.featureImportances.toArray(), atol=1e-6)
    got = M.fit_binary(rows, COLS, "label", **kw)
    want = GBTClassifier(featuresCol="features", labelCol="_class", **kw).fit(data)
    a, b = predicted(got, data, "probability"), predicted(want, data, "probability")
    assert max(abs(a[i][1] - b[i][1]) for i in b) < 1e-5


def test_fits_side_by_side(rows, monkeypatch):
    """Fits of two chunks without each fold are those of the rows alone, by levels and within a task; draws repeat."""
    data = M.assemble(rows, ["b", "d", "e"]).withColumn("_label", F.col("demand"))   # thresholds don't hang on the sample
    make = {"m": lambda: M.gbt_regressor(maxIter=3, subsamplingRate=1.0, featureSubsetStrategy="all")}
    for few in (0, 10 ** 9):
        monkeypatch.setattr(BB, "FEW_ROWS", few)
        got = ST.fit_boosters(data, make, 3, chunk="chunk", chunks=2)
        assert sorted(got) == [(c, "m", f) for c in (0, 1) for f in (1, 2, 3)]
        for (c, _, f), model in got.items():
            own = data.where((F.col("chunk") == c) & (F.col("fold") != f))
            a, b = predicted(model, own), predicted(make["m"]().fit(own), own)
            assert max(abs(a[i] - b[i]) for i in b) < 1e-4
    drawn = [predicted(M.gbt_regressor(maxIter=3).fit(data), data) for _ in range(2)]
    assert drawn[0] == drawn[1]


def test_rows_with_gaps_are_refused(rows):
    for bad in (rows.withColumn("a", F.when(F.col("id") > 3, F.col("a"))), rows.withColumn("demand", F.when(F.col("id") > 3, F.col("demand")))):
        with pytest.raises(Exception, match="to be fitted"):
            M.fit(M.gbt_regressor(maxIter=1), bad, COLS)


def test_lost_blocks_are_made_anew(rows, monkeypatch):
    """A part whose files have gone is spooled again and the rounds so far are walked again: the same trees."""
    monkeypatch.setattr(BB, "FEW_ROWS", 0)
    data = M.assemble(rows, COLS).withColumn("_label", F.col("demand"))
    want = predicted(M.gbt_regressor(maxIter=3).fit(data), data)
    level, calls = BB._level, []

    def losing(blocks, spooled, *args):
        calls.append(1)
        if len(calls) == 6:
            spooled.foreach(TB.discard)
        return level(blocks, spooled, *args)

    monkeypatch.setattr(BB, "_level", losing)
    assert predicted(M.gbt_regressor(maxIter=3).fit(data), data) == want and len(calls) > 6


def test_packed_sums_are_exact():
    """Counts and whole targets of a full block come apart again, at the greatest targets too."""
    q = np.full(TB.ROWS, -TB.TOP)
    total = np.bincount(np.zeros(TB.ROWS, int), q + TB.SHIFT)[0]
    n = np.rint(total / TB.SHIFT)
    assert n == TB.ROWS and total - n * TB.SHIFT == float(-TB.TOP) * TB.ROWS


def test_registered_jobs_are_whole(spark, monkeypatch):
    """Stacking has its 8 chunks, 10 folds and 150 rounds on both levels, and the evaluation takes every row."""
    from demandspark.plans import queries as Q
    seen = {}

    class Stop(Exception):
        pass

    def one(tr, te, cols, n_chunks=8, k=10, num_trees=150, estimators=None, **kw):
        seen["rounds"] = {estimators[n]().getMaxIter() for n in ("gbt_a", "gbt_b")}
        seen["size"] = (n_chunks, k, len(estimators))
        return None, None

    def two(oof, tst, tr, models, **gbt):
        seen["meta"] = dict(M.GBT_PARAMS, **gbt)["maxIter"]
        raise Stop

    def cv(spark, rows, *args, n_rows, **kw):
        seen["cv"] = n_rows
        raise Stop

    monkeypatch.setattr(Q, "_FEATURE_MEMO", {})
    monkeypatch.setattr(Q, "_feature_tables", lambda *a: (None, None))
    monkeypatch.setattr(Q, "_grouped_products", lambda *a: None)
    monkeypatch.setattr(Q.J, "stack_phase_one", one)
    monkeypatch.setattr(Q.J, "stack_phase_two", two)
    monkeypatch.setattr(Q.J, "cv_evaluate", cv)
    monkeypatch.setattr(Q.FX, "demand", lambda *a, **k: spark.range(2_000_007))
    monkeypatch.setattr(Q.FX, "products", lambda *a: None)
    monkeypatch.setattr(Q.FX, "locations", lambda *a: None)
    for name in ("stack_submission", "cv_evaluate"):
        with pytest.raises(Stop):
            Q.QUERIES[name](spark, "no tables")
    assert seen == {"rounds": {150}, "size": (8, 10, 4), "meta": 150, "cv": 2_000_007}


def test_shuffle_writes_no_sorted_copy(spark, monkeypatch):
    from demandspark.sources import ids
    monkeypatch.setattr(ids, "materialize", lambda *a: pytest.fail("a copy is written"))
    df = spark.range(5000).select(F.col("id").alias("row_id"), (F.col("id") * 2).alias("v")).repartition(4)
    got = SP.shuffle_rows(df).collect()
    order = [r.row_id for r in df.orderBy(SP.hash_order(), "row_id").select("row_id").collect()]
    assert [r.row_id for r in sorted(got, key=lambda r: r.shuffled_pos)] == order
    assert [r.shuffled_pos for r in got] == list(range(1, 5001)) and all(r.v == 2 * r.row_id for r in got)


def test_unique_counts_are_described_from_one_count(spark, monkeypatch):
    from demandspark.plans import queries as Q
    train = spark.createDataFrame([(i % 3, i % 5, i % 7, i % 2) for i in range(60)],
                                  "depot_id long, client_id long, product_id long, channel_id int")
    monkeypatch.setattr(Q, "_train", lambda *a, **k: train)
    written = []
    monkeypatch.setattr(Q, "materialize", lambda df, name: written.append(name) or df.localCheckpoint())
    got = {(r.key, r.column): r["mean"] for r in Q.QUERIES["describe_unique_counts"](spark, "").collect()}
    assert written == ["unique-counts"] * 3 and len(got) == 8 and got["depot_id", "n_products_per_depot"] == 7.0
