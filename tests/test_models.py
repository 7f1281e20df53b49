"""Sparse mixture, linear booster, staged boosting and stacking against plain versions."""

import re
from collections import Counter

import numpy as np
import pytest
from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F

from demandspark.operators import boosting as BO
from demandspark.operators import models as M
from demandspark.operators import stacking as ST
from demandspark.operators import words as W
from demandspark.operators.linear_booster import LinearBooster, descend

NAMES = ["pan blanco grande", "pan integral", "pan blanco", "galleta de chocolate", "galleta chocolate", "torta",
         "pan pan integral", None, "", "galleta integral", "pan blanco", "x torta torta"]


def name_rows(spark):
    return spark.createDataFrame(list(enumerate(NAMES)), "product_id long, name string").repartition(3)


def brute_counts(min_df=2):
    held = [Counter(re.findall(r"\w\w+", (n or "").lower())) for n in NAMES]
    df = Counter(t for c in held for t in c)
    vocab = sorted(t for t, n in df.items() if n >= min_df)
    return vocab, [(i, vocab.index(t), t, n) for i, c in enumerate(held) for t, n in c.items() if t in vocab]


def test_word_counts(spark):
    _, want = brute_counts()
    assert sorted(map(tuple, W.word_counts(name_rows(spark), "name").collect())) == sorted(want)


def test_mixture_equals_dense_expectation_maximisation(spark):
    vocab, counts = brute_counts()
    x = np.zeros((len(NAMES), len(vocab)))
    for i, w, _, n in counts:
        x[i, w] = n
    k, rounds = 3, 6
    fitted = W.fit_mixture(name_rows(spark), W.word_counts(name_rows(spark), "name"), k=k, rounds=rounds, tolerance=-1.0)
    assert len(fitted.likelihoods) == rounds + 1
    assert all(b >= a - 1e-9 for a, b in zip(fitted.likelihoods, fitted.likelihoods[1:]))
    # the same start: k different rows in the order of their hash
    patterns = sorted({tuple((w, int(n)) for w, n in enumerate(r) if n) for r in x})
    order = spark.createDataFrame([(i,) for i in range(len(patterns))], "row long").orderBy(
        F.xxhash64("row", F.lit(47)), "row").limit(k).collect()
    m = np.zeros((k, len(vocab)))
    for c, r in enumerate(order):
        for w, n in patterns[r["row"]]:
            m[c, w] = n
    v = np.tile(np.maximum(W.MIN_VARIANCE, x.var(axis=0)), (k, 1))
    shares, told = np.full(k, 1 / k), []
    for _ in range(rounds + 1):
        logs = np.log(shares) - 0.5 * (np.log(2 * np.pi * v)[None] + (x[:, None] - m[None]) ** 2 / v[None]).sum(axis=2)
        density = np.logaddexp.reduce(logs, axis=1)
        told.append(density.mean())
        r = np.exp(logs - density[:, None])
        size = r.sum(axis=0)
        shares, m = size / len(x), r.T @ x / size[:, None]
        v = np.maximum(W.MIN_VARIANCE, r.T @ x ** 2 / size[:, None] - m ** 2)
    assert np.allclose(fitted.likelihoods, told, atol=1e-6)
    got = {g.product_id: g.group for g in fitted.groups.collect()}
    assert got == dict(enumerate(logs.argmax(axis=1)))


def test_mixture_of_few_rows(spark):
    same = spark.createDataFrame([(i, "uno dos") for i in range(5)], "product_id long, name string")
    assert {g.group for g in W.fit_mixture(same, W.word_counts(same, "name"), k=4, rounds=3).groups.collect()} == {0}
    none = spark.createDataFrame([(1, "zz"), (2, "yy")], "product_id long, name string")
    fitted = W.fit_mixture(none, W.word_counts(none, "name"), k=4, rounds=3)
    assert sorted(g.product_id for g in fitted.groups.collect()) == [1, 2]


def numbers(spark, n=400, seed=3):
    r = np.random.default_rng(seed)
    x = np.column_stack([r.normal(5, 2, n), np.full(n, 7.0), r.integers(0, 4, n), np.zeros(n)])
    y = 3 * x[:, 0] - x[:, 2] + r.normal(0, 0.1, n) + 4
    rows = [(i, *map(float, x[i]), float(y[i]), i % 3 + 1) for i in range(n)]
    return x, y, spark.createDataFrame(rows, "id long, a double, b double, c double, d double, demand double, fold int")


COLS = ["a", "b", "c", "d"]


def test_linear_booster_equals_a_plain_loop(spark):
    x, y, df = numbers(spark)
    rounds, step, penalty, base = 40, 0.3, 1.0, 0.5
    w, bias = np.zeros(4), 0.0
    for _ in range(rounds):        # one coordinate after another on the rows themselves
        bias -= step * (base + bias + x @ w - y).sum() / len(y)
        for j in range(4):
            if (x[:, j] ** 2).sum() < 1e-5:
                continue
            slope = ((base + bias + x @ w - y) * x[:, j]).sum()
            w[j] -= step * (slope + penalty * w[j]) / ((x[:, j] ** 2).sum() + penalty)
    model = M.fit(LinearBooster(rounds=rounds, step=step, penalty=penalty), df, COLS)
    assert np.allclose([model.intercept - base, *model.coefficients], [bias, *w], rtol=1e-9)
    assert model.coefficients[3] == 0.0
    got = {r.id: r.prediction for r in M.predict(model, df, COLS, floor=False).collect()}
    assert np.allclose([got[i] for i in range(len(y))], base + bias + x @ w)
    # many rounds of a small penalty come near the least squares
    g = np.column_stack([np.ones(len(y)), x[:, [0, 2]]])
    near = descend(g.T @ g, g.T @ y, rounds=3000, step=0.5, penalty=0.0)
    assert np.allclose(near, np.linalg.lstsq(g, y, rcond=None)[0], atol=1e-6)


def test_best_round():
    assert BO.best_round([5, 4, 3, 3.5, 3.4, 2], patience=2) == 3     # stops before the 2
    assert BO.best_round([5, 4, 3, 3.5, 3.4, 2], patience=3) == 6
    assert BO.best_round([1.0]) == 1 and BO.best_round([2, 2, 2], patience=1) == 1


@pytest.fixture(scope="module")
def booster(spark):
    _, _, df = numbers(spark)
    df = df.withColumn("is_valid", F.col("id") % 4 == 0)
    return df, BO.fit_early_stop(df, COLS, maxIter=12, stepSize=0.3, minInstancesPerNode=2)


def test_staged_predictions(spark, booster):
    df, stopped = booster
    holes = df.withColumn("a", F.when(F.col("id") % 5 > 0, F.col("a"))).withColumn(
        "c", F.when(F.col("id") % 7 == 0, float("nan")).otherwise(F.col("c")))
    whole = {r.id: r.prediction for r in M.predict(stopped.model, holes, COLS, floor=False).collect()}
    staged = {r.id: r.p for r in holes.select("id", BO.staged_predictions(stopped.model, COLS).alias("p")).collect()}
    assert all(len(p) == 12 and abs(p[-1] - whole[i]) < 1e-9 for i, p in staged.items())
    errors = [r["rmsle"] for r in BO.staged_errors(stopped.model, df.where("is_valid"), COLS).orderBy("round").collect()]
    assert errors == stopped.errors and stopped.rounds == BO.best_round(errors)


def test_staged_walk_reads_the_features_once(spark, booster):
    """The array of the features is worked out before the walk, not at each of its steps."""
    df, stopped = booster
    plan = df.select(BO.tree_values(stopped.model, COLS).alias("v"))._jdf.queryExecution().analyzed().toString()
    before, walk = plan.split("aggregate(", 1)
    assert before.count("coalesce(") == len(COLS) and "coalesce(" not in walk


def test_fits_deal_their_rows_over_the_cores(spark):
    _, _, df = numbers(spark, 60)
    seen = []

    class Told:
        def fit(self, data):
            seen.append((data.rdd.getNumPartitions(), data.count()))

    M.fit(Told(), df.coalesce(1), COLS)
    assert seen == [(spark.sparkContext.defaultParallelism, 60)]


def test_planted_best_round(spark, booster):
    """Held-out labels that are the prediction after five rounds make five rounds the best."""
    df, stopped = booster
    after = BO.staged_predictions(stopped.model, COLS)[4]
    planted = df.withColumn("demand", F.when(F.col("is_valid"), after).otherwise(F.col("demand")))
    again = BO.fit_early_stop(planted, COLS, patience=3, maxIter=12, stepSize=0.3, minInstancesPerNode=2)
    assert again.rounds == 5 and again.errors[4] < 1e-9
    got = {r.id: r.prediction for r in again.predict(planted.where("is_valid"), COLS, floor=False).collect()}
    want = {r.id: r.demand for r in planted.where("is_valid").collect()}
    assert all(abs(got[i] - want[i]) < 1e-9 for i in want)


def test_split_counts_are_those_of_the_trees(spark, booster):
    _, stopped = booster
    told = Counter(int(i) for i in re.findall(r"If \(feature (\d+) ", stopped.model.toDebugString))
    assert {r.feature: r.n for r in BO.split_counts(stopped.model).collect()} == dict(told)
    rows = BO.split_importance(stopped.model, COLS).collect()
    assert {r.feature: round(r.fscore, 9) for r in rows} == {
        COLS[i]: round(n / told.total(), 9) for i, n in told.items()}
    assert [r.fscore for r in rows] == sorted(r.fscore for r in rows)


def test_stacking_in_one_pass(spark):
    """The same predictions as fits one by one, from one scan a side, whichever fit ends first."""
    _, _, df = numbers(spark, 150)
    gaps = df.withColumn("a", F.when(F.col("id") % 9 > 0, F.col("a"))).withColumnRenamed("id", "row_id")
    path = ST.M.assemble(gaps, COLS).withColumn("_label", F.col("demand"))
    test = ST.M.assemble(gaps.withColumnRenamed("row_id", "id"), COLS)
    estimators = {"tree": lambda: ST.MeanFilled(M.gbt_regressor(maxIter=2, minInstancesPerNode=1)),
                  "line": lambda: ST.MeanFilled(LinearRegression(featuresCol="features", labelCol="_label", regParam=0.1)),
                  "booster": lambda: ST.MeanFilled(LinearBooster(rounds=20))}
    oof, tst = ST.fold_predictions(path, test, estimators, 3, threads=4)
    for side in (oof, tst):
        plan = side._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("LogicalRDD") + plan.count("Relation [") == 1 and "Union" not in plan
    got = {(r.row_id, r.model): r.prediction for r in oof.collect()}
    means = {(r.id, r.model): r.prediction for r in tst.collect()}
    assert len(got) == len(means) == 450
    for name, make in estimators.items():
        sums = Counter()
        for f in (1, 2, 3):
            model = make().fit(path.where(F.col("fold") != f))
            for r in model.transform(path.where(F.col("fold") == f)).collect():
                assert abs(got[r.row_id, name] - r.prediction) < 1e-9
            for r in model.transform(test).collect():
                sums[r.id] += r.prediction / 3
        assert all(abs(means[i, name] - v) < 1e-9 for i, v in sums.items())


def test_facts_turn_red_for_a_constant_model(spark):
    from demandspark.plans import queries as Q
    rows = spark.createDataFrame([(i, float(i % 40)) for i in range(400)], "id long, demand double")
    constant = rows.withColumn("prediction", F.lit(12.0))
    good = rows.withColumn("prediction", F.col("demand") + 0.5)
    assert not Q.learnt(constant).first().beats_constant and Q.learnt(good).first().beats_constant
    for name, (key, value, low, high, group) in Q.FACTS.items():
        flat = rows.select(F.col("id").alias(key), F.lit(1).cast("double").alias(value), F.lit("m").alias("model"))
        assert not Q._facts(flat, key, value, low, high, group).first().varied, name
        wild = flat.withColumn(value, F.when(F.col(key) == 3, 1e6).otherwise(2.0))
        assert Q._facts(wild, key, value, low, high, group).first().n_wrong == 1, name


def test_linear_booster_reads_its_rows_once(spark):
    """Sums come from whole blocks of rows, empty parts included, in one job over the rows and none for their width."""
    from demandspark.operators.linear_booster import block_sums
    rows = [(1.0, 2.0, 3.0), (float("nan"), 1.0, None), (4.0, 0.5, 1.0)]
    df = spark.createDataFrame(rows, "a double, b double, y double").repartition(7)
    got = block_sums(df.select(F.array("a", "b").alias("x"), F.array(F.coalesce("y", F.lit(0.0))).alias("y")),
                     lambda x, y: np.nan_to_num(x).T @ y)
    assert np.allclose(got, [1 * 3 + 4 * 1, 2 * 3 + 0.5]) and len(block_sums(df.where("false").select(F.array("a").alias("x")), lambda x: x)) == 0
    seen = spark.sparkContext.accumulator(0)
    count = F.udf(lambda y: (seen.add(1), y)[1], "double").asNondeterministic()
    data = M.assemble(df.withColumn("a", F.coalesce("a", F.lit(0.0))), ["a", "b"]).withColumn("_label", count(F.col("y")))
    LinearBooster(rounds=5).fit(data)
    assert seen.value == len(rows)


def test_assembled_numbers_name_their_features(spark):
    """One array for all numbers instead of a row object per row, with the assembler's values and names."""
    from pyspark.ml.feature import VectorAssembler
    rows = [(1, 2.5, None), (None, float("nan"), 3), (0, 0.0, 0)]
    df = spark.createDataFrame(rows, "a int, b double, c long")
    got = M.assemble(df, ["a", "b", "c"])
    want = VectorAssembler(inputCols=["a", "b", "c"], outputCol="features", handleInvalid="keep").transform(df)
    assert np.array_equal(*[np.array([r.features.toArray() for r in x.collect()]) for x in (got, want)], equal_nan=True)
    for x in (got, want):
        meta = x.schema["features"].metadata["ml_attr"]
        assert [m["name"] for m in meta["attrs"]["numeric"]] == ["a", "b", "c"] and meta["num_attrs"] == 3
    assert "named_struct" not in got._jdf.queryExecution().optimizedPlan().toString()
    again = M.assemble(got, ["a", "features"], "more").first()     # a vector among the columns
    assert len(again.more) == 4


def test_rows_without_gaps_are_fitted_as_they_are(spark):
    """The filler is not worked out over rows that need none, and is over those that do."""
    _, _, df = numbers(spark, 60)
    plans = []

    class Told:
        def fit(self, data):
            plans.append(data._jdf.queryExecution().analyzed().toString())

    for rows in (df, df.withColumn("a", F.when(F.col("id") > 3, F.col("a")))):
        ST.MeanFilled(Told()).fit(ST.M.assemble(rows, COLS))
    assert ["zip_with" in p for p in plans] == [False, True]


def test_stacking_keeps_only_the_columns_it_needs(spark, monkeypatch):
    from demandspark.plans import jobs as J
    _, _, df = numbers(spark, 60)
    seen = []

    def held(data, tdata, *args, **kw):
        seen.append((data.columns, tdata.columns, tdata.rdd.getNumPartitions()))
        one = F.lit("m").alias("model"), F.lit(0.0).alias("prediction")
        return data.select("row_id", *one), tdata.select("id", *one)

    monkeypatch.setattr(ST, "fold_predictions", held)
    J.stack_phase_one(df.withColumnRenamed("id", "row_id"), df.drop("demand").coalesce(1), COLS, n_chunks=1, k=2, estimators={})
    assert seen == [(["row_id", "fold", "features", "_label"], ["id", "features"], spark.sparkContext.defaultParallelism)]
