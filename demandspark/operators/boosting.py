"""Fitted tree ensembles as tables and column expressions: split counts,
predictions and errors after every round, and early stopping with patience.

A fitted ensemble is saved by Spark ML as Parquet, one row per node. That table
gives the importance by an aggregate, and the trees as a constant that a column
expression walks, so that one pass over the rows sees the predictions after each round.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.ml.regression import GBTRegressionModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from demandspark.operators import models as M
from demandspark.session import shared_dir

PATIENCE = 20   # rounds without a better error that end the boosting


def node_table(model) -> DataFrame:
    """(tree, weight, id, prediction, left, right, feature, threshold) of a fitted
    ensemble of regression trees; a leaf has feature -1."""
    spark = SparkSession.getActiveSession()
    path = shared_dir(spark, "trees")
    model.write().save(path)
    weights = spark.read.parquet(f"{path}/treesMetadata").select(F.col("_1").alias("tree"), F.col("_3").alias("weight"))
    n = F.col("nodeData")
    return (spark.read.parquet(f"{path}/data")
            .select(F.col("treeID").alias("tree"), n["id"].alias("id"), n["prediction"].alias("prediction"),
                    n["leftChild"].alias("left"), n["rightChild"].alias("right"),
                    n["split"]["featureIndex"].alias("feature"),
                    F.get(n["split"]["leftCategoriesOrThreshold"], F.lit(0)).alias("threshold"))
            .join(weights, "tree"))


def split_counts(model) -> DataFrame:
    """(feature, n): how many splits of the ensemble use each feature's number."""
    return node_table(model).where("feature >= 0").groupBy("feature").agg(F.count(F.lit(1)).alias("n"))


def split_importance(model, cols: Sequence[str]) -> DataFrame:
    """(feature, fscore, gain): share of the splits, ascending, next to Spark's gain-based importance."""
    spark = SparkSession.getActiveSession()
    gains = model.featureImportances.toArray()
    names = spark.createDataFrame([(i, c, float(g)) for i, (c, g) in enumerate(zip(cols, gains))],
                                  "i int, name string, gain double")
    counts = split_counts(model)
    total = counts.agg(F.sum("n")).first()[0] or 1
    return (counts.join(names, counts["feature"] == names["i"])
            .select(F.col("name").alias("feature"), (F.col("n") / F.lit(total)).alias("fscore"), "gain")
            .orderBy("fscore", "feature"))


_NODES = "array<array<struct<feature:int,threshold:double,left:int,right:int,value:double>>>"


def tree_values(model, cols: Sequence[str], rounds: int | None = None) -> Column:
    """Array of what the tree of each round (the first ``rounds``) adds to the
    prediction. A missing or NaN feature goes to the right, as in Spark's trees.

    The nodes are a constant of the plan and a tree is walked from node to node,
    so the expression is as small for 150 trees as for one."""
    trees: dict[int, list] = {}
    for r in node_table(model).orderBy("tree", "id").collect():   # as many rows as the model has nodes
        trees.setdefault(r["tree"], []).append({
            "feature": r["feature"], "threshold": r["threshold"] or 0.0, "left": r["left"], "right": r["right"],
            "value": r["prediction"] * r["weight"]})
    nodes = F.from_json(F.lit(json.dumps([trees[t] for t in sorted(trees)][:rounds])), _NODES)
    x = F.array(*[F.coalesce(F.col(c).cast("double"), F.lit(float("nan"))) for c in cols])
    levels = F.sequence(F.lit(1), F.lit(max(1, model.getMaxDepth())))

    def step(x: Column, tree: Column, at: Column) -> Column:
        return _bound(F.get(tree, at), lambda node: F.when(node["feature"] < 0, at).when(
            F.get(x, node["feature"]) <= node["threshold"], node["left"]).otherwise(node["right"]))

    def value(x: Column, tree: Column) -> Column:
        leaf = F.aggregate(levels, F.lit(0), lambda at, _: step(x, tree, at))
        return F.get(tree, leaf)["value"]

    return _bound(x, lambda x: F.transform(nodes, lambda tree: value(x, tree)))


def _bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is worked out once, however often ``use`` names it: a column named
    inside a lambda is worked out again at each of its calls."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def staged_predictions(model, cols: Sequence[str]) -> Column:
    """Array of the predictions after the first, second, ... round."""
    none = F.array().cast("array<double>")
    return F.aggregate(tree_values(model, cols), none, lambda acc, x: F.concat(
        acc, F.array(F.coalesce(F.get(acc, F.size(acc) - 1), F.lit(0.0)) + x)))


def staged_errors(model, rows: DataFrame, cols: Sequence[str], label: str = "demand") -> DataFrame:
    """(round, n, rmsle) after each round, from one pass over the rows: the trees are walked by numpy on the blocks
    of rows of a task, whose sums (two numbers a round) are added up on the driver."""
    trees = _node_arrays(model)
    depth = max(1, model.getMaxDepth())

    def summed(batches):
        part, n, known = np.zeros(len(trees)), 0, 0
        for b in batches:
            if not b.num_rows:
                continue
            y = b.column(1).to_numpy(zero_copy_only=False)
            there = ~np.isnan(y)        # a missing label is left out, as by an average
            x = b.column(0).flatten().to_numpy(zero_copy_only=False).reshape(b.num_rows, -1)[there]
            y, p = np.log1p(y[there]), np.zeros(int(there.sum()))
            of, n = np.arange(len(y)), n + b.num_rows
            for i, (feature, threshold, left, right, value) in enumerate(trees):
                at = np.zeros(len(y), np.int64)
                for _ in range(depth):
                    f = feature[at]
                    at = np.where(f < 0, at, np.where(x[of, f] <= threshold[at], left[at], right[at]))
                p += value[at]
                off = np.log1p(np.where(p > 0.0, p, 0.0)) - y
                part[i] += off @ off
            known += len(y)
        yield pa.RecordBatch.from_arrays(
            [pa.array([TaskContext.get().partitionId()]), pa.array([n]), pa.array([known]),
             pa.array([part.tolist()], pa.list_(pa.float64()))], ["part", "n", "known", "s"])

    x = F.array(*[F.coalesce(F.col(c).cast("double"), F.lit(float("nan"))) for c in cols])
    told = (rows.select(x.alias("x"), F.coalesce(F.col(label).cast("double"), F.lit(float("nan"))).alias("y"))
            .mapInArrow(summed, "part long, n long, known long, s array<double>").collect())
    told.sort(key=lambda r: r["part"])      # one order of the sums
    n, known = sum(r["n"] for r in told), sum(r["known"] for r in told)
    total = sum((np.array(r["s"]) for r in told), np.zeros(len(trees)))
    errors = [(i + 1, n, float(np.sqrt(t / known)) if known else None) for i, t in enumerate(total)] if n else []
    return rows.sparkSession.createDataFrame(errors, "round int, n long, rmsle double")


def _node_arrays(model) -> list[tuple[np.ndarray, ...]]:
    """Per tree the arrays (feature, threshold, left, right, what a leaf adds) over its nodes; a leaf's feature is -1."""
    trees: dict[int, list] = {}
    for r in node_table(model).orderBy("tree", "id").collect():   # as many rows as the model has nodes
        trees.setdefault(r["tree"], []).append(r)
    return [(np.array([r["feature"] for r in t]), np.array([r["threshold"] or 0.0 for r in t]), np.array([r["left"] for r in t]),
             np.array([r["right"] for r in t]), np.array([r["prediction"] * r["weight"] for r in t]))
            for _, t in sorted(trees.items())]


def first_rounds(model, rounds: int) -> GBTRegressionModel:
    """Spark's model of the first ``rounds`` trees."""
    sc = SparkSession.getActiveSession().sparkContext
    jvm, old = sc._jvm, model._java_obj
    trees = sc._gateway.new_array(jvm.org.apache.spark.ml.regression.DecisionTreeRegressionModel, rounds)
    weights = sc._gateway.new_array(jvm.double, rounds)
    for i in range(rounds):
        trees[i], weights[i] = old.trees()[i], float(model.treeWeights[i])
    cut = jvm.org.apache.spark.ml.regression.GBTRegressionModel(model.uid, trees, weights)
    return GBTRegressionModel(cut.setFeaturesCol(old.getFeaturesCol()).setPredictionCol(old.getPredictionCol()))


def best_round(errors: Sequence[float], patience: int = PATIENCE) -> int:
    """The round (from 1) of the least error seen before ``patience`` rounds in a row bring no lesser one."""
    best = 0
    for i, e in enumerate(errors):
        if e < errors[best]:
            best = i
        elif i - best >= patience:
            break
    return best + 1


@dataclass
class StoppedBooster:
    """An ensemble cut after ``rounds``; ``errors`` are the held-out errors of all its rounds."""
    model: object
    rounds: int
    errors: list[float]

    def predict(self, rows: DataFrame, cols: Sequence[str], id_col: str = "id", floor: bool = True) -> DataFrame:
        """(id, prediction) of the first ``rounds`` trees, negatives floored at 0 when ``floor``."""
        return M.predict(first_rounds(self.model, self.rounds), rows, cols, id_col, floor)


def fit_early_stop(train: DataFrame, cols: Sequence[str], label: str = "demand", valid_col: str = "is_valid",
                   patience: int = PATIENCE, **overrides) -> StoppedBooster:
    """Boosting on the rows not flagged by ``valid_col``, cut at the round after
    which the flagged rows' error didn't fall for ``patience`` rounds."""
    model = M.fit(M.gbt_regressor(**overrides), train.where(~F.col(valid_col)), cols, label)
    told = staged_errors(model, train.where(F.col(valid_col)), cols, label).orderBy("round").collect()
    errors = [r["rmsle"] for r in told]     # one number a round
    return StoppedBooster(model, best_round(errors, patience) if errors else model.getNumTrees, errors)
