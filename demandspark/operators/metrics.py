"""RMSLE metrics (strict and clamped), constant baselines, and an ML
Evaluator wrapper so the metric plugs into Spark ML tuning."""

from __future__ import annotations

from pyspark.ml.evaluation import Evaluator
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandspark.functions.expressions import log_mean, rmsle
from demandspark.operators.joins import with_constants
from demandspark.operators.quantiles import median_of


def score(df: DataFrame, pred: str, label: str, clamp: bool = True,
          name: str = "rmsle") -> DataFrame:
    """One row: RMSLE of ``pred`` against ``label`` (clamped at 0 by default)."""
    return df.agg(rmsle(pred, label, clamp).alias(name), F.count(F.lit(1)).alias("n"))


def constant_baselines(train: DataFrame, label: str = "demand") -> DataFrame:
    """Score three constant predictions on the training rows: the log-mean,
    the mean and the median of the label (constants attached as a one-row
    broadcast, never collected)."""
    consts = with_constants(
        train.agg(log_mean(label).alias("c_log_mean"), F.avg(label).alias("c_mean")),
        median_of(train, label, "c_median"))
    scored = with_constants(train.select(label), consts)
    return scored.agg(
        F.first("c_log_mean").alias("log_mean"), F.first("c_mean").alias("mean"),
        F.first("c_median").alias("median"),
        rmsle("c_log_mean", label).alias("rmsle_log_mean"),
        rmsle("c_mean", label).alias("rmsle_mean"),
        rmsle("c_median", label).alias("rmsle_median"))


class RmsleEvaluator(Evaluator):
    """Spark ML evaluator for RMSLE (smaller is better)."""

    def __init__(self, predictionCol: str = "prediction", labelCol: str = "label",
                 clamp: bool = True):
        super().__init__()
        self.predictionCol = predictionCol
        self.labelCol = labelCol
        self.clamp = clamp

    def _evaluate(self, dataset: DataFrame) -> float:
        row = dataset.agg(rmsle(self.predictionCol, self.labelCol, self.clamp).alias("e")).first()
        return float(row["e"])

    def isLargerBetter(self) -> bool:
        return False
