"""Spark ML models: OLS, boosted trees (regression / binary), linear booster,
random forest, standard scaling and mean imputation.

Parameter defaults follow the source pipeline (150 rounds, depth 4, step
0.01, row subsample 0.7, column share 0.4, min child weight 7, seed 1301).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline
from pyspark.ml.feature import Imputer, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import VectorUDT
from pyspark.ml.regression import LinearRegression, RandomForestRegressor
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from demandspark.functions.expressions import binarise, cap_label, floor_zero
from demandspark.operators.block_booster import BlockGBTClassifier, BlockGBTRegressor
from demandspark.operators.joins import with_constants
from demandspark.operators.linear_booster import LinearBooster

# The booster parameter map.
GBT_PARAMS = dict(maxIter=150, maxDepth=4, stepSize=0.01, subsamplingRate=0.7,
                  featureSubsetStrategy="0.4", minInstancesPerNode=7, minInfoGain=0.0,
                  seed=1301)
STACK_GBT_PARAMS = dict(GBT_PARAMS, stepSize=0.015, minInstancesPerNode=20)
FOREST_PARAMS = dict(featureSubsetStrategy="log2", maxDepth=30, seed=47)
# how Spark goes about deep trees: a row's node is kept, not walked to anew, and twice the nodes a pass
FOREST_RUN = dict(cacheNodeIds=True, maxMemoryInMB=512)
LABEL_CAP = 10


def assemble(df: DataFrame, cols: Sequence[str], out: str = "features") -> DataFrame:
    """Feature vector column, NULL and NaN kept as NaN: fitted trees send them to the right, but fits
    refuse them, so rows to be fitted need every feature (as the feature tables have) or a filler.

    Numbers go into the vector as one array (the assembler works through a row object per row); columns
    that are vectors themselves need the assembler. Either way the column's metadata names the features."""
    if any(isinstance(df.schema[c].dataType, VectorUDT) for c in cols):
        return VectorAssembler(inputCols=list(cols), outputCol=out, handleInvalid="keep").transform(df)
    x = F.array(*[F.coalesce(F.col(c).cast("double"), F.lit(float("nan"))) for c in cols])
    named = {"attrs": {"numeric": [{"idx": i, "name": c} for i, c in enumerate(cols)]}, "num_attrs": len(cols)}
    return df.withColumn(out, array_to_vector(x)).withMetadata(out, {"ml_attr": named})


def _label(df: DataFrame, label: str, cap: float | None) -> DataFrame:
    v = F.col(label).cast("double")
    return df.withColumn("_label", cap_label(v, cap) if cap is not None else v)


def fit_ols(train: DataFrame, cols: Sequence[str], label: str = "demand",
            cap: float | None = LABEL_CAP):
    """Ordinary least squares (normal equations, no penalty) on a capped label."""
    return fit(ols(), train, cols, label, cap)


def fit_imputed(estimator, train: DataFrame, cols: Sequence[str], label: str = "demand",
                cap: float | None = None):
    """A linear model behind a mean imputer: NULL and NaN features become the
    column's mean over ``train``, in training and in prediction. Every column
    needs a value somewhere in ``train``. Score it with ``predict_imputed``."""
    filled = [f"_filled_{c}" for c in cols]
    steps = [Imputer(strategy="mean", inputCols=[f"_in_{c}" for c in cols], outputCols=filled),
             VectorAssembler(inputCols=filled, outputCol="features", handleInvalid="error"), estimator]
    return Pipeline(stages=steps).fit(_label(_imputer_inputs(train, cols), label, cap))


def predict_imputed(model, rows: DataFrame, cols: Sequence[str], id_col: str = "id",
                    floor: bool = True) -> DataFrame:
    """(id, prediction) of a ``fit_imputed`` model, negatives floored at 0 when ``floor``."""
    scored = model.transform(_imputer_inputs(rows, cols))
    p = floor_zero(F.col("prediction")) if floor else F.col("prediction")
    return scored.select(id_col, p.cast("double").alias("prediction"))


def _imputer_inputs(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """The imputer takes doubles."""
    return df.withColumns({f"_in_{c}": F.col(c).cast("double") for c in cols})


def ols() -> LinearRegression:
    return LinearRegression(featuresCol="features", labelCol="_label", solver="normal",
                            regParam=0.0, elasticNetParam=0.0)


def ols_line(train: DataFrame, x: str, y: str) -> DataFrame:
    """One-feature OLS: one row (slope, intercept); the fit's coefficients
    are read off the model and attached as a one-row frame."""
    m = fit_ols(train, [x], y, cap=None)
    spark = SparkSession.getActiveSession()
    return spark.createDataFrame([(float(m.coefficients[0]), float(m.intercept))],
                                 "slope double, intercept double")


def gbt_regressor(**overrides) -> BlockGBTRegressor:
    params = dict(GBT_PARAMS)
    params.update(overrides)
    return BlockGBTRegressor(featuresCol="features", labelCol="_label", predictionCol="prediction",
                             **params)


def linear_booster(**options) -> LinearBooster:
    """Linear base learner of a booster: coordinate descent with step and penalty."""
    return LinearBooster(**options)


def random_forest(num_trees: int = 20, **overrides) -> RandomForestRegressor:
    params = dict(FOREST_PARAMS, **FOREST_RUN)
    params.update(overrides)
    return RandomForestRegressor(featuresCol="features", labelCol="_label", numTrees=num_trees,
                                 **params)


def balanced(rows: DataFrame) -> DataFrame:
    """Rows dealt evenly over the cores. A tree fit goes over its rows some hundred times, and the
    parts of a written table are as uneven as its files (a small table is one)."""
    return rows.repartition(rows.sparkSession.sparkContext.defaultParallelism)


def fit(estimator, train: DataFrame, cols: Sequence[str], label: str = "demand",
        cap: float | None = None):
    # the block booster deals its blocks itself
    rows = train if isinstance(estimator, BlockGBTRegressor) else balanced(train)
    return estimator.fit(_label(assemble(rows, cols), label, cap))


def predict(model, rows: DataFrame, cols: Sequence[str], id_col: str = "id",
            floor: bool = True) -> DataFrame:
    """(id, prediction), negatives floored at 0 when ``floor``."""
    scored = model.transform(assemble(rows, cols))
    p = floor_zero(F.col("prediction")) if floor else F.col("prediction")
    return scored.select(id_col, p.cast("double").alias("prediction"))


def fit_binary(train: DataFrame, cols: Sequence[str], label: str = "label",
               threshold: float = 0.5, **overrides):
    """Binary boosted classifier on a label binarised at ``threshold``."""
    params = dict(GBT_PARAMS)
    params.update(overrides)
    data = assemble(train, cols).withColumn("_label", binarise(F.col(label), threshold).cast("double"))
    return BlockGBTClassifier(featuresCol="features", labelCol="_label", **params).fit(data)


def predict_binary(model, rows: DataFrame, cols: Sequence[str], id_col: str = "id") -> DataFrame:
    """(id, p1, p0, prediction): named class probabilities, no positional ambiguity."""
    scored = model.transform(assemble(rows, cols))
    prob = vector_to_array("probability")
    return scored.select(id_col, prob[1].alias("p1"), prob[0].alias("p0"),
                         F.col("prediction").cast("int").alias("prediction"))


def standard_scale(train: DataFrame, rows: DataFrame, cols: Sequence[str],
                   suffix: str = "") -> DataFrame:
    """(x - mean) / population std with mean and std fitted on ``train``;
    a zero-variance column keeps scale 1 (so it becomes 0, no division error)."""
    # a column is constant if its least value is its greatest: the rounded sums
    # of a constant may give a tiny deviation instead of zero
    constant = {c: F.min(c) == F.max(c) for c in cols}
    stats = train.agg(
        *[F.when(constant[c], F.min(c).cast("double")).otherwise(F.avg(c)).alias(f"_m_{c}") for c in cols],
        *[F.when(constant[c], F.lit(1.0)).otherwise(F.stddev_pop(c)).alias(f"_s_{c}") for c in cols])
    out = with_constants(rows, stats)
    out = out.withColumns({c + suffix: (F.col(c) - F.col(f"_m_{c}")) / F.col(f"_s_{c}") for c in cols})
    return out.drop(*[f"_m_{c}" for c in cols], *[f"_s_{c}" for c in cols])


def impute_mean(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Spark ML mean imputer (fit on ``df``, applied to ``df``)."""
    dbl = df.withColumns({c: F.col(c).cast("double") for c in cols})
    model = Imputer(strategy="mean", inputCols=list(cols), outputCols=list(cols)).fit(dbl)
    return model.transform(dbl)
