"""Exact medians and quantiles without collecting a group into one task.

Values are first counted per (group, value) with map-side partial
aggregation, so a hot group shrinks to one row per distinct value before any
shuffle. Positions are then found on the running count of that histogram.
Interpolation is linear between the two neighbouring order statistics, as in
pandas/numpy and SQL ``percentile``/``quantile_cont``.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from demandspark.operators.joins import with_constants
from demandspark.sources.ids import with_running_sum


#: Types whose distinct values fit one window whatever the key.
SMALL_TYPES = ("tinyint", "smallint")


def _pick(probs: Sequence[float], names: Sequence[str], of: Callable[[Column], Column] = lambda e: e):
    """Quantile aggregates of a histogram with its running count; ``of`` limits them to some of its rows."""
    out = []
    for p, name in zip(probs, names):
        h = (F.col("_n") - 1) * F.lit(float(p))
        lo, hi = F.floor(h), F.ceil(h)
        v_lo = F.min(of(F.when(F.col("_cum") > lo, F.col("_v"))))
        v_hi = F.min(of(F.when(F.col("_cum") > hi, F.col("_v"))))
        frac = F.first(of(h - lo), ignorenulls=True)
        out.append((v_lo + (v_hi - v_lo) * frac).cast("double").alias(name))
    return out


def grouped_quantiles(df: DataFrame, keys: Sequence[str], value: str,
                      probs: Sequence[float] = (0.5,), names: Sequence[str] | None = None,
                      small_domain: bool | None = None) -> DataFrame:
    """Exact quantiles of ``value`` per key group (NULL values ignored, NULL keys dropped).

    Default: the (key, value) histogram is sorted across partitions and its
    running count is taken per partition plus a partition offset; a key's
    start is subtracted afterwards. No task holds a whole group, however many
    distinct values a hot key has.

    ``small_domain=True`` uses a window per key over its histogram instead:
    fewer jobs, and the window holds one row per distinct value of the key
    (never the key's rows). ``None`` (default) picks it for types of at most
    65,536 values and the distributed form for all others.
    """
    if small_domain is None:
        small_domain = dict(df.dtypes)[value] in SMALL_TYPES
    names = list(names or [f"q{int(p * 100)}" for p in probs])
    keys = list(keys)
    base = df.select(*keys, F.col(value).alias("_v")).where(F.col("_v").isNotNull())
    for k in keys:
        base = base.where(F.col(k).isNotNull())
    hist = base.groupBy(*keys, "_v").agg(F.count(F.lit(1)).alias("_c"))
    if small_domain:
        w = Window.partitionBy(*keys).orderBy("_v")
        hist = (hist.withColumn("_cum", F.sum("_c").over(w.rowsBetween(Window.unboundedPreceding, 0)))
                .withColumn("_n", F.sum("_c").over(Window.partitionBy(*keys))))
        return hist.groupBy(*keys).agg(*_pick(probs, names))
    hist = with_running_sum(hist, [*keys, "_v"], "_c", name="_gcum")
    base_of = hist.groupBy(*keys).agg(F.min(F.col("_gcum") - F.col("_c")).alias("_base"),
                                      F.sum("_c").alias("_n"))
    hist = (hist.join(base_of, keys)
            .withColumn("_cum", F.col("_gcum") - F.col("_base")))
    return hist.groupBy(*keys).agg(*_pick(probs, names))


def global_quantiles(df: DataFrame, value: str, probs: Sequence[float] = (0.5,),
                     names: Sequence[str] | None = None) -> DataFrame:
    """One-row exact quantiles of a whole column.

    The histogram is sorted with range partitioning and its running count is
    computed per partition plus a partition offset: no step holds the whole
    column in one task.
    """
    names = list(names or [f"q{int(p * 100)}" for p in probs])
    hist = (df.select(F.col(value).alias("_v")).where(F.col("_v").isNotNull())
            .groupBy("_v").agg(F.count(F.lit(1)).alias("_c")))
    hist = with_running_sum(hist, ["_v"], "_c", name="_cum")
    total = hist.agg(F.sum("_c").alias("_n"))
    return with_constants(hist, total).agg(*_pick(probs, names))


def median_of(df: DataFrame, value: str, name: str = "median") -> DataFrame:
    return global_quantiles(df, value, [0.5], [name])
