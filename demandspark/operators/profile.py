"""Profiling: grouped statistics, describe, shapes, null counts, frequent
values, natural self join and product coverage."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from demandspark.functions.expressions import log_mean, null_count
from demandspark.operators.joins import with_constants
from demandspark.operators.quantiles import SMALL_TYPES, _pick, grouped_quantiles
from demandspark.sources.ids import with_running_sum

STAT_NAMES = ["count", "sum", "min", "max", "median", "mean"]
_INTEGRAL = ("tinyint", "smallint", "int", "bigint")
DESCRIBE_PROBS = [0.25, 0.5, 0.75]


def grouped_stats(df: DataFrame, keys: Sequence[str], cols: Sequence[str]) -> DataFrame:
    """count/sum/min/max/median/mean of each value column per key, named
    ``{col}_{stat}``.

    The value columns are stacked to (column, value) and all six statistics
    come from one (key, column, value) histogram, so a hot key is reduced
    map-side before the shuffle. The running count for the median is a window
    per (key, column) over distinct values if all columns have a type of at
    most 65,536 values and a distributed sorted running count otherwise: no
    task holds a whole group. Integer columns are stacked as exact decimals if
    all columns are integers, so their sums never pass through a double.
    """
    keys = list(keys)
    types = dict(df.dtypes)
    kind = "decimal(20,0)" if all(types[c] in _INTEGRAL for c in cols) else "double"
    stack = "stack({}, {}) as (_col, _v)".format(
        len(cols), ", ".join(f"'{c}', cast(`{c}` as {kind})" for c in cols))
    long = df.selectExpr(*[f"`{k}`" for k in keys], stack).where(F.col("_v").isNotNull())
    gk = keys + ["_col"]
    hist = long.groupBy(*gk, "_v").agg(F.count(F.lit(1)).alias("_c"))
    if all(types[c] in SMALL_TYPES for c in cols):
        # a key's window holds one row per distinct value
        w = Window.partitionBy(*gk).orderBy("_v")
        hist = (hist.withColumn("_cum", F.sum("_c").over(w.rowsBetween(Window.unboundedPreceding, 0)))
                .withColumn("_n", F.sum("_c").over(Window.partitionBy(*gk))))
    else:
        hist = with_running_sum(hist, [*gk, "_v"], "_c", name="_gcum")
        base_of = hist.groupBy(*gk).agg(F.min(F.col("_gcum") - F.col("_c")).alias("_base"),
                                        F.sum("_c").alias("_n"))
        hist = hist.join(base_of, gk).withColumn("_cum", F.col("_gcum") - F.col("_base"))
    # one aggregate per key for all columns and statistics: no row per (key, column) is grouped again by a pivot
    out = []
    for c in cols:
        def of(e):
            return F.when(F.col("_col") == c, e)

        n, total = F.sum(of(F.col("_c"))), F.sum(of(F.col("_v") * F.col("_c")))
        stat = {"count": n, "sum": total, "min": F.min(of(F.col("_v"))), "max": F.max(of(F.col("_v"))),
                "median": _pick([0.5], ["median"], of)[0], "mean": total.cast("double") / n}
        for s in STAT_NAMES:
            e = stat[s]
            # integer statistics keep integer types (counts and sums of counts)
            if s == "count" or (s == "sum" and types[c] in _INTEGRAL):
                e = e.cast("long")
            elif s in ("min", "max") and types[c] in _INTEGRAL:
                e = e.cast(types[c])  # min/max keep the column's own type
            out.append(e.alias(f"{c}_{s}"))
    return hist.groupBy(*keys).agg(*out)


def median_join_back(rows: DataFrame, keys: Sequence[str], value: str = "demand",
                     name: str = "median_demand") -> DataFrame:
    """Rows with the exact median of their key group (inner join)."""
    med = grouped_quantiles(rows, keys, value, [0.5], [name])
    return rows.join(med, list(keys), "inner")


def median_and_log_mean(rows: DataFrame, keys: Sequence[str], value: str = "demand") -> DataFrame:
    med = grouped_quantiles(rows, keys, value, [0.5], ["median"])
    lm = rows.groupBy(*keys).agg(log_mean(value).alias("log_mean"))
    return med.join(lm, list(keys), "inner")


def describe(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """One row per numeric column: count, mean, std (sample), min, p25, p50,
    p75, max. Percentiles are exact (linear interpolation).

    Columns are unpivoted to (column, value); the quantiles come from a
    (column, value) histogram sorted across partitions, so no task holds a
    whole column.
    """
    if cols is None:
        cols = [f.name for f in df.schema.fields
                if isinstance(f.dataType, (T.IntegerType, T.LongType, T.DoubleType, T.FloatType,
                                           T.ShortType, T.ByteType))]
    stack = "stack({}, {}) as (column, _v)".format(
        len(cols), ", ".join(f"'{c}', cast(`{c}` as double)" for c in cols))
    long = df.selectExpr(stack)
    moments = long.groupBy("column").agg(
        F.count("_v").alias("count"), F.avg("_v").alias("mean"),
        F.stddev_samp("_v").alias("std"), F.min("_v").alias("min"), F.max("_v").alias("max"))
    hist = (long.where(F.col("_v").isNotNull())
            .groupBy("column", "_v").agg(F.count(F.lit(1)).alias("_c")))
    hist = with_running_sum(hist, ["column", "_v"], "_c", name="_gcum")
    base = hist.groupBy("column").agg(F.min(F.col("_gcum") - F.col("_c")).alias("_base"),
                                      F.sum("_c").alias("_n"))
    hist = (hist.join(F.broadcast(base), "column")  # one row per column
            .withColumn("_cum", F.col("_gcum") - F.col("_base")))
    q = hist.groupBy("column").agg(*_pick(DESCRIBE_PROBS, ["p25", "p50", "p75"]))
    return moments.join(q, "column", "left").select(
        "column", "count", "mean", "std", "min", "p25", "p50", "p75", "max")


def table_shape(frames: dict[str, DataFrame]) -> DataFrame:
    """(table, n_rows, n_cols, columns) for each named frame."""
    parts = []
    for name, df in frames.items():
        parts.append(df.agg(F.count(F.lit(1)).alias("n_rows")).select(
            F.lit(name).alias("table"), "n_rows",
            F.lit(len(df.columns)).cast("long").alias("n_cols"),
            F.lit(",".join(df.columns)).alias("columns")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def null_counts(df: DataFrame) -> DataFrame:
    """(column, nulls) for every column."""
    wide = df.agg(*[null_count(c) for c in df.columns])
    stack = "stack({}, {}) as (column, nulls)".format(
        len(df.columns), ", ".join(f"'{c}', `{c}`" for c in df.columns))
    return wide.selectExpr(stack)


def top_values(df: DataFrame, col: str, n: int = 10) -> DataFrame:
    """The ``n`` most frequent values (ties by value): a top-k report."""
    return (df.groupBy(col).agg(F.count(F.lit(1)).alias("count"))
            .orderBy(F.desc("count"), F.asc(col)).limit(n))


def self_join_counts(df: DataFrame) -> DataFrame:
    """Row counts before and after a natural self join (NULL matches NULL).

    A group of c identical rows (grouping treats NULL as equal, as the
    null-safe join does) yields c*c joined rows, so the count after the join
    is sum(c^2) over groups: no pair is materialised.
    """
    groups = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_c"))
    return groups.agg(F.sum("_c").alias("rows_before"),
                      F.sum(F.col("_c") * F.col("_c")).alias("rows_after"))


def unseen(test: DataFrame, train: DataFrame, key: str = "product_id") -> DataFrame:
    """Distinct ``key`` values of test that never occur in train (anti join)."""
    return test.select(key).distinct().join(train.select(key).distinct(), key, "left_anti")


def coverage(test: DataFrame, train: DataFrame, key: str = "product_id") -> DataFrame:
    """One row: distinct keys in test, and how many of them are unseen in train."""
    n_test = test.agg(F.count_distinct(key).alias(f"n_test_{key}"))
    n_unseen = unseen(test, train, key).agg(F.count(F.lit(1)).alias(f"n_unseen_{key}"))
    return with_constants(n_test, n_unseen)
