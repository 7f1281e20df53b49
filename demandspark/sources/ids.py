"""Distributed consecutive numbering and running sums over a global order.

``row_number() OVER (ORDER BY ...)`` without a partition moves every row into
one task. These helpers keep the work spread out: a range-partitioned sort,
a per-partition row count (one row per partition, so its size is bounded by
the partition count and safe to broadcast), and a prefix sum over those counts
as the offset of each partition.

The sorted frame is written as parquet to the shared checkpoint folder
before it is read twice: range bounds come from sampling, so two independent
evaluations could partition differently. Reading one written copy makes the
counts and the positions agree, and survives executor loss.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from demandspark.session import materialize

_LOCAL_BITS = 33  # monotonically_increasing_id: partition index << 33 | position


def _ordered_with_position(df: DataFrame, order: Sequence[str | Column],
                           keep: Sequence[str | Column]) -> DataFrame:
    mid = F.monotonically_increasing_id()
    ordered = (df.orderBy(*order)
               .withColumn("_mid", mid)
               .withColumn("_pid", F.shiftright(F.col("_mid"), _LOCAL_BITS))
               .withColumn("_pos", F.col("_mid").bitwiseAND((1 << _LOCAL_BITS) - 1))
               .select(*keep, "_pid", "_pos"))
    return materialize(ordered, "ordered")


def _partition_offsets(ordered: DataFrame, weight: Column) -> DataFrame:
    sizes = ordered.groupBy("_pid").agg(F.sum(weight).alias("_n"))
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    # one row per partition of the sort: bounded, broadcast is safe
    return F.broadcast(sizes.select(
        "_pid", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off")))


def with_consecutive_id(df: DataFrame, order: Sequence[str | Column], name: str = "row_id",
                        start: int = 1, keep: Sequence[str | Column] | None = None) -> DataFrame:
    """Add ``name`` = start, start+1, ... following ``order`` (ties broken arbitrarily).

    ``keep`` names the columns of the result, all by default, or works them out from those of ``df``:
    columns that only order the rows are then sorted by but not written."""
    keep = list(df.columns if keep is None else keep)
    cols = df.select(*keep).columns
    ordered = _ordered_with_position(df, order, keep)
    offsets = _partition_offsets(ordered, F.lit(1))
    return (ordered.join(offsets, "_pid")
            .select(*cols, (F.col("_off") + F.col("_pos") + F.lit(start)).cast("long").alias(name)))


def with_running_sum(df: DataFrame, order: Sequence[str | Column], weight: str,
                     name: str = "cum") -> DataFrame:
    """Inclusive running sum of ``weight`` over a global order, computed per partition."""
    cols = df.columns
    ordered = _ordered_with_position(df, order, cols)
    offsets = _partition_offsets(ordered, F.col(weight))
    local = F.sum(weight).over(Window.partitionBy("_pid").orderBy("_pos")
                               .rowsBetween(Window.unboundedPreceding, 0))
    return (ordered.withColumn("_local", local).join(offsets, "_pid")
            .select(*cols, (F.col("_off") + F.col("_local")).alias(name)))


def dense_codes_many(df: DataFrame, cols: dict[str, str]) -> dict[str, DataFrame]:
    """Dictionaries for several columns from one distributed numbering.

    Values of all columns are stacked as (dictionary, value), numbered once in
    (dictionary, value NULLS LAST) order, and each code is the global number
    minus the first number of its dictionary.
    """
    parts = None
    for c in cols:
        p = df.select(F.lit(c).alias("_dict"), F.col(c).cast("string").alias("_val")).distinct()
        parts = p if parts is None else parts.unionByName(p)
    numbered = with_consecutive_id(parts, [F.col("_dict"), F.col("_val").asc_nulls_last()],
                                   name="_gid", start=0)
    first = numbered.groupBy("_dict").agg(F.min("_gid").alias("_first"))
    coded = numbered.join(F.broadcast(first), "_dict").select(  # one row per dictionary
        "_dict", "_val", (F.col("_gid") - F.col("_first")).cast("int").alias("_code"))
    return {c: coded.where(F.col("_dict") == c).select(F.col("_val"), F.col("_code").alias(code))
            for c, code in cols.items()}
