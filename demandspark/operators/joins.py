"""Join helpers: no broadcast hints.

Dimensions and aggregates are joined with plain equi-joins; AQE turns a shuffle
join into a broadcast join when the materialised side is small in bytes, and
splits skewed partitions when one key is hot.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandspark.session import materialize

def written_dimension(df: DataFrame) -> DataFrame:
    """Write a dimension table once to the checkpoint folder (cutting its
    lineage). The planner then knows its bytes and picks the join by them."""
    return materialize(df, "dimension")


def with_constants(df: DataFrame, consts: DataFrame) -> DataFrame:
    """Attach the columns of a one-row frame (global log-mean, medians, row
    counts...) as constants. The row is packed into one struct and used as a
    scalar subquery: computed once, embedded in the plan, no join at all."""
    cols = consts.columns
    k = consts.select(F.struct(*cols).alias("_k")).scalar()
    # one subquery: the struct is embedded once, fields read from the column
    with_k = df.withColumn("_consts", k)
    return with_k.withColumns({c: F.col("_consts").getField(c) for c in cols}).drop("_consts")


def left_attach(rows: DataFrame, stats: DataFrame, keys: Sequence[str]) -> DataFrame:
    """rows LEFT JOIN stats USING keys (keys are non-null ids)."""
    return rows.join(stats, list(keys), "left")
