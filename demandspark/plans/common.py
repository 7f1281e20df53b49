"""Shared helpers for the registered queries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def round_doubles(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round every float/double column (the oracle compares at 6 decimals)."""
    out = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            out.append(F.round(F.col(f.name).cast("double"), digits).alias(f.name))
        else:
            out.append(F.col(f.name))
    return df.select(*out)


def cast_ints(df: DataFrame, cols: list[str], to: str = "long") -> DataFrame:
    return df.withColumns({c: F.col(c).cast(to) for c in cols})
