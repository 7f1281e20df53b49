"""Shared parts of the text operators: inputs, content keys, written cut points."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from demandspark.session import shared_dir

__all__ = ["content_key", "drop_tables", "full_text", "materialize", "read_table", "recording", "small_batches"]


_RECORD: ContextVar[list[str] | None] = ContextVar("cut_points", default=None)


@contextmanager
def recording(paths: list[str]) -> Iterator[None]:
    """Cut points that are written inside are noted in ``paths``."""
    token = _RECORD.set(paths)
    try:
        yield
    finally:
        _RECORD.reset(token)


def materialize(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet in the shared folder and read back: a lineage cut
    that survives lost executors."""
    spark = df.sparkSession
    path = shared_dir(spark, name)
    df.write.parquet(path)
    if (noted := _RECORD.get()) is not None:
        noted.append(path)
    return spark.read.parquet(path)


def drop_tables(spark: SparkSession, paths: list[str]) -> None:
    """Delete cut points whose readers are done."""
    for path in paths:
        place = spark._jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


ARROW_ROWS = 2000   # texts in one Arrow batch, so that a Python worker holds a few MB of them
_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"


def small_batches(spark: SparkSession) -> None:
    """Small Arrow batches for this session, unless the cluster sets their size itself."""
    if not spark.sparkContext.getConf().contains(_BATCH):
        spark.conf.set(_BATCH, str(ARROW_ROWS))


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    small_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def full_text(column: str = "text") -> Column:
    """The text, a null as the empty text."""
    return F.coalesce(F.col(column), F.lit(""))


def content_key(text: Column) -> list[Column]:
    """Two 64-bit hashes (k1, k2) that name a text by its content."""
    return [F.xxhash64(text).alias("k1"), F.xxhash64(F.lit(1), text).alias("k2")]
