"""Scans and sinks: typed CSV, first rows, parquet caches, partitioned
writes, submission files and a file inventory.

Written tables go under the shared checkpoint folder (``session.shared_dir``),
never a machine-local temp folder, so every executor can read them back.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Sequence
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from demandspark.functions.expressions import clamp_nonneg, size_mb

CACHE_VERSION = 1   # part of every manifest: raise it when prepared tables change their meaning


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """CSV with a header and an explicit schema (no inference)."""
    return spark.read.schema(schema).option("header", True).csv(path)


def first_rows(df: DataFrame, n: int, order: Sequence[str]) -> DataFrame:
    """The first ``n`` rows in an explicit order (a head report)."""
    return df.orderBy(*order).limit(n)


def write_csv(df: DataFrame, path: str) -> str:
    df.write.mode("overwrite").option("header", True).csv(path)
    return path


def write_parquet(df: DataFrame, path: str, partition_by: Sequence[str] | None = None) -> str:
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return path


def input_fingerprint(spark: SparkSession, inputs: Sequence[DataFrame]) -> dict | None:
    """What the files behind ``inputs`` are now: their number, bytes and a hash of
    (path, length, modification time) that doesn't depend on their order. Only
    the listing is read, and it is summed in Spark. None if an input has no
    files (made in memory), as such a table can't be told from a changed one."""
    paths: set[str] = set()
    for df in inputs:
        files = df.inputFiles()
        if not files:
            return None
        paths.update(unquote(f) for f in files)
    if not paths:
        return {"files": 0, "bytes": 0, "hash": 0}
    seen = (spark.read.format("binaryFile").load(sorted(paths))
            .select("path", "length", "modificationTime").distinct())
    return seen.agg(F.count(F.lit(1)).alias("files"), F.sum("length").alias("bytes"),
                    F.bit_xor(F.xxhash64("path", "length", "modificationTime")).alias("hash")).first().asDict()


def cached_table(spark: SparkSession, path: str, build, rebuild: bool = False,
                 inputs: Sequence[DataFrame] = (), params: dict | None = None) -> DataFrame:
    """Read a parquet cache, building (and writing) it first when there is none
    for these ``params`` and for ``inputs`` as their files are now.

    Each state of parameters and input files has a folder of its own under
    ``path``, named by their digest, and beside it a manifest that is written
    last: a build that was cut short has none and runs again, a changed input or
    parameter leads to a new folder, and readers of an older one keep its files.
    With an input that has no files the table is built on every call."""
    state = input_fingerprint(spark, inputs)
    manifest = json.dumps({"version": CACHE_VERSION, "params": params or {}, "inputs": state}, sort_keys=True)
    digest = hashlib.sha256(manifest.encode()).hexdigest()[:24]
    table, note = f"{path}/{digest}", f"{path}/{digest}-manifest"
    if rebuild or state is None or _read_manifest(spark, note) != manifest:
        write_parquet(build(), table)
        spark.createDataFrame([(manifest,)], "value string").coalesce(1).write.mode("overwrite").text(note)
    return spark.read.parquet(table)


def _read_manifest(spark: SparkSession, path: str) -> str | None:
    """The manifest's text, or None where there is none."""
    try:
        row = spark.read.text(path, wholetext=True).first()
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    return row.value.strip() if row else None


def write_submission(pred: DataFrame, path: str, id_col: str = "id",
                     value: str = "prediction") -> str:
    """(id, demand) with negatives set to 0, fixed column order, CSV."""
    out = pred.select(F.col(id_col).alias("id"), clamp_nonneg(value).alias("demand"))
    return write_csv(out, path)


def file_inventory(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """(file_name, size_mb) of every file behind the given tables: one row per
    file from the listing, no content is read."""
    files = spark.read.format("binaryFile").load(list(paths)).select("path", "length")
    return files.select(F.regexp_extract("path", r"([^/]+)$", 1).alias("file_name"),
                        size_mb("length").alias("size_mb"))
