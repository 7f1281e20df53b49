"""Session construction and the shared folder used for lineage cuts."""

from __future__ import annotations

import atexit
import os
import re
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings that matter at scale. AQE re-plans joins at runtime (broadcast when a
# shuffled side turns out small, skew splits for hot keys) and coalesces
# shuffle partitions; partitions are sized by bytes, not counts.
SCALE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # compressed bytes: a task holds several times as much in each of its sorts and hash tables
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "32m",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.parquet.filterPushdown": "true",
}


def get_session(master: str | None = None, app: str = "demandspark",
                shuffle_partitions: int = 8, extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the scale settings applied.

    On a cluster call with ``master=None`` and let spark-submit decide.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(SCALE_CONF)
    conf.update({
        "spark.sql.shuffle.partitions": str(shuffle_partitions),
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
    })
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    for k, v in SCALE_CONF.items():
        spark.conf.set(k, v)
    ensure_checkpoint_dir(spark)
    return spark


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime SQL settings and the checkpoint folder to a session
    built elsewhere (e.g. by spark-submit or a test driver). Settings that the
    cluster chose itself stay."""
    chosen = spark.sparkContext.getConf()
    for k, v in SCALE_CONF.items():
        if not chosen.contains(k):
            spark.conf.set(k, v)
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster this setting names a folder every executor can reach; it is
    read from the session. Only a ``local`` master without the setting (tests)
    gets a folder under the system temp folder, which goes when the process
    ends; on a cluster a missing setting is an error, as files in one machine's
    folder are lost to the others.
    """
    d = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get(
        "spark.checkpoint.dir", None)
    if not d:
        master = spark.sparkContext.master
        if not re.fullmatch(r"local(\[[^\]]*\])?", master):
            raise ValueError(f"set spark.checkpoint.dir to a shared folder (master is {master})")
        d = tempfile.mkdtemp(prefix="demandspark-ckpt-")
        atexit.register(shutil.rmtree, d, ignore_errors=True)
        spark.conf.set("spark.checkpoint.dir", d)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(d)
    return d


def shared_dir(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared checkpoint folder for written tables."""
    base = ensure_checkpoint_dir(spark)
    return os.path.join(base, f"{name}-{uuid.uuid4().hex[:12]}")


def materialize(df, name: str):
    """Write ``df`` as parquet under the shared checkpoint folder and read it
    back: cuts the lineage (a lost executor recomputes nothing before this
    point) and later scans get column pruning and filter pushdown."""
    spark = df.sparkSession
    path = shared_dir(spark, name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)
