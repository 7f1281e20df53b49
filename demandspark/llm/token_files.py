"""Token ids in shard files with a minimal perfect hash index.

Layout under ``path`` (Parquet, so writing is atomic and survives retries):

* ``shards``: ``part``, ``seq`` (order of shards), ``docs``, ``lens`` and
  ``ids``, the raw little-endian unsigned 32-bit ids of those documents one
  after another, in ascending doc_id order over all shards;
* ``index``: for each bucket of keys a minimal perfect hash (displacement seeds)
  and, at a key's slot, its fingerprint, shard, offset, length and global start.

A lookup hashes the key to a bucket and a slot, compares the fingerprint and
reads one shard: constant time at any size. A key is (doc_id, copy); copy
numbers rows of equal doc_id from 0.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from demandspark.llm.arrays import MULT_A, MULT_B, mix64
from demandspark.llm.common import full_text
from demandspark.llm.tokens import encoded_slices

SHARD_TOKENS = 1 << 20   # a shard ends with the document that reaches this many ids
BUCKET_KEYS = 2000       # mean keys of a bucket, each built in memory
GROUP_KEYS = 3           # mean keys that share a displacement seed

SHARDS = "part int, seq int, docs array<long>, copies array<long>, lens array<int>, ids binary"
INDEX = "bucket long, n int, seeds binary, prints binary, part binary, seq binary, at binary, len binary, start binary"


def _shard_rows(batches: Iterator[pa.RecordBatch], spec: str, end_id: int) -> Iterator[pa.RecordBatch]:
    part, seq = TaskContext.get().partitionId(), 0
    docs: list = []
    copies: list[int] = []
    lens: list[int] = []
    ids: list[np.ndarray] = []
    size, last, copy = 0, object(), 0
    tail = np.array([end_id], np.uint32)

    def shard():
        return pa.RecordBatch.from_arrays([
            pa.array([part], pa.int32()), pa.array([seq], pa.int32()),
            pa.array([docs], pa.list_(pa.int64())), pa.array([copies], pa.list_(pa.int64())),
            pa.array([lens], pa.list_(pa.int32())),
            pa.array([np.concatenate(ids).astype("<u4").tobytes()], pa.binary())],
            names=["part", "seq", "docs", "copies", "lens", "ids"])

    for batch in batches:
        doc = batch.column("doc_id").to_pylist()
        for i, j, found, offs in encoded_slices(batch, "_t", spec):
            for k in range(i, j):
                copy = copy + 1 if doc[k] == last else 0
                last = doc[k]
                own = found[offs[k - i]:offs[k - i + 1]]
                docs.append(doc[k])
                copies.append(copy)
                lens.append(len(own) + 1)
                ids += [own, tail]
                size += len(own) + 1
                if size >= SHARD_TOKENS:
                    yield shard()
                    docs, copies, lens, ids, size, seq = [], [], [], [], 0, seq + 1
    if docs:
        yield shard()


def key_hashes(doc_id: np.ndarray, copy: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    d, c = doc_id.astype(np.int64).view(np.uint64), copy.astype(np.int64).view(np.uint64)
    return (mix64(d * MULT_A + mix64(c + MULT_B)), mix64(mix64(d ^ MULT_B) + c * MULT_A))


def _slot(h: np.ndarray, g: np.ndarray, seed: np.ndarray, n: int) -> np.ndarray:
    return (mix64(h + seed.astype(np.uint64) * MULT_B ^ g) % np.uint64(n)).astype(np.int64)


def build_hash(h: np.ndarray, g: np.ndarray) -> np.ndarray:
    """Displacement seeds of a minimal perfect hash of distinct keys: one for
    each group; a seed < 0 names the slot -1 - seed of a group of one."""
    n = len(h)
    groups = -(-n // GROUP_KEYS)
    own = ((g >> np.uint64(32)) % np.uint64(groups)).astype(np.int64)
    seeds = np.zeros(groups, np.int32)
    free = np.ones(n, bool)
    order = np.argsort(own, kind="stable")
    begin = np.searchsorted(own[order], np.arange(groups + 1))
    sizes = np.diff(begin)
    for grp in np.argsort(-sizes, kind="stable"):
        m = sizes[grp]
        if m < 2:
            break
        keys = order[begin[grp]:begin[grp + 1]]
        seed = 0
        while True:
            tried = np.arange(seed, seed + 32)
            slots = _slot(h[keys][None, :], g[keys][None, :], tried[:, None], n)
            good = free[slots].all(axis=1)
            for t in np.flatnonzero(good):
                if len(np.unique(slots[t])) == m:
                    seeds[grp] = tried[t]
                    free[slots[t]] = False
                    break
            else:
                seed += 32
                continue
            break
    left = iter(np.flatnonzero(free))
    for grp in np.flatnonzero(sizes == 1):
        seeds[grp] = -1 - next(left)
    return seeds


def find_slots(seeds: np.ndarray, h: np.ndarray, g: np.ndarray, n: int) -> np.ndarray:
    own = ((g >> np.uint64(32)) % np.uint64(len(seeds))).astype(np.int64)
    seed = seeds[own].astype(np.int64)
    return np.where(seed < 0, -1 - seed, _slot(h, g, np.maximum(seed, 0), n))


def _build_bucket(pdf: pd.DataFrame) -> pd.DataFrame:
    h, g = key_hashes(pdf["doc_id"].to_numpy(), pdf["copy"].to_numpy())
    n = len(pdf)
    seeds = build_hash(h, g)
    row = np.empty(n, np.int64)
    row[find_slots(seeds, h, g, n)] = np.arange(n)

    def cells(x, kind):
        return np.ascontiguousarray(x[row].astype(kind)).tobytes()

    return pd.DataFrame([{
        "bucket": pdf["bucket"].iloc[0], "n": n, "seeds": seeds.astype("<i4").tobytes(),
        "prints": cells(g & np.uint64(0xFFFFFFFF), "<u4"),
        **{c: cells(pdf[c].to_numpy(), "<i8") for c in ("part", "seq", "at", "len", "start")}}])


def _lookup_bucket(keys: pd.DataFrame, index: pd.DataFrame) -> pd.DataFrame:
    cols = ["doc_id", "copy", "part", "seq", "at", "len", "start"]
    if not len(keys) or not len(index):
        return pd.DataFrame(columns=cols)
    row = index.iloc[0]
    h, g = key_hashes(keys["doc_id"].to_numpy(), keys["copy"].to_numpy())
    slot = find_slots(np.frombuffer(row["seeds"], "<i4"), h, g, int(row["n"]))
    hit = np.frombuffer(row["prints"], "<u4")[slot] == (g & np.uint64(0xFFFFFFFF)).astype(np.uint32)
    out = {"doc_id": keys["doc_id"].to_numpy(), "copy": keys["copy"].to_numpy()}
    out |= {c: np.frombuffer(row[c], "<i8")[slot] for c in cols[2:]}
    return pd.DataFrame(out)[hit]


def _keyed(df: DataFrame) -> DataFrame:
    """Keys without nulls: copy c of the null doc_id is copy -1 - c of 0."""
    missing = F.col("doc_id").isNull()
    return df.withColumns({"copy": F.when(missing, -1 - F.col("copy")).otherwise(F.col("copy")),
                           "doc_id": F.coalesce("doc_id", F.lit(0)).cast("long")})


def _with_bucket(df: DataFrame, buckets: int) -> DataFrame:
    return df.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "copy"), F.lit(buckets)))


def write_token_files(docs: DataFrame, path: str, spec: str, end_id: int = 1) -> int:
    """Write the ids of every text (null: empty), each followed by ``end_id``,
    in ascending doc_id order, and the index. Returns the number of buckets.

    Rows of equal doc_id are ordered by their text and numbered as copies; a
    null doc_id comes first and has copies like any other; other columns are
    ignored; an empty table gives empty files.
    """
    spark = docs.sparkSession
    ordered = (docs.select("doc_id", full_text().alias("_t"))
               .repartitionByRange("doc_id").sortWithinPartitions("doc_id", "_t"))
    (ordered.mapInArrow(lambda it: _shard_rows(it, spec, end_id), SHARDS)
     .write.option("compression", "zstd").parquet(f"{path}/shards"))
    shards = spark.read.schema(SHARDS).parquet(f"{path}/shards").select("part", "seq", "docs", "copies", "lens")
    sizes = shards.select("part", "seq", F.aggregate("lens", F.lit(0).cast("long"), lambda a, x: a + x).alias("n"))
    # starts: prefix sums over tasks (one row each), then over the shards of a task
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    tasks = (sizes.groupBy("part").agg(F.sum("n").alias("n"))
             .select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first")))
    own = Window.partitionBy("part").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    bases = sizes.join(tasks, "part").select(
        "part", "seq", (F.col("first") + F.coalesce(F.sum("n").over(own), F.lit(0))).alias("base"))
    rows = (shards.select("part", "seq", F.posexplode(F.arrays_zip("docs", "copies", "lens")).alias("ord", "x"))
            .select("part", "seq", "ord", F.col("x.docs").alias("doc_id"), F.col("x.copies").alias("copy"),
                    F.col("x.lens").alias("len")))
    # a shard's rows are at most SHARD_TOKENS + 1, as every document has an id
    up = Window.partitionBy("part", "seq").orderBy("ord").rowsBetween(Window.unboundedPreceding, -1)
    entries = (rows.withColumn("at", F.coalesce(F.sum("len").over(up), F.lit(0)))
               .join(bases, ["part", "seq"])
               .withColumn("start", F.col("base") + F.col("at")))
    n = shards.agg(F.sum(F.size("docs"))).first()[0] or 0
    buckets = max(1, -(-n // BUCKET_KEYS))
    (_with_bucket(_keyed(entries).select("doc_id", "copy", "part", "seq", "at", "len", "start"), buckets)
     .groupBy("bucket").applyInPandas(_build_bucket, INDEX)
     .withColumn("buckets", F.lit(buckets))
     .write.parquet(f"{path}/index"))
    return buckets


def _index(spark: SparkSession, path: str) -> tuple[DataFrame, int]:
    index = spark.read.schema(INDEX + ", buckets int").parquet(f"{path}/index")
    first = index.select("buckets").first()
    return index.drop("buckets"), first[0] if first else 1


def find_documents(spark: SparkSession, path: str, keys: DataFrame) -> DataFrame:
    """(doc_id, copy, part, seq, at, len, start) of those of ``keys`` (doc_id,
    copy) that the index holds (up to a fingerprint match in 2**32)."""
    index, buckets = _index(spark, path)
    keys = _with_bucket(_keyed(keys.select(F.col("doc_id").cast("long"), F.col("copy").cast("long"))), buckets)
    found = keys.groupBy("bucket").cogroup(index.groupBy("bucket")).applyInPandas(
        _lookup_bucket, "doc_id long, copy long, part int, seq int, at long, len long, start long")
    missing = F.col("copy") < 0
    return found.withColumns({"doc_id": F.when(~missing, F.col("doc_id")),
                              "copy": F.when(missing, -1 - F.col("copy")).otherwise(F.col("copy"))})


def read_document(spark: SparkSession, path: str, doc_id: int | None, copy: int = 0) -> np.ndarray | None:
    """The ids of one document: one index row and one shard are read."""
    index, buckets = _index(spark, path)
    key = _with_bucket(_keyed(spark.createDataFrame([(doc_id, copy)], "doc_id long, copy long")), buckets).toPandas()
    rows = index.where(F.col("bucket") == int(key["bucket"][0])).toPandas()
    found = _lookup_bucket(key, rows)
    if not len(found):
        return None
    f = found.iloc[0]
    shard = (spark.read.schema(SHARDS).parquet(f"{path}/shards")
             .where((F.col("part") == int(f["part"])) & (F.col("seq") == int(f["seq"]))).select("ids").first())
    return np.frombuffer(shard[0], "<u4", count=int(f["len"]), offset=4 * int(f["at"]))


def _shard_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for r in range(batch.num_rows):
            one = batch.slice(r, 1)
            lens = one.column("lens").values.to_numpy()[one.column("lens").offsets[0].as_py():][:len(one.column("lens")[0])]
            ids = one.column("ids")[0].as_buffer()
            at = np.cumsum(lens, dtype=np.int64) - lens
            crc = [zlib.crc32(ids[4 * int(a):4 * int(a + n)]) for a, n in zip(at, lens)]
            m = len(lens)
            yield pa.RecordBatch.from_arrays([
                pa.array(np.full(m, one.column("part")[0].as_py(), np.int32)),
                pa.array(np.full(m, one.column("seq")[0].as_py(), np.int32)),
                pa.array(at), pa.array(crc, pa.int64())], names=["part", "seq", "at", "crc"])


def read_checksums(spark: SparkSession, path: str) -> DataFrame:
    """Per stored document, found through the index: doc_id, copy, start,
    n_tokens, ids_crc32 (of its raw bytes in the shard). One scan of the
    payloads without a shuffle of them."""
    shards = spark.read.schema(SHARDS).parquet(f"{path}/shards")
    keys = (shards.select(F.explode(F.arrays_zip("docs", "copies")).alias("x"))
            .select(F.col("x.docs").alias("doc_id"), F.col("x.copies").alias("copy")))
    sums = shards.select("part", "seq", "lens", "ids").mapInArrow(
        _shard_sums, "part int, seq int, at long, crc long")
    return (find_documents(spark, path, keys).join(sums, ["part", "seq", "at"])
            .select("doc_id", "copy", "start", F.col("len").alias("n_tokens"), F.col("crc").alias("ids_crc32")))
