"""Shuffling, exact-size sampling, K-fold assignment, chunks and hold-out.

Exact operators need a global order; they use the distributed numbering of
``sources.ids`` (range-partitioned sort + partition offsets) and plain
arithmetic, never a single-partition window. Hash folds need no order at all
and are the scalable default.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

from demandspark.operators.joins import with_constants
from demandspark.session import shared_dir
from demandspark.sources.ids import with_consecutive_id
from demandspark.sources.io import write_parquet

DEFAULT_SEED = 47
CV_SEED = 451
HOLDOUT_SEED = 1729
PREFIX_BITS = 16   # hash prefixes that the exact sample counts


def hash_order(id_col: str = "row_id", seed: int = DEFAULT_SEED) -> Column:
    """A reproducible pseudo-random order key (same rows, same order, any run)."""
    return F.xxhash64(F.col(id_col), F.lit(seed))


def ntile_of(pos: Column, n: Column, k: int) -> Column:
    """ntile(k) of 1-based position ``pos`` among ``n`` rows: the first n mod k
    tiles hold one extra row (the same sizes as numpy.array_split / KFold)."""
    q = F.floor(n / k)
    r = n - q * k
    big = r * (q + 1)
    idx = F.when(pos <= big, F.floor((pos - 1) / (q + 1))) \
           .otherwise(r + F.floor((pos - 1 - big) / F.greatest(q, F.lit(1))))
    return (idx + 1).cast("int")


def with_position(df: DataFrame, order: list, name: str = "_pos") -> DataFrame:
    return with_consecutive_id(df, order, name=name)


def exact_folds(df: DataFrame, k: int, order: list | None = None, shuffle: bool = False,
                seed: int = CV_SEED, id_col: str = "row_id", name: str = "fold") -> DataFrame:
    """Contiguous folds 1..k over ``order`` (or over a seeded shuffle)."""
    if order is None:
        order = [hash_order(id_col, seed), F.col(id_col)] if shuffle else [F.col(id_col)]
    pos = with_position(df, order)
    n = pos.agg(F.count(F.lit(1)).alias("_n"))
    return (with_constants(pos, n)
            .withColumn(name, ntile_of(F.col("_pos"), F.col("_n"), k))
            .drop("_pos", "_n"))


def hash_folds(df: DataFrame, k: int, seed: int = CV_SEED, id_col: str = "row_id",
               name: str = "fold") -> DataFrame:
    """Folds 1..k from a seeded hash of the id: no sort, no shuffle."""
    return df.withColumn(name, (F.pmod(hash_order(id_col, seed), F.lit(k)) + 1).cast("int"))


def chunk_ids(df: DataFrame, n_chunks: int, order: list | None = None,
              id_col: str = "row_id", name: str = "chunk_id") -> DataFrame:
    """Equal consecutive chunks 0..n_chunks-1 of ceil(n / n_chunks) rows in file order."""
    pos = with_position(df, order or [F.col(id_col)])
    n = pos.agg(F.count(F.lit(1)).alias("_n"))
    size = F.ceil(F.col("_n") / F.lit(n_chunks))
    return (with_constants(pos, n)
            .withColumn(name, F.floor((F.col("_pos") - 1) / size).cast("int"))
            .drop("_pos", "_n"))


def split_parts(df: DataFrame, n_parts: int, id_col: str = "row_id",
                name: str = "part") -> list[DataFrame]:
    """array_split into ``n_parts`` consecutive parts (sizes differ by <= 1). The
    tagged rows are written once, a folder per part, so each part reads its own files."""
    tagged = exact_folds(df, n_parts, order=[F.col(id_col)], name=name)
    path = write_parquet(tagged, shared_dir(df.sparkSession, "parts"), [name])
    rows = df.sparkSession.read.schema(tagged.schema).parquet(path).select(*tagged.columns)
    return [rows.where(F.col(name) == i) for i in range(1, n_parts + 1)]


def union_parts(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def shuffle_rows(df: DataFrame, seed: int = DEFAULT_SEED, id_col: str = "row_id",
                 name: str = "shuffled_pos") -> DataFrame:
    """A reproducible random permutation: rows in a new order, each with its position.

    One scan counts rows per hash prefix (at most 2^PREFIX_BITS counts). The whole rows are then shuffled once, dealt
    by ranges of the prefix, and numbered within each prefix, so no sorted copy of them is written in between."""
    order, prefix = hash_order(id_col, seed), hash_prefix(id_col, seed)
    counts = df.groupBy(prefix.alias("_prefix")).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_prefix").rowsBetween(Window.unboundedPreceding, -1)
    # a fixed number of prefixes: broadcast is safe
    offsets = F.broadcast(counts.select("_prefix", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off")))
    within = F.row_number().over(Window.partitionBy("_prefix").orderBy(order, F.col(id_col)))
    dealt = df.withColumn("_prefix", prefix).repartitionByRange("_prefix").withColumn("_rank", within)
    return (dealt.join(offsets, "_prefix")
            .select(*df.columns, (F.col("_off") + F.col("_rank")).cast("long").alias(name)))


def exact_sample(df: DataFrame, n: int, seed: int = DEFAULT_SEED, id_col: str = "row_id") -> DataFrame:
    """Exactly ``n`` rows (or all, if fewer), uniformly at random and reproducible:
    the first ``n`` rows by a seeded hash, without a global sort.

    One scan counts rows per hash prefix (at most 2^PREFIX_BITS counts, merged
    map-side). The prefix in which the n-th row lies is the bound: rows below it
    all belong to the sample, rows above it none, and only those on it (about one
    in 2^PREFIX_BITS; more if ids repeat, as these hash alike) are sorted and
    written. The kept rows are filters on scans of ``df``, so ``df`` should be a
    written table."""
    if n <= 0:
        return df.where(F.lit(False))
    bound = prefix_bound(df, n, seed, id_col)
    if bound is None:
        return df
    order, prefix = hash_order(id_col, seed), hash_prefix(id_col, seed)
    on_bound = with_consecutive_id(df.where(prefix == bound.prefix), [order, F.col(id_col)], name="_rank")
    return (df.where(prefix < bound.prefix)
            .unionByName(on_bound.where(F.col("_rank") <= n - bound.below).drop("_rank")))


def hash_prefix(id_col: str = "row_id", seed: int = DEFAULT_SEED) -> Column:
    """The leading bits of the hash order (signed, so prefixes order as hashes do)."""
    return F.shiftright(hash_order(id_col, seed), 64 - PREFIX_BITS)


def prefix_bound(df: DataFrame, n: int, seed: int = DEFAULT_SEED, id_col: str = "row_id") -> Row | None:
    """(prefix, below) of the prefix that holds the n-th row and the number of
    rows before it; None if all rows are among the first ``n``. The window runs
    over the histogram, whose size is fixed."""
    counts = df.groupBy(hash_prefix(id_col, seed).alias("prefix")).agg(F.count(F.lit(1)).alias("_n"))
    upto = F.sum("_n").over(Window.orderBy("prefix").rowsBetween(Window.unboundedPreceding, 0))
    total = F.sum("_n").over(Window.partitionBy())
    return (counts.select("prefix", (upto - F.col("_n")).alias("below"), upto.alias("_upto"), total.alias("_total"))
            .where((F.col("_upto") >= n) & (F.col("below") < n) & (F.col("_total") > n))
            .select("prefix", "below").first())


def holdout_split(df: DataFrame, test_fraction: float = 0.2,
                  seed: int = HOLDOUT_SEED) -> tuple[DataFrame, DataFrame]:
    train, test = df.randomSplit([1.0 - test_fraction, test_fraction], seed=seed)
    return train, test
