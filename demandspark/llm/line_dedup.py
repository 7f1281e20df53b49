"""Removal of repeated line runs by prefix doubling over line-ID sequences.

Every line gets an ID (hash of its text). Positions are ranked on 1, 2, 4, ...
consecutive lines, and on the depths between: the rank of a longer run is the
pair of ranks at a position and at an offset behind it, formed by a join of the
positions left. A position whose rank is unique leaves, as no longer run from it
can repeat. The classes of equal ranks at a depth are the longest-common-prefix
intervals of at least that depth; each member but the first in document order
starts a later copy. A class counts if it is ``min_lines`` deep or its run holds
``min_words`` words. Runs that overlap or follow each other make up the maximal
repeated run, so repeats beyond ``min_lines`` need no further rounds.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandspark.llm.arrays import byte_column
from demandspark.llm.common import full_text, materialize

MIN_LINES = 3
# Fixed value: a word.
WORD = "[^\\x20\\x09-\\x0D]+"


def _repeated(ranks: DataFrame) -> DataFrame:
    """Positions (rid, i) whose pair (a, b) occurs twice or more, with the name of the pair."""
    twice = ranks.groupBy("a", "b").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select("a", "b")
    return ranks.join(twice, ["a", "b"], "left_semi")


def _half(depth: int) -> int:
    """The largest power of two below ``depth``: a run's first part; the rest is no longer."""
    return 1 << (depth - 1).bit_length() - 1


def _depths(min_lines: int, every: bool) -> list[int]:
    """The depths to rank: all, or the powers of two and the rests that make up ``min_lines``."""
    if every:
        return list(range(1, min_lines + 1))
    out, rest = {min_lines, 1}, min_lines
    while rest > 1:
        out |= {rest} | {1 << k for k in range(_half(rest).bit_length())}
        rest -= _half(rest)
    return sorted(out)


def _cut_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        names = [c for c in batch.schema.names if c not in ("_t", "starts")]
        data, offs = byte_column(batch.column("_t"))
        lists = batch.column("starts")
        at = lists.offsets.to_numpy()
        begins, sizes = (x.to_numpy() for x in lists.values.flatten())
        has = lists.is_valid().to_numpy(zero_copy_only=False)
        kept, n_lines, n_removed, n_runs = [], [], [], []
        for r in range(batch.num_rows):
            text = data[offs[r]:offs[r + 1]]
            breaks = np.flatnonzero(text == 10)
            begin = np.concatenate([[0], breaks + 1])
            n = len(begin)
            n_lines.append(n)
            if not has[r]:
                kept.append(text.tobytes())
                n_removed.append(0)
                n_runs.append(0)
                continue
            mark = np.zeros(n + 1, np.int64)
            own = begins[at[r]:at[r + 1]]
            np.add.at(mark, own, 1)
            np.add.at(mark, own + sizes[at[r]:at[r + 1]], -1)
            gone = np.cumsum(mark)[:-1] > 0
            end = np.concatenate([breaks, [len(text)]])
            kept.append(b"\n".join(text[b:e].tobytes() for b, e in zip(begin[~gone], end[~gone])))
            n_removed.append(int(gone.sum()))
            n_runs.append(int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum()))
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(c) for c in names), pa.array([k.decode() for k in kept], pa.string()),
             *(pa.array(x, pa.int64()) for x in (n_lines, n_removed, n_runs))],
            names=[*names, "_kept", "_n_lines", "_n_removed", "_n_runs"])


def dedup_lines(docs: DataFrame, min_lines: int = MIN_LINES, min_words: int | None = None) -> DataFrame:
    """Delete later copies of runs of ``min_lines`` or more equal lines, and of
    shorter runs that hold ``min_words`` words or more (None: none of these).

    docs: doc_id, text, and any other columns, which are kept. A line is what
    stands between line feeds (compared byte by byte), a word what stands
    between ASCII white space; a run that counts and also starts earlier
    (smaller doc_id, then row, then line; a null doc_id is the smallest) is
    deleted, whole longer runs with it. Returns the input's columns with the
    text cut (null stays null) and n_lines, n_removed, n_runs (maximal deleted
    runs); these three replace columns of that name. A document that is a later
    copy as a whole is left with an empty text. Repeated rows are documents of
    their own; an empty table gives no rows.
    """
    if min_lines < 1:
        raise ValueError("min_lines must be 1 at least")
    if min_words is not None and min_words < 1:
        raise ValueError("min_words must be 1 at least")
    columns = [c for c in docs.columns if c not in ("n_lines", "n_removed", "n_runs")]
    renamed = docs.select(*[F.col(c).alias(f"c_{c}") for c in columns])
    # one written copy: row numbers must be the same for every reader
    base = materialize(renamed.withColumn("rid", F.monotonically_increasing_id()), "rows")
    split = F.split(full_text("c_text"), "\n")
    none = F.lit(0).cast("long")
    ids = base.select(F.explode(F.transform(split, lambda x: F.xxhash64(x))).alias("a"))
    words = none if min_words is None else F.regexp_count("line", F.lit(WORD)).cast("long")
    lines = (base.select("rid", F.posexplode(split).alias("i", "line"))
             .select("rid", "i", F.xxhash64("line").alias("a"), none.alias("b"), words.alias("w")))
    # the words are counted on the side that keeps the positions only
    twice = ids.groupBy("a").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select("a")
    ranked = {1: materialize(lines.join(twice, "a", "left_semi"), "ranked-lines")}

    def named(depth: int) -> DataFrame:
        # lines are ranked by their ID, longer runs by the name of their pair
        name = F.col("a") if depth == 1 else F.xxhash64("a", "b")
        return ranked[depth].select("rid", "i", name.alias("a"), "w")

    for depth in _depths(min_lines, min_words is not None)[1:]:
        half = _half(depth)
        behind = named(depth - half).select("rid", (F.col("i") - half).alias("i"), F.col("a").alias("b"),
                                            F.col("w").alias("_w"))
        pairs = named(half).join(behind, ["rid", "i"]).select("rid", "i", "a", "b", (F.col("w") + F.col("_w")).alias("w"))
        ranked[depth] = materialize(_repeated(pairs), "ranked-lines")
    runs = ranked[min_lines].select("rid", "i", "a", "b", F.lit(min_lines).alias("n"))
    if min_words is not None:
        for depth in range(1, min_lines):
            runs = runs.unionByName(ranked[depth].where(F.col("w") >= min_words)
                                    .select("rid", "i", "a", "b", F.lit(depth).alias("n")))
    order = base.select("rid", F.col("c_doc_id").alias("doc"))
    placed = runs.join(order, "rid")
    # the one first position of a class stays; it is looked up by place, so a class's rows never meet in one task
    first = placed.groupBy("n", "a", "b").agg(F.min(F.struct("doc", "rid", "i")).alias("f"))
    later = (placed.join(first.select("n", "f.rid", "f.i"), ["n", "rid", "i"], "left_anti")
             .groupBy("rid").agg(F.collect_list(F.struct("i", "n")).alias("starts")))
    cut = base.withColumn("_t", full_text("c_text")).join(later, "rid", "left").drop("rid")
    keep = [f for f in cut.schema.fields if f.name not in ("_t", "starts")]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in keep)
    out = cut.mapInArrow(_cut_lines, f"{schema}, _kept string, _n_lines long, _n_removed long, _n_runs long")
    text = F.when(F.col("c_text").isNotNull(), F.col("_kept")).alias("text")
    return out.select(*[text if c == "text" else F.col(f"c_{c}").alias(c) for c in columns],
                      F.col("_n_lines").alias("n_lines"), F.col("_n_removed").alias("n_removed"),
                      F.col("_n_runs").alias("n_runs"))
