"""Exact removal of long repeated byte strings (suffix-array dedup by prefix doubling).

The order of suffixes is never needed, only which positions share a prefix of
``length`` bytes. Prefix doubling finds that by ranking positions on growing
prefixes and dropping those whose rank is unique. Here ranks are 64-bit names
(fingerprints) that are equal exactly when the strings are, so a pair of ranks
at an offset is formed where the text is, and Spark's shuffles only rerank:

1. ``GRAM`` bytes. Of the positions of a text only anchors are ranked: for
   each window of ``length`` bytes the position of its smallest gram name
   (leftmost on ties). Equal windows choose the same anchor, so a window whose
   anchor's gram is unique cannot repeat, and is dropped.
2. The run of consecutive windows that share an anchor (up to 2 * length
   bytes). If a run's name occurs twice, all its windows repeat: the inside of
   long copies ends here with one row per ~170 bytes.
3. ``length`` bytes. For the rest (the edges of copies) the bytes around an
   anchor go to the task of its class, where each window is ranked by the pair
   of names of its two halves (position p and p + length/2).

A class (anchors of one gram) with more than ``max_class`` members is dealt
over several tasks, whose distinct windows meet in a second aggregation.

Texts are named by two content hashes: copies of a text share all rows. A text
that occurs twice is repeated as a whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from demandspark.llm.arrays import (MULT_A, MULT_B, as_long, byte_column, mix64, powers)
from demandspark.llm.common import content_key, full_text, materialize

LENGTH = 400
GRAM = 64
PIECE = 1 << 19          # windows of a text handled at once: bounds memory for very long texts
MAX_CLASS = 8000         # anchors of a class in one task
SALTS = 64               # parts into which the rows of a gram or run are dealt for a join (one bit each)
INVERSE_A = np.uint64(pow(int(MULT_A), -1, 1 << 64))
MULT_C = np.uint64(0xD6E8FEB86659FD93)   # fixed value: second polynomial
INVERSE_C = np.uint64(pow(int(MULT_C), -1, 1 << 64))
POS_MASK = np.uint64((1 << 20) - 1)

ANCHORS = "k1 long, k2 long, first int, n int, at int, gram long, run long"
_TABLES: dict[str, np.ndarray] = {}


def _powers(name: str, mult: np.uint64, n: int) -> np.ndarray:
    if len(_TABLES.get(name, ())) < n:
        _TABLES[name] = powers(mult, n)
    return _TABLES[name]


class _Names:
    """Names of substrings of a byte array (prefix sums of a polynomial modulo 2**64)."""

    def __init__(self, data: np.ndarray, mult: np.uint64 = MULT_A, inverse: np.uint64 = INVERSE_A):
        n = len(data)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * _powers(f"m{mult}", mult, n)[:n],
                  out=self.sums[1:])
        self.inverse = _powers(f"i{inverse}", inverse, n + 1)

    def at(self, start: np.ndarray, length) -> np.ndarray:
        return mix64((self.sums[start + length] - self.sums[start]) * self.inverse[start])


def _anchors(text: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """(first, n, at, gram, run) of the runs of windows with one anchor.

    first: start of the first window, n: how many windows, at: the anchor."""
    out = []
    gram = min(GRAM, length)
    width = length - gram + 1
    for base in range(0, len(text) - length + 1, PIECE):
        piece = text[base:base + PIECE + length - 1]
        names = _Names(piece)
        grams = names.at(np.arange(len(piece) - gram + 1), gram)
        order = (grams & ~POS_MASK) | np.arange(len(grams), dtype=np.uint64)
        blocks = -(-len(order) // width)
        padded = np.full(blocks * width, np.iinfo(np.uint64).max, np.uint64)
        padded[:len(order)] = order
        padded = padded.reshape(blocks, width)
        ahead = np.minimum.accumulate(padded, axis=1).ravel()
        behind = np.minimum.accumulate(padded[:, ::-1], axis=1)[:, ::-1].ravel()
        count = len(piece) - length + 1
        least = np.minimum(behind[:count], ahead[width - 1:width - 1 + count])
        first = np.flatnonzero(np.concatenate([[True], least[1:] != least[:-1]]))
        n = np.diff(np.append(first, count))
        at = (least[first] & POS_MASK).astype(np.int64)
        span = n + length - 1
        run = mix64(names.at(first, span) + span.astype(np.uint64) * MULT_B
                    + (at - first).astype(np.uint64) * MULT_C)
        out.append((first + base, n, at + base, grams[at], run))
    return tuple(np.concatenate(x) for x in zip(*out))


def _anchor_rows(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    seen: set[tuple[int, int]] = set()
    for batch in batches:
        data, offs = byte_column(batch.column("_t"))
        k1, k2 = (batch.column(c).to_numpy() for c in ("k1", "k2"))
        rows, size = [], 0

        def flush():
            cols = [np.concatenate(c) for c in zip(*rows)]
            return pa.RecordBatch.from_arrays(
                [pa.array(cols[0]), pa.array(cols[1]),
                 *(pa.array(c.astype(np.int32)) for c in cols[2:5]),
                 as_long(cols[5]), as_long(cols[6])],
                names=["k1", "k2", "first", "n", "at", "gram", "run"])

        for i in range(batch.num_rows):
            key = (int(k1[i]), int(k2[i]))
            if key in seen:
                continue
            seen.add(key)
            found = _anchors(data[offs[i]:offs[i + 1]], length)
            m = len(found[0])
            rows.append((np.full(m, key[0]), np.full(m, key[1]), *found))
            size += m
            if size > 200_000:
                yield flush()
                rows, size = [], 0
        if rows:
            yield flush()


def _context_rows(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """Bytes around each listed anchor of a text."""
    for batch in batches:
        data, offs = byte_column(batch.column("_t"))
        k1, k2 = (batch.column(c).to_numpy() for c in ("k1", "k2"))
        tasks = batch.column("tasks").to_pylist()
        cols: dict[str, list] = {c: [] for c in ("gram", "salt", "split", "k1", "k2", "first", "known", "bytes")}
        size = 0
        for i in range(batch.num_rows):
            for t in tasks[i]:
                lo = int(offs[i]) + t["first"]
                piece = data[lo:lo + t["n"] + length - 1].tobytes()
                for c, v in zip(cols, (t["gram"], t["salt"], t["split"], k1[i], k2[i], t["first"],
                                       t["known"], piece)):
                    cols[c].append(v)
                size += len(piece)
            if size > 4 << 20:
                yield _context_batch(cols)
                cols, size = {c: [] for c in cols}, 0
        if cols["gram"]:
            yield _context_batch(cols)


def _context_batch(cols: dict[str, list]) -> pa.RecordBatch:
    kinds = {"gram": pa.int64(), "salt": pa.int32(), "split": pa.bool_(), "k1": pa.int64(),
             "k2": pa.int64(), "first": pa.int32(), "known": pa.bool_(), "bytes": pa.binary()}
    return pa.RecordBatch.from_arrays([pa.array(v, kinds[c]) for c, v in cols.items()],
                                      names=list(cols))


def _rank_windows(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """Windows of whole (gram, salt) groups, sorted by group: one row for each
    maximal run of repeated windows (n > 0), and for split classes one row for
    each window that still has to meet other tasks (n = 0)."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        whole = pa.Table.from_batches(held).combine_chunks()
        gram, salt = whole["gram"].to_numpy(), whole["salt"].to_numpy()
        new = np.flatnonzero((gram[1:] != gram[:-1]) | (salt[1:] != salt[:-1]))
        if len(new) and whole.nbytes > 2 << 20:
            cut = int(new[-1]) + 1
            yield from _rank_groups(whole.slice(0, cut), length)
            held = whole.slice(cut).combine_chunks().to_batches()
    if held:
        yield from _rank_groups(pa.Table.from_batches(held).combine_chunks(), length)


def _rank_groups(table: pa.Table, length: int) -> Iterator[pa.RecordBatch]:
    gram, salt = table["gram"].to_numpy(), table["salt"].to_numpy()
    bounds = np.concatenate([[0], np.flatnonzero((gram[1:] != gram[:-1]) | (salt[1:] != salt[:-1])) + 1,
                             [len(gram)]])
    data, offs = byte_column(table["bytes"])
    start = 0
    while start < len(bounds) - 1:   # some whole groups at a time
        end = int(np.searchsorted(offs[bounds], offs[bounds[start]] + (1 << 20), side="right")) - 1
        end = min(max(end, start + 1), len(bounds) - 1)
        yield _rank_rows(table.slice(bounds[start], bounds[end] - bounds[start]),
                         data, offs[bounds[start]:bounds[end] + 1], length)
        start = end


def _rank_rows(table: pa.Table, data: np.ndarray, offs: np.ndarray, length: int) -> pa.RecordBatch:
    half = length // 2
    base = offs[0]
    piece = data[base:offs[-1]]
    n = np.diff(offs) - length + 1
    row = np.repeat(np.arange(len(n)), n)
    shift = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
    at = np.repeat(offs[:-1] - base, n) + shift
    one, two = _Names(piece), _Names(piece, MULT_C, INVERSE_C)
    # ranks of the two halves, at p and p + half
    left, right = one.at(at, half), two.at(at + half, length - half)
    order = np.lexsort((right, left))
    same = (left[order][1:] == left[order][:-1]) & (right[order][1:] == right[order][:-1])
    group = np.concatenate([[0], np.cumsum(~same)])
    known = table["known"].to_numpy(zero_copy_only=False)
    # a known run has an equal run elsewhere: it counts as two
    weight = np.bincount(group, weights=np.where(known[row[order]], 2, 1))
    times = np.empty(len(row))
    times[order] = weight[group]
    hit = times >= 2
    own = ~known[row]
    k1, k2, first = (table[c].to_numpy() for c in ("k1", "k2", "first"))
    begins, ends = _true_runs(hit & own, row)
    split = table["split"].to_numpy(zero_copy_only=False)
    open_ = np.zeros(len(row), bool)
    if split.any():  # each distinct window of a split class once
        leader = order[np.concatenate([[True], ~same])]
        open_[leader[split[row[leader]]]] = True
    w = np.flatnonzero(open_)
    take = np.concatenate([row[begins], row[w]])
    return pa.RecordBatch.from_arrays([
        pa.array(k1[take]), pa.array(k2[take]),
        pa.array((first[take] + np.concatenate([shift[begins], shift[w]])).astype(np.int32)),
        pa.array(np.concatenate([ends - begins, np.zeros(len(w), np.int64)]).astype(np.int32)),
        as_long(np.concatenate([np.zeros(len(begins), np.uint64), left[w]])),
        as_long(np.concatenate([np.zeros(len(begins), np.uint64), right[w]])),
        pa.array(np.concatenate([np.zeros(len(begins), bool), hit[w] | known[row[w]]])),
    ], names=["k1", "k2", "first", "n", "left", "right", "settled"])


def _true_runs(mask: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Runs of True that stay within one row."""
    if not len(mask):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    joined = np.zeros(len(mask), bool)
    joined[1:] = mask[1:] & mask[:-1] & (row[1:] == row[:-1])
    begins = np.flatnonzero(mask & ~joined)
    last = mask.copy()
    last[:-1] &= ~joined[1:]
    return begins, np.flatnonzero(last) + 1


def _remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, offs = byte_column(batch.column("_t"))
        copied = batch.column("copied").to_numpy(zero_copy_only=False)
        lists = batch.column("spans")
        at, values = lists.offsets.to_numpy(), lists.values
        starts, ends = values.field("s").to_numpy(), values.field("e").to_numpy()
        present = lists.is_valid().to_numpy(zero_copy_only=False)
        kept, removed, spans = [], [], []
        for i in range(batch.num_rows):
            text = data[offs[i]:offs[i + 1]]
            if copied[i]:
                kept.append(b"")
                removed.append(len(text))
                spans.append(1)
                continue
            if not present[i]:
                kept.append(text.tobytes())
                removed.append(0)
                spans.append(0)
                continue
            s, e = starts[at[i]:at[i + 1]], ends[at[i]:at[i + 1]]
            mark = np.zeros(len(text) + 1, np.int32)
            np.add.at(mark, s, 1)
            np.add.at(mark, e, -1)
            gone = np.cumsum(mark)[:-1] > 0
            kept.append(text[~gone].tobytes())
            removed.append(int(gone.sum()))
            spans.append(int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum()))
        yield pa.RecordBatch.from_arrays([
            batch.column("doc_id"), pa.array([len(x) + y for x, y in zip(kept, removed)], pa.int64()),
            pa.array(removed, pa.int64()), pa.array(spans, pa.int64()), pa.array(kept, pa.binary())],
            names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept"])


def _salt(*cols: str) -> Column:
    return F.pmod(F.xxhash64(*cols), F.lit(SALTS)).cast("int")


def _held_salts() -> Column:
    """The salts of a group's rows, as bits: merged map-side like any sum."""
    return F.expr("bit_or(shiftleft(1L, _salt))").alias("_salts")


def _per_salt(groups: DataFrame) -> DataFrame:
    """A row of each group for every salt that its rows hold, in place of ``_salts``:
    a join on it and ``_salt`` spreads a hot group, and one of few rows stays of few rows."""
    salts = F.filter(F.sequence(F.lit(0), F.lit(SALTS - 1)), lambda s: F.getbit(F.col("_salts"), s) == 1)
    return groups.withColumn("_salt", F.explode(salts)).drop("_salts")


def repeated_spans(docs: DataFrame, length: int = LENGTH, max_class: int = MAX_CLASS) -> DataFrame:
    """(k1, k2, copied, spans): for each text, named by its content hashes, the
    byte ranges [s, e) covered by ``length``-byte strings that start elsewhere
    too; ``copied`` if the whole text occurs more than once (spans may then be
    null). Texts without any have no row."""
    base = docs.select(full_text().alias("_t")).select("_t", *content_key(F.col("_t")))
    long_ = base.where(F.octet_length("_t") >= length)
    anchors = materialize(
        long_.mapInArrow(lambda it: _anchor_rows(it, length), ANCHORS), "anchors")
    copies = (long_.groupBy("k1", "k2").agg(F.count(F.lit(1)).alias("_c")).where("_c > 1")
              .select("k1", "k2", F.lit(True).alias("copied")))

    # rank on GRAM bytes: positions with a unique rank leave
    anchors = anchors.withColumn("_salt", _salt("k1", "first"))
    grams = (anchors.groupBy("gram")
             .agg(F.count(F.lit(1)).alias("members"), F.min("run").alias("_lo"), F.max("run").alias("_hi"), _held_salts())
             .where("members > 1")
             .select("gram", "members", (F.col("_lo") == F.col("_hi")).alias("uniform"), "_salts"))
    left = materialize(anchors.join(_per_salt(grams), ["gram", "_salt"]), "classes")

    # rank on whole runs of windows
    mixed = left.where(~F.col("uniform"))
    runs = (mixed.groupBy("gram", "run")
            .agg(F.count(F.lit(1)).alias("times"), F.max("members").alias("members"),
                 F.min(F.struct("k1", "k2", "first", "n")).alias("one"), _held_salts()))
    runs = materialize(runs, "runs")
    again = mixed.join(_per_salt(runs.where("times > 1").select("gram", "run", "_salts")),
                       ["gram", "run", "_salt"], "left_semi")
    covered = left.where("uniform").select("k1", "k2", "first", "n").unionByName(
        again.select("k1", "k2", "first", "n"))

    # rank on `length` bytes: classes that hold a run found once
    runs = runs.drop("_salts").withColumn("_salt", _salt("run"))
    open_ = _per_salt(runs.groupBy("gram").agg(F.max(F.col("times") == 1).alias("_o"), _held_salts())
                      .where("_o").select("gram", "_salts"))
    parts = F.ceil(F.col("members") / max_class).cast("int")
    tasks = (runs.join(open_, ["gram", "_salt"], "left_semi")
             .select("one.k1", "one.k2", F.struct(
                 "gram", (F.pmod(F.xxhash64("run"), parts)).cast("int").alias("salt"),
                 (parts > 1).alias("split"), F.col("one.first").alias("first"),
                 F.col("one.n").alias("n"), (F.col("times") > 1).alias("known")).alias("t"))
             .groupBy("k1", "k2").agg(F.collect_list("t").alias("tasks")))
    context = (long_.join(tasks, ["k1", "k2"])
               .mapInArrow(lambda it: _context_rows(it, length),
                           "gram long, salt int, split boolean, k1 long, k2 long, first int, "
                           "known boolean, bytes binary"))
    ranked = materialize(
        context.repartition("gram", "salt").sortWithinPartitions("gram", "salt")
        .mapInArrow(lambda it: _rank_windows(it, length),
                    "k1 long, k2 long, first int, n int, left long, right long, settled boolean"),
        "windows")
    # windows of split classes meet those of the other tasks
    pending = ranked.where("n = 0")
    twice = (pending.groupBy("left", "right").agg(F.count(F.lit(1)).alias("_c"), F.max("settled").alias("_s"))
             .where("_c > 1 or _s").select("left", "right"))
    met = pending.join(twice, ["left", "right"], "left_semi").select(
        "k1", "k2", "first", F.lit(1).alias("n"))
    covered = covered.unionByName(ranked.where("n > 0").select("k1", "k2", "first", "n")).unionByName(met)
    spans = (covered.distinct()
             .groupBy("k1", "k2")
             .agg(F.collect_list(F.struct(F.col("first").alias("s"),
                                          (F.col("first") + F.col("n") + length - 1).alias("e"))).alias("spans")))
    return (copies.join(spans, ["k1", "k2"], "full")
            .select("k1", "k2", F.coalesce("copied", F.lit(False)).alias("copied"), "spans"))


def remove_repeats(docs: DataFrame, length: int = LENGTH, max_class: int = MAX_CLASS) -> DataFrame:
    """Remove each byte covered by a ``length``-byte string that also starts
    anywhere else in ``docs``, in the same text or another.

    docs: doc_id, text (other columns are ignored). Returns one row per input
    row: doc_id, n_bytes, n_removed, n_spans (maximal removed runs), kept (the
    remaining UTF-8 bytes). Strings are judged on the input and may overlap. A
    null text is empty; texts shorter than ``length`` keep all bytes; repeated
    rows and equal doc_ids are rows of their own; a null doc_id is kept. The
    cut may fall inside a UTF-8 sequence, so ``kept`` is binary.
    """
    if length < 2:
        raise ValueError("length must be 2 bytes at least")
    spans = repeated_spans(docs, length, max_class)
    base = (docs.select("doc_id", full_text().alias("_t"))
            .select("doc_id", "_t", *content_key(F.col("_t"))))
    found = base.join(spans, ["k1", "k2"], "left").select(
        "doc_id", "_t", F.coalesce("copied", F.lit(False)).alias("copied"), "spans")
    return found.mapInArrow(_remove, "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary")
