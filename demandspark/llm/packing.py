"""Best-fit packing of token sequences by minimum bin slack.

Texts become pieces of at most ``capacity`` tokens. Which lengths share a
sequence depends only on how many pieces there are of each length, a table of
at most ``capacity`` numbers, so the packing is planned on that table: the
longest piece left opens a sequence, a bitset subset-sum over the lengths
available finds the fullest combination that fits beside it, and the pattern is
repeated as often as the counts allow. Each round uses up a length, so the
plan's size depends on the capacity and not on the data. Spark then numbers the
pieces of each length and looks up their place in the plan.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from demandspark.llm.common import full_text, materialize
from demandspark.llm.tokens import encoded_slices

CAPACITY = 2048
PIECES = "doc_id long, piece int, start long, length int, ids_crc32 long, task int, ord long"


def _pieces(batches: Iterator[pa.RecordBatch], spec: str, capacity: int, end_id: int) -> Iterator[pa.RecordBatch]:
    """Pieces of each text; ord numbers the pieces of a length within this task."""
    task = TaskContext.get().partitionId()
    seen = np.zeros(capacity + 1, np.int64)
    tail = np.array([end_id], "<u4").tobytes()
    for batch in batches:
        doc = batch.column("doc_id").to_pylist()
        for i, j, ids, offs in encoded_slices(batch, "_t", spec):
            cols: list[list] = [[] for _ in range(7)]
            for k in range(i, j):
                raw = ids[offs[k - i]:offs[k - i + 1]].astype("<u4").tobytes() + tail
                n = len(raw) // 4
                for p in range(0, n, capacity):
                    size = min(capacity, n - p)
                    row = (doc[k], p // capacity, p, size, zlib.crc32(raw[4 * p:4 * (p + size)]), task,
                           int(seen[size]))
                    seen[size] += 1
                    for c, v in zip(cols, row):
                        c.append(v)
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(cols, kinds)],
                names=["doc_id", "piece", "start", "length", "ids_crc32", "task", "ord"])


def fullest(counts: dict[int, int], room: int) -> dict[int, int]:
    """The multiset of available lengths with the largest sum <= room (longer lengths first).

    Bit s of a set says that some combination sums to s."""
    reach = 1
    full = (1 << (room + 1)) - 1
    steps = []
    for size in sorted((s for s in counts if s <= room), reverse=True):
        steps.append((size, reach))
        left, part = min(counts[size], room // size), 1
        while left > 0:  # 1, 2, 4, ... copies: every number up to the count
            take = min(part, left)
            reach |= (reach << (size * take)) & full
            left, part = left - take, part * 2
        if reach >> room & 1:
            break
    total = reach.bit_length() - 1
    used: dict[int, int] = {}
    for size, before in reversed(steps):
        while not before >> total & 1:
            total -= size
            used[size] = used.get(size, 0) + 1
    return used


def plan(counts: dict[int, int], capacity: int) -> list[tuple[list[int], int]]:
    """[(lengths of a sequence, how many such sequences)] by minimum bin slack."""
    left = {s: n for s, n in counts.items() if n > 0}
    out = []
    while left:
        top = max(left)
        rest = dict(left)
        rest[top] -= 1
        used = fullest({s: n for s, n in rest.items() if n > 0}, capacity - top)
        used[top] = used.get(top, 0) + 1
        times = min(left[s] // m for s, m in used.items())
        out.append(([s for s, m in sorted(used.items(), reverse=True) for _ in range(m)], times))
        for s, m in used.items():
            left[s] -= m * times
            if not left[s]:
                del left[s]
    return out


def _places(patterns: list[tuple[list[int], int]]) -> np.ndarray:
    """Rows (length, first rank, first sequence, offset), sorted: the pieces of a
    length from that rank on go to consecutive sequences at that offset."""
    rank: dict[int, int] = {}
    rows, sequence = [], 0
    for sizes, times in patterns:
        offset = 0
        for s in sizes:
            rows.append((s, rank.get(s, 0), sequence, offset))
            rank[s] = rank.get(s, 0) + times
            offset += s
        sequence += times
    return np.array(sorted(rows), np.int64).reshape(-1, 4)


def _assign(batches: Iterator[pa.RecordBatch], places: np.ndarray) -> Iterator[pa.RecordBatch]:
    lengths = np.unique(places[:, 0]) if len(places) else np.zeros(0, np.int64)
    bounds = np.searchsorted(places[:, 0], lengths)
    for batch in batches:
        size = batch.column("length").to_numpy().astype(np.int64)
        rank = batch.column("rank").to_numpy()
        at = np.empty(len(size), np.int64)
        for s in np.unique(size):
            i = int(np.searchsorted(lengths, s))
            lo = bounds[i]
            hi = bounds[i + 1] if i + 1 < len(bounds) else len(places)
            own = np.flatnonzero(size == s)
            at[own] = lo + np.searchsorted(places[lo:hi, 1], rank[own], side="right") - 1
        p = places[at] if len(at) else np.zeros((0, 4), np.int64)
        keep = ["doc_id", "piece", "start", "length", "ids_crc32"]
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(c) for c in keep), pa.array(p[:, 2] + rank - p[:, 1]), pa.array(p[:, 3])],
            names=[*keep, "sequence_id", "offset"])


def pack_documents(docs: DataFrame, spec: str, capacity: int = CAPACITY, end_id: int = 0) -> DataFrame:
    """Pack all texts into as few sequences of at most ``capacity`` tokens as
    minimum bin slack finds.

    docs: doc_id, text (null: empty; other columns are ignored). A document is
    its ids and ``end_id``; one longer than ``capacity`` is cut into pieces of
    ``capacity`` and a last, shorter one. Returns per piece: doc_id, piece,
    start, length, ids_crc32, sequence_id, offset. Every row has pieces of its
    own, also repeated rows and a null doc_id; an empty table gives no rows.
    """
    pieces = materialize(
        docs.select("doc_id", full_text().alias("_t"))
        .mapInArrow(lambda it: _pieces(it, spec, capacity, end_id), PIECES), "pieces")
    own = materialize(pieces.groupBy("task", "length").agg(F.count(F.lit(1)).alias("n")), "piece-counts")
    # at most `capacity` rows
    counts = {r["length"]: r["n"] for r in own.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    places = _places(plan(counts, capacity))
    # rank of a piece among those of its length: earlier tasks' counts plus its number in the task
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    first = own.select("task", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    ranked = pieces.join(first, ["task", "length"]).select(
        "doc_id", "piece", "start", "length", "ids_crc32", (F.col("first") + F.col("ord")).alias("rank"))
    return ranked.mapInArrow(
        lambda it: _assign(it, places),
        "doc_id long, piece int, start long, length int, ids_crc32 long, sequence_id long, offset long")
