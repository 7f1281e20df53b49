"""Benchmark decontamination by greedy string tiling.

A document and a benchmark item are tiled with their longest common word runs:
the longest match of unmarked words is marked in both, again and again, until
no match of ``min_match`` words is left. Marked words of the item show how
much of it the document holds, also when its passages were reordered. Matches
grow from seeds, Karp-Rabin names of ``min_match`` words that both texts share.

The benchmark is the query set: it goes to the tasks in blocks of bounded size,
and every document is held against each block's seeds where it is read, so
documents are never shuffled.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandspark.llm.arrays import LOWER, MULT_A, byte_column, mix64, run_hashes, runs, slices
MIN_MATCH = 5
COVERAGE = 0.5
BLOCK_BYTES = 8 << 20    # benchmark text in one block

# Word characters are ASCII digits and letters and everything beyond ASCII.
WORD = np.ones(256, dtype=bool)
WORD[:48] = WORD[58:65] = WORD[91:97] = WORD[123:128] = False

MATCHES = "array<struct<item_id:long,coverage:double,words:int,tiles:array<struct<item:int,doc:int,words:int>>>>"


def word_names(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(64-bit name of each lower-cased word, offsets of the rows into them)."""
    base = offsets[0]
    piece, rows = LOWER[data[base:offsets[-1]]], offsets - base
    starts, ends = runs(WORD[piece], rows)
    return run_hashes(piece, starts, ends), np.searchsorted(starts, rows)


def seed_names(words: np.ndarray, size: int) -> np.ndarray:
    """Karp-Rabin name of each window of ``size`` words."""
    n = len(words) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = words[:n].copy()
    for k in range(1, size):
        out = out * MULT_A + words[k:k + n]
    return mix64(out)


class Block:
    """Items of the benchmark with an index of their seeds."""

    def __init__(self, items: list[tuple[int, str]], min_match: int):
        raw = [(t or "").encode() for _, t in items]
        data = np.frombuffer(b"".join(raw), np.uint8)
        words, at = word_names(data, np.concatenate([[0], np.cumsum([len(x) for x in raw])]).astype(np.int64))
        self.ids = [i for i, _ in items]
        self.words = [words[at[k]:at[k + 1]] for k in range(len(items))]
        self.seeds: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
        sizes = {min(min_match, len(w)) for w in self.words if len(w)}
        for size in sizes:  # items shorter than min_match must match as a whole
            own = [(k, seed_names(w, size)) for k, w in enumerate(self.words)
                   if min(min_match, len(w)) == size]
            names = np.concatenate([s for _, s in own])
            item = np.concatenate([np.full(len(s), k) for k, s in own])
            pos = np.concatenate([np.arange(len(s)) for _, s in own])
            order = np.argsort(names, kind="stable")
            self.seeds[size] = names[order], item[order], pos[order]


def tile(doc: np.ndarray, item: np.ndarray, offsets: np.ndarray, size: int) -> list[tuple[int, int, int]]:
    """Tiles (item start, document start, words) of greedy string tiling.

    offsets: the differences of document and item position at which ``size``
    words may agree. Ties go to the first place in the item, then in the
    document. Memory follows the texts and their runs of agreeing words, of
    which an offset has few, not the pairs of agreeing places."""
    heap = []
    for o in offsets.tolist():
        lo, hi = max(0, -o), min(len(item), len(doc) - o)
        edge = np.flatnonzero(np.diff(np.concatenate([[False], item[lo:hi] == doc[lo + o:hi + o], [False]])))
        heap.extend((b - e, lo + b, lo + b + o) for b, e in zip(edge[::2].tolist(), edge[1::2].tolist()) if e - b >= size)
    heapq.heapify(heap)
    item_free, doc_free = np.ones(len(item), bool), np.ones(len(doc), bool)
    tiles = []
    while heap:
        n, i, j = heapq.heappop(heap)
        n = -n
        free = item_free[i:i + n] & doc_free[j:j + n]
        if free.all():
            item_free[i:i + n] = doc_free[j:j + n] = False
            tiles.append((i, j, n))
            continue
        edge = np.flatnonzero(np.diff(np.concatenate([[False], free, [False]])))   # what is left of the match
        for b, e in zip(edge[::2].tolist(), edge[1::2].tolist()):
            if e - b >= size:
                heapq.heappush(heap, (b - e, i + b, j + b))
    return sorted(tiles)


def _matches(words: np.ndarray, block: Block, hits: dict[int, tuple[np.ndarray, np.ndarray]]) -> list[dict]:
    out = []
    for size, (names, where) in hits.items():
        known, item, pos = block.seeds[size]
        order = np.argsort(names, kind="stable")
        once, first = np.unique(names[order], return_index=True)
        places = np.split(where[order], first[1:])                 # in the document, by seed
        lo, hi = np.searchsorted(known, once, "left"), np.searchsorted(known, once, "right")
        n = hi - lo
        at = np.repeat(lo - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
        seed, k, p = np.repeat(np.arange(len(once)), n), item[at], pos[at]
        for own in np.unique(k):
            of = k == own
            target = block.words[own]
            agree = np.zeros(len(words) + len(target), bool)
            for s, i in zip(seed[of], p[of]):
                agree[places[s] - i + len(target)] = True
            tiles = tile(words, target, np.flatnonzero(agree) - len(target), size)
            covered = sum(t[2] for t in tiles)
            out.append({"item_id": block.ids[own], "coverage": covered / len(target), "words": covered,
                        "tiles": [dict(zip(("item", "doc", "words"), t)) for t in tiles]})
    return out


def _tile_rows(batches: Iterator[pa.RecordBatch], block: Block, found_so_far: str) -> Iterator[pa.RecordBatch]:
    kind = pa.list_(pa.struct([("item_id", pa.int64()), ("coverage", pa.float64()), ("words", pa.int32()),
                               ("tiles", pa.list_(pa.struct([("item", pa.int32()), ("doc", pa.int32()),
                                                             ("words", pa.int32())])))]))
    for batch in batches:
        data, offs = byte_column(batch.column("text"))
        before = batch.column(found_so_far).to_pylist()
        for i, j in slices(offs):
            words, at = word_names(data, offs[i:j + 1])
            found: dict[int, dict[int, tuple[np.ndarray, np.ndarray]]] = {}
            for size, (known, _, _) in block.seeds.items():
                seeds = seed_names(words, size)
                near = np.minimum(np.searchsorted(known, seeds), len(known) - 1)
                hit = np.flatnonzero(known[near] == seeds)
                row = np.searchsorted(at, hit, side="right") - 1
                inside = hit + size <= at[row + 1]
                hit, row = hit[inside], row[inside]
                for own, r in zip(np.split(hit, np.flatnonzero(np.diff(row)) + 1), np.unique(row)):
                    found.setdefault(int(r), {})[size] = seeds[own], own - at[r]
            for r, hits in found.items():
                before[i + r] = (before[i + r] or []) + _matches(words[at[r]:at[r + 1]], block, hits)
        names = batch.schema.names
        yield pa.RecordBatch.from_arrays(
            [pa.array(before, kind) if c == found_so_far else batch.column(c) for c in names], names=names)


def find_contamination(docs: DataFrame, benchmark: DataFrame, min_match: int = MIN_MATCH,
                       coverage: float = COVERAGE, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """docs (any columns) with ``matches``, an array of item_id, coverage (the
    share of the item's words tiled), words and tiles for the benchmark items
    (item_id, text) of which the document holds at least ``coverage``.

    Words are lower-cased runs of letters, digits and non-ASCII characters. A
    null or empty text, of a document or an item, matches nothing; an item of
    fewer than ``min_match`` words must stand there as a whole; items with equal
    text each match; a column named ``matches`` is replaced.
    """
    items = benchmark.select(F.col("item_id").cast("long"), "text").where("text is not null")
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = -(-size // block_bytes)
    none = F.array().cast(MATCHES)
    out = docs.drop("matches")
    own_name = "_matches"
    while own_name in out.columns:
        own_name += "_"
    out = out.withColumn(own_name, none)
    for b in range(blocks):  # a block is about block_bytes, whatever the benchmark's size
        own = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == b).collect()
        block = Block([(r[0], r[1]) for r in own], min_match)
        if block.seeds:
            out = out.mapInArrow(lambda it, block=block: _tile_rows(it, block, own_name), out.schema)
    return out.withColumn("matches", F.filter(own_name, lambda m: m["coverage"] >= coverage)).drop(own_name)


def decontaminate(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The documents without a match (see ``find_contamination``), columns unchanged."""
    columns = docs.columns
    return find_contamination(docs, benchmark, **options).where(F.size("matches") == 0).select(*columns)
