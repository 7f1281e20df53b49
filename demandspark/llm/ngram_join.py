"""Exact Jaccard join of documents on word shingles, by token-combination prefixes.

A document is the set of its 5-word shingles (tokens). Tokens are put in one
global order, rare before frequent. If two sets overlap enough, their prefixes
share a signature: a rare token, or two frequent tokens of one class. For
frequent tokens a prefix is longer by one token for each class in it, as a class
may share one token without a signature; so hot passages are indexed by pairs
of tokens and rare tokens by themselves, and no pair of similar sets is missed.

How many documents hold a token is counted over all of them, on 32 bits of its
name; the counts reach the tasks as a table of fixed size, in which a token may
get another's higher count. Counts only set the order and the classes, which
are the same for every document, so results don't depend on them.

Equal sets are one node. Documents that share a signature are held against one
pivot of their group, links are verified on whole sets, and only members still
in different components are compared further, so a large group of copies costs
a number of comparisons in proportion to its size.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandspark.llm.arrays import LOWER, MULT_A, MULT_B, byte_column, mix64, run_hashes, runs, slices
from demandspark.llm.common import full_text, materialize

WORDS = 5
PERCENT = 75
CELL_BITS = 32           # bits of a token's name on which documents are counted
RANGE_BITS = 8           # ranges of cells, each counted in one group
SLOT_BITS = 16           # counts kept of a range: the table has 2**(8 + 16) bytes (16 MB)
SHARED = 2               # a count of one is no news
FREQUENT = 64            # counts from here on are indexed by pairs of tokens
BUCKETS = 256            # signature buckets at least, each grouped in memory
BUCKET_SHINGLES = 4_000_000   # shingles of the input for one bucket
PIVOT_ROUNDS = 1         # rounds of large groups against one more pivot before all pairs across components
LARGE = 64               # members of a large group
PROFILE = 2048           # bits of a set's profile
PAIR_BLOCK = 100_000     # pairs held against each other's profile at once
FIRST = 16               # names of its first groups that a member brings along

SPACE = np.zeros(256, dtype=bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True   # fixed values: ASCII white space


def shingle_sets(data: np.ndarray, offsets: np.ndarray, words: int) -> Iterator[np.ndarray]:
    """The sorted distinct shingle names of each row; fewer words than ``words`` are one shingle."""
    base = offsets[0]
    piece, rows = LOWER[data[base:offsets[-1]]], offsets - base
    starts, ends = runs(~SPACE[piece], rows)
    names, at = run_hashes(piece, starts, ends), np.searchsorted(starts, rows)
    n = len(names) - words + 1
    if n > 0:
        grams = names[:n].copy()
        for k in range(1, words):
            grams = grams * MULT_A + names[k:k + n]
        grams = mix64(grams)
    for i, j in zip(at, at[1:]):
        if j - i >= words:
            yield np.unique(grams[i:j - words + 1])
        elif j > i:
            short = np.uint64(j - i)
            for x in names[i:j]:
                short = short * MULT_B + x
            yield mix64(np.array([short]))
        else:
            yield names[:0]


def set_key(tokens: np.ndarray) -> tuple[int, int]:
    """Two 64-bit names of a set."""
    size = np.uint64(len(tokens))
    a = mix64(np.array([mix64(tokens ^ MULT_A).sum(dtype=np.uint64) + size]))
    b = mix64(np.array([mix64(tokens + MULT_B).sum(dtype=np.uint64) ^ size]))
    return int(a.view(np.int64)[0]), int(b.view(np.int64)[0])


def _sets(batches: Iterator[pa.RecordBatch], words: int):
    """(batch, row, tokens, key) of each row with words."""
    for batch in batches:
        data, offs = byte_column(batch.column("_t"))
        for i, j in slices(offs):
            for r, tokens in enumerate(shingle_sets(data, offs[i:j + 1], words), i):
                yield batch, r, tokens


def _cells(tokens: np.ndarray) -> np.ndarray:
    return (tokens >> np.uint64(64 - CELL_BITS)).astype(np.uint32)


def _slots(cells: np.ndarray) -> np.ndarray:
    """Place of each cell in the table: its range, then a hash."""
    inside = mix64(cells.astype(np.uint64)) >> np.uint64(64 - SLOT_BITS)
    return ((cells >> np.uint32(CELL_BITS - RANGE_BITS)).astype(np.int64) << SLOT_BITS) + inside.astype(np.int64)


def _pack(cells: np.ndarray) -> bytes:
    """Sorted cells as gaps, of two bytes where all fit."""
    gaps = np.diff(cells, prepend=cells[:1])
    head = np.array([cells[0]], "<u4").tobytes()
    if int(gaps.max()) < 1 << 16:
        return b"2" + head + gaps.astype("<u2").tobytes()
    return b"4" + head + gaps.astype("<u4").tobytes()


def _unpack(raw: bytes) -> np.ndarray:
    gaps = np.frombuffer(raw, "<u2" if raw[:1] == b"2" else "<u4", -1, 5)
    return np.cumsum(gaps, dtype=np.int64) + np.frombuffer(raw, "<u4", 1, 1)[0]


def _measure(batches: Iterator[pa.RecordBatch], words: int) -> Iterator[pa.RecordBatch]:
    """A row for each document (range -1), and the cells of this task's tokens by range."""
    seen: set[tuple[int, int]] = set()
    kinds = {"doc_id": pa.int64(), "n": pa.int64(), "k1": pa.int64(), "k2": pa.int64(), "range": pa.int32(),
             "cells": pa.binary()}
    rows: list[tuple] = []
    held: list[np.ndarray] = []
    size = 0

    def flush():
        if held:
            cells = np.sort(np.concatenate(held))
            cut = np.searchsorted(cells, np.arange((1 << RANGE_BITS) + 1, dtype=np.int64) << (CELL_BITS - RANGE_BITS))
            rows.extend((None, 0, 0, 0, r, _pack(cells[cut[r]:cut[r + 1]]))
                        for r in range(1 << RANGE_BITS) if cut[r + 1] > cut[r])
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(zip(*rows), kinds.values())], names=list(kinds))

    doc, current = None, None
    for batch, r, tokens in _sets(batches, words):
        if batch is not current:
            current, doc = batch, batch.column("doc_id").to_pylist()
        key = set_key(tokens) if len(tokens) else (0, 0)
        rows.append((doc[r], len(tokens), *key, -1, None))
        if len(tokens) and key not in seen:
            seen.add(key)
            held.append(_cells(tokens))
            size += len(tokens)
        if size >= 3_000_000:
            yield flush()
            rows, held, size = [], [], 0
    if rows:
        yield flush()


def _count_range(pdf: pd.DataFrame) -> pd.DataFrame:
    """The counts of one range of cells, at most 255, in its part of the table."""
    cells = np.sort(np.concatenate([_unpack(raw) for raw in pdf["cells"]])).astype(np.uint32)
    cut = np.flatnonzero(np.concatenate([[True], cells[1:] != cells[:-1]]))
    count = np.diff(np.append(cut, len(cells)))
    own, count = cells[cut[count >= SHARED]], np.minimum(count[count >= SHARED], 255).astype(np.uint8)
    table = np.zeros(1 << SLOT_BITS, np.uint8)
    np.maximum.at(table, _slots(own) & ((1 << SLOT_BITS) - 1), count)
    return pd.DataFrame([{"range": pdf["range"].iloc[0], "counts": table.tobytes()}])


def frequency_table(measured: DataFrame) -> np.ndarray:
    """Counts of all ranges: 2**(RANGE_BITS + SLOT_BITS) bytes, whatever the input."""
    rows = (measured.where("range >= 0").select("range", "cells").groupBy("range")
            .applyInPandas(_count_range, "range int, counts binary").toLocalIterator())
    out = np.zeros((1 << RANGE_BITS, 1 << SLOT_BITS), np.uint8)
    for r in rows:
        out[r["range"]] = np.frombuffer(r["counts"], np.uint8)
    return out.ravel()


def signatures(tokens: np.ndarray, table: np.ndarray, percent: int) -> np.ndarray:
    """Names of the signatures of a set. Two sets whose Jaccard similarity is at
    least ``percent`` have one in common, unless they are equal and of one or two tokens.
    Where similar sets may overlap in one token only, each token is a signature."""
    n = len(tokens)
    need = -(-n * percent // 100)            # overlap with any similar set, at least
    miss = n - need + 1
    freq = table[_slots(_cells(tokens))]
    order = np.argsort(freq, kind="stable")  # by count, then by name
    n_rare = int((freq < FREQUENT).sum())
    rare = tokens[order[:n_rare]]
    if len(rare) >= miss:
        return rare[:miss]
    hot = tokens[order[n_rare:]]
    out = [rare]
    first = n.bit_length() - 1
    last = (n * 100 // percent).bit_length() - 1
    for size in range(first, last + 1):      # the size classes of n and of the largest similar set
        # overlap of two similar sets that meet in this size class, at least; a pair needs one token more than classes
        least = -(-(-(-(1 << size) * percent // 100)) * percent // 100)
        if least == 1:
            out.append(hot[:miss - len(rare)])
            continue
        classes = max(1, min((1 << size) // 8, least - 1))
        own = ((hot * MULT_B) >> np.uint64(32)) % np.uint64(classes)
        _, at = np.unique(own, return_index=True)
        new = np.zeros(len(hot), np.int64)
        new[at] = 1
        enough = np.flatnonzero(len(rare) + np.arange(1, len(hot) + 1) - np.cumsum(new) >= miss)
        p = int(enough[0]) + 1
        by = np.lexsort((hot[:p], own[:p]))
        cls, tok = own[:p][by], hot[:p][by]
        for step in range(1, p):
            same = cls[step:] == cls[:-step]
            if not same.any():
                break
            out.append(mix64((tok[:-step][same] * MULT_A + tok[step:][same]) * MULT_B + np.uint64(size)))
    return np.concatenate(out)


def _signature_rows(batches, words: int, table: np.ndarray, percent: int, buckets: int) -> Iterator[pa.RecordBatch]:
    """This task's signatures, packed by bucket."""
    seen: set[int] = set()
    sigs: list[np.ndarray] = []
    ids: list[int] = []
    sizes: list[int] = []
    total = 0

    def flush():
        s = np.concatenate(sigs)
        n = [len(x) for x in sigs]
        i, z = np.repeat(np.array(ids, np.int64), n), np.repeat(np.array(sizes, np.int32), n)
        bucket = (s % np.uint64(buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        cut = np.searchsorted(bucket[order], np.arange(buckets + 1))
        own = [(b, order[cut[b]:cut[b + 1]]) for b in range(buckets) if cut[b + 1] > cut[b]]
        return pa.RecordBatch.from_arrays([
            pa.array([b for b, _ in own], pa.int32()), pa.array([s[o].tobytes() for _, o in own], pa.binary()),
            pa.array([i[o].tobytes() for _, o in own], pa.binary()),
            pa.array([z[o].tobytes() for _, o in own], pa.binary())], names=["bucket", "sigs", "ids", "sizes"])

    for _, _, tokens in _sets(batches, words):
        if 100 * len(tokens) < 2 * percent:
            continue                         # one token: similar sets are equal
        key = set_key(tokens)[0]
        if key in seen:
            continue
        seen.add(key)
        own = signatures(tokens, table, percent)
        sigs.append(own)
        ids.append(key)
        sizes.append(len(tokens))
        total += len(own)
        if total > 1_000_000:
            yield flush()
            sigs, ids, sizes, total = [], [], [], 0
    if sigs:
        yield flush()


def _group_bucket(pdf: pd.DataFrame) -> pd.DataFrame:
    """The distinct groups of sets that share a signature: members by id, two at least."""
    sig = np.concatenate([np.frombuffer(x, "<u8") for x in pdf["sigs"]])
    ids = np.concatenate([np.frombuffer(x, "<i8") for x in pdf["ids"]])
    size = np.concatenate([np.frombuffer(x, "<i4") for x in pdf["sizes"]])
    once, first = np.unique(sig, return_index=True)
    keep = np.ones(len(sig), bool)
    # most signatures occur once
    times = np.bincount(np.searchsorted(once, sig), minlength=len(once))
    keep = times[np.searchsorted(once, sig)] > 1
    sig, ids, size = sig[keep], ids[keep], size[keep]
    order = np.lexsort((ids, sig))
    sig, ids, size = sig[order], ids[order], size[order]
    new = np.ones(len(sig), bool)
    new[1:] = (sig[1:] != sig[:-1]) | (ids[1:] != ids[:-1])
    sig, ids, size = sig[new], ids[new], size[new]
    cuts = np.flatnonzero(np.concatenate([[True], sig[1:] != sig[:-1], [True]])) if len(sig) else np.zeros(1, int)
    groups: dict[bytes, int] = {}
    rows = []
    for a, b in zip(cuts, cuts[1:]):
        if b - a < 2:
            continue
        raw = ids[a:b].tobytes()
        if raw not in groups:
            groups[raw] = 1
            k1, k2 = set_key(ids[a:b].view(np.uint64))
            rows.append((k1, k2, ids[a:b], size[a:b]))
    return pd.DataFrame(rows, columns=["g1", "g2", "ids", "sizes"])


def _verify(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        left, right = (batch.column(c) for c in ("ls", "rs"))
        linked = []
        for i in range(batch.num_rows):
            a = np.frombuffer(left[i].as_buffer(), "<u8")
            b = np.frombuffer(right[i].as_buffer(), "<u8")
            both = np.concatenate([a, b])
            both.sort()
            common = int((both[1:] == both[:-1]).sum())
            linked.append(100 * common >= percent * (len(a) + len(b) - common))
        yield pa.RecordBatch.from_arrays([batch.column("u"), batch.column("v"), pa.array(linked, pa.bool_())],
                                         names=["u", "v", "linked"])


def profile(tokens: np.ndarray) -> bytes:
    """A bit for each of PROFILE classes that holds a token of the set. For each bit that only one of
    two sets has, that set has a token which the other lacks."""
    bits = np.zeros(PROFILE, bool)
    bits[(tokens & np.uint64(PROFILE - 1)).astype(np.int64)] = True
    return np.packbits(bits).tobytes()


def most_common(left: np.ndarray, right: np.ndarray, n_left: np.ndarray, n_right: np.ndarray) -> np.ndarray:
    """The overlap of sets of these profiles (64-bit words by row) and sizes, at most."""
    def lacks(x: np.ndarray, y: np.ndarray) -> np.ndarray:
        return np.bitwise_count(x & ~y).sum(axis=1, dtype=np.int64)
    return np.minimum(n_left - lacks(left, right), n_right - lacks(right, left))


def _set_rows(batches: Iterator[pa.RecordBatch], words: int) -> Iterator[pa.RecordBatch]:
    ids, raw, sums, size = [], [], [], 0

    def flush():
        return pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(raw, pa.binary()),
                                           pa.array(sums, pa.binary())], names=["id", "s", "p"])

    for _, _, tokens in _sets(batches, words):
        if len(tokens):
            ids.append(set_key(tokens)[0])
            raw.append(tokens.tobytes())
            sums.append(profile(tokens))
            size += len(raw[-1])
        if size > 4 << 20:
            yield flush()
            ids, raw, sums, size = [], [], [], 0
    if ids:
        yield flush()


def connected_components(links: DataFrame) -> DataFrame:
    """(node, root) of the nodes of links (u, v): root is the smallest node
    reachable. Alternating large and small stars, each iteration written."""
    edges = materialize(links.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
                        .distinct(), "edges")
    state = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = (both.where("v > u").join(least, "u").where("v <> m")
                 .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(least.select("u", F.col("m").alias("v")))
                 .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
        edges = materialize(small, "edges")
        # order-free checksum of the edges: the same twice means stars
        now = tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v")),
                              F.sum(F.xxhash64("v", "u").cast("decimal(20,0)"))).first())
        if now == state:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
        state = now


def _across(pivot: int, percent: int):
    """Pairs across components of some groups that may be similar by size and
    profile. Of a group of up to LARGE members all; of a larger one those of one
    member of the largest component (which one depends on ``pivot``) with the
    others, or all if pivot is 0. Then a pair stays out of a group if its members'
    first groups (``first``, by name) show one before it that holds both: that one gives the pair."""
    def pairs(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["g1", "g2", "id"])
        g1, g2, ids, roots, size = (pdf[c].to_numpy() for c in ("g1", "g2", "id", "root", "size"))
        size = size.astype(np.int64)
        bits = np.frombuffer(b"".join(pdf["p"]), np.uint64).reshape(-1, PROFILE // 64)
        cuts = np.flatnonzero(np.concatenate([[True], (g1[1:] != g1[:-1]) | (g2[1:] != g2[:-1]), [True]]))
        us, vs = [], []
        first = np.full((len(pdf), FIRST), np.iinfo(np.int64).max)
        if not pivot:
            for i, names in enumerate(pdf["first"]):
                first[i, :len(names)] = names

        def earlier(u, v, group):
            """Whether an earlier group is among the first ones of both."""
            same = (first[u][:, :, None] == first[v][:, None, :]) & (first[u] < group)[:, :, None]
            return same.any(axis=(1, 2))

        def hold(here, rest):
            step = max(1, PAIR_BLOCK // max(1, len(rest)))
            for i in range(0, len(here), step):
                own = here[i:i + step]
                u, v = np.repeat(own, len(rest)), np.tile(rest, len(own))
                low, high = np.minimum(size[u], size[v]), np.maximum(size[u], size[v])
                near = low * 100 >= high * percent
                u, v = u[near], v[near]
                most = most_common(bits[u], bits[v], size[u], size[v])
                may = most * 100 >= percent * (size[u] + size[v] - most)
                u, v = u[may], v[may]
                if not pivot:
                    new = ~earlier(u, v, g1[here[0]])
                    u, v = u[new], v[new]
                us.append(u)
                vs.append(v)

        for a, b in zip(cuts, cuts[1:]):
            _, code, count = np.unique(roots[a:b], return_inverse=True, return_counts=True)
            if pivot and b - a > LARGE:
                largest = int(count.argmax())
                own = np.flatnonzero(code == largest)
                hold(a + own[[(pivot * 7919) % len(own)]], a + np.flatnonzero(code != largest))
                continue
            left = np.ones(b - a, bool)
            for c in np.argsort(count, kind="stable")[:-1]:   # each smaller component against those left
                here = np.flatnonzero(code == c)
                left[here] = False
                hold(a + here, a + np.flatnonzero(left))
        u, v = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (us, vs))
        return pd.DataFrame({"u": np.minimum(ids[u], ids[v]), "v": np.maximum(ids[u], ids[v]),
                             "us": size[u], "vs": size[v]}).drop_duplicates(["u", "v"])
    return pairs


def near_duplicates(docs: DataFrame, words: int = WORDS, percent: int = PERCENT, keys: bool = False) -> DataFrame:
    """Components of the documents linked by 100 * intersection >= percent * union.

    docs: doc_id, text (other columns are ignored). Texts are lower-cased (A-Z)
    and split at ASCII white space; a text of fewer words than ``words`` is one
    shingle; a null text or one without words has none and links with nothing.
    Returns per row: doc_id, n_shingles, component_id (the smallest doc_id
    reachable by links, its own included; null if there is none but null) and
    component (the component's name), with ``keys`` also k1 (the name of the
    row's set). Equal sets are always linked, so repeated
    rows share a component; an empty table gives no rows. Shingles and sets are
    compared by 64-bit names.
    """
    if not 0 < percent <= 100:
        raise ValueError("percent must be above 0 and 100 at most")
    base = docs.select("doc_id", full_text().alias("_t"))
    measured = materialize(base.mapInArrow(
        lambda it: _measure(it, words),
        "doc_id long, n long, k1 long, k2 long, range int, cells binary"), "measured")
    rows = measured.where("range = -1").select("doc_id", "n", "k1", "k2")
    table = frequency_table(measured)
    shingles = rows.agg(F.sum("n")).first()[0] or 0
    buckets = max(BUCKETS, -(-shingles // BUCKET_SHINGLES))
    groups = (base.mapInArrow(lambda it: _signature_rows(it, words, table, percent, buckets),
                              "bucket int, sigs binary, ids binary, sizes binary")
              .groupBy("bucket").applyInPandas(_group_bucket, "g1 long, g2 long, ids array<long>, sizes array<int>"))
    groups = materialize(groups.dropDuplicates(["g1", "g2"]), "groups")
    members = groups.select("g1", "g2", F.explode(F.arrays_zip("ids", "sizes")).alias("x")).select(
        "g1", "g2", F.col("x.ids").alias("id"), F.col("x.sizes").alias("size"))
    # the sets of all that share a signature, computed again from one text each
    wanted = members.select("id").distinct()
    one = rows.join(wanted, F.col("k1") == F.col("id"), "left_semi").groupBy("k1").agg(F.min("doc_id").alias("doc_id"))
    own = (base.join(one.select("doc_id").distinct(), "doc_id", "left_semi")
           .mapInArrow(lambda it: _set_rows(it, words), "id long, s binary, p binary"))
    if not rows.where("doc_id is null and n > 0").isEmpty():
        # sets of rows without a doc_id only are found by their own name
        own = own.unionByName(
            base.where("doc_id is null").mapInArrow(lambda it: _set_rows(it, words), "id long, s binary, p binary")
            .dropDuplicates(["id"])
            .join(one.where("doc_id is null").select(F.col("k1").alias("id")), "id", "left_semi"))
    sets = materialize(own.dropDuplicates(["id"]), "sets")

    def verify(pairs: DataFrame) -> DataFrame:
        near = (pairs.where(F.least("us", "vs") * 100 >= F.greatest("us", "vs") * percent)
                .select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct())
        if tested is not None:
            near = near.join(tested, ["u", "v"], "left_anti")
        full = (near.join(sets.select(F.col("id").alias("u"), F.col("s").alias("ls")), "u")
                .join(sets.select(F.col("id").alias("v"), F.col("s").alias("rs")), "v"))
        return materialize(full.mapInArrow(lambda it: _verify(it, percent), "u long, v long, linked boolean"), "pairs")

    # the first member of each group is its pivot
    tested = None
    tested = verify(groups.select(F.explode(F.arrays_zip("ids", "sizes")).alias("x"),
                                  F.get("ids", F.lit(0)).alias("u"), F.get("sizes", F.lit(0)).alias("us"))
                    .select("u", F.col("x.ids").alias("v"), "us", F.col("x.sizes").alias("vs")).where("u <> v"))
    roots = connected_components(tested.where("linked"))
    members = members.join(groups.where(F.size("ids") > 2).select("g1", "g2"), ["g1", "g2"], "left_semi")
    for pivot in [*range(1, PIVOT_ROUNDS + 1), 0]:
        placed = (members.join(roots, F.col("id") == F.col("node"), "left")
                  .select("g1", "g2", "id", "size", F.coalesce("root", "id").alias("root")))
        split = (placed.groupBy("g1", "g2").agg(F.min("root").alias("a"), F.max("root").alias("b"))
                 .where("a <> b").select("g1", "g2"))
        members = materialize(placed.join(split, ["g1", "g2"], "left_semi"), "members")
        if members.isEmpty():
            break
        rows_of = members.join(sets.select("id", "p"), "id")
        if not pivot:
            # as many groups as a set has signatures, at most
            named = members.groupBy("id").agg(F.slice(F.array_sort(F.collect_set("g1")), 1, FIRST).alias("first"))
            rows_of = rows_of.join(named, "id")
        new = verify(rows_of
                     .groupBy(F.pmod(F.xxhash64("g1", "g2"), F.lit(buckets)).alias("b"))
                     .applyInPandas(_across(pivot, percent), "u long, v long, us int, vs int"))
        members = members.drop("root")
        tested = tested.unionByName(new)
        if not new.where("linked").isEmpty():
            roots = connected_components(tested.where("linked"))

    named = rows.join(roots, F.col("k1") == F.col("node"), "left").select(
        "doc_id", "n", "k1", F.coalesce("root", "k1").alias("component"))
    named = materialize(named, "named")
    lowest = named.where("n > 0").groupBy("component").agg(F.min("doc_id").alias("component_id"))
    linked = named.where("n > 0").join(lowest, "component").select("doc_id", "n", "k1", "component", "component_id")
    alone = named.where("n = 0").select("doc_id", "n", F.lit(None).cast("long").alias("k1"),
                                        F.lit(None).cast("long").alias("component"),
                                        F.col("doc_id").alias("component_id"))
    return linked.unionByName(alone).select("doc_id", F.col("n").alias("n_shingles"), "component_id", "component",
                                            *(["k1"] if keys else []))


def _keyed(batches: Iterator[pa.RecordBatch], words: int) -> Iterator[pa.RecordBatch]:
    """The rows, which have words, with the name of their set."""
    for batch in batches:
        keys = [set_key(tokens)[0] for _, _, tokens in _sets(iter([batch]), words)]
        names = [c for c in batch.schema.names if c != "_t"]
        yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), pa.array(keys, pa.int64())],
                                         names=[*names, "_k1"])


def keep_first(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """docs with one document of each component: that of the smallest doc_id (a
    null only where there is no other; of its rows one of the smallest set name,
    any one of equal sets). Documents without words all stay; columns unchanged."""
    columns = docs.columns
    renamed = docs.select(*[F.col(f"`{c}`").alias(f"c_{c}") for c in columns])   # own names can't clash
    found = near_duplicates(docs, words, percent, keys=True).where("n_shingles > 0")
    first = (found.groupBy("component")
             .agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "k1")).alias("f"))
             .select(F.col("f.doc_id").alias("_d"), F.col("f.k1").alias("_k")))
    empty = F.length(F.regexp_replace(full_text("c_text"), "[\\x20\\x09-\\x0D]+", "")) == 0
    full = renamed.where(~empty)
    # a doc_id of one row names it; rows of others and of null are told apart by their sets
    repeated = materialize(found.groupBy("doc_id").count().where("count > 1 or doc_id is null")
                           .select(F.col("doc_id").alias("c_doc_id")), "repeated")
    sure = first.join(repeated, F.col("_d") == F.col("c_doc_id"), "left_anti").select("_d")
    kept = full.join(sure, F.col("c_doc_id") == F.col("_d"), "left_semi")
    if not repeated.isEmpty():
        schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in full.schema.fields)
        keyed = (full.where("c_doc_id is null").unionByName(full.join(repeated, "c_doc_id", "left_semi")
                                                            .select(*full.columns))
                 .withColumn("_t", full_text("c_text"))
                 .mapInArrow(lambda it: _keyed(it, words), f"{schema}, _k1 long"))
        kept = kept.unionByName(
            keyed.join(first, F.col("c_doc_id").eqNullSafe(F.col("_d")) & (F.col("_k1") == F.col("_k")), "left_semi")
            .dropDuplicates(["c_doc_id", "_k1"]).select(*full.columns))
    return kept.unionByName(renamed.where(empty)).toDF(*columns)
