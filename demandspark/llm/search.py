"""Ranked lexical search by the Best Position Algorithm.

The documents are dealt into shards as they are read. A shard holds for each
query term its impact list: the documents of the shard by falling impact. A
query reads its lists from the top in growing steps. Every document met is
scored at once by direct accesses to all lists, which also mark its places
there. The best position of a list is the end of the places seen without a gap,
so no unseen document can have more than the impacts behind the best positions
add up to. That bound falls faster than one from the last places read; the
search of a shard stops when it is strictly below the k-th score, so ties stay.

The queries come in blocks of bounded size. Corpus statistics (documents,
length, document counts of the query terms) are sums over all documents; only
counts of one block's terms reach the driver. Words are compared by 64-bit names.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from demandspark.llm.arrays import byte_column, slices
from demandspark.llm.common import full_text, materialize
from demandspark.llm.decontaminate import word_names

TOP = 20
BLOCK_BYTES = 1 << 20         # query text in one block
SHARD_POSTINGS = 1_500_000    # postings of a shard, at least
STEP = 32                     # places read of each list at first
SALTS = 32                    # parts in which the candidates of an item are ranked first

# Fixed values of the score (integers, div rounds down): see ``impacts`` and ``lengths``.
SCALE, TF_SCALE, SATURATION, LENGTH_SHARE, WEIGHT_SCALE = 1_000_000_000, 1000, 12, 25, 1000


class Queries:
    """A block of queries: their terms as places in one sorted vocabulary."""

    def __init__(self, texts: list[str | None]):
        raw = [(t or "").encode() for t in texts]
        offsets = np.concatenate([[0], np.cumsum([len(x) for x in raw])]).astype(np.int64)
        names, at = word_names(np.frombuffer(b"".join(raw), np.uint8), offsets)
        self.vocabulary = np.unique(names)
        self.terms = [np.unique(np.searchsorted(self.vocabulary, names[a:b]), return_counts=True)
                      for a, b in zip(at, at[1:])]


def _postings(batches: Iterator[pa.RecordBatch], vocabulary: np.ndarray) -> Iterator[pa.RecordBatch]:
    """A row for each document with query terms (places in the vocabulary and how often), and one for
    the task: n = -1, documents and words in doc_id and total, document counts of the terms it met."""
    kinds = {"doc_id": pa.int64(), "n": pa.int64(), "total": pa.int64(), "terms": pa.binary(), "times": pa.binary()}
    size = len(vocabulary)
    df, docs, total = np.zeros(size, np.int64), 0, 0
    for batch in batches:
        data, offs = byte_column(batch.column("_t"))
        ids = batch.column("doc_id").to_pylist()
        rows = []
        for i, j in slices(offs):
            names, at = word_names(data, offs[i:j + 1])
            length = np.diff(at)
            docs += int((length > 0).sum())
            total += len(names)
            if not size or not len(names):
                continue
            place = np.minimum(np.searchsorted(vocabulary, names), size - 1)
            hit = np.flatnonzero(vocabulary[place] == names)
            row = np.searchsorted(at, hit, side="right") - 1
            pair, times = np.unique(row * size + place[hit], return_counts=True)
            row, term = pair // size, (pair % size).astype(np.int32)
            df += np.bincount(term, minlength=size)
            cut = np.searchsorted(row, np.arange(j - i + 1))
            times = times.astype(np.int32)
            rows.extend((ids[i + r], int(length[r]), 0, term[cut[r]:cut[r + 1]].tobytes(),
                         times[cut[r]:cut[r + 1]].tobytes()) for r in range(j - i) if cut[r + 1] > cut[r])
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds.values())],
                                             names=list(kinds))
    met = np.flatnonzero(df)
    yield pa.RecordBatch.from_arrays(
        [pa.array([x], k) for x, k in zip((docs, -1, total, met.astype(np.int32).tobytes(),
                                           df[met].astype(np.int64).tobytes()), kinds.values())], names=list(kinds))


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(term, df) of the tasks' rows; term -1 for documents, -2 for words."""
    for batch in batches:
        docs, total = (batch.column(c).to_numpy().astype(np.int64) for c in ("doc_id", "total"))
        terms = [np.frombuffer(x, np.int32) for x in batch.column("terms").to_pylist()]
        times = [np.frombuffer(x, np.int64) for x in batch.column("times").to_pylist()]
        few = np.repeat(np.array([-1, -2], np.int32), len(docs))
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([few, *terms])),
                                          pa.array(np.concatenate([docs, total, *times]))], names=["term", "df"])


def weights(df: np.ndarray, documents: int) -> np.ndarray:
    """Weight of each term from the documents that hold it."""
    return np.array([math.floor(WEIGHT_SCALE * math.log((2 * documents + 2) / (2 * int(d) + 1))) for d in df],
                    np.int64)


def lengths(n: np.ndarray, documents: int, total: int) -> np.ndarray:
    """The length factor m of documents of n words."""
    return 100 - LENGTH_SHARE + (LENGTH_SHARE * n * documents) // max(total, 1)


def impacts(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    """What a term brings a document before its weight."""
    tf = tf.astype(np.int64)
    return (SCALE * tf) // (TF_SCALE * tf + SATURATION * m)


class Shard:
    """Impact lists of some documents, and the documents' own postings for direct access."""

    def __init__(self, n: np.ndarray, terms: list[bytes], times: list[bytes], documents: int, total: int, size: int):
        count = np.array([len(t) // 4 for t in terms])
        self.term = np.frombuffer(b"".join(terms), np.int32)
        row = np.repeat(np.arange(len(n), dtype=np.int32), count)
        self.own = np.concatenate([[0], np.cumsum(count)])              # postings of each document
        self.impact = impacts(np.frombuffer(b"".join(times), np.int32), lengths(n, documents, total)[row])
        order = np.lexsort((-self.impact, self.term))
        self.start = np.searchsorted(self.term[order], np.arange(size + 1))   # the lists
        self.row, self.listed = row[order], self.impact[order]
        self.place = np.empty(len(order), np.int64)                     # of each posting in the lists
        self.place[order] = np.arange(len(order))
        self.seen = np.zeros(len(order), np.int32)                      # last query that saw the place
        self.scored = np.zeros(len(n), np.int32)                        # last query that scored the document
        self.asked = 0

    def direct(self, rows: np.ndarray, weight: np.ndarray) -> np.ndarray:
        """Scores of documents; their places in the lists count as seen."""
        first, n = self.own[rows], self.own[rows + 1] - self.own[rows]
        to = np.cumsum(n)
        at = np.repeat(first - (to - n), n) + np.arange(int(to[-1]))
        self.seen[self.place[at]] = self.asked
        self.scored[rows] = self.asked
        return np.add.reduceat(weight[self.term[at]] * self.impact[at], to - n)

    def search(self, terms: np.ndarray, weight: np.ndarray, k: int, least: int) -> tuple[np.ndarray, np.ndarray]:
        """(rows, scores) of the documents met until no other can be among the k best, or reach ``least``.

        weight: per term of the vocabulary its weight times its repeats in the query, 0 for others."""
        self.asked += 1
        lists = [(self.start[t], self.start[t + 1], int(weight[t])) for t in terms
                 if weight[t] > 0 and self.start[t + 1] > self.start[t]]
        best = [a for a, _, _ in lists]           # first place not seen, per list
        rows, scores, step = [], [], STEP
        top = np.zeros(0, np.int64)
        while lists:
            met = np.unique(np.concatenate([self.row[p:min(p + step, b)] for p, (_, b, _) in zip(best, lists)]))
            new = met[self.scored[met] != self.asked]
            if len(new):
                rows.append(new)
                scores.append(self.direct(new, weight))
                top = np.concatenate([top, scores[-1]])
                if len(top) > k:
                    top = np.partition(top, len(top) - k)[-k:]
            bound, open_lists, open_best = 0, [], []
            for p, (a, b, w) in zip(best, lists):
                while p < b:                      # on to the first gap
                    gap = self.seen[p:p + 4 * step][:b - p] != self.asked
                    hole = int(gap.argmax())
                    if gap[hole]:
                        p += hole
                        break
                    p += len(gap)
                if p < b:
                    bound += w * int(self.listed[p])
                    open_lists.append((a, b, w))
                    open_best.append(p)
            lists, best = open_lists, open_best
            kth = max(least, int(top.min()) if len(top) == k else 0)
            if bound < kth:
                break
            step *= 2
        return (np.concatenate(rows), np.concatenate(scores)) if rows else (np.zeros(0, np.int32), np.zeros(0, np.int64))


def _best(ids: np.ndarray, missing: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    """Places of the k best: by score, then doc_id, null last."""
    if len(scores) > 4 * k:
        few = np.flatnonzero(scores >= np.partition(scores, len(scores) - k)[-k])
        return few[np.lexsort((ids[few], missing[few], -scores[few]))[:k]]
    return np.lexsort((ids, missing, -scores))[:k]


def _search(batches: Iterator[pa.RecordBatch], queries: Queries, weight: np.ndarray, documents: int, total: int,
            k: int, postings: int) -> Iterator[pa.RecordBatch]:
    """The k best documents of this task for each query."""
    none = np.zeros(0, np.int64)
    found = [(none, none.astype(bool), none) for _ in queries.terms]
    asked = np.zeros(len(weight), np.int64)

    def look(held: list[pa.RecordBatch]) -> None:
        table = pa.Table.from_batches(held).combine_chunks()
        ids = table["doc_id"].fill_null(0).to_numpy()
        missing = table["doc_id"].is_null().to_numpy()
        shard = Shard(table["n"].to_numpy(), table["terms"].to_pylist(), table["times"].to_pylist(),
                      documents, total, len(weight))
        for q, (terms, times) in enumerate(queries.terms):
            asked[terms] = weight[terms] * times
            before = found[q]
            least = int(before[2].min()) if len(before[2]) == k else 0
            rows, scores = shard.search(terms, asked, k, least)
            asked[terms] = 0
            good = scores >= max(least, 1)
            new = ids[rows[good]], missing[rows[good]], scores[good]
            both = tuple(np.concatenate(x) for x in zip(before, new))
            keep = _best(*both, k)
            found[q] = tuple(x[keep] for x in both)

    held, size = [], 0
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        size += sum(len(x) for x in batch.column("terms").to_pylist()) // 4
        if size >= postings:
            look(held)
            held, size = [], 0
    if held:
        look(held)
    q = np.repeat(np.arange(len(found), dtype=np.int32), [len(x[2]) for x in found])
    ids, missing, scores = (np.concatenate(x) if found else none for x in zip(*found)) if found else (none,) * 3
    yield pa.RecordBatch.from_arrays([pa.array(q, pa.int32()), pa.array(ids, pa.int64(), mask=missing.astype(bool)),
                                      pa.array(scores, pa.int64())], names=["q", "doc_id", "score"])


def _block(docs: DataFrame, items: list, k: int, postings: int) -> DataFrame:
    """The k best documents of some items, written."""
    spark = docs.sparkSession
    queries = Queries([x["text"] for x in items])
    vocabulary = queries.vocabulary
    index = materialize(docs.mapInArrow(lambda it: _postings(it, vocabulary),
                                        "doc_id long, n long, total long, terms binary, times binary"), "postings")
    counted = (index.where("n = -1").mapInArrow(_counts, "term int, df long").groupBy("term").agg(F.sum("df").alias("df"))
               .toPandas())                     # a row for each term of the block
    counts = dict(zip(counted["term"], counted["df"]))
    documents, total = int(counts.get(-1, 0)), int(counts.get(-2, 0))
    df = np.array([counts.get(t, 0) for t in range(len(vocabulary))], np.int64)
    weight = weights(df, documents)
    found = (index.where("n >= 0").select("doc_id", "n", "terms", "times")
             .mapInArrow(lambda it: _search(it, queries, weight, documents, total, k, postings),
                         "q int, doc_id long, score long"))
    order = [F.desc("score"), F.asc_nulls_last("doc_id")]
    salted = found.withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)))
    for by in (["q", "salt"], ["q"]):            # an item's candidates are ranked in parts first
        salted = salted.withColumn("rank", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).where(
            F.col("rank") <= k)
    named = spark.createDataFrame([(q, x["item_id"]) for q, x in enumerate(items)], "q int, item_id long")
    return materialize(salted.join(named, "q").select("item_id", F.col("rank").cast("int").alias("rank"),
                                                      "doc_id", "score"), "ranked")


def search(docs: DataFrame, items: DataFrame, k: int = TOP, block_bytes: int = BLOCK_BYTES,
           postings: int = SHARD_POSTINGS) -> DataFrame:
    """The k highest-scoring documents of each item.

    docs: doc_id, text; items: item_id, text (other columns are ignored,
    whatever their names). Terms are runs of ASCII letters, digits and
    characters beyond ASCII, A-Z lower-cased. Returns item_id, rank (from 1),
    doc_id, score (above 0); equal scores by ascending doc_id, null last. A null
    or empty text has no terms: such a document scores nothing, such an item
    has no rows. Rows of one doc_id are documents of their own, rows of one
    item_id items of their own. Without documents or items there are no rows.
    """
    base = docs.select(F.col("doc_id").cast("long"), full_text().alias("_t"))
    asked = items.select(F.col("item_id").cast("long"), full_text().alias("text"))
    size = asked.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-size // block_bytes))
    none = docs.sparkSession.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    own = (asked.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == b) for b in range(blocks))
    # one block after another: the driver holds the items of one
    return reduce(DataFrame.unionByName, (_block(base, x.collect(), k, postings) for x in own), none)
