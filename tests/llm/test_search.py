"""Ranked search against plain Python."""

import math
import random
import re
from collections import Counter

import numpy as np

from demandspark.llm import search

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def terms(text):
    return [re.sub("[A-Z]", lambda m: m[0].lower(), w) for w in TERM.findall(text or "")]


def brute(docs, items, k=20):
    bags = [(d, Counter(terms(t))) for d, t in docs]
    bags = [(d, b) for d, b in bags if b]
    N, L = len(bags), sum(sum(b.values()) for _, b in bags)
    df = Counter(w for _, b in bags for w in b)
    out = []
    for item, text in items:
        scored = []
        for d, b in bags:
            m = 100 - 25 + (25 * sum(b.values()) * N) // L
            s = sum(math.floor(1000 * math.log((2 * N + 2) / (2 * df[w] + 1))) *
                    ((1000000000 * b[w]) // (1000 * b[w] + 12 * m)) for w in terms(text) if b[w])
            if s > 0:
                scored.append((-s, d is None, d or 0, d))
        out += [(item, r, d, -s) for r, (s, _, _, d) in enumerate(sorted(scored)[:k], 1)]
    return sorted(out, key=str)


def got(spark, docs, items, parts=3, **options):
    d = spark.createDataFrame([(*x, 1, "y") for x in docs], "doc_id long, text string, score int, _t string").repartition(parts)
    i = spark.createDataFrame([(*x, 1) for x in items], "item_id long, text string, rank int")
    return sorted(((r.item_id, r["rank"], r.doc_id, r.score) for r in search.search(d, i, **options).collect()), key=str)


def corpus(r, n=300):
    vocab = [f"w{i}" for i in range(60)] + ["Été", "日本", "ÀB", "X9"]
    text = lambda m: "".join(r.choice(vocab[:r.choice([5, 64])]) + r.choice([" ", ", ", "\x00", "[", "`\n"])
                             for _ in range(m))
    docs = [(k, text(r.randint(0, 40))) for k in range(n)] + [(n, None), (n + 1, " .,"), (None, "w1 w2 w3 W40")]
    docs += [(500 + k, "W7 w7 w8 tie") for k in range(30)] + [(600, "w7 w7 w8 tie")] * 3    # ties and repeated rows
    docs += [(700, " ".join(f"w{i % 60}" for i in range(50_000)))]
    items = [(k, text(r.randint(1, 12))) for k in range(25)]
    items += [(90, "tie tie w7"), (91, ""), (92, None), (93, "unknown words"), (94, "w1 " * 50), (None, "w40")]
    return docs, items


def test_search(spark):
    docs, items = corpus(random.Random(8))
    want = brute(docs, items)
    assert got(spark, docs, items) == want
    assert got(spark, docs, items, postings=200) == want                  # many shards
    assert got(spark, docs, items, block_bytes=100, parts=1) == want      # many blocks
    assert got(spark, docs, items, k=3) == brute(docs, items, 3)


def test_empty(spark):
    docs, items = [(1, "a b")], [(1, "a")]
    d = spark.createDataFrame(docs, "doc_id long, text string")
    i = spark.createDataFrame(items, "item_id long, text string")
    assert search.search(d.where("doc_id = 2"), i).count() == 0
    assert search.search(d, i.where("item_id = 2")).count() == 0
    assert got(spark, docs, items) == brute(docs, items)


def test_early_stop():
    """Where one term singles documents out, a small part of the lists is read, and none better is left out."""
    r = np.random.default_rng(1)
    n, size = 5000, 8
    own = [np.flatnonzero(r.random(size) < 0.9).astype(np.int32) for _ in range(n)]
    times = [r.integers(1, 4, len(x)).astype(np.int32) for x in own]
    for k in range(30):
        times[k][:] = 60
    length = np.array([int(t.sum()) + 1 for t in times])
    shard = search.Shard(length, [x.tobytes() for x in own], [x.tobytes() for x in times], n, int(length.sum()), size)
    weight = np.zeros(size, np.int64)
    weight[[1, 3, 6]] = [500, 40, 7]
    rows, scores = shard.search(np.array([1, 3, 6]), weight, 5, 0)
    m = search.lengths(length, n, int(length.sum()))
    full = np.array([sum(int(weight[t]) * int(search.impacts(np.array([f]), m[[d]])[0]) for t, f in zip(own[d], times[d]))
                     for d in range(n)])
    assert (full[rows] == scores).all() and len(set(rows)) == len(rows) < n / 2
    assert sorted(scores)[-5:] == sorted(full)[-5:]
    again, _ = shard.search(np.array([1, 3, 6]), weight, 5, int(full.max()))
    assert len(again) <= len(rows)
