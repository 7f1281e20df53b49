"""N-gram Jaccard join against comparing all pairs."""

import random
import re

import numpy as np
import pytest

from demandspark.llm import ngram_join as J


def brute(rows, k=5, percent=75):
    sets = []
    for _, t in rows:
        w = re.findall("[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda c: c[0].lower(), t or ""))
        sets.append({tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set()))
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    low = {}
    for i, (d, _) in enumerate(rows):
        low.setdefault(find(i), []).append(d)
    return sorted(((d, len(s), min((x for x in low[find(i)] if x is not None), default=None))
                   for i, ((d, _), s) in enumerate(zip(rows, sets))), key=str)


def corpus(seed):
    r = random.Random(seed)
    vocab = [f"w{i}" for i in range(60)]

    def text(n):
        return [r.choice(vocab) for _ in range(n)]

    def near(w, edits):
        w = list(w)
        for _ in range(edits):
            w[r.randrange(len(w))] = f"e{r.random()}"
        return w

    rows = [(i, " ".join(text(r.choice([0, 1, 3, 5, 6, 8, 30, 200])))) for i in range(25)]
    hot = text(120)
    rows += [(100 + i, " ".join(near(hot, r.randint(0, 6)))) for i in range(45)]
    passage = text(60)
    rows += [(200 + i, " ".join(passage + text(r.choice([5, 12, 60])))) for i in range(30)]
    for i in range(10):
        w = text(r.choice([7, 9, 12, 40]))
        rows += [(300 + 3 * i + j, " ".join(near(w, j % 2) + text(j))) for j in range(3)]
    chain = text(300)
    rows += [(400 + i, " ".join(chain[10 * i:10 * i + 100])) for i in range(18)]
    rows += [(500, "A  b\tC d E f"), (501, "a b c d e f"), (502, None), (503, ""), (503, ""), (100, rows[40][1]),
             (None, " ".join(hot)), (None, "only null here at all now"), (504, "x " * 500), (505, "x " * 5)]
    return rows


@pytest.mark.parametrize("seed,frequent", [(1, 64), (2, 0), (3, 4)])
def test_against_all_pairs(spark, monkeypatch, seed, frequent):
    monkeypatch.setattr(J, "LARGE", 8)
    monkeypatch.setattr(J, "FREQUENT", frequent)   # 0: all tokens are frequent
    rows = corpus(seed)
    df = spark.createDataFrame([(d, t, 1) for d, t in rows], "doc_id long, text string, component int").repartition(4)
    got = sorted(((x.doc_id, x.n_shingles, x.component_id) for x in J.near_duplicates(df).collect()), key=str)
    assert got == brute(rows)


@pytest.mark.parametrize("hot", [0.0, 0.3, 0.9, 1.0])
def test_similar_sets_share_a_signature(monkeypatch, hot):
    monkeypatch.setattr(J, "FREQUENT", 1)
    r = np.random.default_rng(7)
    pool = r.integers(0, 2**63, 20_000).astype(np.uint64)
    table = np.where(r.random(1 << 24) < hot, r.integers(1, 99, 1 << 24), 0).astype(np.uint8)
    for _ in range(1500):
        n = int(r.choice([2, 3, 4, 5, 7, 8, 15, 16, 17, 31, 33, 90, 400]))
        a = r.choice(pool, n, replace=False)
        drop = r.integers(0, max(1, n // 4 + 1))
        b = np.concatenate([a[drop:], r.choice(pool, int(r.integers(0, n // 3 + 1)), replace=False)])
        a, b = np.unique(a), np.unique(b)
        common = len(np.intersect1d(a, b))
        if 100 * common >= 75 * (len(a) + len(b) - common) and len(a) != len(b) or common < min(len(a), len(b)) and \
                100 * common >= 75 * (len(a) + len(b) - common):
            assert len(np.intersect1d(J.signatures(a, table, 75), J.signatures(b, table, 75)))


def test_empty_and_keep_first(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert J.near_duplicates(df).count() == 0
    text = " ".join(f"w{i}" for i in range(40))
    df = spark.createDataFrame([(3, text, "a"), (1, text + " x", "b"), (2, "other words stand here today", "c"),
                                (4, None, "d"), (5, "", "e"), (1, text + " x", "b")], "doc_id long, text string, source string")
    out = J.keep_first(df)
    assert out.columns == df.columns
    assert sorted((x.doc_id, x.source) for x in out.collect()) == [(1, "b"), (2, "c"), (4, "d"), (5, "e")]


def test_null_and_repeated_doc_ids(spark):
    r = random.Random(4)

    def text(n):
        return [f"v{r.randrange(500)}" for _ in range(n)]

    a, b, c, d = text(60), text(60), text(60), text(60)
    rows = [(None, " ".join(a)), (None, " ".join(b)), (None, " ".join([*b, "end"])), (None, " ".join(a)),
            (None, " ".join(text(40))), (7, " ".join(c)), (7, " ".join(text(40))), (7, " ".join([*c, "end"])),
            (8, " ".join([*d, "end"])), (None, " ".join(d)), (None, None), (None, ""), (9, " ".join([*c, "other"]))]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    found = J.near_duplicates(df)
    assert sorted(((x.doc_id, x.n_shingles, x.component_id) for x in found.collect()), key=str) == brute(rows)
    assert found.where("n_shingles > 0").select("component").distinct().count() == 6
    got = [(x.doc_id, x.text) for x in J.keep_first(df).collect()]
    groups = [{0, 3}, {1, 2}, {4}, {5, 7}, {6}, {8}, {10}, {11}]     # what may be kept, one of each
    assert len(got) == len(groups)
    for group in groups:
        assert sum(x in [rows[i] for i in group] for x in got) == 1


@pytest.mark.parametrize("percent", [1, 5, 10, 20, 30, 36, 40, 50, 51, 66, 75, 90, 100])
def test_similar_sets_share_a_signature_at_any_percent(monkeypatch, percent):
    monkeypatch.setattr(J, "FREQUENT", 1)
    r = np.random.default_rng(percent)
    pool = r.integers(0, 2**63, 20_000).astype(np.uint64)
    tables = [np.where(r.random(1 << 24) < hot, r.integers(1, 99, 1 << 24), 0).astype(np.uint8) for hot in (0.5, 1.0)]
    found = 0
    for _ in range(3000):
        # the least overlap that is similar, as often as not
        n, m = (int(x) for x in r.choice([1, 2, 3, 4, 5, 7, 8, 15, 16, 17, 31, 33, 90, 400], 2))
        common = min(n, m, -(-(n + m) * percent // (100 + percent)) + int(r.integers(0, 2)))
        own = r.choice(pool, n + m - common, replace=False)
        a, b = np.unique(own[:n]), np.unique(own[n - common:])
        if 100 * common < percent * (n + m - common) or common == n == m:
            continue
        found += 1
        for table in tables:
            assert len(np.intersect1d(J.signatures(a, table, percent), J.signatures(b, table, percent))), (n, m, common)
    assert found or percent > 90


@pytest.mark.parametrize("percent,frequent", [(10, 0), (30, 0), (50, 0), (50, 64)])
def test_low_percents_against_all_pairs(spark, monkeypatch, percent, frequent):
    monkeypatch.setattr(J, "FREQUENT", frequent)
    r = random.Random(percent)
    vocab = [f"w{i}" for i in range(9)]
    rows = [(1, "a b c d e"), (2, "a b c d e f"), (3, "only these")]
    rows += [(10 + i, " ".join(r.choice(vocab) for _ in range(r.choice([5, 6, 7, 9, 12])))) for i in range(40)]
    long = [f"x{i}" for i in range(400)]
    rows += [(100 + i, " ".join(long[25 * i:25 * i + 60])) for i in range(8)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    found = J.near_duplicates(df, percent=percent).collect()
    assert sorted(((x.doc_id, x.n_shingles, x.component_id) for x in found), key=str) == brute(rows, percent=percent)


@pytest.mark.parametrize("percent", [0, 101])
def test_percent_out_of_range(spark, percent):
    with pytest.raises(ValueError):
        J.near_duplicates(spark.createDataFrame([(1, "a")], "doc_id long, text string"), percent=percent)


def test_clashing_names(spark):
    rows = [(1, "a b c d e f", 5, 6), (2, "a b c d e f", 7, 8), (None, "g h i j k", 9, 9), (3, "", 0, 0), (3, "x y z v w", 1, 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, _d int, _k1 int")
    for a, b in (("_t", "_k"), ("_d", "_k1"), ("component", "n_shingles"), ("g1", "c_text")):
        out = J.keep_first(df.toDF("doc_id", "text", a, b))
        assert out.columns == ["doc_id", "text", a, b]
        assert sorted(map(tuple, out.collect()), key=str) == sorted([rows[0], *rows[2:]], key=str)


def test_pairs_come_from_one_group(spark, monkeypatch):
    """A pair that many groups hold comes out once, and none is lost when members bring one name only."""
    r = random.Random(6)
    shared = [f"s{i}" for i in range(60)]
    rows = [(k, " ".join(shared[:r.randint(20, 60)] + [f"o{k}x{i}" for i in range(r.randint(0, 30))])) for k in range(90)]
    monkeypatch.setattr(J, "FREQUENT", 3)
    monkeypatch.setattr(J, "LARGE", 8)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    for first in (1, 16):
        monkeypatch.setattr(J, "FIRST", first)
        found = sorted(((x.doc_id, x.n_shingles, x.component_id) for x in J.near_duplicates(df).collect()), key=str)
        assert found == brute(rows)


def test_most_common_is_a_bound():
    r = np.random.default_rng(4)
    for _ in range(200):
        n, m, common = (int(x) for x in r.integers(1, 3000, 3))
        own = r.integers(0, 2**63, n + m).astype(np.uint64)
        a, b = np.unique(own[:n]), np.unique(own[max(0, n - common):])
        bits = [np.frombuffer(J.profile(x), np.uint64)[None, :] for x in (a, b)]
        most = J.most_common(*bits, np.array([len(a)]), np.array([len(b)]))
        assert most[0] >= len(np.intersect1d(a, b))
