"""Line dedup and decontamination against brute force."""

import random
import re

import pytest
from pyspark.sql import functions as F

from demandspark.llm.decontaminate import decontaminate, find_contamination
from demandspark.llm.line_dedup import dedup_lines


def brute_lines(rows, m, min_words=None):
    """rows in order: (doc_id, text)."""
    seen, out = set(), []
    for doc, text in rows:
        lines = (text or "").split("\n")
        gone = [False] * len(lines)
        for k in range(1, m + 1):
            for i in range(len(lines) - k + 1):
                run = tuple(lines[i:i + k])
                n_words = sum(len(re.findall("[^\x20\x09-\x0d]+", x)) for x in run)
                if k < m and (min_words is None or n_words < min_words):
                    continue
                if run in seen:
                    gone[i:i + k] = [True] * k
                seen.add(run)
        runs = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        kept = None if text is None else "\n".join(x for x, g in zip(lines, gone) if not g)
        out.append((doc, kept, len(lines), sum(gone), runs))
    return out


@pytest.mark.parametrize("m", [1, 2, 3, 5])
def test_lines(spark, m):
    r = random.Random(m)
    block = [f"shared {i}" for i in range(9)]
    rows = [(0, None), (1, ""), (2, "a"), (3, "\n\n\n\n\n\n"), (4, "x\nx\nx\nx\nx\nx\nx")]
    for i in range(5, 40):
        lines = [r.choice(["é", "b", f"own {i}", "", "long line " * 50]) for _ in range(r.randint(0, 7))]
        p, q = sorted((r.randint(0, 9), r.randint(0, 9)))
        rows.append((i, "\n".join(lines + block[p:q] + lines[:2])))
    df = spark.createDataFrame([(d, t, "z", 1) for d, t in rows], "doc_id long, text string, rid string, starts int")
    out = dedup_lines(df.repartition(4), m)
    assert out.columns == ["doc_id", "text", "rid", "starts", "n_lines", "n_removed", "n_runs"]
    got = [(x.doc_id, x.text, x.n_lines, x.n_removed, x.n_runs) for x in out.orderBy("doc_id").collect()]
    assert got == brute_lines(rows, m)


@pytest.mark.parametrize("m, w", [(1, 4), (2, 3), (3, 4), (4, 6), (6, 5)])
def test_short_runs_of_many_words(spark, m, w):
    r = random.Random(10 * m + w)
    rows = [(0, None), (1, ""), (2, "a b c d e f"), (3, "a b c d e f"), (4, " a  b\tc\x0bd e f "), (5, "a b c\r\nd e f")]
    for i in range(6, 60):
        rows.append((i, "\n".join(r.choice(["é", "b", f"own {i}", "", "two words", "and then three", "a b c\td", "  "])
                                  for _ in range(r.randint(0, 8)))))
    rows += [(60, "long word " * 20000), (61, "x\n" + "long word " * 20000 + "\ny")]
    df = spark.createDataFrame([(d, t, "z", 1) for d, t in rows], "doc_id long, text string, w string, line int")
    out = dedup_lines(df.repartition(4), m, w)
    assert out.columns == ["doc_id", "text", "w", "line", "n_lines", "n_removed", "n_runs"]
    got = [(x.doc_id, x.text, x.n_lines, x.n_removed, x.n_runs) for x in out.orderBy("doc_id").collect()]
    assert got == brute_lines(rows, m, w)
    with pytest.raises(ValueError):
        dedup_lines(df, m, 0)


def test_lines_repeated_rows_and_empty(spark):
    text = "one\ntwo\nthree\nfour"
    df = spark.createDataFrame([(7, text), (7, text), (None, text)], "doc_id long, text string")
    got = sorted((x.n_removed for x in dedup_lines(df).collect()))
    assert got == [0, 4, 4]
    assert dedup_lines(df.where("doc_id = 99")).count() == 0


def brute_tiles(item, doc, m):
    """Greedy string tiling by trying every pair of positions."""
    im, dm, tiles = [False] * len(item), [False] * len(doc), []
    while True:
        best = None
        for i in range(len(item)):
            for j in range(len(doc)):
                n = 0
                while (i + n < len(item) and j + n < len(doc) and item[i + n] == doc[j + n]
                       and not im[i + n] and not dm[j + n]):
                    n += 1
                if n >= m and (best is None or n > best[2]):
                    best = (i, j, n)
        if best is None:
            return sorted(tiles)
        i, j, n = best
        im[i:i + n] = [True] * n
        dm[j:j + n] = [True] * n
        tiles.append(best)


def words(t):
    return re.findall("[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+", re.sub("[A-Z]", lambda c: c[0].lower(), t or ""))


@pytest.mark.parametrize("block_bytes", [1 << 20, 60])
def test_tiling(spark, block_bytes):
    r = random.Random(3)
    vocab = ["a", "b", "É", "d", "e5"]
    items = [(i, " ".join(r.choice(vocab) for _ in range(r.randint(1, 20)))) for i in range(12)]
    items += [(50, None), (51, ""), (52, "Only three words"), (53, items[0][1])]
    docs = [(0, None), (1, ""), (2, "here: only THREE words!")]
    for i in range(3, 30):
        parts = [r.choice(items[:12])[1].split() for _ in range(3)]
        cut = [p[r.randint(0, 3):][:r.randint(1, 20)] for p in parts]
        docs.append((i, ", ".join(" ".join(c) for c in cut)))
    m, share = 5, 0.4
    df = spark.createDataFrame([(d, t, 1) for d, t in docs], "doc_id long, text string, matches int").repartition(3)
    bench = spark.createDataFrame(items, "item_id long, text string")
    out = find_contamination(df, bench, m, share, block_bytes)
    got = {x.doc_id: sorted((y.item_id, round(y.coverage, 9), sorted((t.item, t.doc, t.words) for t in y.tiles))
                            for y in x.matches) for x in out.collect()}
    expect = {}
    for d, t in docs:
        expect[d] = []
        for i, s in items:
            item = words(s)
            if item:
                tiles = brute_tiles(item, words(t), min(m, len(item)))
                cov = sum(x[2] for x in tiles) / len(item)
                if cov >= share:
                    expect[d].append((i, round(cov, 9), tiles))
    assert got == {d: sorted(v) for d, v in expect.items()}
    kept = {x.doc_id for x in decontaminate(df, bench, min_match=m, coverage=share, block_bytes=block_bytes).collect()}
    assert kept == {d for d, v in expect.items() if not v}


def test_no_benchmark(spark):
    df = spark.createDataFrame([(1, "a b c d e f g")], "doc_id long, text string")
    empty = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate(df, empty).count() == 1
    assert decontaminate(df.where("doc_id > 1"), spark.createDataFrame([(1, "a b c d e")], "item_id long, text string")).count() == 0


def test_long_texts_of_equal_words(spark):
    """Every place agrees with every other; memory follows the texts' lengths, not their product."""
    docs = [(1, "la " * 200_000, 1), (2, "la " * 300 + "x " * 9 + "la " * 300, 2), (1, "other words", 3), (1, "other words", 3)]
    df = spark.createDataFrame(docs, "doc_id long, text string, _m int").withColumn("_matches", F.lit("kept"))
    bench = spark.createDataFrame([(1, "la " * 500), (2, "la " * 40)], "item_id long, text string")
    out = find_contamination(df, bench)
    assert out.columns == ["doc_id", "text", "_m", "_matches", "matches"]
    got = {x._m: sorted((y.item_id, y.coverage, [(t.item, t.doc, t.words) for t in y.tiles]) for y in x.matches)
           for x in out.collect()}
    assert got == {1: [(1, 1.0, [(0, 0, 500)]), (2, 1.0, [(0, 0, 40)])],
                   2: [(1, 1.0, [(0, 0, 300), (300, 309, 200)]), (2, 1.0, [(0, 0, 40)])], 3: []}
    assert out.where("_matches = 'kept'").count() == 4
