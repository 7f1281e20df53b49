"""Suffix dedup against brute force over all windows."""

import random

import pytest
from pyspark.sql import functions as F

from demandspark.llm.queries import op10_suffix_dedup
from demandspark.llm.suffix_dedup import remove_repeats


def brute(rows, length):
    texts = [(i, (t or "").encode()) for i, t in rows]
    seen = {}
    for _, b in texts:
        for p in range(len(b) - length + 1):
            seen[b[p:p + length]] = seen.get(b[p:p + length], 0) + 1
    out = []
    for i, b in texts:
        gone = bytearray(len(b))
        for p in range(len(b) - length + 1):
            if seen[b[p:p + length]] > 1:
                gone[p:p + length] = b"\1" * length
        spans = sum(1 for p in range(len(b)) if gone[p] and (p == 0 or not gone[p - 1]))
        out.append((i, len(b), sum(gone), spans, bytes(c for c, g in zip(b, gone) if not g)))
    return sorted(out, key=str)


def corpus(seed):
    r = random.Random(seed)

    def words(n):
        return "".join(r.choice("abcdeé \n") for _ in range(n))

    passage, other = words(300), words(250)
    rows = [(i, words(r.randint(0, 400))) for i in range(12)]
    rows += [(20 + i, words(r.randint(0, 90)) + passage[r.randint(0, 60):] + words(40)) for i in range(9)]
    rows += [(40 + i, words(30) + other + passage[:200] + other) for i in range(3)]
    rows += [(50, "a" * 700), (51, "b" + "a" * 150), (52, "ab" * 200), (53, None), (54, ""), (55, "x" * 30)]
    near = words(500)
    for i in range(10):
        p = r.randint(0, 480)
        rows.append((60 + i, near[:p] + r.choice("xyz") + near[p + 3:]))
    rows += [(80, near), (81, near), (80, near), (None, passage)]
    return rows


@pytest.mark.parametrize("seed,length,max_class", [(1, 50, 8000), (2, 100, 3), (3, 101, 2), (4, 80, 5)])
def test_against_brute_force(spark, seed, length, max_class):
    rows = corpus(seed)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept))
                  for r in remove_repeats(df, length, max_class).collect()), key=str)
    assert got == brute(rows, length)


def test_empty_and_clashing_columns(spark):
    df = spark.createDataFrame([], "doc_id long, text string, k1 string, gram int, spans string")
    assert remove_repeats(df).count() == 0
    df = spark.createDataFrame([(1, "q" * 500, "x", 1, "y")],
                               "doc_id long, text string, k1 string, gram int, spans string")
    row = remove_repeats(df).select("n_bytes", "n_removed", F.length("kept").alias("n")).first()
    assert tuple(row) == (500, 500, 0)


def test_passages_of_over_50_words(spark, tmp_path):
    """Shared passages lose their bytes from 400 bytes on, however many words they have."""
    def words(seed, n):
        return " ".join(f"{random.Random(seed * 1000 + i).randrange(16 ** 6):06x}" for i in range(n))

    long_, short = words(1, 60), words(2, 57) + "."   # 419 and 399 bytes
    exact = words(3, 57) + ".."                       # 400 bytes
    texts = [t for k, p in enumerate((long_, short, exact))
             for t in (words(10 + k, 30) + "<" + p + ">" + words(20 + k, 90), words(30 + k, 70) + "[" + p + "]" + words(40 + k, 20))]
    texts += [words(50, 200), words(51, 58), None]
    spark.createDataFrame([*enumerate(texts)], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    rows = op10_suffix_dedup(spark, str(tmp_path)).orderBy("doc_id").collect()
    assert [len(p) for p in (long_, short, exact)] == [419, 399, 400]
    assert [r.n_bytes for r in rows] == [len(t or "") for t in texts]
    assert [r.n_removed for r in rows] == [419, 419, 0, 0, 400, 400, 0, 0, 0]
    assert [r.repeated for r in rows] == [True, True, False, False, True, True, False, False, False]
