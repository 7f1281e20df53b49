"""Multiset fingerprints against plain Python."""

import hashlib
import random

from pyspark.sql import functions as F

from demandspark.llm import fingerprints as fp


def lanes(text):
    """count, 12 wide lanes, 240 sign lanes of a text, by plain sums."""
    out = {}
    for line in (text or "").split("\n"):
        h = hashlib.sha256(line.encode()).hexdigest()
        words = [int(h[15 * k:15 * k + 15], 16) for k in range(4)]
        full = bool(line.strip(" \t\n\x0b\x0c\r"))
        for k, w in enumerate(words):
            for l in range(3):
                out["wide", k, l] = out.get(("wide", k, l), 0) + ((w >> 20 * l) & 65535)
            for j in range(20):
                for l in range(3):
                    out["sign", 20 * k + j, l] = out.get(("sign", 20 * k + j, l), 0) + (full and (w >> (j + 20 * l)) & 1)
        out["count"] = out.get("count", 0) + full
    return {k: v % 65536 for k, v in out.items()}


def brute(text):
    x = lanes(text)
    longs = [sum(x["sign", p, l] << 20 * l for l in range(3)) for p in range(80)]
    longs += [sum(x["wide", k, l] << 20 * l for l in range(3)) for k in range(4)] + [x["count"]]
    return "".join(f"{v:015x}" for v in longs)


def alike(a, b):
    x, y = lanes(a), lanes(b)
    if x == y:
        return 1.0
    s = [((2 * z["sign", p, l] - z["count"] + 32768) % 65536) - 32768 for z in (x, y) for p in range(80) for l in range(3)]
    u, v = s[:240], s[240:]
    size = sum(i * i for i in u + v)
    return 0.0 if size == 0 else max(0.0, min(1.0, 2 * sum(i * j for i, j in zip(u, v)) / size))


def expected(rows):
    """Rows in descending doc_id, null last; ties only between equal texts here."""
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0)))
    out = []
    for k, (doc, text) in enumerate(order):
        text, new = text or "", order[(k + 1) % len(order)][1] or ""
        h = len(text) // 2
        edited = text[:len(text) - h] + new[:h]
        out.append((doc, len(text), hashlib.sha256(edited.encode()).hexdigest(), brute(text), brute(edited),
                    round(alike(text, edited), 9), round(alike(text, new), 9)))
    return sorted(out, key=str)


def got(df):
    return sorted(((r.doc_id, r.n_chars, r.edited_sha256, r.fingerprint, r.edited_fingerprint,
                    round(r.near_edited, 9), round(r.near_next, 9)) for r in fp.edit_fingerprints(df).collect()), key=str)


def test_edits(spark):
    r = random.Random(5)
    line = lambda: " ".join(r.choice(["é", "😀b", "x", "word"]) for _ in range(r.randint(0, 6)))
    rows = [(k, "\n".join(line() for _ in range(r.randint(1, 9)))) for k in range(40)]
    rows += [(100, None), (101, ""), (102, "\n\n"), (103, "one"), (104, "a\nb\nc"), (105, "c\nb\na"), (None, "no id\nat all"),
             (106, "\n".join(f"line {i % 9000}" for i in range(30_000)))]
    rows += [(7000, "same\ntext here")] * 5          # repeated rows
    df = spark.createDataFrame([(*x, "t", 1) for x in rows], "doc_id long, text string, _t string, k1 int").repartition(5)
    assert got(df) == expected(rows)
    by = {x[0]: x[3] for x in got(df)}
    assert by[104] == by[105] and by[100] == by[101] != by[102]


def test_few_rows(spark):
    one = spark.createDataFrame([(1, "ab\ncd")], "doc_id long, text string")
    assert got(one) == expected([(1, "ab\ncd")])
    assert got(one.where("doc_id = 2")) == []


def test_insert_and_delete(spark):
    """Sums don't depend on order, and lines that are added and taken away leave no trace."""
    df = spark.createDataFrame([("a\nb\nb\nc", "b\nc\nb\na", "b\nx")], "t string, u string, v string")
    f = {c: fp.fingerprint(F.col(c)) for c in "tuv"}
    row = df.select((f["t"] == f["u"]).alias("order"),
                    (fp.subtract(fp.add(f["t"], f["v"]), f["v"]) == f["t"]).alias("back"),
                    (fp.subtract(f["t"], f["t"]) == fp.empty_fingerprint()).alias("none"),
                    (fp.add(f["t"], f["v"]) == fp.fingerprint(F.concat("u", F.lit("\n"), "v"))).alias("joined"),
                    (f["t"] == f["v"]).alias("other")).first()
    assert (row.order, row.back, row.none, row.joined, row.other) == (True, True, True, True, False)


def test_likeness_follows_shared_lines(spark):
    base = [f"paragraph {i}" for i in range(40)]
    rows = [("\n".join(base), "\n".join(base[:40 - k] + [f"other {i}" for i in range(k)]), k) for k in range(0, 41, 10)]
    df = spark.createDataFrame(rows, "a string, b string, k int")
    out = df.select("k", fp.likeness(fp.fingerprint(F.col("a")), fp.fingerprint(F.col("b"))).alias("v")).collect()
    assert all(abs(x.v - (1 - x.k / 40)) < 0.2 for x in out) and [x.v for x in out if x.k == 0] == [1.0]


def test_many_copies_and_native_plan(spark):
    df = spark.range(3000).select((F.col("id") % 3).alias("doc_id"), F.lit("one\ntwo").alias("text"))
    out = fp.edit_fingerprints(df)
    assert out.count() == 3000 and out.where("near_next < 1").count() == 0
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan and "Cartesian" not in plan
    assert "NestedLoop" not in plan
