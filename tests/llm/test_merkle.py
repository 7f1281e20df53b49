"""Merkle manifest and multiproofs against plain Python."""

import hashlib
import random

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from demandspark.llm import merkle


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def enc(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def leaf(row, lower=False):
    text = row[4]
    if lower and text is not None:
        text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
    return H(*map(enc, (*row[:4], text)))


def tree(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([H(*levels[-1][k:k + 16]) for k in range(0, len(levels[-1]), 16)])
    return levels


def brute(rows, tampered):
    """(doc_id, leaf, subroot, root, proof, folded, verified) of rows (doc_id, source, lang, n_chars, text)."""
    by = {}
    for row in rows:
        by.setdefault(row[1], []).append(row)
    for x in by.values():
        x.sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
    sources = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: tree([leaf(r) for r in by[s]]) for s in sources}
    top = tree([trees[s][-1][0] for s in sources])
    out = []
    for g, s in enumerate(sources):
        for i, row in enumerate(by[s]):
            folded, siblings = leaf(row, tampered(row)), ""
            for levels, place in ((trees[s], i), (top, g)):
                for level in levels[:-1]:
                    run, o = level[place // 16 * 16:place // 16 * 16 + 16], place % 16
                    siblings += "".join(run[:o] + run[o + 1:])
                    folded = H(*run[:o], folded, *run[o + 1:])
                    place //= 16
            root = top[-1][0]
            out.append((row[0], leaf(row), trees[s][-1][0], root, H(siblings), folded, folded == root))
    return sorted(out, key=str)


SCHEMA = "doc_id long, source string, lang string, n_chars long, text string, g int, n int, _salt int, digest int, claimed int"


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, 2, 3, 4, 5) for r in rows], SCHEMA).repartition(6)


def rows_of(df):
    return sorted(((r.doc_id, r.leaf, r.subroot, r.root, r.proof_sha256, r.folded_root, r.verified)
                   for r in df.collect()), key=str)


def make(n, r):
    """A hot source, small ones of 1, 16, 17 rows, a null one, nulls elsewhere, repeated rows."""
    rows = [(k, r.choice(["hot", "hot", "é", "b"]), "en", 5, f"Text {k}") for k in range(n)]
    rows += [(n + k, "s16", None, None, "A" * k) for k in range(16)] + [(n + 50 + k, "s17", "fr", 1, None) for k in range(17)]
    rows += [(None, None, None, None, None), (None, "hot", "x", 2**40, "UPPER É"), (2**60 + 1, "one", "", 0, "")]
    rows += [(3, "hot", "en", 5, "Same")] * 3
    return rows


def test_documents(spark):
    rows = make(700, random.Random(2))
    got = rows_of(merkle.document_proofs(frame(spark, rows), F.col("doc_id") % 5 == 0))
    want = brute(rows, lambda r: r[0] is not None and r[0] % 5 == 0)
    assert got == want
    assert {x[-1] for x in got} == {True, False}


def test_parts_and_subsets(spark, monkeypatch):
    """Parts that cut through groups, and proofs of a few leaves only, fetch what they lack."""
    monkeypatch.setattr(merkle, "PART", 37)
    rows = make(900, random.Random(3))
    want = brute(rows, lambda r: False)
    manifest = merkle.build_manifest(merkle.document_leaves(frame(spark, rows)), "source", "doc_id")
    assert rows_of(merkle.prove(manifest, manifest.leaves, "doc_id")) == want
    few = rows_of(merkle.prove(manifest, manifest.leaves.where("doc_id % 50 = 7"), "doc_id"))
    assert few == [x for x in want if x[0] is not None and x[0] % 50 == 7]


def test_many_groups(spark):
    rows = [(k, f"src{k}", "en", 1, "t") for k in range(300)]
    assert rows_of(merkle.document_proofs(frame(spark, rows))) == brute(rows, lambda r: False)


def test_small_tables(spark):
    one = [(1, "a", "en", 3, "abc")]
    got = rows_of(merkle.document_proofs(frame(spark, one)))
    assert got == brute(one, lambda r: False) and got[0][4] == hashlib.sha256(b"").hexdigest()
    assert merkle.document_proofs(frame(spark, one).where("doc_id = 2")).count() == 0


def test_missing_nodes_are_the_fewest():
    """No node that follows from the part's leaves, and none twice."""
    leaves = pd.DataFrame({"g": 0, "i": np.arange(16, 48), "size": 600})
    found = set(merkle.missing_nodes(leaves, 1).itertuples(index=False, name=None))
    want = {(0, 1, i) for i in range(16) if i not in (1, 2)} | {(0, 2, 1), (0, 2, 2)}
    assert found == want
    whole = pd.DataFrame({"g": 0, "i": np.arange(600), "size": 600})
    assert len(merkle.missing_nodes(whole, 1)) == 0
