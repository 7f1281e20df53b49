"""License scan against plain Python, with and without the gate."""

import random
import re

from re import _parser

from pyspark.sql import functions as F

from conftest import SF_SMALL
from demandspark.llm.license_scan import BASE, RULES, gate, scan

GAP = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def lower(t):
    return re.sub("[A-Z]", lambda m: m[0].lower(), t or "")


def brute(t):
    words = GAP.findall(lower(t))
    places, base = [], set()
    for phrase, label in BASE.items():
        p = phrase.split()
        own = [i for i in range(len(words)) if words[i:i + len(p)] == p]
        places += own
        base |= {label} if own else set()
    joined = " " + " ".join(words) + " "
    found = []
    for n, r in enumerate(RULES):
        if any(k in joined for k in r.keywords):
            for m in re.finditer(f" ((?:{r.pattern}))(?= )", joined):
                first = joined[:m.start(1)].count(" ") - 1
                found.append((first, -(first + m[1].count(" ")), n, r.label, r.score))
    kept, last, rule = [], -1, -1
    for f, e, n, label, score in sorted(found):
        if -e <= last or (f <= last and n >= rule):
            continue
        kept.append((f, -e, n, label, score))
        last, rule = -e, n
    score = max([0.0, *(k[4] for k in kept)] + [0.9] * bool(places))
    return (len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(base)),
            ",".join(sorted(base | {k[3] for k in kept})), score, kept)


def rows_of(df):
    return {r.doc_id: (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels, r.labels, r.score,
                       [tuple(d) for d in r.detections]) for r in df.collect()}


def test_rules():
    assert 200 <= len(RULES) <= 600
    for r in RULES:
        re.compile(r.pattern)
        assert r.keywords and all(len(re.sub("[^a-z0-9]", "", k)) >= 3 for k in r.keywords), r


def test_against_brute_force(spark):
    r = random.Random(6)
    lines = ["Released under the MIT License.", "Licensed under CC BY-NC 4.0.", "GNU General Public License, version 3",
             "Apache License Version 2.0", "SPDX-License-Identifier: GPL-3.0-or-later", "cc by cc by", "MIT licensé",
             "GNU GENERAL public license or any later version", "All rights reserved", "mit", "cc", "by", "acción apl",
             "Permission is hereby granted, free of charge, to any person obtaining a copy of this software",
             "dual: LGPL v2.1, MPL 1.1; BSD 3-Clause", "creative commons attribution sharealike 4.0", "the cat", "ÀÉ mit",
             "licensed under the terms of the Apache License 2.0 or later", "public domain", "gpl\x01\x02$1"]
    texts = [None, "", "...", *lines] + ["; ".join(r.choice(lines) for _ in range(r.randint(1, 8))) for _ in range(60)]
    texts += ["mit license " * 400, texts[-1]]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = rows_of(scan(df.selectExpr("*", "1 as _words", "2 as labels")))
    for i, t in enumerate(texts):
        assert got[i] == brute(t), t
    plan = scan(df)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Exchange" not in plan


def test_given_documents(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    got = rows_of(scan(docs))
    for d in docs.collect():
        assert got[d.doc_id] == brute(d.text)
    assert scan(docs.where("doc_id < 0")).count() == 0


def sample(tree, k):
    """A match of a parsed pattern: alternative k of each choice, as few repeats as possible."""
    out = ""
    for op, arg in tree:
        match str(op):
            case "LITERAL":
                out += chr(arg)
            case "IN":
                out += "x" if str(arg[0][0]) != "LITERAL" else chr(arg[k % len(arg)][1])
            case "BRANCH":
                out += sample(arg[1][k % len(arg[1])], k)
            case "SUBPATTERN":
                out += sample(arg[3], k)
            case "MAX_REPEAT" | "MIN_REPEAT":
                out += sample(arg[2], k) * arg[0]
            case _:
                raise ValueError(op)
    return out


def test_matches_hold_a_keyword():
    """No rule loses a match for want of its keywords, and none is looked for in plain prose."""
    prose = " the cat and a dog walked along commons and open gates for all the people of magpie class "
    for r in RULES:
        for k in range(12):
            match = sample(_parser.parse(r.pattern), k)
            assert any(word in f" {match} " for word in r.keywords), (r, match)
        assert not any(word in prose for word in r.keywords), r


def test_gate_with_anything_between_words(spark):
    gaps = [" ", "\n", "\n# ", "\n * ", " '", '", "', "-", ",  ", "\r\n// "]
    texts = set()
    for r in RULES:
        for k in range(9):
            match = sample(_parser.parse(r.pattern), k)
            assert re.fullmatch(r.pattern, match)
            texts |= {gap.join(match.split(" ")) for gap in gaps}
    df = spark.createDataFrame([(t,) for t in sorted(texts)], "text string")
    assert [r.text for r in df.where(~gate(F.col("text"))).collect()] == []


def test_wrapped_notices(spark):
    texts = ["This software is provided 'as-is', without any express or implied warranty.",
             "# published by the Free\n# Software Foundation", "released into the public\ndomain",
             "Permission to use, copy, modify, and/or distribute this software for any purpose is hereby\ngranted",
             "free of software", "a public, open domain", "hereby not granted"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = rows_of(scan(df))
    for i, t in enumerate(texts):
        assert got[i] == brute(t), t
    assert [got[i][5] for i in range(7)] == ["zlib", "gpl", "public-domain", "isc", "", "", ""]
