"""Language ID: exact Viterbi, held-out accuracy and edge cases."""

import itertools
import random

import numpy as np

from conftest import SF_ORACLE
from demandspark.llm import language_id as L


def toy(text):
    raw = text.encode()
    return L.split_words(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]))


def test_viterbi_against_all_paths():
    r = np.random.default_rng(1)
    model = L.Model(["a", "b", "c"], r.normal(size=(L.BINS, 3)).astype(np.float32),
                    np.zeros((L.N_SCRIPTS, 3), np.float32))
    for text in ("ab cd ef gh", "x", "one two three four five six", "Ä ß 12 é"):
        w = toy(text)
        s = np.array([[model.scores[w.grams[b:e], k].sum() for k in range(3)]
                      for b, e in zip(w.begin, [*w.begin[1:], len(w.grams)])])
        n = len(s)

        def value(path):
            return sum(s[t, k] for t, k in enumerate(path)) - 2.0 * sum(a != b for a, b in zip(path, path[1:]))

        best = max(itertools.product(range(3), repeat=n), key=value)
        assert abs(value(L.label_words(w, model, 2.0)) - value(best)) < 1e-3


def test_words_follow_letters():
    w = toy("ab1c Привет, été")
    assert [(int(s), int(e)) for s, e in zip(w.starts, w.ends)] == [(0, 2), (3, 4), (5, 11), (13, 16)]
    assert list(w.script) == [0, 0, 2, 0]


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF_ORACLE}/documents.parquet")
    model = L.fit(docs.where(~L.held_out()))
    out = L.identify(docs.where(L.held_out()).select("doc_id", "text", "lang"), model).toPandas()
    assert (out["lang"] == out["lang_pred"]).mean() > 0.98


def test_spans_scripts_and_edges(spark):
    r = random.Random(2)
    en, ru, de = "the cat sat on warm mats with others", "кот сидит на тёплом коврике", "über straße schön größer müde"
    train = [(i, " ".join(r.choices(t.split(), k=30)), lang) for i in range(30)
             for t, lang in ((en, "en"), (ru, "ru"), (de, "de"))] + [(99, None, "fr"), (98, "text", None)]
    model = L.fit(spark.createDataFrame(train, "doc_id long, text string, lang string"))
    assert model.languages == ["de", "en", "ru"]
    rows = [(1, f"{en} {ru}"), (2, None), (3, ""), (4, "12 !?"), (5, "日本語"), (5, "日本語"), (None, de),
            (6, (en + " ") * 3000)]
    df = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, score int").repartition(2)
    got = {(x.doc_id, x.text): x for x in L.identify(df, model).collect()}
    assert len(L.identify(df, model).collect()) == len(rows)
    mixed = got[(1, f"{en} {ru}")]
    assert [s.lang for s in mixed.spans] == ["en", "ru"] and mixed.spans[0].end == len(en)
    assert mixed.spans[1].start == len(en) + 1 and mixed.lang_pred == "en" and 0.5 < mixed.score < 0.7
    for key in ((2, None), (3, ""), (4, "12 !?")):
        assert (got[key].lang_pred, got[key].score, got[key].spans) == ("und", 0.0, [])
    assert got[(5, "日本語")].lang_pred in model.languages
    assert got[(None, de)].lang_pred == "de"
    assert got[(6, rows[-1][1])].lang_pred == "en"


def test_no_training_rows(spark):
    df = spark.createDataFrame([(1, "abc")], "doc_id long, text string")
    model = L.fit(spark.createDataFrame([], "doc_id long, text string, lang string"))
    assert L.identify(df, model).first().lang_pred == "und"
    assert L.identify(df.where("doc_id > 1"), model).count() == 0
