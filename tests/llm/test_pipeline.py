"""The pipeline's stages on given documents, each against a plain version on its own input."""

import re
from collections import Counter

import corpus_pipeline as P
from conftest import SF_SMALL
from demandspark.llm.ngram_join import near_duplicates
from demandspark.session import materialize
from test_lines_and_benchmark import brute_lines, words
from test_ngram_join import brute as brute_groups
from test_tokens import ids_of


def test_stages(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    extra = spark.createDataFrame([(9000, None, "en", "s", 0), (9001, "12 !", "en", "s", 4)], docs.schema)
    docs = docs.unionByName(extra)
    items = [words(r.text) for r in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").collect()]
    columns = docs.columns
    for name, stage in P.STAGES:
        out = materialize(stage(spark, docs, SF_SMALL), name)
        before = {r.doc_id: r.text for r in docs.collect()}
        if name == "best_fit_packing":
            break
        assert out.columns == columns
        after = {r.doc_id: r.text for r in out.collect()}
        if name == "language_id":
            assert after == {d: t for d, t in before.items() if t and re.search("[^\\W\\d_]", t)}
        elif name == "line_dedup":
            expect = {d: k for d, k, n, gone, _ in brute_lines(sorted(before.items()), 3, 50) if gone < n}
            assert after == expect
        elif name == "ngram_jaccard_join":
            assert set(after) == {d for d, n, low in brute_groups(list(before.items())) if n == 0 or d == low}
        else:
            def runs(w):
                return {tuple(w[i:i + 5]) for i in range(len(w) - 4)}

            for d, t in before.items():
                own = runs(words(t))
                share = max((sum(any(tuple(x[j:j + 5]) in own for j in range(max(0, i - 4), i + 1))
                                 for i in range(len(x))) / len(x)) for x in items)
                assert (d in after) == (share < 0.5), (d, share)
        docs = out
    pieces = out.collect()
    tokens = {d: len(ids_of(t)) + 1 for d, t in before.items()}
    assert Counter({d: n for d, n in tokens.items()}) == sum(
        (Counter({r.doc_id: r.length}) for r in pieces), Counter())
    bins = Counter()
    for r in pieces:
        bins[r.sequence_id] += r.length
    assert max(bins.values()) <= 2048 and len(bins) <= -(-sum(tokens.values()) // 2048) + 2


def test_other_results_outlive_the_pipeline(spark):
    """Stages delete only what the pipeline wrote on its way."""
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    found = near_duplicates(docs)
    assert P.run(spark, SF_SMALL).count() >= found.count() / 2
