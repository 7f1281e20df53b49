"""Token files and packing against the tokenizers library."""

import itertools
import math
import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from demandspark.llm import packing, token_files
from demandspark.llm.tokens import WordEncoder, tokenizer_text
from demandspark.session import shared_dir

SPEC = tokenizer_text()


LIBRARY = Tokenizer.from_str(SPEC)


def ids_of(text):
    return LIBRARY.encode(text or "", add_special_tokens=False).ids


@settings(max_examples=600, deadline=None)
@given(st.lists(st.text(alphabet=st.one_of(st.sampled_from(" \n\t'sStTlLdDrRaAéßΣ1٣½²ªÉ́  \x1c\x85<|>endoftxr,.!"),
                                           st.sampled_from("ÀÖØÞ×÷ßÿ-="), st.characters(exclude_categories=["Cs"])), max_size=30), max_size=5))
def test_encoder_equals_library(texts):
    raw = [t.encode() for t in texts]
    data = np.frombuffer(b"".join(raw), np.uint8)
    offs = np.concatenate([[0], np.cumsum([len(r) for r in raw])]).astype(np.int64)
    ids, at = ENC.encode(data, offs)
    assert [ids[at[i]:at[i + 1]].tolist() for i in range(len(texts))] == [ids_of(t) for t in texts]


ENC = WordEncoder(SPEC)


def rows(n=60):
    r = random.Random(5)
    out = [(i * 3 % 41, " ".join(r.choice(["alpha", "Beta's", "x", "été", "12,5", "the"])
                                 for _ in range(r.choice([0, 3, 40, 700])))) for i in range(n)]
    return out + [(99, None), (99, ""), (None, "no key"), (None, "no key, again"), (7, "<|endoftext|> stays"), (7, "<|endoftext|> stays")]


def test_token_files(spark, monkeypatch):
    monkeypatch.setattr(token_files, "BUCKET_KEYS", 10)
    data = rows()
    df = spark.createDataFrame([(d, t, 1) for d, t in data], "doc_id long, text string, part int").repartition(4)
    path = shared_dir(spark, "tokens")
    token_files.write_token_files(df, path, SPEC)
    expect, at = [], 0
    for d, t in sorted(data, key=lambda x: (x[0] is not None, x[0] or 0, x[1] or "")):
        ids = ids_of(t) + [1]
        expect.append((d, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    got = [(r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in token_files.read_checksums(spark, path).collect()]
    assert sorted(got, key=str) == sorted(expect, key=str)
    assert token_files.read_document(spark, path, None, 1).tolist() == ids_of("no key, again") + [1]
    assert token_files.read_document(spark, path, 7, 0).tolist()[-1] == 1
    assert token_files.read_document(spark, path, 123456) is None


def test_token_files_empty(spark):
    path = shared_dir(spark, "tokens")
    token_files.write_token_files(spark.createDataFrame([], "doc_id long, text string"), path, SPEC)
    assert token_files.read_checksums(spark, path).count() == 0


@pytest.mark.parametrize("n", [1, 2, 3, 4, 50, 3000])
def test_minimal_perfect_hash(n):
    h, g = token_files.key_hashes(np.arange(n), np.zeros(n, np.int64))
    slots = token_files.find_slots(token_files.build_hash(h, g), h, g, n)
    assert sorted(slots) == list(range(n))


@settings(max_examples=200, deadline=None)
@given(st.dictionaries(st.integers(1, 12), st.integers(1, 3), max_size=4), st.integers(0, 25))
def test_fullest_against_all_subsets(counts, room):
    sums = {sum(s * k for s, k in zip(counts, ks)) for ks in itertools.product(*(range(c + 1) for c in counts.values()))}
    used = packing.fullest(counts, room)
    assert all(used[s] <= counts[s] for s in used)
    assert sum(s * m for s, m in used.items()) == max(x for x in sums if x <= room)


def test_packing(spark):
    data = rows()
    df = spark.createDataFrame(data, "doc_id long, text string").repartition(4)
    cap = 64
    got = packing.pack_documents(df, SPEC, capacity=cap).collect()
    pieces = []
    for d, t in data:
        ids = ids_of(t) + [0]
        for p in range(0, len(ids), cap):
            part = ids[p:p + cap]
            pieces.append((d, p // cap, p, len(part), zlib.crc32(np.array(part, "<u4").tobytes())))
    assert sorted(map(str, [(r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got])) == sorted(map(str, pieces))
    bins = {}
    for r in got:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for own in bins.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= cap
    assert len(bins) <= math.ceil(sum(p[3] for p in pieces) / cap) + 2


def test_packing_empty(spark):
    assert packing.pack_documents(spark.createDataFrame([], "doc_id long, text string"), SPEC).count() == 0
