"""Language identification of mixed text: word scores and Viterbi spans.

A word (a run of letters) is scored for each language by the log-probabilities
of its letter trigrams, counted over the whole labelled text. The word's script,
found by code point ranges, narrows the languages to those that are written in
it. Viterbi over the words of a text, with a penalty for each switch, labels
spans; the text's language is that of most of its letters.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandspark.llm.arrays import byte_column, slices

BINS = 1 << 15           # trigram counters of a language
SWITCH = 8.0             # log-score lost by a change of language between words
FOREIGN = 30.0           # log-score lost by a word in a script that a language doesn't use
SHARE = 0.005            # a script with a smaller share of a language's letters isn't its own
UNKNOWN = "und"
BLOCK_CELLS = 400_000    # words times texts of one Viterbi block

# First code points of Unicode script ranges, in order; 0 is Latin and the rest.
SCRIPTS = [(0x0370, 1), (0x0400, 2), (0x0530, 3), (0x0590, 4), (0x0600, 5), (0x0700, 6), (0x0900, 7),
           (0x0980, 8), (0x0A00, 9), (0x0B80, 10), (0x0E00, 11), (0x0E80, 12), (0x0F00, 13), (0x10A0, 14),
           (0x1100, 15), (0x1200, 16), (0x1E00, 0), (0x1F00, 1), (0x2000, 0), (0x3040, 17), (0x30A0, 18),
           (0x3100, 19), (0xAC00, 15), (0xD7B0, 19), (0xFB00, 0), (0xFB1D, 4), (0xFB50, 5), (0xFF00, 0),
           (0x10000, 20), (0x20000, 19), (0x30000, 19)]
N_SCRIPTS = 21

_LETTERS: list[np.ndarray] = []


def _tables() -> tuple[np.ndarray, np.ndarray]:
    """(is a letter, small letter) by code point."""
    if not _LETTERS:
        n = sys.maxunicode + 1
        letter, small = np.zeros(n, bool), np.arange(n, dtype=np.uint32)
        for c in range(n):
            x = chr(c)
            if x.isalpha():
                letter[c] = True
                y = x.lower()
                if len(y) == 1:
                    small[c] = ord(y)
        _LETTERS.extend((letter, small))
    return _LETTERS[0], _LETTERS[1]


@dataclass
class Words:
    """Words of some texts: spans of code points, and the grams of their letters."""
    rows: np.ndarray      # offsets of the texts into the code points
    starts: np.ndarray
    ends: np.ndarray
    at: np.ndarray        # offsets of the texts into the words
    grams: np.ndarray     # trigram bins, one for each letter and one for each word's end
    begin: np.ndarray     # first gram of each word
    script: np.ndarray


def split_words(data: np.ndarray, offsets: np.ndarray) -> Words:
    letter, small = _tables()
    base = offsets[0]
    piece = data[base:offsets[-1]]
    rows = np.concatenate([[0], np.cumsum((piece & 0xC0) != 0x80)])[offsets - base]
    code = np.frombuffer(piece.tobytes().decode().encode("utf-32-le"), "<u4")
    inside = letter[code]
    edge = np.zeros(len(code) + 1, bool)
    edge[rows] = True
    first = inside & (np.concatenate([[True], ~inside[:-1]]) | edge[:-1])[:len(code)]
    last = inside & (np.concatenate([~inside[1:], [True]]) | edge[1:])[:len(code)]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    at = np.searchsorted(starts, rows)
    size = ends - starts
    if not len(starts):
        none = np.zeros(0, np.int64)
        return Words(rows, starts, ends, at, none, none, none)
    # each word's letters between a zero and two: trigrams see both ends
    begin = np.cumsum(size + 1) - (size + 1)
    letters = np.zeros(int((size + 1).sum()), np.uint64)
    slot = np.ones(len(letters), bool)
    slot[begin + size] = False
    letters[slot] = small[code[inside]]
    back1 = np.concatenate([[0], letters[:-1]]).astype(np.uint64)
    back1[begin] = 0
    back2 = np.concatenate([[0], back1[:-1]]).astype(np.uint64)
    back2[begin] = 0
    names = (letters * np.uint64(0x9E3779B1) + back1) * np.uint64(0x85EBCA77) + back2
    grams = ((names * np.uint64(0xC2B2AE3D27D4EB4F)) >> np.uint64(64 - BINS.bit_length() + 1)).astype(np.int64)
    bounds = np.array([x for x, _ in SCRIPTS])
    kind = np.array([0, *(k for _, k in SCRIPTS)])[np.searchsorted(bounds, code[starts], side="right")]
    return Words(rows, starts, ends, at, grams, begin, kind)


@dataclass
class Model:
    languages: list[str]
    scores: np.ndarray    # (BINS, languages), log-probabilities
    foreign: np.ndarray   # (scripts, languages), penalty of a word


def _count_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of this task by language: trigram bins, then letters by script."""
    counts: dict[str, np.ndarray] = {}
    for batch in batches:
        data, offs = byte_column(batch.column("text"))
        lang = batch.column("lang").to_pylist()
        for i, j in slices(offs, 1 << 20):
            w = split_words(data, offs[i:j + 1])
            names = sorted(set(lang[i:j]))
            code = np.array([names.index(x) for x in lang[i:j]])
            word = np.repeat(code, np.diff(w.at))
            size = w.ends - w.starts
            grams = np.bincount(np.repeat(word, size + 1) * BINS + w.grams, minlength=len(names) * BINS)
            scripts = np.bincount(word * N_SCRIPTS + w.script, weights=size, minlength=len(names) * N_SCRIPTS)
            for k, x in enumerate(names):
                own = counts.setdefault(x, np.zeros(BINS + N_SCRIPTS, np.int64))
                own[:BINS] += grams[k * BINS:(k + 1) * BINS]
                own[BINS:] += scripts[k * N_SCRIPTS:(k + 1) * N_SCRIPTS].astype(np.int64)
    for x, own in counts.items():
        used = np.flatnonzero(own)
        yield pa.RecordBatch.from_arrays([pa.array([x] * len(used), pa.string()), pa.array(used), pa.array(own[used])],
                                         names=["lang", "bin", "n"])


def fit(docs: DataFrame) -> Model:
    """A model of the languages of docs (text, lang), counted over all their text.

    Rows without text or lang are left out. What reaches the driver is bounded by
    the number of languages: BINS + N_SCRIPTS counts each."""
    counts = (docs.where("text is not null and lang is not null").select("lang", "text")
              .mapInArrow(_count_rows, "lang string, bin long, n long")
              .groupBy("lang", "bin").agg(F.sum("n").alias("n")).toPandas())
    languages = sorted(set(counts["lang"]))
    table = np.zeros((len(languages), BINS + N_SCRIPTS))
    table[[languages.index(x) for x in counts["lang"]], counts["bin"].to_numpy(dtype=np.int64)] = counts["n"]
    grams, scripts = table[:, :BINS], table[:, BINS:]
    scores = np.log((grams + 0.5) / (grams.sum(axis=1, keepdims=True) + 0.5 * BINS))
    own = scripts > SHARE * np.maximum(scripts.sum(axis=1, keepdims=True), 1)
    # a script that no language uses leaves all of them
    foreign = np.where(own | ~own.any(axis=0), 0.0, FOREIGN)
    return Model(languages, scores.T.astype(np.float32).copy(), foreign.T.astype(np.float32).copy())


def label_words(w: Words, model: Model, switch: float = SWITCH) -> np.ndarray:
    """The language (index) of each word by Viterbi within its text."""
    n, langs = len(w.starts), len(model.languages)
    out = np.zeros(n, np.int16)
    if not n or not langs:
        return out
    score = np.empty((n, langs), np.float32)
    for k in range(langs):
        score[:, k] = np.add.reduceat(model.scores[w.grams, k], w.begin)
    score -= model.foreign[w.script]
    size = np.diff(w.at)
    order = np.argsort(-size, kind="stable")
    order = order[size[order] > 0]
    i = 0
    while i < len(order):   # texts of like length together
        steps = int(size[order[i]])
        rows = order[i:i + max(1, BLOCK_CELLS // steps)]
        i += len(rows)
        own = np.arange(steps)[:, None]
        inside = own < size[rows][None, :]
        cell = np.where(inside, w.at[rows][None, :] + own, 0)
        step = np.where(inside[:, :, None], score[cell], 0)
        back = np.empty((steps, len(rows), langs), np.int16)
        state, every = step[0], np.arange(langs, dtype=np.int16)
        each = np.arange(len(rows))
        for t in range(1, steps):
            best = state.argmax(axis=1)
            other = state[each, best] - switch
            take = other[:, None] > state
            back[t] = np.where(take, best[:, None], every)
            state = np.where(take, other[:, None], state) + step[t]
        at = state.argmax(axis=1)
        for t in range(steps - 1, -1, -1):
            here = inside[t]
            out[cell[t][here]] = at[here]
            at = back[t][each, at] if t else at
    return out


def _label_rows(batches: Iterator[pa.RecordBatch], model: Model, switch: float) -> Iterator[pa.RecordBatch]:
    langs = max(1, len(model.languages))
    names = np.array([*model.languages, UNKNOWN], dtype=object)
    span = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("lang", pa.string())]))
    limit = max(1 << 16, min(1 << 20, (16 << 20) // langs))
    for batch in batches:
        data, offs = byte_column(batch.column("text"))
        preds, shares, spans = [], [], []
        for i, j in slices(offs, limit):
            w = split_words(data, offs[i:j + 1])
            label = label_words(w, model, switch)
            row = np.repeat(np.arange(j - i), np.diff(w.at))
            size = w.ends - w.starts
            mass = np.bincount(row * langs + label, weights=size, minlength=(j - i) * langs).reshape(-1, langs)
            total = mass.sum(axis=1)
            best = np.where((total > 0) & bool(model.languages), mass.argmax(axis=1), len(model.languages))
            preds.append(names[best])
            shares.append(np.where(best < len(model.languages), mass.max(axis=1) / np.maximum(total, 1), 0.0))
            # spans of words with one label
            new = np.flatnonzero(np.concatenate([[True], (row[1:] != row[:-1]) | (label[1:] != label[:-1])])) \
                if len(row) and model.languages else np.zeros(0, np.int64)
            end = np.append(new[1:], len(row)) - 1 if len(new) else new
            parts = pa.StructArray.from_arrays(
                [pa.array((w.starts[new] - w.rows[row[new]]).astype(np.int32)),
                 pa.array((w.ends[end] - w.rows[row[new]]).astype(np.int32)),
                 pa.array(names[label[new]], pa.string())], fields=list(span.value_type))
            bounds = np.searchsorted(row[new], np.arange(j - i + 1)).astype(np.int32)
            spans.append(pa.ListArray.from_arrays(pa.array(bounds), parts, type=span))
        keep = [c for c in batch.schema.names]
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(c) for c in keep),
             pa.array(np.concatenate(preds) if preds else [], pa.string()),
             pa.array(np.concatenate(shares) if shares else [], pa.float64()),
             pa.concat_arrays(spans) if spans else pa.array([], span)],
            names=[*keep, "lang_pred", "score", "spans"])


def identify(docs: DataFrame, model: Model, switch: float = SWITCH) -> DataFrame:
    """docs (a column text, and any others but lang_pred, score and spans, which
    are replaced) with lang_pred, score (the share of letters in spans of that
    language) and spans (start and end in code points, lang).

    A null text, one without a letter, and any text under a model without
    languages is ``und`` with score 0 and no spans. Ties go to the language
    first in order; a word in a script that no language uses is scored for all.
    """
    base = docs.drop("lang_pred", "score", "spans")
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in base.schema.fields)
    return base.mapInArrow(
        lambda it: _label_rows(it, model, switch),
        f"{fields}, lang_pred string, score double, spans array<struct<start:int,end:int,lang:string>>")


def held_out():
    """Documents whose labels are not learned from: crc32 of doc_id as text, modulo 4, is 2."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))
