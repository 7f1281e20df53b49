"""Token ids of whole texts with a public tokenizer, inside Arrow batches.

No token of the word BPE crosses white space, or the border of a letter and an
ASCII digit or mark, so a text's ids are those of such pieces in a row. Each
distinct piece of a slice goes through the tokenizers library once; a bounded
cache keeps the ids of pieces seen before.
"""

from __future__ import annotations

import json
import os
import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from demandspark.llm.arrays import LOWER, byte_column, slices

ENCODE_BYTES = 4 << 20   # bytes of text encoded at once: more repeat each piece more often
CACHE_PIECES = 200_000   # pieces in each of the two generations kept per Python worker

# Byte classes. A cut between a Latin-1 letter and an ASCII digit or mark is a
# cut for the tokenizer as well; GLUE (apostrophes, angle brackets and bars of
# special tokens, all other characters) is never cut from its neighbours.
SPACE, LETTER, MARK, GLUE = 0, 1, 2, 5
CLASS = np.full(256, GLUE, dtype=np.uint8)
CLASS[[9, 10, 11, 12, 13, 32]] = SPACE
CLASS[33:127] = MARK
CLASS[[ord(c) for c in "'<|>"]] = GLUE
CLASS[65:91] = CLASS[97:123] = LETTER
LATIN_LEAD = 0xC3        # lead byte of U+00C0..U+00FF in UTF-8
LATIN_TAIL = np.zeros(256, dtype=bool)
LATIN_TAIL[0x80:0xC0] = True
LATIN_TAIL[[0x97, 0xB7]] = False         # the signs of multiplication and division
PLAIN = re.compile("[a-zß-öø-ÿ]+")
LOWER_TAIL = np.arange(256, dtype=np.uint8)
LOWER_TAIL[0x80:0x9F] += 32

_ENCODERS: dict[int, "WordEncoder"] = {}


def tokenizer_text(name: str = "word_bpe_49k.json") -> str:
    """The JSON of a public tokenizer, read on the driver and sent to the tasks."""
    import public_tokenizers
    with open(public_tokenizers.path(name), encoding="utf-8") as f:
        return f.read()


def byte_classes(data: np.ndarray) -> np.ndarray:
    cls = CLASS[data]
    lead = np.flatnonzero(data[:-1] == LATIN_LEAD)
    lead = lead[LATIN_TAIL[data[lead + 1]]]
    cls[lead] = LETTER
    cls[lead + 1] = LETTER
    return cls


class WordEncoder:
    """Ids of texts, piece by piece."""

    def __init__(self, spec: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.whole = Tokenizer.from_str(spec)
        # for pieces of small letters only: the same model without the steps that leave them as they are
        short = json.loads(spec)
        short["normalizer"], short["added_tokens"] = None, []
        short["pre_tokenizer"] = {"type": "Sequence", "pretokenizers": [
            {"type": "WhitespaceSplit"},
            {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}]}
        self.letters = Tokenizer.from_str(json.dumps(short))
        self.new: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def _add(self, pieces: list[str]) -> None:
        plain, other = [], []
        for w in pieces:
            (plain if PLAIN.fullmatch(w) else other).append(w)
        for w, e in zip(other, self.whole.encode_batch(other, add_special_tokens=False)):
            self.new[w] = array("I", e.ids).tobytes()
        parts = [plain[i:i + 500] for i in range(0, len(plain), 500)]
        for own, e in zip(parts, self.letters.encode_batch([" ".join(x) for x in parts], add_special_tokens=False)):
            raw = array("I", e.ids).tobytes()
            ends = (np.cumsum(np.bincount(e.word_ids, minlength=len(own))) * 4).tolist()
            for w, a, b in zip(own, [0, *ends], ends):
                self.new[w] = raw[a:b]

    def _ids(self, pieces: list[str]) -> list[bytes]:
        if len(self.new) > CACHE_PIECES:
            self.old, self.new = self.new, {}
        missing = []
        for w in pieces:
            if w not in self.new:
                known = self.old.get(w)
                if known is None:
                    missing.append(w)
                else:
                    self.new[w] = known
        if missing:
            self._add(missing)
        return [self.new[w] for w in pieces]

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids as uint32, offsets into them) of the rows data[offsets[i]:offsets[i+1]]."""
        base = offsets[0]
        piece, rows = data[base:offsets[-1]], offsets - base
        if not len(piece):
            return np.zeros(0, np.uint32), np.zeros(len(rows), np.int64)
        cls = byte_classes(piece)
        inside = cls != SPACE
        begins = np.ones(len(piece), bool)
        begins[1:] = (cls[:-1] == SPACE) | (cls[1:] + cls[:-1] == LETTER + MARK)
        begins[rows[rows < len(piece)]] = True
        starts = np.flatnonzero(begins & inside)
        if not len(starts):
            return np.zeros(0, np.uint32), np.zeros(len(rows), np.int64)
        last = inside.copy()
        last[:-1] &= begins[1:] | ~inside[1:]
        sizes = np.flatnonzero(last) + 1 - starts
        # letters of pieces without glue in lower case
        glued = np.zeros(len(starts), bool)
        glued[np.searchsorted(starts, np.flatnonzero(cls == GLUE), side="right") - 1] = True
        owner = np.repeat(glued, sizes)
        text, own = piece[inside], cls[inside]
        plain = (own == LETTER) & ~owner
        tail = plain & (text >= 0x80) & (text != LATIN_LEAD)
        text = np.where(tail, LOWER_TAIL[text], np.where(plain & (text < 0x80), LOWER[text], text))
        words = pa.LargeStringArray.from_buffers(
            len(starts), pa.py_buffer(np.concatenate([[0], np.cumsum(sizes)])), pa.py_buffer(text.astype(np.uint8)))
        coded = words.dictionary_encode()
        which = coded.indices.to_numpy()
        found = self._ids(coded.dictionary.to_pylist())
        size = np.array([len(x) >> 2 for x in found], np.int64)
        flat = np.frombuffer(b"".join(found), "<u4")
        n = size[which]
        upto = np.cumsum(n)
        # 32 bits hold the places in one slice
        shift = ((np.cumsum(size) - size)[which] - (upto - n)).astype(np.int32 if upto[-1] < 1 << 30 else np.int64)
        ids = flat[np.repeat(shift, n) + np.arange(int(upto[-1]), dtype=shift.dtype)]
        before = np.concatenate([[0], upto])
        return ids, before[np.searchsorted(starts, rows)]


def encoder(spec: str) -> WordEncoder:
    key = hash(spec)
    if key not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[key] = WordEncoder(spec)
    return _ENCODERS[key]


def encoded_slices(batch: pa.RecordBatch, column: str, spec: str
                   ) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, ids, offsets) for slices of a batch."""
    data, offs = byte_column(batch.column(column))
    enc = encoder(spec)
    for i, j in slices(offs, ENCODE_BYTES):
        yield i, j, *enc.encode(data, offs[i:j + 1])
