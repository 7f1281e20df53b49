"""Numpy helpers that read whole Arrow string columns as UTF-8 byte arrays.

Operators that must look at every byte or word of a text run inside
``mapInArrow``: a batch is cut into slices of a few MB (whole texts), and each
slice is handled by array operations over its bytes, so no Python object is
made per word. Memory per task is bounded by the slice size and the longest
single text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 2 << 20   # bytes of text handled at once inside a task

# Odd multipliers of the byte polynomials (golden-ratio constants of public mixers).
MULT_A = np.uint64(0x9E3779B97F4A7C15)
MULT_B = np.uint64(0xC2B2AE3D27D4EB4F)

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def byte_column(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string or binary column; a null is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = pc.fill_null(column, b"" if pa.types.is_binary(column.type) else "")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offs, data = column.buffers()
    offsets = np.frombuffer(offs, dtype=np.int64 if wide else np.int32,
                            count=column.offset + len(column) + 1)[column.offset:].astype(np.int64)
    if data is None:
        return np.zeros(0, np.uint8), offsets
    return np.frombuffer(data, dtype=np.uint8), offsets


def slices(offsets: np.ndarray, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges whose texts hold at most ``limit`` bytes together, or one longer text."""
    start, n = 0, len(offsets) - 1
    while start < n:
        end = int(np.searchsorted(offsets, offsets[start] + limit, side="right")) - 1
        end = min(max(end, start + 1), n)
        yield start, end
        start = end


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser that spreads all bits of a 64-bit value."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def powers(mult: np.uint64, n: int) -> np.ndarray:
    """mult**0 .. mult**(n-1), modulo 2**64."""
    out = np.full(max(n, 1), mult, dtype=np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def runs(mask: np.ndarray, starts_of_rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal True runs that don't cross a row start."""
    if not len(mask):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    cut = np.zeros(len(mask) + 1, dtype=bool)
    cut[starts_of_rows[starts_of_rows <= len(mask)]] = True
    cut[0] = cut[-1] = True
    before = np.empty(len(mask), dtype=bool)
    before[0] = False
    before[1:] = mask[:-1]
    first = mask & (~before | cut[:-1])
    after = np.empty(len(mask), dtype=bool)
    after[-1] = False
    after[:-1] = mask[1:]
    last = mask & (~after | cut[1:])
    return np.flatnonzero(first), np.flatnonzero(last) + 1


_POW: dict[int, np.ndarray] = {}


def run_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray,
               mult: np.uint64 = MULT_A) -> np.ndarray:
    """64-bit hash of each byte run data[starts[i]:ends[i]] (runs in order, apart).

    The runs are handled in blocks, so memory doesn't grow with their total.
    """
    out = np.zeros(len(starts), dtype=np.uint64)
    if not len(starts):
        return out
    longest = int((ends - starts).max())
    table = _POW.get(int(mult))
    if table is None or len(table) < longest + 1:
        table = _POW[int(mult)] = powers(mult, max(64, longest + 1))
    i = 0
    while i < len(starts):
        j = int(np.searchsorted(ends, starts[i] + SLICE_BYTES, side="right"))
        j = max(j, i + 1)
        lo, hi = int(starts[i]), int(ends[j - 1])
        s, e = starts[i:j] - lo, ends[i:j] - lo
        piece = data[lo:hi].astype(np.uint64) + np.uint64(1)
        # the exponent of a byte is its distance from the end of its run
        lens = e - s
        to_end = np.repeat(e, np.diff(np.append(s, hi - lo))) - 1 - np.arange(hi - lo)
        inside = to_end >= 0
        weight = table[np.where(inside, to_end, 0)]
        weight[~inside] = 0
        sums = np.add.reduceat(piece * weight, s)
        out[i:j] = mix64(sums + lens.astype(np.uint64) * MULT_B)
        i = j
    return out


def as_long(x: np.ndarray) -> pa.Array:
    """uint64 values as Spark longs (same bits)."""
    return pa.array(x.view(np.int64))
