"""Words of Arrow string columns as numpy arrays: byte spans, rows and 64-bit hashes.

Separators are ASCII and only A-Z change case, so bytes of UTF-8 give the same
words as code points. A slice of rows is worked on at a time, so memory follows
the slice (or the longest text) and not the Arrow batch.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1 << 20

_U = np.uint64
_P = 0x9E3779B97F4A7C15
_P_INV = pow(_P, -1, 1 << 64)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def _table(keep) -> np.ndarray:
    out = np.zeros(256, dtype=bool)
    out[[b for b in range(256) if keep(b)]] = True
    return out


#: `[^\x20\x09-\x0D]+`
SPACED = _table(lambda b: b != 0x20 and not 0x09 <= b <= 0x0D)
#: `[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`
ALNUM = _table(lambda b: 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80)


def mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser: spreads every input bit over the whole word."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * _U(_P))
_POW = np.ones(1, dtype=np.uint64)
_INV = np.ones(1, dtype=np.uint64)


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers 0..n-1 of the base and of its inverse; kept while small."""
    global _POW, _INV
    if n <= len(_POW):
        return _POW, _INV
    size = max(n, SLICE_BYTES + 1)
    up, down = (np.cumprod(np.concatenate(([_U(1)], np.full(size - 1, _U(p)))), dtype=np.uint64) for p in (_P, _P_INV))
    if size <= 4 * SLICE_BYTES:
        _POW, _INV = up, down
    return up, down


@dataclass
class Words:
    """Words of rows first..first+rows of a batch, in text order."""

    first: int
    rows: int
    data: np.ndarray  # lower-cased bytes of the slice
    start: np.ndarray  # byte positions in data
    end: np.ndarray
    row: np.ndarray  # 0-based within the slice
    hash: np.ndarray
    bound: np.ndarray  # words of row r are bound[r]..bound[r+1]
    offsets: np.ndarray  # bytes of row r are offsets[r]..offsets[r+1]


def text_slices(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes, offsets) of runs of rows of about SLICE_BYTES; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    if not len(column):
        return
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, dtype=np.int64, count=len(column) + 1 + column.offset)[column.offset :]
    data = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.empty(0, np.uint8)
    a = 0
    while a < len(column):
        b = max(a + 1, int(np.searchsorted(offsets, offsets[a] + SLICE_BYTES, side="right")) - 1)
        yield a, data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]
        a = b


def word_slices(column: pa.Array, kind: np.ndarray = SPACED) -> Iterator[Words]:
    for first, raw, offsets in text_slices(column):
        data = _LOWER[raw]
        inside = kind[data]
        # A text ends its last word, whatever follows it in the buffer.
        before = np.zeros(len(data) + 1, dtype=bool)
        before[1:] = inside
        before[offsets] = False
        after = np.zeros(len(data) + 1, dtype=bool)
        after[: len(data)] = inside
        after[offsets] = False
        start = np.flatnonzero(inside & ~before[:-1])
        end = np.flatnonzero(inside & ~after[1:]) + 1
        up, down = _powers(len(data) + 1)
        total = np.zeros(len(data) + 1, dtype=np.uint64)
        np.cumsum(_BYTE[data] * up[: len(data)], out=total[1:])
        hashed = mix((total[end] - total[start]) * down[start] + (end - start).astype(np.uint64))
        bound = np.searchsorted(start, offsets)
        row = np.repeat(np.arange(len(offsets) - 1), np.diff(bound))
        yield Words(first, len(offsets) - 1, data, start, end, row, hashed, bound, offsets)


def shingle_hashes(w: Words, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of k words and the index of each run's first word, rows in order.

    A row of fewer than k words, but not none, has one run: all its words.
    """
    n = len(w.hash)
    count = np.diff(w.bound)
    full = n - k + 1
    if full > 0:
        acc = np.zeros(full, dtype=np.uint64)
        for j in range(k):
            acc = acc * _U(0xD1342543DE82EF95) + w.hash[j : j + full]
        at = np.flatnonzero(w.row[:full] == w.row[k - 1 :])
        acc = mix(acc[at] + _U(k))
    else:
        acc, at = np.empty(0, np.uint64), np.empty(0, np.int64)
    short = np.flatnonzero((count > 0) & (count < k))
    if len(short):
        whole = np.zeros(len(short), dtype=np.uint64)
        for i, r in enumerate(short):
            h = _U(0)
            with np.errstate(over="ignore"):
                for x in w.hash[w.bound[r] : w.bound[r + 1]]:
                    h = h * _U(0xD1342543DE82EF95) + x
                whole[i] = h + _U(count[r])
        at = np.concatenate((at, w.bound[short]))
        acc = np.concatenate((acc, mix(whole)))
        order = np.argsort(at, kind="stable")
        at, acc = at[order], acc[order]
    return acc, at
