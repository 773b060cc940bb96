"""Vectorised text access inside Arrow batches.

A slab is a run of whole documents of one batch whose UTF-8 bytes lie next to each other
in the Arrow buffer, at most about ``max_bytes`` long (a longer document is a slab alone).
Working on slabs keeps numpy temporaries small whatever the batch holds.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash

_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
KEPT_POWERS = 1 << 22
_powers = np.ones(1, dtype=np.uint64)
_inverses = np.ones(1, dtype=np.uint64)


def text_buffers(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """``(bytes, offsets)`` of a string column; a null has the empty range."""
    if col.null_count:
        col = col.fill_null("")
    if not pa.types.is_string(col.type):
        col = col.cast(pa.string())
    if not len(col):
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    _, offs, data = col.buffers()
    off = np.frombuffer(offs, dtype=np.int32, count=len(col) + 1 + col.offset)[col.offset:].astype(np.int64)
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.empty(0, np.uint8)
    return raw, off


def slabs(col: pa.Array, max_bytes: int = 1 << 20) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Yield ``(lo, hi, bytes, offsets)``: rows lo..hi-1, with offsets into ``bytes``."""
    raw, off = text_buffers(col)
    lo, n = 0, len(off) - 1
    while lo < n:
        hi = int(np.searchsorted(off, off[lo] + max_bytes, side="right")) - 1
        hi = min(max(hi, lo + 1), n)
        yield lo, hi, raw[off[lo]:off[hi]], off[lo:hi + 1] - off[lo]
        lo = hi


def _power_table(base: int, size: int) -> np.ndarray:
    p = np.full(size, np.uint64(base), dtype=np.uint64)
    p[0] = 1
    return np.cumprod(p, dtype=np.uint64)


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    global _powers, _inverses
    if n > KEPT_POWERS:      # one very long document: made for it alone, so workers don't hold it for life
        return _power_table(_BASE, n), _power_table(_INVERSE, n)
    if len(_powers) < n:
        size = min(KEPT_POWERS, max(n, 2 * len(_powers)))
        _powers, _inverses = _power_table(_BASE, size), _power_table(_INVERSE, size)
    return _powers[:n], _inverses[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """Finalising avalanche, so that every bit of a polynomial hash is usable."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(29))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(32))


def prefix_hash(symbols: np.ndarray) -> np.ndarray:
    """Polynomial prefix sums H (mod 2**64): the hash of symbols[i:j] is (H[j]-H[i]) * base**-i."""
    p, _ = powers(len(symbols) + 1)
    h = np.zeros(len(symbols) + 1, dtype=np.uint64)
    np.cumsum((symbols.astype(np.uint64) + np.uint64(1)) * p[:-1], out=h[1:], dtype=np.uint64)
    return h


def span_hash(h: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Mixed 64-bit hashes of the spans [start, end), the same wherever the span stands."""
    _, inv = powers(len(h))
    return mix((h[end] - h[start]) * inv[start] + (end - start).astype(np.uint64))


LONG_WORD = 32    # bytes


def word_hash(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit identity of the words [start, end) of a slab.

    A polynomial modulo 2**64 gives some unlike strings one value whatever its base is (Thue-Morse strings
    and their complements, from 1,024 symbols on), so words above ``LONG_WORD`` bytes get XXH3 of their bytes.
    """
    out = span_hash(prefix_hash(data), start, end)
    for i in np.flatnonzero(end - start > LONG_WORD).tolist():
        out[i] = xxhash.xxh3_64_intdigest(data[start[i]:end[i]].tobytes())
    return out


_KIND = np.full(256, 2, dtype=np.uint8)          # other signs
_KIND[[9, 10, 11, 12, 13, 32]] = 0               # white space
for _lo, _hi in ((48, 57), (65, 90), (97, 122), (128, 255)):
    _KIND[_lo:_hi + 1] = 1                       # letters, digits, bytes of other scripts


def tokens(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Tokens of a slab: maximal runs of word bytes or of sign bytes, never across documents.
    Returns ``(start, end, doc)`` arrays."""
    kind = _KIND[data]
    edge = np.ones(len(data) + 1, dtype=bool)
    edge[1:-1] = kind[1:] != kind[:-1]
    edge[off] = True
    cut = np.flatnonzero(edge)
    start, end = cut[:-1], cut[1:]
    keep = kind[start] != 0
    start, end = start[keep], end[keep]
    return start, end, np.searchsorted(off, start, side="right") - 1


def words(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words of a slab: maximal runs of bytes other than ASCII white space, as ``tokens``."""
    space = _KIND[data] == 0
    edge = np.ones(len(data) + 1, dtype=bool)
    edge[1:-1] = space[1:] != space[:-1]
    edge[off] = True
    cut = np.flatnonzero(edge)
    start, end = cut[:-1], cut[1:]
    keep = ~space[start]
    start, end = start[keep], end[keep]
    return start, end, np.searchsorted(off, start, side="right") - 1
