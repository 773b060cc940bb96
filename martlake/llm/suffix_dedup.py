"""Suffix-array dedup of repeated byte strings.

Each byte covered by a 50-byte string that also starts in a document with a smaller doc_id is
removed.  ``repeats`` brings the segments that can hold a common window together; here a
suffix array of the distinct segments, built by linear grouping (``suffix_array``), puts equal
windows next to each other, and each run of them belongs to the smallest doc_id of the run.
Before sorting, a segment leaves when no other segment of its anchor shares one of the longer
stretches (a window less ``STRIDE`` bytes) that an equal window would need.

Defined cases: null text is empty; texts shorter than the window keep all bytes; whole copies
of a text with a smaller id go whole; rows that repeat an id are no copies of each other (only
a smaller id removes); null ids count as larger than any id and not smaller than each other;
an empty table gives an empty table; other columns of the input are ignored.  The kept bytes
may end inside a code point, so they are binary.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame

from martlake.llm.repeats import LAST, Plan, _runs, remove_repeats
from martlake.llm.slabs import prefix_hash, span_hash
from martlake.llm.suffix_array import suffix_array

WINDOW = 50
GRAM = 20
STRIDE = 10
CHUNK = 1 << 15


def _bytes(data: np.ndarray, off: np.ndarray):
    at = np.arange(len(data))
    return data, off, at, at + 1


def _keep(data: np.ndarray, b0: np.ndarray, b1: np.ndarray, mask: np.ndarray) -> bytes:
    if not len(mask):
        return b""
    own = data[b0[0]:b1[-1]]
    return own.tobytes() if mask.all() else own[mask].tobytes()


def _may_share(sym: np.ndarray, off: np.ndarray, key: np.ndarray, at: np.ndarray, window: int, gram: int) -> np.ndarray:
    """Contents with a stretch around the anchor that another content of the key also has."""
    size = np.diff(off)
    top, bottom = at // STRIDE, (at - (size - window)) // STRIDE
    count = top - bottom + 1
    i = np.repeat(np.arange(len(size)), count)
    cls = np.repeat(bottom, count) + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
    # every window with the anchor at a place in [low, high] holds this stretch
    low = cls * STRIDE
    high = np.minimum(low + STRIDE - 1, window - gram)
    a = off[i] + at[i]
    stretch = span_hash(prefix_hash(sym), a - low, a - high + window) ^ cls.astype(np.uint64)
    order = np.lexsort((stretch, key[i]))
    first = _runs(key[i][order], stretch[order])
    more = np.repeat(np.diff(np.r_[first, len(order)]) > 1, np.diff(np.r_[first, len(order)]))
    out = np.zeros(len(size), dtype=bool)
    out[i[order[more]]] = True
    return out


def window_owners(sym: np.ndarray, off: np.ndarray, low: np.ndarray, key: np.ndarray, at: np.ndarray,
                  window: int = WINDOW, gram: int = GRAM) -> np.ndarray:
    """Smallest id of every window (at its first symbol), by suffix arrays over runs of keys."""
    content = np.repeat(np.arange(len(low)), np.diff(off))
    owner = np.full(len(sym), LAST)
    fits = np.arange(len(sym)) + window <= off[1:][content]
    owner[fits] = low[content[fits]]
    sort = np.flatnonzero(_may_share(sym, off, key, at, window, gram)) if len(low) else np.empty(0, np.int64)
    if not len(sort):
        return owner
    # chunks of whole keys, of about CHUNK symbols
    size = np.diff(off)[sort] + 1
    first = _runs(key[sort])
    ends = np.cumsum(np.add.reduceat(size, first))
    chunk = np.repeat((ends - 1) // CHUNK, np.diff(np.r_[first, len(sort)]))
    cut = np.r_[_runs(chunk), len(sort)]
    for x, y in zip(cut, cut[1:]):
        some = sort[x:y]
        n = np.diff(off)[some]
        start = np.r_[0, np.cumsum(n + 1)]
        text = np.zeros(start[-1], dtype=np.int64)           # 0 closes each content
        inner = np.repeat(start[:-1], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        back = np.repeat(off[some], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        text[inner] = sym[back].astype(np.int64) + 1
        where = np.full(len(text), -1)
        where[inner] = back
        sa = suffix_array(text)
        sa = sa[where[sa] >= 0]
        sa = sa[fits[where[sa]]]                             # suffixes that begin a window
        if not len(sa):
            continue
        rows = np.lib.stride_tricks.sliding_window_view(text, window)[sa]
        same = (rows[1:] == rows[:-1]).all(axis=1)
        runs = np.flatnonzero(np.r_[True, ~same])
        at_sym = where[sa]
        least = np.minimum.reduceat(low[content[at_sym]], runs)
        owner[at_sym] = np.repeat(least, np.diff(np.r_[runs, len(sa)]))
    return owner


PLAN = Plan(WINDOW, GRAM, _bytes, window_owners, _keep)


def dedup_bytes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, n_bytes, n_removed, n_spans, kept)`` for every row."""
    return remove_repeats(docs, PLAN, id_col, text_col).withColumnRenamed("n", "n_bytes")
