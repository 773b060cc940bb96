"""Substring dedup of repeated word passages by prefix-partitioned suffix trees.

Each word covered by a window of 50 words that also starts in a document with a smaller
doc_id is removed.  ``repeats`` deals windows out by their anchor, a run of words inside the
window, and where it is too frequent for one task by the whole window.  In a task the
suffixes are divided by prefixes of variable length until a group fits ``MEMORY`` suffixes,
which a block of ``repeats`` mostly does as it is; the subtree of a group branches level by level, reading as many further
words at once as the group's remaining suffixes leave room for.  Suffixes that stand alone are
leaves and drop out; internal nodes that reach the window's depth are the repeats, and their
smallest doc_id owns the windows below them.

Defined cases: null text has no word; texts shorter than the window keep all words; whole
copies of a text with a smaller id go whole; rows that repeat an id are no copies of each
other (only a smaller id removes); null ids count as larger than any id and not smaller than
each other; an empty table gives an empty table; other columns of the input are ignored.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame

from martlake.llm.repeats import LAST, Plan, _runs, remove_repeats
from martlake.llm.slabs import prefix_hash, span_hash, word_hash, words

WINDOW = 50
GRAM = 8
MEMORY = 1 << 17


def _words(data: np.ndarray, off: np.ndarray):
    start, end, doc = words(data, off)
    return word_hash(data, start, end), np.searchsorted(doc, np.arange(len(off))), start, end


def _keep(data: np.ndarray, b0: np.ndarray, b1: np.ndarray, mask: np.ndarray) -> bytes:
    if not len(mask):
        return b""
    own = data[b0[0]:b1[-1]].tobytes().split()
    return b" ".join(own if mask.all() else [w for w, m in zip(own, mask.tolist()) if m])


def _branch(node: np.ndarray, pos: np.ndarray, h: np.ndarray, depth: int, step: int) -> tuple[np.ndarray, np.ndarray]:
    """Children of each node by the next ``step`` words of its suffixes: suffixes sorted by
    child, and the starts of the children."""
    edge = span_hash(h, pos + depth, pos + depth + step)
    order = np.lexsort((edge, node))
    return order, _runs(node[order], edge[order])


def _groups(pos: np.ndarray, h: np.ndarray, window: int):
    """Suffixes by prefixes of variable length: ``(positions, nodes, prefix length)`` of sets
    of groups that fit the memory together."""
    todo = [(pos, np.zeros(len(pos), dtype=np.int64), 0)]
    while todo:
        at, node, depth = todo.pop()
        if len(at) <= MEMORY or depth >= window:
            yield at, node, depth
            continue
        order, first = _branch(node, at, h, depth, 1)
        size = np.diff(np.r_[first, len(order)])
        # small neighbours share a set; a group above the limit gets a longer prefix
        bins = (np.cumsum(size) - 1) // MEMORY
        cut = np.r_[_runs(bins), len(bins)]
        child = np.repeat(np.arange(len(first)), size)
        for a, b in zip(cut, cut[1:]):
            x, y = first[a], (first[b] if b < len(first) else len(order))
            todo.append((at[order[x:y]], child[x:y], depth + 1))


def window_owners(sym: np.ndarray, off: np.ndarray, low: np.ndarray, key: np.ndarray, at: np.ndarray,
                  window: int = WINDOW) -> np.ndarray:
    """Smallest id of every window (at its first symbol), by suffix trees over variable prefixes."""
    content = np.repeat(np.arange(len(low)), np.diff(off))
    owner = np.full(len(sym), LAST)
    pos = np.flatnonzero(np.arange(len(sym)) + window <= off[1:][content]) if len(sym) else np.empty(0, np.int64)
    own = low[content]
    owner[pos] = own[pos]                                    # a leaf belongs to its own document
    h = prefix_hash(sym)
    for pos, node, depth in _groups(pos, h, window):
        while len(pos) and depth < window:
            step = int(min(window - depth, max(1, MEMORY // len(pos))))
            order, first = _branch(node, pos, h, depth, step)
            size = np.diff(np.r_[first, len(order)])
            inner = np.repeat(size > 1, size)                # leaves drop out
            pos, node = pos[order][inner], np.repeat(np.arange(len(first)), size)[inner]
            depth += step
        if len(pos):
            first = _runs(node)
            owner[pos] = np.repeat(np.minimum.reduceat(own[pos], first), np.diff(np.r_[first, len(pos)]))
    return owner


PLAN = Plan(WINDOW, GRAM, _words, window_owners, _keep)


def dedup_words(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, n_words, n_removed, n_spans, kept)`` for every row; ``kept`` is text."""
    return remove_repeats(docs, PLAN, id_col, text_col).withColumnRenamed("n", "n_words")
