"""Quality classifier: random-indexing word vectors pooled per document, then a two-layer
numpy network with temperature-calibrated probabilities.

Every token is hashed into one of ``BUCKETS`` word slots, each slot owns a sparse ternary
index vector, and a slot's word vector is the sum of the index vectors of its neighbours
(two on each side) over the whole corpus.  Each task adds up its own slots and sends one
block table; Spark adds the tables, so the vectors cover all documents while what reaches
the driver has a fixed size (``BUCKETS * DIM`` numbers).  A document is pooled into the
frequency-damped mean and spread of its word vectors, the length of its mean index vector
(which measures repetition) and its size.  Both passes work column by column: one column
of all slots fits in a core's cache, the gathered rows of all columns don't.  The network is
fitted on a bounded sample of labelled rows, a fifth of which is held back to fit the
temperature.

Defined cases: null and empty texts have the all-zero pooled vector and get the network's
score for it; training rows of one class only give the constant share of that class; rows
are scored one by one, so repeated rows score alike; empty input gives an empty table.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from martlake.llm._common import ship
from martlake.llm.curve import sigmoid
from martlake.llm.slabs import prefix_hash, slabs, span_hash, tokens

BUCKETS = 1 << 15
DIM = 32
BLOCK = 1024
NONZERO = 4
WINDOW = 2
PIECE = 1 << 17           # tokens handled at a time
DAMP = 1e-3
FIELD = 26                # bits from one whole number to the next in a packed pair


@lru_cache(1)
def index_vectors() -> np.ndarray:
    """The fixed sparse ternary index vector of every slot."""
    rng = np.random.default_rng(20240607)
    at = np.argsort(rng.random((BUCKETS, DIM)), axis=1)[:, :NONZERO]
    out = np.zeros((BUCKETS, DIM), dtype=np.float32)
    np.put_along_axis(out, at, rng.choice(np.float32([-1, 1]), size=at.shape), axis=1)
    return out


@lru_cache(1)
def _index_pairs() -> np.ndarray:
    """Columns of the index vectors two at a time, ``a + b * 2**FIELD``, and a zero for no slot.
    Sums of up to ``2 * WINDOW * PIECE`` of them are exact, and so is ``_unpacked``."""
    index = index_vectors().astype(np.float64)
    return np.pad((index[:, ::2] + np.ldexp(index[:, 1::2], FIELD)).T, ((0, 0), (0, 1)))


def _unpacked(sums: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    high = np.rint(np.ldexp(sums, -FIELD))
    return sums - np.ldexp(high, FIELD), high


def _slots(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    start, end, doc = tokens(data, off)
    return (span_hash(prefix_hash(data), start, end) >> np.uint64(49)).astype(np.int64), doc


def _context_sums(batches):
    """One task's table: for each slot the summed index vectors of its neighbours, and its count."""
    pairs = _index_pairs()
    total = np.zeros((DIM + 1, BUCKETS), dtype=np.float64)
    seen = False
    for b in batches:
        for _, _, data, off in slabs(b.column(0)):
            all_slots, all_docs = _slots(data, off)
            seen = seen or len(all_slots) > 0
            for p in range(0, len(all_slots), PIECE):     # with the neighbours on both sides
                left = max(0, p - WINDOW)
                slot, doc = all_slots[left:p + PIECE + WINDOW], all_docs[left:p + PIECE + WINDOW]
                # empty places before, between and after the documents keep them apart
                place = np.arange(len(slot)) + WINDOW * (doc - doc[0] + 1)
                spaced = np.full(place[-1] + 1 + WINDOW, BUCKETS)
                spaced[place] = slot
                own = slice(p - left, p - left + PIECE)
                slot, place = slot[own], place[own]
                for i, column in enumerate(pairs):
                    vec = column.take(spaced)
                    around = np.zeros(len(vec) - 2 * WINDOW)
                    for k in range(2 * WINDOW + 1):
                        if k != WINDOW:
                            around += vec[k:k + len(around)]
                    low, high = _unpacked(np.bincount(slot, weights=around[place - WINDOW], minlength=BUCKETS))
                    total[2 * i] += low
                    total[2 * i + 1] += high
                total[DIM] += np.bincount(slot, minlength=BUCKETS)
    if seen:
        total = total.T
        # sums of small integers: exact in any order of addition
        rows = total.astype(np.int64).astype(np.int32) if np.abs(total).max() < 2**31 else total.astype(np.int64)
        blocks = range(BUCKETS // BLOCK)
        yield pa.RecordBatch.from_pydict({
            "block": pa.array(list(blocks), pa.int32()),
            "wide": pa.array([rows.dtype.itemsize] * len(blocks), pa.int32()),
            "sums": [rows[i * BLOCK:(i + 1) * BLOCK].tobytes() for i in blocks]})


def _add_blocks(batches):
    held: dict[int, np.ndarray] = {}
    for b in batches:
        for block, wide, sums in zip(*(c.to_pylist() for c in b.columns)):
            x = np.frombuffer(sums, dtype=np.int32 if wide == 4 else np.int64).astype(np.int64)
            held[block] = held[block] + x if block in held else x
    if held:
        yield pa.RecordBatch.from_pydict({
            "block": pa.array(list(held), pa.int32()), "sums": [x.tobytes() for x in held.values()]})


@dataclass(frozen=True)
class WordVectors:
    vectors: np.ndarray   # BUCKETS x DIM, unit length or zero
    weights: np.ndarray   # BUCKETS, frequency damping

    def features(self, col: pa.Array) -> np.ndarray:
        """Pooled features of every text of a string column."""
        w, v = self.weights[:, None], self.vectors
        columns = np.ascontiguousarray(np.hstack([w, v * w, v * v * w]).T)
        out = np.zeros((len(col), 2 * DIM + 4), dtype=np.float32)
        for lo, hi, data, off in slabs(col):
            slots, docs = _slots(data, off)
            # sums of each document: tokens, weights, vectors, their squares, index vectors
            total = np.zeros((2 + 3 * DIM, hi - lo))
            for p in range(0, len(slots), PIECE):
                slot, doc = slots[p:p + PIECE], docs[p:p + PIECE]
                first = np.flatnonzero(np.r_[True, doc[1:] != doc[:-1]])
                own = doc[first]
                total[0, own] += np.diff(np.r_[first, len(slot)])
                for i, column in enumerate(columns):
                    total[1 + i, own] += np.add.reduceat(column.take(slot), first, dtype=np.float64)
                for i, column in enumerate(_index_pairs()):
                    low, high = _unpacked(np.add.reduceat(column.take(slot), first))
                    total[2 + 2 * DIM + 2 * i, own] += low
                    total[3 + 2 * DIM + 2 * i, own] += high
            total = np.ascontiguousarray(total.T)
            at = np.flatnonzero(total[:, 0])
            sw, n = np.maximum(total[at, 1:2], 1e-9), total[at, :1]
            mean, square, own = total[at, 2:2 + DIM] / sw, total[at, 2 + DIM:2 + 2 * DIM] / sw, total[at, 2 + 2 * DIM:] / n
            out[lo + at] = np.hstack([
                mean, np.sqrt(np.maximum(square - mean * mean, 0)), np.sqrt((own * own).sum(axis=1, keepdims=True)),
                np.sqrt((mean * mean).sum(axis=1, keepdims=True)), np.log1p(n), np.log(np.maximum(sw / n, 1e-6))])
        return out


def learn_vectors(docs: DataFrame, text_col: str = "text") -> WordVectors:
    """Random-indexing word vectors over every text of ``docs``."""
    ship(docs.sparkSession)
    tables = (docs.select(F.col(text_col).cast("string").alias("text"))
              .mapInArrow(_context_sums, "block int, wide int, sums binary"))
    added = tables.repartition(BUCKETS // BLOCK, "block").mapInArrow(_add_blocks, "block int, sums binary").collect()
    total = np.zeros((BUCKETS, DIM + 1))
    for r in added:
        total[r["block"] * BLOCK:(r["block"] + 1) * BLOCK] += (
            np.frombuffer(r["sums"], dtype=np.int64).reshape(BLOCK, DIM + 1))
    size = np.sqrt((total[:, :DIM] ** 2).sum(axis=1, keepdims=True))
    share = total[:, DIM] / max(total[:, DIM].sum(), 1)
    return WordVectors((total[:, :DIM] / np.maximum(size, 1e-9)).astype(np.float32),
                       (DAMP / (DAMP + share)).astype(np.float32))


@dataclass(frozen=True)
class Network:
    centre: np.ndarray
    scale: np.ndarray
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: float
    temperature: float

    def logits(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.centre) / self.scale, -8, 8)
        return np.tanh(z @ self.w1 + self.b1) @ self.w2 + self.b2

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        return sigmoid(self.logits(x).astype(np.float64) / self.temperature)


def train_network(x: np.ndarray, y: np.ndarray, hidden: int = 24, epochs: int = 60, step: float = 3e-3,
                  decay: float = 1e-4, seed: int = 11) -> Network:
    """Two layers (tanh, logistic) by Adam on four fifths of the rows; the temperature
    minimises the log loss on the other fifth."""
    f = x.shape[1] if x.ndim == 2 and len(x) else 2 * DIM + 4
    if not len(y) or y.min() == y.max():
        share = min(max(float(y.mean()) if len(y) else 0.5, 0.01), 0.99)
        return Network(np.zeros(f), np.ones(f), np.zeros((f, 1)), np.zeros(1), np.zeros(1),
                       float(np.log(share / (1 - share))), 1.0)
    rng = np.random.default_rng(seed)
    order = rng.permutation(len(y))
    held, own = order[:len(y) // 5], order[len(y) // 5:]
    centre, scale = x[own].mean(axis=0), x[own].std(axis=0) + 1e-3
    z = np.clip((x - centre) / scale, -8, 8)
    p = [rng.normal(0, 1 / np.sqrt(f), (f, hidden)), np.zeros(hidden), rng.normal(0, 0.1, hidden), np.zeros(1)]
    m, v, t = [np.zeros_like(a) for a in p], [np.zeros_like(a) for a in p], 0
    for _ in range(epochs):
        for at in np.array_split(rng.permutation(own), max(1, len(own) // 128)):
            a = np.tanh(z[at] @ p[0] + p[1])
            err = (sigmoid(a @ p[2] + p[3][0]) - y[at]) / len(at)
            back = err[:, None] * p[2] * (1 - a * a)
            grads = [z[at].T @ back + decay * p[0], back.sum(axis=0), a.T @ err + decay * p[2], np.array([err.sum()])]
            t += 1
            for i, g in enumerate(grads):
                m[i] = 0.9 * m[i] + 0.1 * g
                v[i] = 0.999 * v[i] + 0.001 * g * g
                p[i] = p[i] - step * (m[i] / (1 - 0.9 ** t)) / (np.sqrt(v[i] / (1 - 0.999 ** t)) + 1e-8)
    net = Network(centre, scale, p[0], p[1], p[2], float(p[3][0]), 1.0)
    at = held if len(held) else own
    raw = net.logits(x[at])

    def loss(temp: float) -> float:
        q = np.clip(sigmoid(raw / temp), 1e-9, 1 - 1e-9)
        return float(-(y[at] * np.log(q) + (1 - y[at]) * np.log(1 - q)).mean())

    grid = np.exp(np.linspace(np.log(0.25), np.log(8), 81))
    return Network(centre, scale, p[0], p[1], p[2], float(p[3][0]), float(min(grid, key=loss)))


@dataclass(frozen=True)
class QualityModel:
    words: WordVectors
    network: Network


def fit(docs: DataFrame, sample: DataFrame, text_col: str = "text", label_col: str = "label") -> QualityModel:
    """Word vectors over all of ``docs``, network over ``sample`` (text, label), which the
    caller bounds (``labelled_sample``)."""
    words = learn_vectors(docs, text_col)

    def rows(batches):
        for b in batches:
            x = words.features(b.column(0))
            yield pa.RecordBatch.from_pydict({"x": [r.tobytes() for r in x], "y": b.column(1)})

    got = (sample.select(F.col(text_col).cast("string").alias("text"), F.col(label_col).cast("int").alias("y"))
           .mapInArrow(rows, "x binary, y int").toPandas())
    got = got.sort_values(["y", "x"])  # a fixed order, whatever the partitions were
    x = np.frombuffer(b"".join(got["x"]), dtype=np.float32).reshape(len(got), -1) if len(got) else np.empty((0, 0))
    return QualityModel(words, train_network(x, (got["y"] > 0).to_numpy(dtype=float)))


def add_score(docs: DataFrame, model: QualityModel, text_col: str = "text", out: str = "score") -> DataFrame:
    """``docs`` with ``out``: the calibrated probability that the text is of high quality."""
    ship(docs.sparkSession)

    @F.pandas_udf("double")
    def scored(s: pd.Series) -> pd.Series:
        return pd.Series(model.network.probabilities(model.words.features(pa.array(s, pa.string(), from_pandas=True))))

    return docs.withColumn(out, scored(F.col(text_col).cast("string")))
