"""Document fingerprints by winnowing.

Every k-gram of code points has a rolling (polynomial) hash; of every window of ``w``
consecutive grams the one with the smallest order value is chosen, the rightmost among
equals, and kept with its position.  So any passage of ``w + k - 1`` code points that two
texts share gives them a common fingerprint entry, and no passage below ``k`` does.  A text
with fewer than ``w`` grams is one window; one shorter than ``k`` is a single gram.

Neighbours in id order (``with_next``) are brought together without an unpartitioned window:
ids are cut at approximate quantiles into one bucket a partition, rows go to their bucket
once, and the first row of each bucket is also sent, as a guest, to the bucket before it.

Defined cases: null text is empty; the empty text has the empty fingerprint; the likeness of
two empty fingerprints is 1, of an empty and another 0; null ids come last in descending
order; repeated ids are ordered by text; a single row is its own next row; empty input gives
an empty table; other columns of the input are ignored.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from martlake.llm._common import parts, ship
from martlake.llm.slabs import prefix_hash, span_hash

GRAM = 16
WINDOW = 33
_SPAN = 1 << 22            # grams of one piece of a very long text
_LOW = np.uint64((1 << 24) - 1)
_RECORD = np.dtype([("hash", "S6"), ("at", ">u4")])


def _choose(grams: np.ndarray, w: int) -> np.ndarray:
    """Positions chosen from the gram hashes of one run, of at most 2**24 grams: the top 40
    bits order them, and of equals the rightmost counts as the smallest."""
    n = len(grams)
    if not n:
        return np.empty(0, np.int64)
    key = (grams & ~_LOW) | (_LOW - np.arange(n, dtype=np.uint64))
    if n <= w:
        low = key.min(keepdims=True)
    else:
        # minimum of every window by doubling: log2(w) passes
        low, size = key, 1
        while size * 2 <= w:
            low = np.minimum(low[:len(low) - size], low[size:])
            size *= 2
        if size < w:
            low = np.minimum(low[:n - w + 1], low[w - size:w - size + n - w + 1])
    at = (_LOW - (low & _LOW)).astype(np.int64)
    return np.unique(at)


def winnow(text: str | None, k: int = GRAM, w: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """``(hashes, positions)`` of the fingerprint of ``text``, by position."""
    codes = np.frombuffer((text or "").encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    n = len(codes)
    if not n:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    if n < k:
        return span_hash(prefix_hash(codes), np.array([0]), np.array([n])), np.zeros(1, np.int64)
    found_h, found_at = [], []
    for lo in range(0, max(1, n - k - w + 2), _SPAN):
        piece = codes[lo:lo + _SPAN + w + k - 2]     # pieces overlap, so no window is cut
        start = np.arange(len(piece) - k + 1)
        grams = span_hash(prefix_hash(piece), start, start + k)
        at = _choose(grams, w)
        found_h.append(grams[at])
        found_at.append(at + lo)
    at, one = np.unique(np.concatenate(found_at), return_index=True)
    return np.concatenate(found_h)[one], at


def pack(hashes: np.ndarray, at: np.ndarray) -> str:
    """Text form: base64 of 10-byte records, the top 48 bits of the hash and the position."""
    rec = np.empty(len(at), dtype=_RECORD)
    rec["hash"] = np.ascontiguousarray(hashes.astype(">u8").view(np.uint8).reshape(-1, 8)[:, :6]).view("S6").ravel()
    rec["at"] = at
    return base64.b64encode(rec.tobytes()).decode()


def likeness(a: frozenset, b: frozenset) -> float:
    """Shared share of two fingerprints (Jaccard)."""
    if not a and not b:
        return 1.0
    return len(a & b) / len(a | b)


def edited(text: str, after: str) -> str:
    """``text`` with its last third replaced by as many first code points of ``after``."""
    cut = len(text) // 3
    return text[:len(text) - cut] + after[:cut]


def with_next(docs: DataFrame, work: Callable[[Iterator[tuple[int | None, str]]], Iterator[pa.RecordBatch]],
              schema: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Run ``work`` over each bucket's rows ``(id, text)`` in descending id order; the last row
    given is the guest that follows the bucket, and after the whole table its first row."""
    spark = docs.sparkSession
    ship(spark)
    n = parts(spark)
    low = -(1 << 63)
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"),
                      F.coalesce(F.col(id_col).cast("long"), F.lit(low)).alias("ord"))
    cuts = np.unique(np.array(src.approxQuantile("ord", [i / n for i in range(1, n)], 0.25 / n) if n > 1 else []))

    @F.pandas_udf("int")
    def bucket(ids: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(cuts, ids.to_numpy(), side="left").astype(np.int32))

    # at most one row a bucket reaches the driver: its largest id
    tops = {r["b"]: r["top"] for r in src.select("ord", bucket("ord").alias("b")).groupBy("b").agg(F.max("ord").alias("top")).collect()}
    order = sorted(tops)
    guest_of = {tops[b]: order[i + 1] if i + 1 < len(order) else order[0] for i, b in enumerate(order)}

    @F.pandas_udf("array<int>")
    def places(ids: pd.Series) -> pd.Series:
        own = np.searchsorted(cuts, ids.to_numpy(), side="left")
        return pd.Series([[int(b), guest_of[i]] if i in guest_of else [int(b)] for i, b in zip(ids, own)])

    spread = (src.withColumn("places", places("ord")).select("doc_id", "text", "ord", F.posexplode("places").alias("guest", "b"))
              .repartitionById(n, F.col("b")).sortWithinPartitions("b", "guest", F.desc("ord"), "text"))

    def run(batches):
        def rows():
            for batch in batches:
                yield from zip(*(batch.column(c).to_pylist() for c in ("b", "guest", "doc_id", "text")))

        group = None
        it = rows()
        row = next(it, None)
        while row is not None:
            group = row[0]

            def bucket_rows():
                nonlocal row
                guest_seen = False
                while row is not None and row[0] == group:
                    if not row[1] or not guest_seen:
                        guest_seen = guest_seen or bool(row[1])
                        yield row[2], row[3] or ""
                    row = next(it, None)

            yield from work(bucket_rows())

    return spread.mapInArrow(run, schema)


def compare_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = GRAM, w: int = WINDOW,
                 batch_rows: int = 512) -> DataFrame:
    """Fingerprints of each text, of its edited text, and their likenesses."""
    names = ("doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next")
    schema = pa.schema([("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()),
                        ("fingerprint", pa.string()), ("edited_fingerprint", pa.string()),
                        ("near_edited", pa.float64()), ("near_next", pa.float64())])

    def work(rows):
        out, held = [], None
        for doc_id, text in rows:
            h, at = winnow(text, k, w)
            marks = frozenset(h.tolist())
            if held is not None:
                was_id, was, packed, was_marks = held
                new = edited(was, text)
                eh, eat = winnow(new, k, w)
                out.append((was_id, len(was), hashlib.sha256(new.encode("utf-8", "surrogatepass")).hexdigest(), packed,
                            pack(eh, eat), likeness(was_marks, frozenset(eh.tolist())), likeness(was_marks, marks)))
                if len(out) >= batch_rows:
                    yield pa.RecordBatch.from_pydict(dict(zip(names, zip(*out))), schema=schema)
                    out = []
            held = doc_id, text, pack(h, at), marks
        if out:
            yield pa.RecordBatch.from_pydict(dict(zip(names, zip(*out))), schema=schema)

    return with_next(docs, work, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
                     "edited_fingerprint string, near_edited double, near_next double", id_col, text_col)
