"""Which windows of L symbols also start in a document with a smaller id: shared frame of the
two substring operators.

A window is found by its anchor, the k-gram inside it with the smallest hash (rightmost among
equals): equal windows have equal anchors at equal places, and consecutive windows share
anchors, so one in about L - k + 1 symbols stands for all.  Documents are dealt once into
parts, and five steps follow, each a grouped map over a part or a bucket of anchors:

1. a part lists its distinct anchors, with the number of distinct segments around each
   (a segment is the run of windows that an anchor stands for) and whether two documents
   of the part hold it;
2. a bucket of anchors finds those held by two documents or more, and those with more
   segments than one task should hold (hot ones), and tells the parts concerned;
3. a part sends the distinct segments of repeated anchors, each with its smallest doc_id.
   A hot anchor's windows are sent one by one, each by the hash of the whole window, so
   only truly equal text meets;
4. a bucket of segments hands the distinct ones to the operator's string index, which
   gives each window the smallest doc_id of all documents that hold it;
5. a part marks the windows whose smallest doc_id is below the document's own.

A passage in a third of all documents costs one entry a part in every step, not one a
document.  Whole copies of a text with a smaller doc_id are found first by content hash and
need no index: all their windows start in the smaller document.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from martlake.llm._common import parts, ship, staged
from martlake.llm.slabs import prefix_hash, slabs, span_hash, text_buffers

LAST = np.int64((1 << 63) - 1)      # the place of a null id: after all others
Symbols = Callable[[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]


@dataclass(frozen=True)
class Plan:
    """``window`` and ``gram`` are L and k in symbols; ``symbols(bytes, offsets)`` gives
    ``(symbol, document offsets, byte start, byte end)``; ``index`` is the operator's own
    string index (step 4), called with ``(symbols, content offsets, smallest id of each content,
    key of each, place of the anchor in each)``, contents sorted by key, and giving for the first
    symbol of every window the smallest id that holds it; ``keep(bytes, byte starts, byte ends,
    mask)`` joins the symbols of a document that stay; ``hot`` is the number of segments above which an anchor is divided
    into single windows."""

    window: int
    gram: int
    symbols: Symbols
    index: Callable[[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray], np.ndarray]
    keep: Callable[[np.ndarray, np.ndarray, np.ndarray, np.ndarray], bytes]
    hot: int = 4096


@dataclass
class Segments:
    """Runs of windows with one anchor: windows first..last (symbol positions), the anchor's
    position and hash, and the document (row of the slab)."""

    first: np.ndarray
    last: np.ndarray
    at: np.ndarray
    key: np.ndarray
    doc: np.ndarray

    def take(self, mask: np.ndarray) -> Segments:
        return Segments(*(getattr(self, n)[mask] for n in ("first", "last", "at", "key", "doc")))


def segments(sym: np.ndarray, off: np.ndarray, h: np.ndarray, plan: Plan) -> Segments:
    """All segments of a slab, in order."""
    window, k = plan.window, plan.gram
    w = window - k + 1
    n = len(sym) - window + 1
    none = np.empty(0, np.int64)
    if n <= 0:
        return Segments(none, none, none, np.empty(0, np.uint64), none)
    start = np.arange(len(sym) - k + 1)
    grams = span_hash(h, start, start + k)
    place = np.uint64((1 << 32) - 1) - start.astype(np.uint64)
    low, size = (grams & np.uint64(0xFFFFFFFF00000000)) | place, 1
    while size * 2 <= w:
        low = np.minimum(low[:len(low) - size], low[size:])
        size *= 2
    if size < w:
        low = np.minimum(low[:n], low[w - size:w - size + n])
    at = ((1 << 32) - 1) - (low[:n] & np.uint64(0xFFFFFFFF)).astype(np.int64)
    doc = np.repeat(np.arange(len(off) - 1), np.diff(off))[:n]
    valid = np.arange(n) + window <= off[1:][doc]
    new = np.ones(n, dtype=bool)
    new[1:] = (at[1:] != at[:-1]) | (doc[1:] != doc[:-1])
    new &= valid
    first = np.flatnonzero(new)
    # a run ends before the next one starts, or where the document has no further window
    stop = np.minimum(np.r_[first[1:], n], off[1:][doc[first]] - window + 1) if len(first) else first
    return Segments(first, stop - 1, at[first], grams[at[first]], doc[first])


def divide(seg: Segments, hot: np.ndarray, h: np.ndarray, plan: Plan) -> Segments:
    """Segments of hot anchors cut into single windows, each under the hash of the whole window:
    such a key has one content, and so one entry a part, however many documents hold it (a
    shorter stretch would have as many contents as it has neighbours)."""
    is_hot = np.isin(seg.key, hot)
    if not is_hot.any():
        return seg
    cold, warm = seg.take(~is_hot), seg.take(is_hot)
    count = warm.last - warm.first + 1
    i = np.repeat(np.arange(len(count)), count)
    first = warm.first[i] + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
    at = warm.at[i]
    key = span_hash(h, first, first + plan.window) ^ (at - first + 1).astype(np.uint64)
    both = [np.r_[getattr(cold, n), x] for n, x in (("first", first), ("last", first), ("at", at), ("key", key),
                                                    ("doc", warm.doc[i]))]
    order = np.argsort(both[0], kind="stable")
    return Segments(*(x[order] for x in both))


def _content(seg: Segments, h: np.ndarray, plan: Plan) -> np.ndarray:
    return span_hash(h, seg.first, seg.last + plan.window)


_SHORT = np.uint64((1 << 48) - 1)      # anchors travel as 48-bit hashes; a clash only adds a comparison


def _to6(x: np.ndarray) -> bytes:
    return np.ascontiguousarray(x.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6]).tobytes()


def _from6(blobs: list[bytes]) -> np.ndarray:
    raw = np.frombuffer(b"".join(blobs), dtype=np.uint8).reshape(-1, 6)
    out = np.zeros((len(raw), 8), dtype=np.uint8)
    out[:, :6] = raw
    return out.view("<u8").ravel()


def _in_sorted(x: np.ndarray, table: np.ndarray) -> np.ndarray:
    if not len(table):
        return np.zeros(len(x), dtype=bool)
    return table[np.minimum(np.searchsorted(table, x), len(table) - 1)] == x


def _runs(*keys: np.ndarray) -> np.ndarray:
    """Starts of the runs of equal keys."""
    new = np.zeros(len(keys[0]), dtype=bool)
    if len(new):
        new[0] = True
    for k in keys:
        new[1:] |= k[1:] != k[:-1]
    return np.flatnonzero(new)


@dataclass
class Part:
    """One part's documents in a fixed order."""

    ids: np.ndarray          # order ids (null last)
    doc_id: pa.Array
    text: pa.Array
    copy: np.ndarray         # whole copies of a text with a smaller id

    @staticmethod
    def open(docs: pa.Table, side: pa.Table) -> Part:
        order = np.lexsort((docs.column("digest").to_numpy(), docs.column("ord").to_numpy()))
        docs = docs.take(pa.array(order))
        ids, digest = docs.column("ord").to_numpy(), docs.column("digest").to_numpy()
        copies = _of_kind(side, 0)
        mark = lambda o, d: o.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) ^ d.view(np.uint64)
        copy = np.isin(mark(ids, digest), mark(copies.column("ord").to_numpy(), copies.column("digest").to_numpy()))
        return Part(ids, _flat(docs.column("doc_id")), _flat(docs.column("text")), copy)

    def slabs(self, plan: Plan) -> Iterator[tuple]:
        for lo, hi, data, off in slabs(self.text, 1 << 18):
            sym, soff, b0, b1 = plan.symbols(data, off)
            yield lo, hi, data, sym, soff, b0, b1, prefix_hash(sym)

    def segments(self, lo: int, sym: np.ndarray, soff: np.ndarray, h: np.ndarray, plan: Plan) -> Segments:
        seg = segments(sym, soff, h, plan)
        seg.key &= _SHORT
        return seg.take(~self.copy[lo + seg.doc])


def _flat(col) -> pa.Array:
    col = col.combine_chunks() if isinstance(col, pa.ChunkedArray) else col
    if isinstance(col, pa.ChunkedArray):
        return col.chunk(0) if col.num_chunks else pa.array([], col.type)
    return col


def _of_kind(side: pa.Table, kind: int) -> pa.Table:
    return side.take(pa.array(np.flatnonzero(side.column("kind").to_numpy() == kind)))


SIDE = "part int, kind int, bucket int, ord long, digest long, a binary, b binary"
_SIDE = pa.schema([("part", pa.int32()), ("kind", pa.int32()), ("bucket", pa.int32()), ("ord", pa.int64()),
                   ("digest", pa.int64()), ("a", pa.binary()), ("b", pa.binary())])


def _step1(plan: Plan, buckets: int):
    schema = pa.schema([("bucket", pa.int32()), ("part", pa.int32()), ("keys", pa.binary()), ("counts", pa.binary()),
                        ("more", pa.binary())])

    def run(docs: pa.Table, side: pa.Table) -> pa.Table:
        if not docs.num_rows:
            return schema.empty_table()
        number, part = docs.column("part")[0].as_py(), Part.open(docs, side)
        found = []
        for lo, _, _, sym, soff, _, _, h in part.slabs(plan):
            seg = part.segments(lo, sym, soff, h, plan)
            found.append((seg.key, _content(seg, h, plan), part.ids[lo + seg.doc]))
        if not found:
            return schema.empty_table()
        key, cont, ids = (np.concatenate(x) for x in zip(*found))
        order = np.lexsort((cont, key, key % np.uint64(buckets)))
        key, cont, ids = key[order], cont[order], ids[order]
        first = _runs(key)
        if not len(first):
            return schema.empty_table()
        fresh = np.zeros(len(key), dtype=np.int64)
        fresh[_runs(key, cont)] = 1
        shared = np.minimum.reduceat(ids, first) != np.maximum.reduceat(ids, first)
        # low seven bits: distinct segments, 127 where the number is in ``more``; high bit: two documents hold it
        many = np.add.reduceat(fresh, first)
        counts = np.minimum(many, 127).astype(np.uint8) | (shared.astype(np.uint8) << 7)
        key = key[first]
        bucket = (key % np.uint64(buckets)).astype(np.int64)
        cut = np.r_[_runs(bucket), len(bucket)]
        return pa.Table.from_pydict({
            "bucket": bucket[cut[:-1]], "part": [number] * (len(cut) - 1),
            "keys": [_to6(key[a:b]) for a, b in zip(cut, cut[1:])],
            "counts": [counts[a:b].tobytes() for a, b in zip(cut, cut[1:])],
            "more": [many[a:b][many[a:b] >= 127].astype("<u4").tobytes() for a, b in zip(cut, cut[1:])]}, schema=schema)

    return run


def _step2(plan: Plan):
    def run(t: pa.Table) -> pa.Table:
        blobs = t.column("keys").to_pylist()
        part = np.repeat(t.column("part").to_numpy(), [len(b) // 6 for b in blobs])
        key = _from6(blobs)
        counts = np.frombuffer(b"".join(t.column("counts").to_pylist()), dtype=np.uint8)
        many = (counts & 127).astype(np.int64)
        many[many == 127] = np.frombuffer(b"".join(t.column("more").to_pylist()), dtype="<u4")
        order = np.lexsort((part, key))
        key, part, counts, many = key[order], part[order], counts[order], many[order]
        first = _runs(key)
        held = np.diff(np.r_[first, len(key)])
        repeated = (held > 1) | (np.maximum.reduceat(counts, first) > 127)
        hot = repeated & (np.add.reduceat(many, first) > plan.hot)
        tell, is_hot = np.repeat(repeated, held), np.repeat(hot, held)
        key, part, is_hot = key[tell], part[tell], is_hot[tell]
        order = np.argsort(part, kind="stable")
        key, part, is_hot = key[order], part[order], is_hot[order]
        cut = np.r_[_runs(part), len(part)] if len(part) else np.zeros(1, np.int64)
        spans = list(zip(cut, cut[1:]))
        n = len(spans)
        return pa.Table.from_pydict({
            "part": part[cut[:-1]], "kind": [1] * n, "bucket": [0] * n, "ord": [0] * n, "digest": [0] * n,
            "a": [_to6(key[a:b]) for a, b in spans], "b": [_to6(key[a:b][is_hot[a:b]]) for a, b in spans]}, schema=_SIDE)

    return run


@dataclass
class Entries:
    """Distinct segments of a part, by bucket, and where they occur."""

    bucket: np.ndarray
    key: np.ndarray
    low: np.ndarray          # smallest order id
    b0: np.ndarray           # bytes in the part's text buffer
    b1: np.ndarray
    at: np.ndarray           # place of the anchor in the segment
    windows: np.ndarray
    seen: list               # per slab: (segments, entry of each)


def _entries(part: Part, side: pa.Table, plan: Plan, buckets: int) -> Entries:
    told = _of_kind(side, 1)
    repeated = np.sort(_from6(told.column("a").to_pylist()))
    hot = np.sort(_from6(told.column("b").to_pylist()))
    rows, kept, base = [], [], 0
    for lo, _, data, sym, soff, b0, b1, h in part.slabs(plan):
        seg = part.segments(lo, sym, soff, h, plan)
        seg = divide(seg.take(_in_sorted(seg.key, repeated)), hot, h, plan)
        kept.append(seg)
        rows.append((seg.key, _content(seg, h, plan), part.ids[lo + seg.doc], base + b0[seg.first],
                     base + b1[seg.last + plan.window - 1], seg.at - seg.first, seg.last - seg.first + 1))
        base += len(data)
    key, cont, ids, b0, b1, at, windows = (np.concatenate(x) for x in zip(*rows))
    bucket = (key % np.uint64(buckets)).astype(np.int64)
    order = np.lexsort((ids, cont, key, bucket))
    first = _runs(key[order], cont[order])
    entry = np.empty(len(key), dtype=np.int64)
    entry[order] = np.repeat(np.arange(len(first)), np.diff(np.r_[first, len(key)]))
    one = order[first]
    cut = np.cumsum([len(s.first) for s in kept])[:-1]
    return Entries(bucket[one], key[one], ids[one], b0[one], b1[one], at[one], windows[one],
                   list(zip(kept, np.split(entry, cut))))


def _step3(plan: Plan, buckets: int):
    schema = pa.schema([("bucket", pa.int32()), ("part", pa.int32()), ("keys", pa.binary()), ("lows", pa.binary()),
                        ("ats", pa.binary()), ("lens", pa.binary()), ("content", pa.binary())])

    def run(docs: pa.Table, side: pa.Table) -> pa.Table:
        if not docs.num_rows:
            return schema.empty_table()
        number, part = docs.column("part")[0].as_py(), Part.open(docs, side)
        e = _entries(part, side, plan, buckets)
        raw, off = text_buffers(part.text)
        raw = raw[off[0]:off[-1]]
        cut = np.r_[_runs(e.bucket), len(e.bucket)]
        rows = {n: [] for n in schema.names}
        for a, b in zip(cut, cut[1:]):
            rows["bucket"].append(int(e.bucket[a]))
            rows["part"].append(number)
            rows["keys"].append(e.key[a:b].tobytes())
            rows["lows"].append(e.low[a:b].tobytes())
            rows["ats"].append(e.at[a:b].astype(np.uint16).tobytes())
            rows["lens"].append((e.b1[a:b] - e.b0[a:b]).astype(np.int32).tobytes())
            rows["content"].append(b"".join([raw[x:y].tobytes() for x, y in zip(e.b0[a:b].tolist(), e.b1[a:b].tolist())]))
        return pa.Table.from_pydict(rows, schema=schema)

    return run


BLOCK = 1 << 19          # bytes of segments indexed at a time; an anchor's segments stay together


def _owners(plan: Plan, data: np.ndarray, off: np.ndarray, key: np.ndarray, low: np.ndarray, at: np.ndarray):
    """Owner of every window of every entry of whole anchors, as runs: ``(entry, length, owner)``."""
    sym, soff, _, _ = plan.symbols(data, off)
    h = prefix_hash(sym)
    cont = span_hash(h, soff[:-1], soff[1:])
    # one of each content under a key, with the smallest id of all parts
    order = np.lexsort((cont, key))
    first = _runs(key[order], cont[order])
    one = order[first]
    lowest = np.minimum.reduceat(low[order], first)
    same = np.empty(len(key), dtype=np.int64)
    same[order] = np.repeat(np.arange(len(first)), np.diff(np.r_[first, len(key)]))
    size = (soff[1:] - soff[:-1])[one]
    usoff = np.r_[0, np.cumsum(size)]
    usym = sym[np.repeat(soff[one] - usoff[:-1], size) + np.arange(usoff[-1])]
    owner = plan.index(usym, usoff, lowest, key[one], at[one])
    windows = (soff[1:] - soff[:-1]) - plan.window + 1
    woff = np.r_[0, np.cumsum(windows)]
    val = owner[np.repeat(usoff[same] - woff[:-1], windows) + np.arange(woff[-1])]
    entry = np.repeat(np.arange(len(key)), windows)
    starts = _runs(val, entry)
    return entry[starts], np.diff(np.r_[starts, len(val)]), val[starts]


def _step4(plan: Plan):
    def run(t: pa.Table) -> pa.Table:
        col = lambda n, kind: np.frombuffer(b"".join(t.column(n).to_pylist()), dtype=kind)
        key, low, at = col("keys", np.uint64), col("lows", np.int64), col("ats", np.uint16).astype(np.int64)
        data, size = col("content", np.uint8), col("lens", np.int32).astype(np.int64)
        off = np.cumsum(size) - size
        order = np.argsort(key, kind="stable")
        first = _runs(key[order])
        ends = np.cumsum(np.add.reduceat(size[order], first))
        block = np.repeat((ends - 1) // BLOCK, np.diff(np.r_[first, len(order)]))
        cut = np.r_[_runs(block), len(order)]
        found = []
        for x, y in zip(cut, cut[1:]):
            some = order[x:y]
            own = np.r_[0, np.cumsum(size[some])]
            part = data[np.repeat(off[some] - own[:-1], size[some]) + np.arange(own[-1])]
            entry, length, owner = _owners(plan, part, own, key[some], low[some], at[some])
            found.append((some[entry], length.astype(np.int32), owner))
        entry, length, owner = (np.concatenate(z) for z in zip(*found))
        back = np.argsort(entry, kind="stable")
        entry, length, owner = entry[back], length[back], owner[back]
        # back to the parts, in the order in which they sent their entries
        sent = np.r_[0, np.cumsum([len(k) // 8 for k in t.column("keys").to_pylist()])]
        cut, n = np.searchsorted(entry, sent), t.num_rows
        return pa.Table.from_pydict({
            "part": t.column("part").to_numpy(), "kind": [2] * n, "bucket": t.column("bucket").to_numpy(),
            "ord": [0] * n, "digest": [0] * n,
            "a": [length[x:y].tobytes() for x, y in zip(cut, cut[1:])],
            "b": [owner[x:y].tobytes() for x, y in zip(cut, cut[1:])]}, schema=_SIDE)

    return run


def _step5(plan: Plan, buckets: int):
    schema = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()),
                        ("kept", pa.binary())])

    def run(docs: pa.Table, side: pa.Table) -> pa.Table:
        if not docs.num_rows:
            return schema.empty_table()
        part = Part.open(docs, side)
        e = _entries(part, side, plan, buckets)
        told = _of_kind(side, 2)
        rows = np.argsort(told.column("bucket").to_numpy(), kind="stable")
        a, b = told.column("a").to_pylist(), told.column("b").to_pylist()
        length = np.frombuffer(b"".join(a[i] for i in rows), dtype=np.int32)
        owner = np.repeat(np.frombuffer(b"".join(b[i] for i in rows), dtype=np.int64), length)
        at = np.r_[0, np.cumsum(e.windows)]
        assert len(owner) == at[-1], "a bucket's answer is missing"
        out = {n: [] for n in schema.names[1:]}
        for (lo, hi, data, sym, soff, b0, b1, _), (seg, entry) in zip(part.slabs(plan), e.seen):
            count = seg.last - seg.first + 1
            step = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
            gone = owner[np.repeat(at[entry], count) + step] < np.repeat(part.ids[lo + seg.doc], count)
            start = (np.repeat(seg.first, count) + step)[gone]
            change = np.bincount(start, minlength=len(sym) + plan.window + 1)
            change[plan.window:] -= np.bincount(start, minlength=len(sym) + plan.window + 1)[:-plan.window]
            covered = np.cumsum(change)[:len(sym)] > 0
            for r in range(hi - lo):
                x, y = int(soff[r]), int(soff[r + 1])
                if part.copy[lo + r] and y - x >= plan.window:
                    covered[x:y] = True
                own = covered[x:y]
                gone_n = int(own.sum())
                out["n"].append(y - x)
                out["n_removed"].append(gone_n)
                out["n_spans"].append(int(own[0]) + int((own[1:] > own[:-1]).sum()) if gone_n else 0)
                out["kept"].append(plan.keep(data, b0[x:y], b1[x:y], ~own))
        return pa.Table.from_pydict({"doc_id": part.doc_id, **out}, schema=schema)

    return run


def remove_repeats(docs: DataFrame, plan: Plan, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, n, n_removed, n_spans, kept)`` for every row: symbols, symbols removed, runs
    of them, and the bytes kept."""
    spark = docs.sparkSession
    ship(spark)
    n = parts(spark)
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    ident = F.col(id_col).cast("long")
    base = docs.select(ident.alias("doc_id"), F.coalesce(ident, F.lit(int(LAST))).alias("ord"), text.alias("text"))
    base = base.withColumn("digest", F.xxhash64("text"))
    part = F.pmod(F.xxhash64("ord", "digest"), F.lit(n)).cast("int").alias("part")
    # the texts are dealt out once; Spark reuses this exchange for steps 1, 3 and 5
    dealt = base.select(part, "doc_id", "ord", "digest", "text").repartition(n, "part")
    marks = base.select(part, "ord", "digest", F.sha2("text", 256).alias("sha"))
    # written apart from the join: a text that a third of the documents share is then split or broadcast
    twice = staged(marks.groupBy("sha").agg(F.min("ord").alias("low"), F.max("ord").alias("high"))
                   .filter("high > low").select("sha", "low"), "repeat-twice")
    copies = staged(marks.join(twice, "sha").filter("ord > low").select("part", "ord", "digest").distinct(), "repeat-copies")
    none = F.lit(None).cast("binary")
    copies = copies.select("part", F.lit(0).alias("kind"), F.lit(0).alias("bucket"), "ord", "digest", none.alias("a"), none.alias("b"))

    def over_parts(side: DataFrame, step, schema: str) -> DataFrame:
        return dealt.groupBy("part").cogroup(side.groupBy("part")).applyInArrow(step, schema)

    anchors = over_parts(copies, _step1(plan, n), "bucket int, part int, keys binary, counts binary, more binary")
    told = copies.union(anchors.groupBy("bucket").applyInArrow(_step2(plan), SIDE))
    sent = over_parts(told, _step3(plan, n), "bucket int, part int, keys binary, lows binary, ats binary, lens binary, content binary")
    answers = sent.groupBy("bucket").applyInArrow(_step4(plan), SIDE)
    return over_parts(told.union(answers), _step5(plan, n), "doc_id long, n long, n_removed long, n_spans long, kept binary")
