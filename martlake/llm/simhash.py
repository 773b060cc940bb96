"""SimHash near-duplicate groups: binary trie self-join over 64-bit fingerprints.

Distinct fingerprints are first collapsed to their smallest doc_id.  Two fingerprints
within ``max_bits`` agree exactly on one of ``max_bits + 1`` bit segments, so each
fingerprint is rotated to bring every segment to the front once and sent to the subtree
below that segment.  In a subtree the trie is joined with itself: node pairs are walked
together level by level, differing bits are accumulated, and a pair is dropped when it
exceeds the budget.  A subtree above ``subtree_rows`` is cut again by its next bits into
smaller subtrees, and the pairs of those within the budget become tasks of their own.
Each task emits a spanning forest of its links (never all pairs), and Spark joins the
forests into components.

Defined cases: null or wordless text has fingerprint 0 and links like any other; rows with
a null doc_id get a fingerprint and the component of their group, but never name one
(a fingerprint held by null ids alone has a null component); repeated rows are kept; empty input
gives an empty table; other columns of the input are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from martlake.llm._common import fresh, ship, staged
from martlake.llm.components import components

SEED = 42
BITS = 64


def simhash_text(text: str | None, shingle: int = 3) -> int:
    """64-bit SimHash of the word shingles of ``text`` (A-Z lower-cased, repeats counted)."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle:
        h = np.array([xxhash.xxh64_intdigest(joined, SEED)], dtype=np.uint64)
    else:
        size = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
        start = np.zeros(len(words), dtype=np.int64)
        np.cumsum(size[:-1] + 1, out=start[1:])
        end = (start + size)[shingle - 1:].tolist()
        digest = xxhash.xxh64_intdigest
        h = np.fromiter((digest(joined[a:b], SEED) for a, b in zip(start.tolist(), end)),
                        dtype=np.uint64, count=len(end))
    ones = np.zeros(BITS, dtype=np.int64)
    for lo in range(0, len(h), 1 << 16):
        some = h[lo:lo + (1 << 16)].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(some, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(2 * ones > len(h), bitorder="little")
    return int(bits.view(np.uint64)[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3) -> DataFrame:
    """``(doc_id, fp)`` for every row; ``fp`` is the fingerprint as a signed long."""
    ship(docs.sparkSession)

    def run(batches):
        for b in batches:
            fp = np.fromiter((simhash_text(t, shingle) for t in b.column(1).to_pylist()),
                             dtype=np.uint64, count=b.num_rows)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fp.view(np.int64))], names=["doc_id", "fp"])

    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return src.mapInArrow(run, "doc_id long, fp long")


def _segments(max_bits: int) -> list[tuple[int, int]]:
    cuts = [round(i * BITS / (max_bits + 1)) for i in range(max_bits + 2)]
    return [(a, b - a) for a, b in zip(cuts, cuts[1:])]


def _popcount(x: np.ndarray) -> np.ndarray:
    return np.bitwise_count(x).astype(np.int64)


def trie_pairs(fp: np.ndarray, group: np.ndarray, max_bits: int, side: np.ndarray | None = None,
               leaf: int = 64, block: int = 200_000):
    """Yield index arrays ``(i, j)`` of the pairs within ``max_bits`` inside each group.

    ``fp`` (unsigned, sorted inside a group) and ``group`` (contiguous runs) describe one
    binary trie per group.  A node is a run of the sorted array with a common prefix; the
    two children of a node are the runs with bit 0 and bit 1 at the current depth.  With
    ``side`` (0/1, sorted before fp inside a group) only pairs across the sides are wanted.
    """
    n = len(fp)
    if n < 2:
        return
    first = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
    last = np.r_[first[1:], n]
    if side is None:
        alo, ahi, blo, bhi = first, last, first, last
    else:
        ones = np.add.reduceat(side.astype(np.int64), first)
        cut = last - ones
        alo, ahi, blo, bhi = first, cut, cut, last
    stack = [(0, alo, ahi, blo, bhi, np.zeros(len(alo), dtype=np.int64))]
    while stack:
        depth, alo, ahi, blo, bhi, diff = stack.pop()
        if len(alo) > block:
            h = len(alo) // 2
            stack.append((depth, alo[h:], ahi[h:], blo[h:], bhi[h:], diff[h:]))
            alo, ahi, blo, bhi, diff = alo[:h], ahi[:h], blo[:h], bhi[:h], diff[:h]
            stack.append((depth, alo, ahi, blo, bhi, diff))
            continue
        same = alo == blo
        live = np.where(same, ahi - alo > 1, (ahi > alo) & (bhi > blo))
        alo, ahi, blo, bhi, diff, same = (x[live] for x in (alo, ahi, blo, bhi, diff, same))
        if not len(alo):
            continue
        small = (ahi - alo) * (bhi - blo) <= leaf
        if depth >= BITS:
            small[:] = True
        if small.any():
            na, nb = (ahi - alo)[small], (bhi - blo)[small]
            size = na * nb
            at = np.repeat(np.arange(len(size)), size)
            k = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
            i = alo[small][at] + k // nb[at]
            j = blo[small][at] + k % nb[at]
            ok = (_popcount(fp[i] ^ fp[j]) <= max_bits) & (~same[small][at] | (i < j))
            if ok.any():
                yield i[ok], j[ok]
            big = ~small
            alo, ahi, blo, bhi, diff, same = (x[big] for x in (alo, ahi, blo, bhi, diff, same))
            if not len(alo):
                continue
        bit = np.uint64(1) << np.uint64(BITS - 1 - depth)
        acut, bcut = _cut(fp, alo, ahi, bit), _cut(fp, blo, bhi, bit)
        # children: 00 and 11 keep the error count, 01 (and 10 for unlike nodes) add one
        kids = [(alo, acut, blo, bcut, diff), (acut, ahi, bcut, bhi, diff)]
        room = diff < max_bits
        if room.any():
            kids.append((alo[room], acut[room], bcut[room], bhi[room], diff[room] + 1))
            room &= ~same
            kids.append((acut[room], ahi[room], blo[room], bcut[room], diff[room] + 1))
        stack.append((depth + 1, *(np.concatenate(x) for x in zip(*kids))))


def _cut(fp: np.ndarray, lo: np.ndarray, hi: np.ndarray, bit: np.uint64) -> np.ndarray:
    """First index in [lo, hi) whose ``bit`` is set (vectorised bisection)."""
    a, b = lo.copy(), hi.copy()
    while True:
        open_ = a < b
        if not open_.any():
            return a
        mid = (a + b) >> 1
        one = np.zeros(len(a), dtype=bool)
        one[open_] = (fp[mid[open_]] & bit) != 0
        b = np.where(open_ & one, mid, b)
        a = np.where(open_ & ~one, mid + 1, a)


def forest(pairs, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Spanning forest of the links in ``pairs``: at most n - 1 of them, by min-label hooking."""
    label = np.arange(n)
    keep_i, keep_j = [], []
    for i, j in pairs:
        while len(i):
            li, lj = label[i], label[j]
            open_ = li != lj
            i, j, li, lj = i[open_], j[open_], li[open_], lj[open_]
            if not len(i):
                break
            hi, lo = np.maximum(li, lj), np.minimum(li, lj)
            top, at = np.unique(hi, return_index=True)  # one hook for each root: no cycles, as hi > lo
            keep_i.append(i[at])
            keep_j.append(j[at])
            label[top] = lo[at]
            while True:
                up = label[label]
                if (up == label).all():
                    break
                label = up
    if not keep_i:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    return np.concatenate(keep_i), np.concatenate(keep_j)


def _subtree_links(max_bits: int, chunk_rows: int):
    """Stream rows sorted by subtree key, join whole subtrees at a time, emit forests."""
    def solve(key, side, rot, rep):
        order = np.lexsort((rot, side, key))
        key, side, rot, rep = key[order], side[order], rot[order], rep[order]
        first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
        crossed = np.repeat(np.add.reduceat(side.astype(np.int64), first) > 0, np.diff(np.r_[first, len(key)]))
        out = []
        for mask, s in ((~crossed, None), (crossed, side)):
            if mask.any():
                i, j = forest(trie_pairs(rot[mask], key[mask], max_bits, None if s is None else s[mask]), int(mask.sum()))
                out.append((rep[mask][i], rep[mask][j]))
        a, b = (np.concatenate(x) for x in zip(*out))
        return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

    def run(batches):
        held = []
        size = 0
        for batch in batches:
            if not batch.num_rows:
                continue
            cols = [batch.column(c).to_numpy(zero_copy_only=False) for c in range(4)]
            held.append((cols[0], cols[1], cols[2].view(np.uint64), cols[3]))
            size += batch.num_rows
            if size >= chunk_rows:
                key, side, rot, rep = (np.concatenate(x) for x in zip(*held))
                done = int(np.searchsorted(key, key[-1]))  # the last subtree may go on
                if done:
                    yield solve(key[:done], side[:done], rot[:done], rep[:done])
                    held, size = [(key[done:], side[done:], rot[done:], rep[done:])], len(key) - done
                else:
                    held = [(key, side, rot, rep)]
        if held:
            yield solve(*(np.concatenate(x) for x in zip(*held)))

    return run


def links(distinct: DataFrame, max_bits: int = 2, subtree_rows: int = 1000, chunk_rows: int = 65_536) -> DataFrame:
    """``distinct(fp, rep)`` to a forest of links ``(a, b)`` between reps whose fingerprints
    are within ``max_bits``.  ``subtree_rows`` is the size above which a subtree is cut."""
    seg = _segments(max_bits)
    rotated = distinct.select("rep", F.explode(F.array(*[
        F.struct(F.lit(i).alias("s"), F.lit(w).alias("w"),
                 (F.shiftleft("fp", a).bitwiseOR(F.shiftrightunsigned("fp", BITS - a)) if a else F.col("fp")).alias("rot"))
        for i, (a, w) in enumerate(seg)])).alias("x")).select("rep", "x.*")
    rows = rotated.withColumn("head", F.expr("shiftrightunsigned(rot, 64 - w)"))
    hot = (rows.groupBy("s", "head").agg(F.count("*").alias("n")).filter(F.col("n") > subtree_rows)
           .select("s", "head", F.least(F.lit(16), F.ceil(F.log2(F.col("n") / subtree_rows)) + 2).cast("int").alias("d")))
    cut = rows.join(hot, ["s", "head"], "left").withColumn("d", F.coalesce("d", F.lit(0)))
    cut = cut.withColumn("own", F.expr("shiftrightunsigned(rot, 64 - w - d) & (shiftleft(1L, d) - 1)"))
    # the node pairs (own, other) at depth d within the budget; the smaller node names the pair
    flips = F.when(F.col("d") == 0, F.array(F.lit(0).cast("long"))).otherwise(_flips(max_bits))
    pairs = cut.withColumn("other", F.explode(flips)).withColumn("other", F.expr("own ^ other"))
    keyed = pairs.select(
        F.xxhash64("s", "head", F.least("own", "other"), F.greatest("own", "other")).alias("key"),
        F.when(F.col("own") > F.col("other"), 1).otherwise(0).cast("int").alias("side"), "rot", "rep")
    spark = distinct.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ship(spark)
    return (keyed.repartition(n, "key").sortWithinPartitions("key")
            .mapInArrow(_subtree_links(max_bits, chunk_rows), "a long, b long"))


def _flips(max_bits: int):
    """All masks of at most ``max_bits`` bits among the low ``d`` bits."""
    expr = "array(0L)"
    for _ in range(max_bits):
        expr = (f"array_distinct(concat({expr}, flatten(transform({expr}, m -> "
                f"transform(sequence(0, d - 1), k -> m | shiftleft(1L, k))))))")
    return F.expr(expr)


def simhash_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3,
                   max_bits: int = 2) -> DataFrame:
    """``(doc_id, fp, component_id)`` for every row of ``docs``."""
    marks = staged(fingerprints(docs, id_col, text_col, shingle), "simhash-fp")
    distinct = staged(marks.groupBy("fp").agg(F.min("doc_id").alias("rep")), "simhash-distinct")
    named = distinct.filter("rep is not null")
    comp = components(links(named, max_bits))
    # a fingerprint held by null ids alone joins no group
    of_fp = distinct.join(comp, distinct.rep == comp.node, "left").select(
        "fp", F.coalesce("component", "rep").alias("component_id"))
    return marks.join(of_fp, "fp").select("doc_id", "fp", "component_id")


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3,
                         max_bits: int = 2) -> DataFrame:
    """``docs`` (all columns) with one document of each group: the one with the smallest id.

    An id that comes with several texts is as many documents, told apart by fingerprint and, where that is
    the same, by text (the smallest stays); of rows that repeat both id and text one stays.  Rows
    without an id name no group and stay.
    """
    marks = staged(fingerprints(docs, id_col, text_col, shingle).filter("doc_id is not null")
                   .groupBy("doc_id", "fp").agg(F.count("*").alias("n")), "simhash-fp")
    # the nodes are the fingerprints themselves: an id with several texts doesn't join their groups
    distinct = staged(marks.groupBy("fp").agg(F.min("doc_id").alias("low")), "simhash-distinct")
    comp = components(links(distinct.select("fp", F.col("fp").alias("rep")), max_bits))
    first = (distinct.join(comp, distinct.fp == comp.node, "left").groupBy(F.coalesce("component", "fp").alias("group"))
             .agg(F.min(F.struct("low", "fp")).alias("first")).select(F.col("first.low").alias("doc_id"), F.col("first.fp").alias("fp")))
    first = staged(first, "simhash-first")
    # only the ids to go (and ids that repeat) are joined with the texts
    stays = marks.join(first.withColumn("stays", F.lit(1)), ["doc_id", "fp"], "left")
    odd = stays.groupBy("doc_id").agg(F.sum("n").alias("n"), F.count("stays").alias("stays"))
    odd = staged(odd.filter("n > 1 or stays = 0"), "simhash-odd")
    ident = fresh(docs, "simhash_id")
    key = docs.withColumn(ident, F.col(id_col).cast("long"))
    kept = key.join(odd.select(F.col("doc_id").alias(ident)), ident, "left_anti")
    again = odd.filter("n > 1 and stays > 0").select(F.col("doc_id").alias(ident))
    if not again.isEmpty():
        kept = kept.unionByName(_first_of_repeated(key.join(again, ident, "left_semi"), first, ident, text_col, shingle))
    return kept.select(*docs.columns)


def _first_of_repeated(rows: DataFrame, first: DataFrame, ident: str, text_col: str, shingle: int) -> DataFrame:
    """Of rows whose id repeats, those that stay: the ones with an (id, fingerprint) of ``first``, by the
    smallest text of each, once."""
    its_id, its_text = fresh(rows, "simhash_of"), fresh(rows, "simhash_text")
    texts = rows.select(F.col(ident).alias("doc_id"), F.col(text_col).cast("string").alias("text")).distinct()
    texts = staged(texts.withColumn("number", F.monotonically_increasing_id()), "simhash-texts")
    marked = texts.join(fingerprints(texts.select("number", "text"), "number", "text", shingle).toDF("number", "fp"), "number")
    stay = staged(marked.join(first, ["doc_id", "fp"]).groupBy("doc_id", "fp").agg(F.min(F.struct(
        F.col("text").isNull().alias("none"), "text")).alias("t")).select("doc_id", "t.text"), "simhash-stay")
    same = (F.col(ident) == F.col(its_id)) & F.col(text_col).cast("string").eqNullSafe(F.col(its_text))
    return rows.join(stay.toDF(its_id, its_text), same, "left_semi").dropDuplicates([ident, text_col])
