"""Benchmark decontamination by greedy string tiling.

Seeds are the runs of ``min_match`` (five) words of the benchmark items.  A Bloom filter of
the seeds, of a fixed size whatever the benchmark, goes to the executors; documents without a
seed leave in that one pass.  The seeds that the others hold are joined with each item's rarest
ones, as many as a document that reaches the threshold can't miss all of; a pair with too few shared
seeds leaves, so a stock phrase of many items and documents makes no pairs by itself.
A pair is then tiled: matches of both word sequences, found by running Karp-Rabin hashes over
unmarked words and compared word by word, are marked from the longest down, never overlapping, until none of
``min_match`` words is left.  A document is contaminated by an item when the tiles cover
``threshold`` (0.8) of the item's words, in whatever order its passages stand.

Words are runs of ASCII letters and digits and of other non-ASCII characters, lower-cased.
Defined cases: null and empty texts match nothing; an item with fewer than ``min_match`` words
can't be told from chance and matches nothing; null ids of documents are kept in the result,
null or repeated item ids stand for their texts; repeated rows are tested each; empty
documents or an empty benchmark give an empty table; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from martlake.llm._common import fresh, ship, staged
from martlake.llm.slabs import _KIND, prefix_hash, slabs, span_hash, tokens, word_hash

MIN_MATCH = 5
THRESHOLD = 0.8
FILTER_BITS = 25          # the Bloom filter has 2**25 bits (4 MB)
PROBES = 4


def _word_hashes(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash, byte start and document of each word of a slab."""
    start, end, doc = tokens(data, off)
    word = _KIND[data[start]] == 1
    start, end, doc = start[word], end[word], doc[word]
    return word_hash(data, start, end), start, doc


def _seeds(word: np.ndarray, doc: np.ndarray, m: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the runs of ``m`` words, and their documents."""
    if len(word) < m:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    at = np.flatnonzero(doc[m - 1:] == doc[:len(doc) - m + 1])
    return span_hash(prefix_hash(word), at, at + m), doc[at]


def word_ids(text: str | None) -> np.ndarray:
    """Hashed words of one text."""
    data = np.frombuffer((text or "").lower().encode("utf-8", "surrogatepass"), dtype=np.uint8)
    if not len(data):
        return np.empty(0, np.uint64)
    return _word_hashes(data, np.array([0, len(data)]))[0]


class _Runs:
    """The unmarked runs of a given number of words of one text, by running hashes."""

    def __init__(self, words: np.ndarray):
        self.words, self.hash = words, prefix_hash(words)
        self.free = np.ones(len(words), dtype=bool)

    def of(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """Starts and hashes."""
        if len(self.words) < size:
            return np.empty(0, np.int64), np.empty(0, np.uint64)
        marked = np.r_[0, np.cumsum(~self.free)]
        at = np.flatnonzero(marked[size:] == marked[:-size])
        return at, span_hash(self.hash, at, at + size)

    def shares(self, other: _Runs, size: int) -> bool:
        return bool(np.isin(self.of(size)[1], other.of(size)[1]).any())


def _longest(item: _Runs, doc: _Runs, min_match: int, most: int) -> int:
    """The length of the longest unmarked match, at most ``most`` (0: none of ``min_match``):
    a shared run holds shared runs of every smaller length, so the length is bisected."""
    if most < min_match or not item.shares(doc, min_match):
        return 0
    low, high = min_match, most
    while low < high:
        middle = (low + high + 1) // 2
        if item.shares(doc, middle):
            low = middle
        else:
            high = middle - 1
    return low


def _mark(item: _Runs, doc: _Runs, size: int) -> Iterator[tuple[int, int]]:
    """Mark matches of the longest length, by place in the item and then in the document.  A place
    of the document that a tile has taken stays taken, so the places of a run are passed once
    however often it repeats."""
    at, key = item.of(size)
    where, held = doc.of(size)
    order = np.argsort(held, kind="stable")
    held, where = held[order], where[order]
    first = np.searchsorted(held, key)
    here = first < len(held)
    here[here] = held[first[here]] == key[here]
    stop = np.searchsorted(held, key, side="right")
    done: dict[int, int] = {}
    for i, x, y in zip(at[here].tolist(), first[here].tolist(), stop[here].tolist()):
        if not item.free[i:i + size].all():
            continue
        place = done.get(x, x)
        while place < y and not doc.free[where[place]:where[place] + size].all():
            place += 1
        done[x] = place
        # equal hashes of different words are passed over, for this run only
        for j in where[place:y].tolist():
            if doc.free[j:j + size].all() and np.array_equal(item.words[i:i + size], doc.words[j:j + size]):
                item.free[i:i + size] = doc.free[j:j + size] = False
                yield i, j
                break


def tile(item: np.ndarray, doc: np.ndarray, min_match: int = MIN_MATCH) -> list[tuple[int, int, int]]:
    """Tiles ``(start in item, start in doc, words)``, longest first; ties by place.

    Each length costs a bisection and one pass over both texts.  The lengths differ and their sum is at
    most the item's words, so there are at most about sqrt(2 * words) of them, whatever repeats."""
    a, b = _Runs(item), _Runs(doc)
    tiles: list[tuple[int, int, int]] = []
    size = _longest(a, b, min_match, min(len(item), len(doc)))
    while size:
        tiles += [(i, j, size) for i, j in _mark(a, b, size)]
        size = _longest(a, b, min_match, size - 1)
    return tiles


def _probe(seeds: np.ndarray) -> list[np.ndarray]:
    lo = seeds & np.uint64(0xFFFFFFFF)
    hi = seeds >> np.uint64(32)
    return [((lo + np.uint64(k) * hi) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - FILTER_BITS) for k in range(PROBES)]


def _item_seeds(items: DataFrame, m: int) -> DataFrame:
    """``(item, seed, n_words)``: the distinct seeds of each item."""
    def run(batches):
        for b in batches:
            out = {"item": [], "seed": [], "n_words": []}
            for item, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                w = word_ids(text)
                s = np.unique(_seeds(w, np.zeros(len(w), np.int64), m)[0])
                out["item"] += [item] * len(s)
                out["seed"] += s.view(np.int64).tolist()
                out["n_words"] += [len(w)] * len(s)
            yield pa.RecordBatch.from_pydict(out, schema=pa.schema([
                ("item", pa.int64()), ("seed", pa.int64()), ("n_words", pa.int32())]))

    return items.select("item", "text").mapInArrow(run, "item long, seed long, n_words int")


def _bloom(seeds: DataFrame) -> np.ndarray:
    """Filter of all seeds, joined from the tasks' words of 64 bits: 2**19 rows at most
    reach the driver, whatever the number of seeds and tasks."""
    def run(batches):
        for b in batches:
            at = np.unique(np.concatenate(_probe(b.column(0).to_numpy().view(np.uint64))))
            bit = np.uint64(1) << (at & np.uint64(63))
            word = (at >> np.uint64(6)).astype(np.int64)
            first = np.flatnonzero(np.r_[True, word[1:] != word[:-1]]) if len(word) else np.empty(0, np.int64)
            bits = np.bitwise_or.reduceat(bit, first).view(np.int64) if len(first) else np.empty(0, np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(word[first]), pa.array(bits)], names=["word", "bits"])

    rows = (seeds.select("seed").mapInArrow(run, "word long, bits long")
            .groupBy("word").agg(F.bit_or("bits").alias("bits")).toArrow())
    out = np.zeros(1 << (FILTER_BITS - 6), dtype=np.uint64)
    out[rows.column("word").to_numpy()] = rows.column("bits").to_numpy().view(np.uint64)
    return out


def _holders(docs: DataFrame, bloom: np.ndarray, m: int) -> DataFrame:
    """Documents that may hold a seed: ``(doc_id, text, hits)``."""
    def run(batches):
        for b in batches:
            # lower-cased as in word_ids: Arrow's function differs for some letters
            low = pa.array([(t or "").lower() for t in b.column(1).to_pylist()], pa.string())
            rows, hits = [], []
            for lo, _, data, off in slabs(low):
                word, _, doc = _word_hashes(data, off)
                seed, own = _seeds(word, doc, m)
                for k in range(PROBES):
                    at = _probe(seed)[k].astype(np.int64)
                    ok = (bloom[at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1) != 0
                    seed, own = seed[ok], own[ok]
                if len(seed):
                    cut = np.r_[np.flatnonzero(np.r_[True, own[1:] != own[:-1]]), len(own)]
                    for x, y in zip(cut, cut[1:]):
                        rows.append(lo + int(own[x]))
                        hits.append(np.unique(seed[x:y]).view(np.int64).tolist())
            if rows:
                kept = b.take(pa.array(rows))
                yield pa.RecordBatch.from_arrays([kept.column(0), kept.column(1), pa.array(hits, pa.list_(pa.int64()))],
                                                 names=["doc_id", "text", "hits"])

    return docs.mapInArrow(run, "doc_id long, text string, hits array<long>")


MATCH = "doc_id long, digest long, item_id long, n_words int, n_covered int, coverage double, tiles array<struct<item:int,doc:int,words:int>>"


def contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 item_col: str = "item_id", item_text_col: str = "text", min_match: int = MIN_MATCH,
                 threshold: float = THRESHOLD) -> DataFrame:
    """``(doc_id, digest, item_id, n_words, n_covered, coverage, tiles)``: every pair whose
    tiles cover ``threshold`` of the item or more; ``digest`` is xxhash64 of the text."""
    spark = docs.sparkSession
    ship(spark)
    items = benchmark.select(F.col(item_col).cast("long").alias("item_id"), F.col(item_text_col).cast("string").alias("text"))
    items = staged(items.filter("text is not null").distinct().withColumn("item", F.monotonically_increasing_id()), "decontam-items")
    seeds = staged(_item_seeds(items, min_match), "decontam-seeds")
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    # written once, so the row numbers hold
    held = staged(_holders(src, _bloom(seeds), min_match).withColumn("row", F.monotonically_increasing_id()), "decontam-held")
    # n words covered by tiles of min_match or more hold at least n / min_match seeds; a seed
    # that the item repeats counts once, so the bound is that of one for such items
    need = F.when(F.col("n_seeds") == F.col("n_words") - (min_match - 1),
                  F.ceil(threshold * F.col("n_words") / min_match)).otherwise(1).cast("int")
    own = held.select("row", F.explode("hits").alias("seed"))
    held_by = staged(own.groupBy("seed").agg(F.count("*").alias("rows")).join(seeds.select("seed").distinct(), "seed"), "decontam-counts")
    # a document with ``need`` of the n seeds has one of any n - need + 1 of them, so of the rarest
    rare = (seeds.join(held_by, "seed", "left")
            .groupBy("item").agg(F.first("n_words").alias("n_words"), F.count("*").alias("n_seeds"),
                                 F.sort_array(F.collect_list(F.struct(F.coalesce("rows", F.lit(0)).alias("rows"), "seed"))).alias("all"))
            .select("item", need.alias("need"), F.col("all.seed").alias("seeds"),
                    F.slice("all", F.lit(1), F.col("n_seeds").cast("int") - need + 1).alias("rare"))
            .filter(F.size("seeds") >= F.col("need")))
    rare = staged(rare, "decontam-rare")
    probes = rare.select("item", F.explode("rare").alias("rare")).filter("rare.rows > 0").select("item", F.col("rare.seed").alias("seed"))
    # numbers only up to here; the texts join each pair
    pairs = staged(own.join(probes, "seed").select("row", "item").distinct(), "decontam-pairs")
    counted = (pairs.join(rare.select("item", "need", "seeds"), "item").join(held.select("row", "hits"), "row")
               .filter(F.size(F.array_intersect("hits", "seeds")) >= F.col("need")).select("row", "item"))

    def run(batches):
        for b in batches:
            out = []
            for doc_id, digest, text, item_id, item_text in zip(*(b.column(c).to_pylist() for c in range(5))):
                item = word_ids(item_text)
                tiles = tile(item, word_ids(text), min_match)
                covered = sum(t[2] for t in tiles)
                if covered >= threshold * len(item):
                    out.append({"doc_id": doc_id, "digest": digest, "item_id": item_id, "n_words": len(item), "n_covered": covered,
                                "coverage": covered / len(item),
                                "tiles": [dict(zip(("item", "doc", "words"), t)) for t in tiles]})
            schema = pa.schema([("doc_id", pa.int64()), ("digest", pa.int64()), ("item_id", pa.int64()),
                                ("n_words", pa.int32()), ("n_covered", pa.int32()), ("coverage", pa.float64()), ("tiles", pa.list_(pa.struct(
                                    [("item", pa.int32()), ("doc", pa.int32()), ("words", pa.int32())])))])
            yield pa.RecordBatch.from_pylist(out, schema=schema)

    return (counted.join(items.select("item", "item_id", F.col("text").alias("item_text")), "item").join(held, "row")
            .select("doc_id", F.xxhash64("text").alias("digest"), "text", "item_id", "item_text").mapInArrow(run, MATCH))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                      min_match: int = MIN_MATCH, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` (all columns) without the contaminated ones, told by id and text."""
    gone = contaminated(docs, benchmark, id_col, text_col, min_match=min_match, threshold=threshold)
    gone = staged(gone.select("doc_id", "digest").distinct(), "decontam-gone")
    i, d, gi, gd = (fresh(docs, n) for n in ("own_id", "own_digest", "gone_id", "gone_digest"))
    marked = docs.withColumn(i, F.col(id_col).cast("long")).withColumn(d, F.xxhash64(F.col(text_col).cast("string")))
    same = F.col(i).eqNullSafe(F.col(gi)) & (F.col(d) == F.col(gd))
    return marked.join(gone.toDF(gi, gd), same, "left_anti").select(*docs.columns)
