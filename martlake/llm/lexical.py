"""Ranked lexical search by dense blocked matrix products.

Items (queries) are dealt into blocks whose terms are bounded in bytes (``BLOCK_BYTES``); only
a block's vocabulary goes to the executors.  For each block

1. one pass over the documents turns every text into its number of terms and the compact list
   of (term of the block, occurrences), written once;
2. the corpus figures (documents with terms, all terms, documents of each term) are summed from
   that table by Spark;
3. a second pass over the compact table multiplies tiles: ``TILE`` documents by the columns of
   an item tile (the terms that its ``ITEMS`` items hold, at most ``WIDTH`` columns a product),
   in float64 through BLAS.  Impacts are below 10^6, and a column tile ends where an item's
   weights in it would pass ``2**53 / 10**6``, so every partial sum is a whole number below
   2^53 and exact; the sums of column tiles are added as 64-bit integers;
4. each partition keeps an item's best documents: a tile offers every document that reaches the
   item's current last score, equal scores included, and the surplus is cut by (score, doc_id).
   The partitions' lists meet in two steps, by (item, hash of the document) and by item.

Weights: ``w = floor(1000 ln((2N+2) / (2 df+1)))``; a document's length norm is
``m = 25 + (75 n N) div L``; a term adds ``w * ((10^9 tf) div (1000 tf + 8 m))`` for each of its
occurrences in the item.

Defined cases: null and empty texts have no terms and are never found; an item without terms
has no rows; a null doc_id comes after all others of its score; repeated rows are documents of
their own; items that repeat both id and text are one item, with another text an item of its
own under the same id; empty tables give an empty result; other columns are ignored.
"""

from __future__ import annotations

import math
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from martlake.llm._common import ship, staged
from martlake.llm.slabs import text_buffers

TOP = 10
BLOCK_BYTES = 16 << 20    # terms of one item block, with 64 bytes for each
ITEMS = 64                # items of a tile
WIDTH = 1024              # columns of a product
TILE = 512                # documents of a tile
IMPACT = 1_000_000        # impacts are below this
ROOM = (1 << 53) // IMPACT
SALTS = 32

# A-Z to a-z, other ASCII signs to a space; letters, digits and bytes of other scripts stay
_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256))


def terms(raw: np.ndarray) -> list[bytes]:
    """Terms of one text given as UTF-8 bytes."""
    return raw.tobytes().translate(_FOLD).split()


def weight(docs: int, holders: int) -> int:
    return math.floor(1000 * math.log((2 * docs + 2) / (2 * holders + 1)))


def _item_terms(items: DataFrame) -> DataFrame:
    """``(item, item_id, term, times)`` of every item."""
    schema = pa.schema([("item", pa.int64()), ("item_id", pa.int64()), ("term", pa.string()), ("times", pa.int64())])

    def run(batches):
        for b in batches:
            raw, off = text_buffers(b.column(2))
            for i, (item, item_id) in enumerate(zip(b.column(0).to_pylist(), b.column(1).to_pylist())):
                found: dict[bytes, int] = {}
                for t in terms(raw[off[i]:off[i + 1]]):
                    found[t] = found.get(t, 0) + 1
                yield pa.RecordBatch.from_arrays(
                    [pa.array([item] * len(found), pa.int64()), pa.array([item_id] * len(found), pa.int64()),
                     pa.array([t.decode() for t in found], pa.string()), pa.array(list(found.values()), pa.int64())], schema=schema)

    return items.select("item", "item_id", "text").mapInArrow(run, "item long, item_id long, term string, times long")


def _postings(docs: DataFrame, vocabulary) -> DataFrame:
    """``(doc_id, n, ids, tfs)``: all terms' number, and the block's terms with occurrences."""
    schema = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("ids", pa.binary()), ("tfs", pa.binary())])

    def run(batches):
        number = {t: i for i, t in enumerate(vocabulary.value)}
        for b in batches:
            raw, off = text_buffers(b.column(1))
            n, ids, tfs = [], [], []
            for i in range(b.num_rows):
                words = terms(raw[off[i]:off[i + 1]])
                own = np.fromiter(map(number.get, words, repeat(-1)), np.int32, len(words))
                own, times = np.unique(own[own >= 0], return_counts=True)
                n.append(len(words))
                ids.append(own.astype("<i4").tobytes())
                tfs.append(times.astype("<i8").tobytes())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n, pa.int64()), pa.array(ids, pa.binary()), pa.array(tfs, pa.binary())],
                                             schema=schema)

    return docs.mapInArrow(run, "doc_id long, n long, ids binary, tfs binary")


def _holders(postings: DataFrame, size: int) -> np.ndarray:
    """Documents of each term of the block: a count for every term and partition, summed by Spark."""
    def run(batches):
        total = np.zeros(size, np.int64)
        for b in batches:
            ids = np.frombuffer(b"".join(b.column(0).to_pylist()), "<i4")
            total += np.bincount(ids, minlength=size)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(total[at], pa.int64())], names=["id", "c"])

    counts = (postings.select("ids").mapInArrow(run, "id long, c long").groupBy("id").agg(F.sum("c").alias("c"))).toPandas()
    out = np.zeros(size, np.int64)
    out[counts["id"].to_numpy(np.int64)] = counts["c"].to_numpy(np.int64)
    return out


def column_tiles(entries: list[tuple[int, int, int]], width: int = WIDTH, room: int = ROOM) -> list[tuple]:
    """Cut the (term, item, weight) entries of an item tile into column tiles.

    Each is ``(columns, row of each entry, item of each entry, weights)`` with at most ``width`` columns, ascending,
    in which no item's weights add up to more than ``room``.  A weight above ``room`` is
    shared among several tiles.
    """
    layers: dict[tuple[int, int], list[tuple[int, int]]] = {}
    for term, item, w in entries:
        layer = 0
        while w > 0:
            layers.setdefault((layer, term), []).append((item, min(w, room)))
            w -= room
            layer += 1
    tiles, cols, sums = [], {}, {}

    def close():
        if cols:
            flat = [(k, item, w) for k, own in enumerate(cols.values()) for item, w in own]
            tiles.append((np.array(list(cols), np.int32), *(np.array(x) for x in zip(*flat))))

    last = 0
    for (layer, term), own in sorted(layers.items()):
        if len(cols) == width or layer != last or any(sums.get(i, 0) + w > room for i, w in own):
            close()
            cols, sums, last = {}, {}, layer
        cols[term] = own
        for i, w in own:
            sums[i] = sums.get(i, 0) + w
    close()
    return tiles


def impacts(n: np.ndarray, row: np.ndarray, tf: np.ndarray, docs: int, length: int) -> np.ndarray:
    """Impact of each posting; ``n`` per document, ``row`` and ``tf`` per posting."""
    m = np.array([25 + 75 * x * docs // length for x in n.tolist()], np.int64)
    return (1_000_000_000 * tf) // (1000 * tf + 8 * m[row])


def _best(found: list[tuple], top: int) -> list[tuple]:
    """The ``top`` (score, doc_id) by score descending, doc_id ascending, nulls last."""
    return sorted(found, key=lambda x: (-x[0], x[1] is None, x[1] or 0))[:top]


def _search(postings: DataFrame, plan, docs: int, length: int, top: int) -> DataFrame:
    """``(place, doc_id, score)``: every partition's best documents of each item of the block."""
    def run(batches):
        tiles = plan.value
        kept: dict[int, list[tuple]] = {}
        floor = {k: np.ones(size, np.int64) for k, (_, size, _) in enumerate(tiles)}
        for b in batches:
            names = b.column(0).to_pylist()
            n = b.column(1).to_numpy(zero_copy_only=False)
            ids, tfs = b.column(2).to_pylist(), b.column(3).to_pylist()
            for lo in range(0, b.num_rows, TILE):
                hi = min(lo + TILE, b.num_rows)
                term = np.frombuffer(b"".join(ids[lo:hi]), "<i4")
                row = np.repeat(np.arange(hi - lo), [len(x) // 4 for x in ids[lo:hi]])
                impact = impacts(n[lo:hi], row, np.frombuffer(b"".join(tfs[lo:hi]), "<i8"), docs, length)
                for k, (first, size, columns) in enumerate(tiles):
                    score = np.zeros((hi - lo, size), np.int64)
                    for cols, at, item, w in columns:
                        place = np.minimum(np.searchsorted(cols, term), len(cols) - 1)
                        mine = cols[place] == term
                        left = np.zeros((hi - lo, len(cols)))
                        left[row[mine], place[mine]] = impact[mine]
                        right = np.zeros((len(cols), size))
                        right[at, item] = w
                        score += (left @ right).astype(np.int64)
                    for i, j in zip(*np.nonzero(score >= floor[k])):
                        kept.setdefault(first + int(j), []).append((int(score[i, j]), names[lo + int(i)]))
                    for j in range(size):
                        own = kept.get(first + j, ())
                        if len(own) > top:
                            own = kept[first + j] = _best(own, top)
                        if len(own) == top:
                            floor[k][j] = own[-1][0]
        rows = [(p, d, s) for p, own in kept.items() for s, d in own]
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*rows)], names=["place", "doc_id", "score"])

    return postings.mapInArrow(run, "place long, doc_id long, score long")


def _rank_block(docs: DataFrame, wanted: DataFrame, top: int) -> DataFrame:
    """Ranking of one block of items."""
    spark = docs.sparkSession
    # at most BLOCK_BYTES of terms, by the choice of blocks
    rows = wanted.toPandas()
    vocabulary = sorted(set(rows["term"]))
    number = {t: i for i, t in enumerate(vocabulary)}
    postings = staged(_postings(docs, spark.sparkContext.broadcast([t.encode() for t in vocabulary])), "lexical-postings")
    sums = postings.agg(F.count_if(F.col("n") > 0).alias("docs"), F.sum("n").alias("length")).first()
    holders = _holders(postings, len(vocabulary))
    weights = [weight(sums["docs"], int(h)) for h in holders]
    # items that share terms stand side by side, so a tile's columns are few
    items = list(rows.groupby("item", sort=True)["item_id"].first().items())
    place = {item: k for k, (item, _) in enumerate(items)}
    entries: dict[int, list] = {}
    for item, term, times in zip(rows["item"], rows["term"], rows["times"]):
        at, t = place[item], number[term]
        if holders[t] and weights[t] > 0:
            entries.setdefault(at // ITEMS, []).append((t, at % ITEMS, weights[t] * int(times)))
    plan = [(k * ITEMS, min(ITEMS, len(items) - k * ITEMS), column_tiles(own)) for k, own in sorted(entries.items())]
    found = _search(postings.filter(F.octet_length("ids") > 0), spark.sparkContext.broadcast(plan), sums["docs"], sums["length"] or 1, top)
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
    salt = F.pmod(F.xxhash64("doc_id"), F.lit(SALTS))
    near = (found.withColumn("salt", salt).withColumn("rank", F.row_number().over(Window.partitionBy("place", "salt").orderBy(*order)))
            .filter(F.col("rank") <= top))
    ranked = (near.withColumn("rank", F.row_number().over(Window.partitionBy("place").orderBy(*order))).filter(F.col("rank") <= top))
    names = spark.createDataFrame([(k, None if i is None or i != i else int(i)) for k, (_, i) in enumerate(items)], "place long, item_id long")
    return ranked.join(names, "place").select("item_id", "rank", "doc_id", "score")


def rank(docs: DataFrame, items: DataFrame, top: int = TOP, id_col: str = "doc_id", text_col: str = "text",
         item_col: str = "item_id", item_text_col: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``(item_id, rank, doc_id, score)``: each item's ``top`` documents with a score above 0."""
    spark = docs.sparkSession
    ship(spark)
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    queries = items.select(F.col(item_col).cast("long").alias("item_id"), F.col(item_text_col).cast("string").alias("text"))
    queries = staged(queries.filter("text is not null").distinct().withColumn("item", F.monotonically_increasing_id()), "lexical-items")
    wanted = staged(_item_terms(queries), "lexical-terms")
    size = wanted.agg(F.sum(F.octet_length("term") + 64)).first()[0] or 0
    blocks = math.ceil(size / block_bytes)
    out = spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    for k in range(blocks):
        own = wanted.filter(F.pmod(F.xxhash64("item"), F.lit(blocks)) == k)
        out = out.unionByName(staged(_rank_block(src, own, top), "lexical-ranks"))
    return out
