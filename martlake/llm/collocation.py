"""Phrase collocations by best-first branch and bound.

A phrase grows from its prefix by one word at a time.  A phrase ``x`` of ``a`` occurrences cut
after ``k`` words into parts with ``l`` and ``r`` occurrences scores
``floor(1000 a n / (l r))``, and its score is that of its lowest cut.  As ``a <= r``, no phrase that
begins with the word ``w`` can score above ``1000 n / f(w)``: the prefix's bound.  As the cut before
the last word is known once the phrase is counted, its score is also an upper bound of the
phrase's own.  Both are admissible, so a language is settled when every prefix and phrase left has a bound
below its current 2000th surviving score; those that equal it are still opened.

The frontier is a Spark table in order of the bound (the rarest first word first).  Each round

1. takes the best part of the frontier whose size is bounded (``NODES`` trie nodes,
   ``NODE_BYTES`` of phrases, and ``SHARE`` of the corpus' occurrences) to the driver and compiles it
   to a trie, which is broadcast;
2. counts, in one pass over the numbered corpus, the words that follow each prefix, and for each phrase
   that may still score high enough the words before it and its suffixes of two words or more;
3. scores the phrases exactly (Python integers), drops those with an extension by one word of
   ``dominance`` percent of the occurrences (an occurrence of a longer phrase is one of every
   phrase between, so extensions by one word decide), keeps each language's best ``top`` of them;
4. adds the counted extensions of ``least`` occurrences or more to the frontier.

The corpus is split into words once and written as chunks of about ``CHUNK`` words, in which words have
chunk-local numbers (exact, no hashing).  The trie is walked for all positions of a chunk at once, and each chunk sends one row for a (node, word) pair;
Spark adds them up.  So a hot language or word is counted wherever its documents lie.

Defined cases: null texts are empty, a null language is ``und`` (one class with a language of that name);
repeated rows count each; fewer than ``top`` survivors give as many rows; empty tables give an
empty result; other columns are ignored.
"""

from __future__ import annotations

from collections import defaultdict
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from martlake.llm._common import ship, staged
from martlake.llm.slabs import text_buffers

LONGEST = 5
LEAST = 100
TOP = 2000
DOMINANCE = 100          # percent
CHUNK = 1 << 19          # words counted at once
NODES = 200_000          # trie nodes of a round
NODE_BYTES = 8 << 20     # bytes of a round's phrases
SHARE = 8                # a round's prefixes make up about 1/SHARE of all words at most
SLOTS = 1024             # parts in which equally rare first words are taken

CHUNK_FILES = {"parquet.block.size": str(8 << 20), "parquet.block.size.row.check.min": "1", "parquet.block.size.row.check.max": "1",
               "parquet.page.size.row.check.min": "1", "parquet.page.size.row.check.max": "1", "parquet.enable.dictionary": "false"}

RIGHT, LEFT, WHOLE = 1, 2, 4
_BREAK = 0               # chunk-local number of the border between pieces
# A-Z to a-z, piece separators to a full stop, tab to space
_FOLD = bytes(c + 32 if 65 <= c <= 90 else 46 if c in b".,;:!?\x0a\x0b\x0c\x0d" else 32 if c == 9 else c for c in range(256))


def tokens(texts: list[bytes]) -> list[bytes]:
    """Words of all texts, with a full stop (which no word holds) at every border of pieces."""
    return b".".join(texts).translate(_FOLD).replace(b".", b" . ").split()


def _encode(docs: DataFrame, chunk: int) -> DataFrame:
    """The corpus as chunks ``(lang, words, at)``, written once: the distinct words of some documents of one
    language, joined by spaces, and their text as the words' numbers (int32) between borders."""
    schema = pa.schema([("lang", pa.string()), ("words", pa.binary()), ("at", pa.binary())])

    def flush(texts):
        for lang, own in texts.items():
            number: dict[bytes, int] = defaultdict()
            number.default_factory = number.__len__
            number[b"."] = _BREAK
            found = tokens(own)
            at = np.zeros(len(found) + 2 + LONGEST, "<i4")
            at[1:len(found) + 1] = np.fromiter(map(number.__getitem__, found), np.int32, len(found))
            yield pa.RecordBatch.from_arrays([pa.array([lang], pa.string()), pa.array([b" ".join(number)], pa.binary()),
                                              pa.array([at.tobytes()], pa.binary())], schema=schema)

    def run(batches):
        texts: dict[str, list[bytes]] = {}
        size = 0
        for b in batches:
            raw, off = text_buffers(b.column(1))
            for i, lang in enumerate(b.column(0).to_pylist()):
                if off[i + 1] > off[i]:
                    texts.setdefault(lang, []).append(raw[off[i]:off[i + 1]].tobytes())
                    size += int(off[i + 1] - off[i])
                if size >= 6 * chunk:      # a word and its space are about six bytes
                    yield from flush(texts)
                    texts, size = {}, 0
        yield from flush(texts)

    # rows are megabytes: sizes are tested at every row (not every hundred), so a task holds few at a time
    return staged(docs.mapInArrow(run, "lang string, words binary, at binary"), "collocation-chunks", CHUNK_FILES)


def _decode(batches):
    for b in batches:
        for lang, words, at in zip(*b.columns):
            yield lang.as_py(), words.as_py().split(b" "), np.frombuffer(at.as_py(), "<i4")


def _word_counts(chunks: DataFrame) -> DataFrame:
    """``(lang, word, f)``; the row with a null word holds the language's number of words."""
    schema = pa.schema([("lang", pa.string()), ("word", pa.string()), ("c", pa.int64())])

    def run(batches):
        for lang, words, at in _decode(batches):
            c = np.bincount(at, minlength=len(words))[1:]
            yield pa.RecordBatch.from_arrays([
                pa.array([lang] * len(words), pa.string()), pa.array([None] + [w.decode() for w in words[1:]], pa.string()),
                pa.array(np.r_[c.sum(), c], pa.int64())], schema=schema)

    return chunks.mapInArrow(run, "lang string, word string, c long").groupBy("lang", "word").agg(F.sum("c").alias("f"))


class Requests:
    """What a round counts: a trie of phrases with flags at its nodes."""

    def __init__(self) -> None:
        self.nodes: dict[tuple[int, str], int] = {}
        self.roots: dict[str, int] = {}
        self.flags: list[int] = []

    def add(self, lang: str, words: list[str], flag: int) -> int:
        if lang not in self.roots:
            self.roots[lang] = len(self.flags)
            self.flags.append(0)
        node = self.roots[lang]
        for w in words:
            child = self.nodes.get((node, w))
            if child is None:
                child = self.nodes[node, w] = len(self.flags)
                self.flags.append(0)
            node = child
        self.flags[node] |= flag
        return node

    def compiled(self) -> tuple:
        parent = np.fromiter((p for p, _ in self.nodes), np.int64, len(self.nodes))
        child = np.fromiter(self.nodes.values(), np.int64, len(self.nodes))
        return self.roots, np.array(self.flags, np.int8), parent, child, [w.encode() for _, w in self.nodes]


def count_requests(compiled: tuple, lang: str, words: list[bytes], at: np.ndarray):
    """``(node, kind, word, count)`` arrays of one chunk."""
    roots, flags, parent, child, edge_words = compiled
    root = roots.get(lang)
    if root is None:
        return
    number = {w: i for i, w in enumerate(words)}
    own = np.fromiter(map(number.get, edge_words, repeat(-1)), np.int64, len(edge_words))
    edge = np.flatnonzero(own > 0)
    key = parent[edge] << 32 | own[edge]
    order = np.argsort(key)
    key, target = key[order], child[edge][order]
    if not len(key):
        return

    def step(state, word):
        want = state << 32 | word
        place = np.minimum(np.searchsorted(key, want), len(key) - 1)
        return np.where(key[place] == want, target[place], -1)

    first = step(np.full(len(words), root, np.int64), np.arange(len(words)))
    first[_BREAK] = -1
    state = first[at]
    where = np.flatnonzero(state >= 0)
    state = state[where]
    for depth in range(1, LONGEST + 1):
        flag = flags[state]
        whole = state[flag & WHOLE > 0]
        if len(whole):
            node, c = np.unique(whole, return_counts=True)
            yield node, WHOLE, np.zeros(len(node), np.int64), c
        for kind, offset in ((LEFT, -1), (RIGHT, depth)):
            chosen = flag & kind > 0
            beside = at[where[chosen] + offset].astype(np.int64)
            pair, c = np.unique((state[chosen] << 32 | beside)[beside != _BREAK], return_counts=True)
            if len(pair):
                yield pair >> 32, kind, pair & 0xFFFFFFFF, c
        if depth < LONGEST:
            state = step(state, at[where + depth].astype(np.int64))
            on = state >= 0
            where, state = where[on], state[on]


def _count(chunks: DataFrame, compiled) -> DataFrame:
    """``(node, kind, word, c)`` over all documents; the word is null for whole phrases."""
    schema = pa.schema([("node", pa.int32()), ("kind", pa.int8()), ("word", pa.string()), ("c", pa.int64())])

    def run(batches):
        asked = compiled.value
        for lang, words, at in _decode(batches):
            spelt = pa.array([None] + [w.decode() for w in words[1:]], pa.string())
            for node, kind, word, c in count_requests(asked, lang, words, at):
                yield pa.RecordBatch.from_arrays([pa.array(node, pa.int32()), pa.array(np.full(len(node), kind), pa.int8()),
                                                  spelt.take(pa.array(word)), pa.array(c, pa.int64())], schema=schema)

    return chunks.mapInArrow(run, "node int, kind tinyint, word string, c long").groupBy("node", "kind", "word").agg(F.sum("c").alias("c"))


def best_cut(a: int, n: int, left: list[int], right: list[int]) -> tuple[int, int, int]:
    """``(score, l, r)`` of the lowest-scoring cut, the first one of equal score."""
    score, k = min((1000 * a * n // (x * y), k) for k, (x, y) in enumerate(zip(left, right)))
    return score, left[k], right[k]


# A frontier row: the phrase, its words' number, occurrences, those of its proper prefixes and of its
# last word, the language's words, the bounds of its extensions and of its own score, and its place in line.
_FRONTIER = ["lang", "phrase", "m", "f", "pre", "last", "n", "bound", "slot"]


def _as_frontier(rows: DataFrame) -> DataFrame:
    big = "cast({} as decimal(17,0))".format
    first = F.expr("if(m = 1, f, pre[0])")
    grown = F.expr(f"if(m = {LONGEST}, 0, (cast(1000 as decimal(4,0)) * {big('n')}) div {big('if(m = 1, f, pre[0])')})")
    own = F.expr(f"if(m = 1, 0, (cast(1000 as decimal(4,0)) * {big('f')} * {big('n')}) div ({big('coalesce(pre[m - 2], 1)')} * {big('last')}))")
    slot = first * SLOTS + F.pmod(F.xxhash64("lang", "phrase"), F.lit(SLOTS))
    return rows.withColumn("bound", F.greatest(grown, own)).withColumn("own", own).withColumn("slot", slot).select(*_FRONTIER, "own")


class _Best:
    """Each language's best ``top`` surviving phrases."""

    def __init__(self, top: int) -> None:
        self.top = top
        self.rows: dict[str, list[tuple]] = {}

    def add(self, lang: str, phrase: str, a: int, l: int, r: int, n: int, score: int) -> None:  # noqa: E741
        self.rows.setdefault(lang, []).append((-score, -a, phrase.encode(), l, r, n))

    def settle(self) -> dict[str, int]:
        """Cut to the best; the score below which a language needs nothing more."""
        for own in self.rows.values():
            own.sort()
            del own[self.top:]
        return {lang: -own[-1][0] for lang, own in self.rows.items() if len(own) == self.top}


def _requests(batch, floor: dict[str, int], longest: int) -> tuple[Requests, list[int], set[int]]:
    """Trie of a batch, each row's node, and the rows whose own score may still count."""
    asked, node, live = Requests(), [], set()
    for i, r in enumerate(batch):
        words = r["phrase"].split(" ")
        flag = RIGHT if r["m"] < longest else 0
        if r["m"] > 1 and r["own"] >= floor.get(r["lang"], 0):
            live.add(i)
            flag |= LEFT if r["m"] < longest else 0
            for k in range(1, r["m"] - 1):
                asked.add(r["lang"], words[k:], WHOLE)
        node.append(asked.add(r["lang"], words, flag))
    return asked, node, live


def collocations(docs: DataFrame, lang_col: str = "lang", text_col: str = "text", top: int = TOP, least: int = LEAST,
                 dominance: int = DOMINANCE, nodes: int = NODES, share: int = SHARE, chunk: int = CHUNK) -> DataFrame:
    """``(lang, rank, phrase, a, l, r, n, score)``: the best ``top`` phrases of each language."""
    spark = docs.sparkSession
    ship(spark)
    src = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"), F.col(text_col).cast("string").alias("text"))
    chunks = _encode(src, chunk)
    counted = staged(_word_counts(chunks).filter(f"word is null or f >= {least}"), "collocation-words")
    totals = counted.filter("word is null").select("lang", F.col("f").alias("n"))
    words = counted.filter("word is not null").select("lang", "word", "f")
    all_words = totals.agg(F.sum("n")).first()[0] or 0
    frontier = staged(_as_frontier(words.join(totals, "lang").select(
        "lang", F.col("word").alias("phrase"), F.lit(1).alias("m"), "f", F.array().cast("array<long>").alias("pre"),
        F.col("f").alias("last"), "n")), "collocation-frontier")
    best, floor = _Best(top), {}
    while True:
        ready = frontier
        if floor:
            limits = spark.createDataFrame(list(floor.items()), "lang string, least_score long")
            ready = frontier.join(F.broadcast(limits) if len(floor) < 10_000 else limits, "lang", "left") \
                .filter(F.col("bound") >= F.coalesce("least_score", F.lit(0))).drop("least_score")
        cost = F.expr("m * (m + 1) div 2")
        line = (ready.groupBy("slot").agg(F.sum(cost).alias("nodes"), F.sum(F.octet_length("phrase") * cost).alias("bytes"), F.sum("f").alias("work"))
                .orderBy("slot").limit(20_000).collect())
        if not line:
            break
        used, last = np.zeros(3), line[0]["slot"]
        for r in line:
            used += (r["nodes"], r["bytes"], r["work"])
            if (used > (nodes, NODE_BYTES, all_words / share)).any() and r is not line[0]:
                break
            last = r["slot"]
        batch = ready.filter(F.col("slot") <= last).collect()
        asked, at_node, live = _requests(batch, floor, LONGEST)
        compiled = spark.sparkContext.broadcast(asked.compiled())
        counts = staged(_count(chunks, compiled).filter(f"c >= {least}"), "collocation-counts")
        compiled.unpersist()
        # at most three rows a node
        found = {(r["node"], r["kind"]): r["c"] for r in counts.groupBy("node", "kind").agg(F.max("c").alias("c")).collect()}
        for i in live:
            r, own = batch[i], batch[i]["phrase"].split(" ")
            if any(100 * found.get((at_node[i], kind), 0) >= dominance * r["f"] for kind in (LEFT, RIGHT)):
                continue
            right = [found[asked.add(r["lang"], own[k:], 0), WHOLE] for k in range(1, r["m"] - 1)] + [r["last"]]
            score, x, y = best_cut(r["f"], r["n"], r["pre"], right)
            best.add(r["lang"], r["phrase"], r["f"], x, y, r["n"], score)
        floor = best.settle()
        parents = spark.createDataFrame(
            [(at_node[i], r["lang"], r["phrase"], r["m"], [*r["pre"], r["f"]], r["n"]) for i, r in enumerate(batch) if r["m"] < LONGEST],
            "node int, lang string, phrase string, m int, pre array<long>, n long")
        grown = (counts.filter(F.col("kind") == RIGHT).select("node", "word", F.col("c").alias("f")).join(parents, "node")
                 .join(words.select("lang", "word", F.col("f").alias("last")), ["lang", "word"])
                 .select("lang", F.concat_ws(" ", "phrase", "word").alias("phrase"), (F.col("m") + 1).alias("m"), "f", "pre", "last", "n"))
        frontier = staged(ready.filter(F.col("slot") > last).unionByName(_as_frontier(grown)), "collocation-frontier")
    rows = [(lang, k + 1, p.decode(), -a, x, y, n, -s) for lang, own in best.rows.items() for k, (s, a, p, x, y, n) in enumerate(own)]
    return spark.createDataFrame(rows, "lang string, rank long, phrase string, a long, l long, r long, n long, score long")
