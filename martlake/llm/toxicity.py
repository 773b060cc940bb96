"""Toxicity score: a weighted lexicon matched by an Aho-Corasick automaton.

Texts are folded first (lower case, homoglyphs and digit or sign substitutions inside words
to plain letters, everything else to single spaces).  The lexicon is learned from labelled
documents: words and word beginnings of four to seven letters whose document frequency
among toxic documents is far above that among others and could not be chance among all
beginnings tested, weighted by the smoothed log ratio of their rates in the two classes;
near copies count once.
Counting runs in Spark over a sample of labelled rows that the caller bounds.  Exception phrases
cancel the matches inside them: a few given ones, and those learned as a lexicon word with a
neighbour that makes it harmless by the labels.  The summed weights of
a text, normalised by its length, become a probability by a logistic curve fitted on the
same sample.

Defined cases: null or letterless text scores the curve's value at no match; a training
table without both classes gives an empty lexicon and the constant score of the toxic
share; null ids are scored (they are never in a training set that is chosen by id);
repeated rows are scored alike; empty input gives an empty table.
"""

from __future__ import annotations

import math
import re
import unicodedata
import zlib
from collections import Counter
from dataclasses import dataclass

import ahocorasick
import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from martlake.llm._common import fresh, ship, staged
from martlake.llm.curve import fit_curve, sigmoid

# Look-alike letters of other scripts, and signs and digits that stand for letters.
HOMOGLYPHS = {"а": "a", "в": "b", "е": "e", "к": "k", "м": "m", "н": "h", "о": "o", "р": "p", "с": "c",
              "т": "t", "у": "y", "х": "x", "ѕ": "s", "і": "i", "ј": "j", "ԁ": "d", "ɡ": "g", "ո": "n",
              "α": "a", "ε": "e", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "τ": "t", "υ": "u",
              "χ": "x", "ı": "i", "ⅼ": "l"}
SUBSTITUTES = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "!": "i"}
EXCEPTIONS = ("trash can", "trash bin", "trash bag", "moron mountain", "circus clown", "clown fish",
              "not stupid", "not an idiot", "not a moron", "not worthless")

_WORD = re.compile(r"[^\W\d_]+")
_MIXED = re.compile(r"(?<=[^\W\d_])[013457@$!]+(?=[^\W\d_])|(?<![^\W_])[013457@$]+(?=[^\W\d_][^\W_])")
_WIDE = str.maketrans(HOMOGLYPHS)
_MORE = re.compile("[" + "".join(HOMOGLYPHS) + "]")


def fold(text: str | None) -> str:
    """Folded words of ``text`` joined and enclosed by single spaces."""
    if not text:
        return " "
    t = text.lower()
    if not t.isascii():
        t = unicodedata.normalize("NFKC", t)
        if _MORE.search(t):
            t = t.translate(_WIDE)
    t = _MIXED.sub(lambda m: "".join(SUBSTITUTES[c] for c in m.group()), t)
    words = _WORD.findall(t)
    return f" {' '.join(words)} " if words else " "


# Odd multipliers: each orders the hashes of a text anew.
_ORDERS = np.array([pow(0x9E3779B97F4A7C15, k, 1 << 64) for k in range(1, 9)], dtype=np.uint64)


def _gist(text: str | None) -> str:
    """Smallest hashes of two neighbouring words under eight orders: near copies mostly agree
    in all, unlike texts do not, however frequent a word pair is."""
    words = fold(text).split()
    pairs = {f"{a} {b}" for a, b in zip(words, words[1:])} or {" ".join(words)}
    crc = np.fromiter((zlib.crc32(p.encode()) for p in pairs), dtype=np.uint64, count=len(pairs))
    return ((crc[:, None] + np.uint64(1)) * _ORDERS).min(axis=0).tobytes().hex()


@dataclass(frozen=True)
class ToxicModel:
    patterns: dict[str, float]      # " word " or " beginning" -> weight
    exceptions: tuple[str, ...]
    slope: float
    offset: float

    def automaton(self) -> ahocorasick.Automaton:
        a = ahocorasick.Automaton()
        for p, w in self.patterns.items():
            a.add_word(p, (len(p), w))
        for e in self.exceptions:
            a.add_word(f" {e} ", (len(e) + 2, None))
        if len(a):
            a.make_automaton()
        return a


def _excess(folded: str, automaton) -> tuple[float, int]:
    """Sum over words of the strongest pattern that starts there, outside exception phrases."""
    if not len(automaton):
        return 0.0, folded.count(" ")
    best: dict[int, float] = {}
    free: list[tuple[int, int]] = []
    for end, (size, weight) in automaton.iter(folded):
        at = end - size + 1
        if weight is None:
            free.append((at, end))
        elif weight > best.get(at, 0.0):
            best[at] = weight
    if free:
        best = {at: w for at, w in best.items() if not any(a <= at < b for a, b in free)}
    return sum(best.values()), folded.count(" ")


def _feature(total: float, words: int) -> float:
    # weight a word, damped so that a long text needs more of it but not in proportion
    return math.log1p(total / math.sqrt(1.0 + words / 100.0))


def _raw(texts, automaton) -> np.ndarray:
    return np.fromiter((_feature(*_excess(fold(t), automaton)) for t in texts), dtype=np.float64, count=len(texts))


def _learned_exceptions(src: DataFrame, table: DataFrame, patterns: dict[str, float], share: float, min_docs: int) -> tuple[str, ...]:
    """Phrases of two words in which a pattern's word is harmless: of the sample's documents that hold
    the phrase no more than the base share are toxic, and that few can't be chance (Chernoff
    exponent against the pattern's other documents, for as many phrases as are tested)."""
    lexicon = ToxicModel(patterns, (), 0.0, 0.0)

    def phrases(batches):
        a = lexicon.automaton()
        for b in batches:
            out: dict[tuple[str, str], list[int]] = {}
            for text, y in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                folded = fold(text)
                best: dict[int, str] = {}
                for end, (size, weight) in a.iter(folded) if len(a) else ():
                    at, p = end - size + 1, folded[end - size + 1:end + 1]
                    if at not in best or (weight, p) > (patterns[best[at]], best[at]):
                        best[at] = p
                seen, place = set(), 0
                words = folded.split()
                for i, w in enumerate(words):
                    if place in best:
                        seen.update((" ".join(words[x:x + 2]), best[place]) for x in (i - 1, i) if 0 <= x < len(words) - 1)
                    place += len(w) + 1
                for pair in seen:
                    out.setdefault(pair, [0, 0])[1 if y else 0] += 1
            yield pa.RecordBatch.from_pydict({
                "phrase": pa.array([p for p, _ in out], pa.string()), "gram": pa.array([g for _, g in out], pa.string()),
                "pc": pa.array([v[0] for v in out.values()], pa.int64()), "pt": pa.array([v[1] for v in out.values()], pa.int64())})

    found = (src.mapInArrow(phrases, "phrase string, gram string, pc long, pt long").groupBy("phrase", "gram")
             .agg(F.sum("pc").alias("pc"), F.sum("pt").alias("pt")).filter(F.col("pc") + F.col("pt") >= min_docs))
    found = staged(found, "toxic-phrases")
    tested = max(2, found.count())
    pc, pt = F.col("pc"), F.col("pt")
    n = pc + pt
    other = (F.col("t") - pt + 0.5) / (F.col("t") + F.col("c") - n + 1.0)     # the pattern's share elsewhere
    luck = (F.when(pt > 0, pt * F.log(pt / n / other)).otherwise(0.0)
            + F.when(pc > 0, pc * F.log(pc / n / (1 - other))).otherwise(0.0))
    rows = (found.join(table.select("gram", "c", "t"), "gram")
            .filter((pt <= share * n) & (pt / n < other) & (luck >= math.log(tested))).select("phrase").distinct().collect())
    return tuple(sorted(r["phrase"] for r in rows))


def fit(sample: DataFrame, text_col: str = "text", label_col: str = "label", min_docs: int = 3, min_log_odds: float = 1.0, exceptions: tuple[str, ...] = EXCEPTIONS) -> ToxicModel:
    """Learn lexicon, exception phrases (besides the given ``exceptions``) and curve from the rows of
    ``sample`` (text, 0/1 label), which the caller bounds (``labelled_sample``)."""
    ship(sample.sparkSession)

    @F.pandas_udf("string")
    def gist(texts: pd.Series) -> pd.Series:
        return pd.Series([_gist(t) for t in texts], dtype="object")

    # near copies count once: their words would look like evidence from many documents
    src = staged(sample.select(F.col(text_col).cast("string").alias("text"), F.col(label_col).cast("int").alias("y"))
                 .withColumn("gist", gist("text")).dropDuplicates(["gist", "y"]).select("text", "y"), "toxic-sample")

    def grams(batches):
        # document and occurrence counts by class, combined for each batch before the shuffle;
        # the empty gram holds the number of words
        for b in batches:
            out: dict[str, list[int]] = {"": [0, 0, 0, 0]}
            for text, y in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                k = 1 if y else 0
                words = Counter(fold(text).split())
                seen: Counter = Counter()
                for w, n in words.items():
                    seen[f" {w} "] += n
                    for size in range(4, 8):
                        if len(w) >= size:
                            seen[f" {w[:size]}"] += n
                for g, n in seen.items():
                    row = out.setdefault(g, [0, 0, 0, 0])
                    row[k] += 1
                    row[2 + k] += n
                out[""][2 + k] += sum(words.values())
            yield pa.RecordBatch.from_pydict({"gram": list(out), **{
                name: [v[i] for v in out.values()] for i, name in enumerate(("c", "t", "oc", "ot"))}})

    counts = src.groupBy("y").count().collect()
    n = {int(r["y"] > 0): r["count"] for r in counts}
    if not n.get(1) or not n.get(0):
        share = min(max(n.get(1, 0) / max(1, sum(n.values())), 0.01), 0.99)
        return ToxicModel({}, exceptions, 0.0, math.log(share / (1 - share)))
    share = n[1] / (n[0] + n[1])
    t, c = F.col("t"), F.col("c")
    # how unlikely so many toxic documents among all holders are by chance (Chernoff exponent)
    chance = t * F.log(t / (t + c) / share) + F.when(c > 0, c * F.log(c / (t + c) / (1 - share))).otherwise(0.0)
    table = staged(src.mapInArrow(grams, "gram string, c long, t long, oc long, ot long").groupBy("gram")
                   .agg(*[F.sum(x).alias(x) for x in ("c", "t", "oc", "ot")])
                   .filter((t + c >= min_docs) | (F.col("gram") == "")), "toxic-grams")
    words = table.filter("gram = ''").first()
    odds = (F.log((F.col("ot") + 0.5) / (words["ot"] + 1.0)) - F.log((F.col("oc") + 0.5) / (words["oc"] + 1.0)))
    tested = max(2, table.count())
    proven = (table.filter(t > 0).withColumn("w", odds).withColumn("luck", chance)
             .filter((t >= min_docs) & (F.col("w") >= min_log_odds) & (F.col("luck") >= math.log(tested)))
             .orderBy("gram").collect())    # as many as the bounded sample proves
    patterns = {r["gram"]: float(r["w"]) for r in proven}
    learned = _learned_exceptions(src, table, patterns, share, min_docs)
    exceptions = (*exceptions, *(p for p in learned if p not in exceptions))
    model = ToxicModel(patterns, exceptions, 0.0, 0.0)

    def raw(batches):
        a = model.automaton()
        for b in batches:
            yield pa.RecordBatch.from_pydict({"x": _raw(b.column(0).to_pylist(), a), "y": b.column(1)})

    points = src.mapInArrow(raw, "x double, y int").toPandas()
    slope, offset = fit_curve(points["x"].to_numpy(), (points["y"] > 0).to_numpy(dtype=float))
    return ToxicModel(model.patterns, exceptions, max(slope, 0.0), offset)


def score_texts(model: ToxicModel, texts, automaton=None) -> np.ndarray:
    x = _raw(texts, automaton or model.automaton())
    return sigmoid(model.slope * x + model.offset)


def add_score(docs: DataFrame, model: ToxicModel, text_col: str = "text", out: str = "score") -> DataFrame:
    """``docs`` with the column ``out``: probability that the text is toxic."""
    ship(docs.sparkSession)

    @F.pandas_udf("double")
    def scored(batches: pd.Series) -> pd.Series:
        return pd.Series(score_texts(model, batches.tolist()))

    return docs.withColumn(out, scored(F.col(text_col).cast("string")))


def drop_toxic(docs: DataFrame, model: ToxicModel, text_col: str = "text", threshold: float = 0.3) -> DataFrame:
    """Rows of ``docs`` (all columns) whose score is below ``threshold``."""
    name = fresh(docs, "toxic_score")
    return add_score(docs, model, text_col, name).filter(F.col(name) < threshold).drop(name)
