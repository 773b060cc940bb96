"""Language identification by hierarchical discrimination.

A document becomes hashed byte n-gram frequencies (two to four bytes, ASCII letters
lower-cased, other ASCII as a space; square roots, unit length).  Linear support vector
machines first tell the language family (one against the rest), then one-versus-one
machines inside the family tell its languages apart.  Machines are fitted by dual
coordinate descent on a bounded sample of labelled rows, with ``per_lang`` rows of each
language; margins become probabilities by logistic curves.

Defined cases: a null text or one without a letter is ``und`` with score 0; a training
table with one language predicts it everywhere; without any, everything is ``und``;
repeated rows are predicted alike; empty input gives an empty table.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F

from martlake.llm._common import fresh, ship, staged
from martlake.llm.curve import fit_curve, sigmoid
from martlake.llm.slabs import slabs

SIZES = ((2, 1024), (3, 2048), (4, 1024))
DIM = sum(n for _, n in SIZES)
UNKNOWN = "und"
# Families of common ISO 639-1 codes; any other code is a family of its own.
FAMILIES = {
    "germanic": "en de nl sv da no nb nn is af",
    "romance": "fr es it pt ro ca gl",
    "slavic": "ru uk be pl cs sk bg sr hr sl mk",
}
_FAMILY_OF = {code: name for name, codes in FAMILIES.items() for code in codes.split()}
_PIECE = 1 << 20
_LETTER = regex.compile(r"\p{L}")
_FOLD = np.full(256, 32, dtype=np.uint8)
_FOLD[97:123] = np.arange(97, 123)
_FOLD[65:91] = np.arange(97, 123)
_FOLD[128:] = np.arange(128, 256)


def features(col: pa.Array) -> np.ndarray:
    """Unit-length n-gram features of every text of a string column."""
    out = np.zeros((len(col), DIM), dtype=np.float32)
    for lo, hi, data, off in slabs(col, 1 << 19):
        for p in range(0, len(data), _PIECE):     # a very long document comes in pieces
            b = _FOLD[data[p:p + _PIECE + 3]].astype(np.uint32)
            doc = np.searchsorted(off, np.arange(p, p + len(b)), side="right") - 1
            base = 0
            for n, width in SIZES:
                m = min(_PIECE, len(b) - n + 1)   # n-grams that begin in this piece
                if m > 0:
                    code = b[:m].copy()
                    for k in range(1, n):
                        code = code * np.uint32(257) + b[k:m + k]
                    code = ((code * np.uint32(2654435761)) >> np.uint32(16)) % np.uint32(width)
                    inside = doc[n - 1:n - 1 + m] == doc[:m]
                    at = doc[:m][inside] * width + code[inside]
                    out[lo:hi, base:base + width] += np.bincount(at, minlength=(hi - lo) * width).reshape(hi - lo, width)
                base += width
    np.sqrt(out, out=out)
    out /= np.maximum(np.sqrt((out * out).sum(axis=1, keepdims=True)), 1e-9)
    return out


def train_svm(x: np.ndarray, y: np.ndarray, cost: float = 10.0, epochs: int = 12, seed: int = 3) -> np.ndarray:
    """Linear L2-loss support vector machine (labels -1/+1), dual coordinate descent."""
    w = np.zeros(x.shape[1], dtype=np.float32)
    alpha = np.zeros(len(y))
    diag = (x * x).sum(axis=1) + 0.5 / cost
    rng = np.random.default_rng(seed)
    for _ in range(epochs):
        for i in rng.permutation(len(y)):
            g = y[i] * float(x[i] @ w) - 1 + alpha[i] * 0.5 / cost
            new = max(alpha[i] - g / diag[i], 0.0)
            if new != alpha[i]:
                w += np.float32((new - alpha[i]) * y[i]) * x[i]
                alpha[i] = new
    return w


@dataclass(frozen=True)
class Machine:
    weights: np.ndarray
    slope: float
    offset: float

    def probability(self, x: np.ndarray) -> np.ndarray:
        return sigmoid(self.slope * (x @ self.weights).astype(np.float64) + self.offset)


def _machine(x: np.ndarray, yes: np.ndarray) -> Machine:
    w = train_svm(x, np.where(yes, 1.0, -1.0))
    slope, offset = fit_curve((x @ w).astype(np.float64), yes.astype(float), ridge=1.0)
    return Machine(w, slope, offset)


@dataclass(frozen=True)
class LanguageModel:
    families: tuple[tuple[str, tuple[str, ...]], ...]
    family_machines: tuple[Machine, ...]                  # one against the rest; empty for one family
    pair_machines: dict[tuple[str, str], Machine]

    def predict(self, col: pa.Array) -> tuple[list[str], np.ndarray]:
        n = len(col)
        lang, score = np.full(n, UNKNOWN, dtype=object), np.zeros(n)
        known = np.fromiter((bool(t) and _LETTER.search(t) is not None for t in col.to_pylist()), dtype=bool, count=n)
        if not self.families or not known.any():
            return lang.tolist(), score
        for lo in range(0, n, 512):
            x = features(col.slice(lo, 512))
            sure = np.ones(len(x))
            fam = np.zeros(len(x), dtype=int)
            if len(self.families) > 1:
                p = np.stack([m.probability(x) for m in self.family_machines], axis=1)
                p /= np.maximum(p.sum(axis=1, keepdims=True), 1e-12)
                fam, sure = p.argmax(axis=1), p.max(axis=1)
            for k, (_, langs) in enumerate(self.families):
                at = np.flatnonzero(fam == k)
                if not len(at):
                    continue
                votes, trust = np.zeros((len(at), len(langs))), np.zeros((len(at), len(langs)))
                for i, a in enumerate(langs):
                    for j in range(i + 1, len(langs)):
                        q = self.pair_machines[a, langs[j]].probability(x[at])
                        votes[:, i] += q >= 0.5
                        votes[:, j] += q < 0.5
                        trust[:, i] += q
                        trust[:, j] += 1 - q
                pairs = max(1, len(langs) - 1)
                best = (votes + trust / (pairs + 1)).argmax(axis=1)
                lang[lo + at] = np.array(langs, dtype=object)[best]
                score[lo + at] = sure[at] * (trust[np.arange(len(at)), best] / pairs if len(langs) > 1 else 1.0)
        lang[~known] = UNKNOWN
        score[~known] = 0.0
        return lang.tolist(), np.clip(score, 0, 1)


def fit(labelled: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
        per_lang: int = 1_200, max_rows: int = 76_800) -> LanguageModel:
    """Fit on about ``per_lang`` rows of every language, chosen by a hash of the id; many
    languages share ``max_rows`` rows, but none has fewer than about twenty."""
    ship(labelled.sparkSession)
    src = labelled.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).cast("string").alias("text"),
                          F.col(lang_col).cast("string").alias("lang")).filter("lang is not null and text is not null")
    counts = src.groupBy("lang").count().orderBy(F.desc("count"), "lang").collect()
    if not counts:
        return LanguageModel((), (), {})
    share = min(per_lang, max(20, max_rows // len(counts)))
    rate = F.create_map(*[F.lit(v) for r in counts for v in (r["lang"], max(1, int(1e6 * min(1, share / r["count"]))))])
    mark = F.pmod(F.xxhash64("id", F.lit(5)), F.lit(1_000_000))
    rows = staged(src.filter(mark < rate[F.col("lang")]).select("id", "text", "lang"), "langid-sample")

    def run(batches):
        for b in batches:
            x = features(b.column(1)).astype(np.float16)
            yield pa.RecordBatch.from_pydict({"id": b.column(0), "x": [r.tobytes() for r in x], "lang": b.column(2)})

    got = rows.mapInArrow(run, "id string, x binary, lang string").toPandas().sort_values(["lang", "id", "x"])
    x = np.frombuffer(b"".join(got["x"]), dtype=np.float16).reshape(len(got), DIM).astype(np.float32)
    lang = got["lang"].to_numpy(dtype=object)
    found = sorted(set(lang))
    by_family: dict[str, list[str]] = {}
    for code in found:
        by_family.setdefault(_FAMILY_OF.get(code, code), []).append(code)
    families = tuple((f, tuple(c)) for f, c in sorted(by_family.items()))
    of = np.array([next(k for k, (_, c) in enumerate(families) if a in c) for a in lang])
    over = tuple(_machine(x, of == k) for k in range(len(families))) if len(families) > 1 else ()
    pairs = {}
    for _, langs in families:
        for i, a in enumerate(langs):
            for b in langs[i + 1:]:
                at = (lang == a) | (lang == b)
                pairs[a, b] = _machine(x[at], lang[at] == a)
    return LanguageModel(families, over, pairs)


def add_language(docs: DataFrame, model: LanguageModel, text_col: str = "text", lang_out: str = "lang_pred",
                 score_out: str = "score") -> DataFrame:
    """``docs`` with the predicted language and its probability."""
    ship(docs.sparkSession)

    @F.pandas_udf("lang string, score double")
    def predicted(s: pd.Series) -> pd.DataFrame:
        lang, score = model.predict(pa.array(s, pa.string(), from_pandas=True))
        return pd.DataFrame({"lang": lang, "score": score})

    name = fresh(docs, "language")
    return (docs.withColumn(name, predicted(F.col(text_col).cast("string")))
            .withColumn(lang_out, F.col(f"{name}.lang")).withColumn(score_out, F.col(f"{name}.score")).drop(name))
