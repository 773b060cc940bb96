"""Quality, language and toxicity: held-out accuracy, calibration, and defined odd cases."""

import os
import random
import time
import zlib

import numpy as np
import pyarrow as pa
import pytest

from martlake.llm import langid, quality, queries, toxicity
from martlake.llm._common import labelled_sample

SF = "/root/testdata/sf0.01"
driver = pytest.mark.skipif(not os.path.exists(SF), reason="driver tables not present")


def _auc(score, label):
    pos, neg = score[label == 1], score[label == 0]
    return ((pos[:, None] > neg[None]).mean() + 0.5 * (pos[:, None] == neg[None]).mean())


@driver
def test_quality_held_out(spark):
    got = queries.op1_quality(spark, SF).toPandas()
    labels = spark.read.parquet(f"{SF}/labels.parquet").toPandas()
    assert len(got) == 1000 and got.score.between(0, 1).all() and (got.predicted == (got.score >= 0.5)).all()
    held = got[got.held_out].merge(labels, on="doc_id")
    assert _auc(held.score.to_numpy(), held.quality.to_numpy()) > 0.97
    assert (held.predicted == held.quality).mean() > 0.9


@driver
def test_language_held_out(spark):
    got = queries.op2_language(spark, SF).toPandas()
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang").toPandas()
    held = got[got.held_out].merge(docs, on="doc_id")
    assert len(got) == 1000 and (held.lang_pred == held.lang).mean() > 0.97


def _toxic_corpus(n=900):
    rng = random.Random(5)
    words = ["".join(rng.choice("bcdfglmnprst") + rng.choice("aeiou") for _ in range(rng.randint(1, 3))) for _ in range(400)]
    docs, labels = [], []
    for i in range(n):
        text = [rng.choice(words) for _ in range(rng.randint(20, 90))]
        bad = rng.random() < 0.25
        if bad:
            for _ in range(2):
                text.insert(rng.randrange(len(text)), rng.choice(["grumblor", "zonkhead", "vexu" + rng.choice(words)]))
        docs.append((i, " ".join(text), "en"))
        labels.append((i, 1, int(bad)))
    return docs, labels


def test_toxicity_held_out(spark, table_dir):
    docs, labels = _toxic_corpus()
    got = queries.op10_toxicity(spark, table_dir(docs, labels)).toPandas().set_index("doc_id")
    want = np.array([y for _, _, y in labels])
    got = got.loc[range(len(docs))]
    assert (got.predicted == (got.score >= 0.3)).all()
    held = got.held_out.to_numpy()
    assert (got.predicted.to_numpy() == want)[held].mean() > 0.97


def test_toxicity_folds_and_excepts():
    assert toxicity.fold("Stуpid M0ron, tr4sh") == " stypid moron trash "
    assert toxicity.fold("1d1ot $tupid, in 1999") == " idiot stupid in "
    model = toxicity.ToxicModel({" stupid ": 5.0, " vexu": 4.0}, ("not stupid",), 4.0, -4.0)
    plain, no, far, excused, start = toxicity.score_texts(
        model, ["so stupid", "nothing here", "so stupid " + "calm words here " * 400, "you are not stupid", "vexubara"])
    assert plain > 0.9 and start > 0.9 and no == excused == pytest.approx(0.018, abs=1e-3) and no < far < plain


def test_gist_keeps_unlike_texts_apart():
    """Forty unlike texts hold one pair of words whose hash is the smallest of all."""
    low = min((f"pa{i} pb{i}" for i in range(20_000)), key=lambda p: zlib.crc32(toxicity.fold(p).strip().encode()))
    rng = random.Random(2)
    word = lambda: "".join(rng.choice("bcdfgaeiou") for _ in range(6))
    texts = [" ".join([word() for _ in range(30)] + [low] + [word() for _ in range(30)]) for _ in range(40)]
    assert len({toxicity._gist(t) for t in texts}) == 40
    assert toxicity._gist(texts[0].upper() + "!") == toxicity._gist(texts[0])


def test_more_languages_than_sixty_four(spark):
    rows = [(100 * k + i, f"q{k}x{k}z " * 9 + f"t{i}", f"l{k:02}") for k in range(66) for i in range(3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = langid.fit(docs)
    assert sorted(c for _, codes in model.families for c in codes) == sorted({r[2] for r in rows})


def test_temperature_tames_an_overconfident_network():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(600, 6)).astype(np.float32)
    y = (x[:, 0] * x[:, 1] + 0.8 * rng.normal(size=600) > 0).astype(float)
    net = quality.train_network(x, y, hidden=64, epochs=700)
    assert net.temperature > 1.5
    test = rng.normal(size=(2000, 6)).astype(np.float32)
    truth = (test[:, 0] * test[:, 1] + 0.8 * rng.normal(size=2000) > 0).astype(float)
    loss = lambda p: -np.mean(truth * np.log(p) + (1 - truth) * np.log(1 - p))
    sharp = np.clip(1 / (1 + np.exp(-net.logits(test))), 1e-9, 1 - 1e-9)
    assert loss(np.clip(net.probabilities(test), 1e-9, 1 - 1e-9)) < loss(sharp)


def test_context_sums_match_brute_force():
    texts = ["a b a c, a!", "", None, "b " * 7 + "zz", "c"]
    old, quality.PIECE = quality.PIECE, 3          # pieces must not change the sums
    try:
        (out,) = quality._context_sums([pa.RecordBatch.from_arrays([pa.array(texts)], names=["text"])])
    finally:
        quality.PIECE = old
    got = np.concatenate([np.frombuffer(s, dtype=np.int32) for s in out.column("sums").to_pylist()]).reshape(quality.BUCKETS, -1)
    index, want = quality.index_vectors(), np.zeros_like(got)
    for t in texts:
        raw = np.frombuffer((t or "").encode(), dtype=np.uint8)
        if len(raw):
            slots, _ = quality._slots(raw, np.array([0, len(raw)]))
            for i, s in enumerate(slots):
                want[s, quality.DIM] += 1
                for j in range(max(0, i - 2), min(len(slots), i + 3)):
                    if j != i:
                        want[s, :quality.DIM] += index[slots[j]].astype(np.int32)
    assert (got == want).all()


def _rows_of_all_columns(texts):
    """Context sums and pooled sums by gathering the rows of all columns for every token."""
    index = quality.index_vectors()

    def context():
        total = np.zeros((quality.BUCKETS, quality.DIM + 1))
        for _, _, data, off in quality.slabs(texts):
            slot, doc = quality._slots(data, off)
            vec = index[slot]
            around = np.zeros_like(vec)
            for k in (1, 2):
                same = (doc[k:] == doc[:-k])[:, None]
                around[k:] += vec[:-k] * same
                around[:-k] += vec[k:] * same
            for d in range(quality.DIM):
                total[:, d] += np.bincount(slot, weights=around[:, d], minlength=quality.BUCKETS)
            total[:, quality.DIM] += np.bincount(slot, minlength=quality.BUCKETS)
        return total

    def pooled(words):
        total = np.zeros((len(texts), 2 + 3 * quality.DIM))
        for lo, hi, data, off in quality.slabs(texts):
            slot, doc = quality._slots(data, off)
            first = np.flatnonzero(np.r_[True, doc[1:] != doc[:-1]])
            w, v = words.weights[slot][:, None], words.vectors[slot]
            total[lo + doc[first]] = np.add.reduceat(
                np.hstack([w, np.ones_like(w), v * w, v * v * w, index[slot]]), first, dtype=np.float64)
        return total

    return context, pooled


def _seconds(work):
    best = []
    for _ in range(3):
        began = time.process_time()
        result = work()
        best.append(time.process_time() - began)
    return min(best), result


def test_passes_over_the_words_cost_less_than_gathered_rows():
    """Same sums as by rows of all columns for every token, in at most 0.7 of their processor time."""
    rng = random.Random(9)
    vocabulary = ["".join(rng.choice("bcdfgaeiou") for _ in range(rng.randint(1, 9))) for _ in range(20_000)]
    texts = [" ".join(vocabulary[int(20_000 * rng.random() ** 3)] for _ in range(rng.randint(1, 700))) for _ in range(900)]
    texts = pa.array([None, "", " \n", "one", "same " * 40, *texts, "\u00fc, \u00fc!", None])
    context, pooled = _rows_of_all_columns(texts)
    plain, want = _seconds(context)
    spent, (out,) = _seconds(lambda: list(quality._context_sums([pa.RecordBatch.from_arrays([texts], names=["text"])])))
    got = np.concatenate([np.frombuffer(s, dtype=np.int32) for s in out.column("sums").to_pylist()]).reshape(quality.BUCKETS, -1)
    assert (got == want).all()
    assert spent < 0.7 * plain, (spent, plain)
    words = quality.WordVectors(np.random.default_rng(4).normal(size=(quality.BUCKETS, quality.DIM)).astype(np.float32),
                                np.random.default_rng(5).random(quality.BUCKETS, dtype=np.float32))
    plain, total = _seconds(lambda: pooled(words))
    spent, got = _seconds(lambda: words.features(texts))
    dim, at = quality.DIM, np.flatnonzero(total[:, 1])
    mean, square = (total[at, lo:lo + dim] / total[at, :1] for lo in (2, 2 + dim))
    own = total[at, 2 + 2 * dim:] / total[at, 1:2]
    want = np.column_stack([mean, np.sqrt(np.maximum(square - mean * mean, 0)), np.linalg.norm(own, axis=1),
                            np.linalg.norm(mean, axis=1), np.log1p(total[at, 1]), np.log(total[at, 0] / total[at, 1])])
    assert np.allclose(got[at], want, atol=1e-3, rtol=1e-4) and not np.delete(got, at, axis=0).any()
    assert spent < 0.7 * plain, (spent, plain)


def test_packed_pairs_are_exact():
    low, high = np.meshgrid(*[[-most, -1, 0, 1, most] for most in [2 * quality.WINDOW * quality.PIECE] * 2])
    got = quality._unpacked(low + high * 2.0 ** quality.FIELD)
    assert (got[0] == low).all() and (got[1] == high).all()
    index = quality.index_vectors()
    low, high = quality._unpacked(quality._index_pairs())
    assert (low[:, :-1].T == index[:, ::2]).all() and (high[:, :-1].T == index[:, 1::2]).all()
    assert not low[:, -1].any() and not high[:, -1].any()


def test_ngram_features_of_pieces():
    texts = pa.array(["the house", "Straße über", None, "", "abcabcabc" * 5])
    whole = langid.features(texts)
    old, langid._PIECE = langid._PIECE, 7
    try:
        assert np.allclose(whole, langid.features(texts))
    finally:
        langid._PIECE = old
    assert np.allclose(np.linalg.norm(whole, axis=1), [1, 1, 0, 0, 1])


def test_svm_separates():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(300, 5)).astype(np.float32)
    y = np.where(x @ np.array([1, -2, 0.5, 0, 0]) > 0, 1.0, -1.0)
    assert (np.sign(x @ langid.train_svm(x, y)) == y).mean() > 0.97


def test_odd_rows(spark, odd, none):
    labels = spark.createDataFrame([(1, 1), (4, 0), (6, 1), (8, 0), (None, 1), (1, 1)], "doc_id long, label int")
    for docs in (odd, none):
        sample = labelled_sample(docs, labels, "label", 100)
        n = docs.count()
        tox = toxicity.fit(sample)
        scored = toxicity.add_score(docs.select("doc_id", "text"), tox).toPandas()
        assert len(scored) == n and scored.score.between(0, 1).all()
        assert toxicity.drop_toxic(docs, tox).columns == docs.columns
        model = quality.fit(docs, sample)
        scored = quality.add_score(docs.select("doc_id", "text"), model).toPandas()
        assert len(scored) == n and scored.score.between(0, 1).all()
        lang = langid.fit(docs)
        got = langid.add_language(docs.select("doc_id", "text"), lang).toPandas()
        assert len(got) == n and got.score.between(0, 1).all()
        assert set(got[got.text.isna() | got.text.fillna("").str.strip().eq("")].lang_pred) <= {"und"}


def test_one_class_and_one_language(spark):
    docs = spark.createDataFrame([(i, f"text number {i}", "en") for i in range(8)], "doc_id long, text string, lang string")
    ones = spark.createDataFrame([(i, 1) for i in range(8)], "doc_id long, label int")
    sample = labelled_sample(docs, ones, "label", 100)
    assert quality.add_score(docs, quality.fit(docs, sample)).filter("score < 0.9").count() == 0
    assert toxicity.add_score(docs, toxicity.fit(sample)).filter("score < 0.9").count() == 0
    assert langid.add_language(docs, langid.fit(docs)).filter("lang_pred <> 'en'").count() == 0


def test_labelled_sample_is_bounded(spark):
    docs = spark.range(4000).selectExpr("id AS doc_id", "cast(id AS string) AS text")
    labels = docs.selectExpr("doc_id", "cast(doc_id % 2 AS int) AS label")
    assert 350 < labelled_sample(docs, labels, "label", 500).count() < 650


def test_numbers_are_no_letters(spark):
    docs = spark.createDataFrame([(i, t, "en" if i % 2 else "de") for i, t in enumerate(["the cat sat", "der hund lief"] * 20)],
                                 "doc_id long, text string, lang string")
    model = langid.fit(docs)
    odd = spark.createDataFrame([(1, "\u00bd \u00b2 12"), (2, "\u00e9"), (3, "_ 7 \u2167")], "doc_id long, text string")
    got = {r["doc_id"]: r["lang_pred"] for r in langid.add_language(odd, model).collect()}
    assert got[1] == "und" and got[2] != "und" and got[3] == "und"


def test_exception_phrases_are_learned(spark):
    """A harmless neighbour of a toxic word is learned from labels, one seen too rarely isn't."""
    rng = random.Random(3)
    filler = lambda: " ".join("".join(rng.choice("bcdfghklmn") for _ in range(6)) for _ in range(12))
    rows = [(f"{filler()} zorgon {filler()}", 1) for _ in range(60)]
    rows += [(f"{filler()} zorgon lantern {filler()}", 0) for _ in range(25)] + [(f"{filler()} zorgon kettle {filler()}", 0)]
    rows += [(filler(), 0) for _ in range(250)]
    model = toxicity.fit(spark.createDataFrame(rows, "text string, label int"))
    learned = set(model.exceptions) - set(toxicity.EXCEPTIONS)
    assert " zorgon " in model.patterns
    assert learned == {"zorgon lantern"}
    bad, fine, rare = toxicity.score_texts(model, ["a zorgon b", "a zorgon lantern b", "a zorgon kettle b"])
    assert fine < 0.3 <= min(bad, rare)
