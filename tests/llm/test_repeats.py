"""Suffix array, window owners and both substring operators against brute force."""

import hashlib
import random
import re
from dataclasses import replace

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from martlake.llm import queries, repeats, substring_dedup, suffix_dedup
from martlake.llm.suffix_array import suffix_array


def test_suffix_array_matches_sorting():
    rng = random.Random(4)
    for _ in range(1500):
        x = [rng.randrange(rng.choice([1, 2, 3, 5, 30])) for _ in range(rng.randrange(40))] * rng.choice([1, 1, 3])
        assert suffix_array(np.array(x, dtype=np.int64)).tolist() == sorted(range(len(x)), key=lambda i: x[i:])


def _brute(docs, window, split):
    """doc -> covered mask; docs: (id, text), equal ids allowed; null ids are the largest."""
    first, seqs = {}, []
    for i, t in docs:
        seq = split(t or "")
        seqs.append((repeats.LAST if i is None else i, seq))
        for j in range(len(seq) - window + 1):
            w = tuple(seq[j:j + window])
            first[w] = min(first.get(w, repeats.LAST), seqs[-1][0])
    out = []
    for i, seq in seqs:
        cov = [False] * len(seq)
        for j in range(len(seq) - window + 1):
            if first[tuple(seq[j:j + window])] < i:
                cov[j:j + window] = [True] * window
        out.append(cov)
    return out


def _corpus(seed, n=60):
    rng = random.Random(seed)
    vocab = ["".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 4))) for _ in range(50)]
    some = lambda k: [rng.choice(vocab) for _ in range(k)]
    passages, common = [some(rng.choice([20, 49, 50, 51, 80])) for _ in range(6)], some(12)
    docs = []
    for i in range(n):
        words = some(rng.choice([0, 3, 40, 90]))
        for _ in range(rng.randrange(3)):
            at = rng.randrange(len(words) + 1)
            words[at:at] = rng.choice(passages)
        if i % 2:
            words += common + some(3)                      # one line in every second document
        if i % 7 == 0:
            words += ["be"] * 120                          # periodic
        docs.append((i * 3 % 181, rng.choice([" ", "  ", "\n"]).join(words)))
    docs += [(docs[5][0] + 1000, docs[5][1]), (docs[8][0] + 1000, docs[8][1] + " x"), (None, docs[8][1]), (None, docs[8][1]),
             (2000, None), (2001, ""), (docs[9][0], docs[10][1]), (docs[9][0], docs[9][1])]
    return docs


def _frame(spark, docs):
    return spark.createDataFrame(docs, "doc_id long, text string").repartition(5)


SPLIT = {suffix_dedup: lambda t: list(t.encode()), substring_dedup: lambda t: re.findall(r"[^\x20\x09-\x0D]+", t)}


@pytest.mark.parametrize("hot", [0, 4096])
@pytest.mark.parametrize("mod", [suffix_dedup, substring_dedup])
def test_against_brute_force(spark, mod, hot, monkeypatch):
    """With hot=0 every repeated anchor is divided by longer prefixes; nothing may change."""
    if mod is substring_dedup:
        monkeypatch.setattr(mod, "MEMORY", 64 if hot == 0 else 1 << 17)
    docs = _corpus(hot + 1)
    got = repeats.remove_repeats(_frame(spark, docs), replace(mod.PLAN, hot=hot)).collect()
    rows = {}
    for r in got:
        rows.setdefault(r["doc_id"], []).append((r["n"], r["n_removed"], r["n_spans"], bytes(r["kept"])))
    want = {}
    for (i, t), cov in zip(docs, _brute(docs, mod.WINDOW, SPLIT[mod])):
        seq = SPLIT[mod](t or "")
        left = [s for s, c in zip(seq, cov) if not c]
        kept = bytes(left) if mod is suffix_dedup else " ".join(left).encode()
        spans = len(re.findall("1+", "".join("1" if c else "0" for c in cov)))
        want.setdefault(i, []).append((len(seq), sum(cov), spans, kept))
    assert {k: sorted(v) for k, v in rows.items()} == {k: sorted(v) for k, v in want.items()}
    assert sum(r["n_removed"] for r in got) > 500


@pytest.mark.parametrize("mod", [suffix_dedup, substring_dedup])
def test_hot_anchor_is_bounded(mod):
    """A passage shorter than the window, with other neighbours in each of 400 documents: the
    anchor is found hot from one part's count, and divided it has one content a key."""
    rng = random.Random(6)
    some = (lambda k: "".join(rng.choice("abcdefgh") for _ in range(k))) if mod is suffix_dedup else (
        lambda k: "".join(f" {rng.choice('abcdefgh')}{rng.randrange(99)}" for _ in range(k)))
    passage = some(45)
    docs = pa.table({"part": [0] * 400, "doc_id": list(range(400)), "ord": list(range(400)), "digest": list(range(400)),
                     "text": [some(60) + passage + some(60) for _ in range(400)]})
    none, plan = repeats._SIDE.empty_table(), replace(mod.PLAN, hot=200)
    told = repeats._step2(plan)(repeats._step1(plan, 1)(docs, none))
    assert sum(len(b) for b in told.column("b").to_pylist()) > 0
    sent = repeats._step3(plan, 1)(docs, told)
    key = np.frombuffer(b"".join(sent.column("keys").to_pylist()), dtype=np.uint64)
    assert np.unique(key, return_counts=True)[1].max() <= plan.hot


def test_queries_give_digests(spark, table_dir):
    docs = [(i, t, "en") for i, t in _corpus(9, 30) if i is not None]
    docs = list({d[0]: d for d in docs}.values())
    sf = table_dir(docs)
    for mod, query, size in ((suffix_dedup, queries.op5_suffix_array, "n_bytes"), (substring_dedup, queries.op7_substring, "n_words")):
        got = {r["doc_id"]: r for r in query(spark, sf).collect()}
        for (i, t, _), cov in zip(docs, _brute([d[:2] for d in docs], mod.WINDOW, SPLIT[mod])):
            seq = SPLIT[mod](t or "")
            left = [s for s, c in zip(seq, cov) if not c]
            kept = bytes(left) if mod is suffix_dedup else " ".join(left).encode()
            assert (got[i][size], got[i]["n_removed"], got[i]["kept_sha256"]) == (len(seq), sum(cov), hashlib.sha256(kept).hexdigest())


@pytest.mark.parametrize("mod", [suffix_dedup, substring_dedup])
def test_odd_rows(mod, odd, none):
    op = mod.dedup_bytes if mod is suffix_dedup else mod.dedup_words
    got = op(odd).toPandas()
    assert len(got) == odd.count() and op(none).count() == 0
    nine = got[got.doc_id == 9].iloc[0]                    # a whole copy of document 6
    assert nine.n_removed == nine.iloc[1] > 50 and bytes(nine.kept) == b""
    assert got[got.doc_id == 6].n_removed.iloc[0] == 0
    assert got[got.doc_id.isin([1, 2, 3, 4, 5, 7, 8])].n_removed.sum() == 0


def test_copies_across_many_parts(spark):
    rng = random.Random(1)
    text = " ".join("".join(rng.choice("abcdef") for _ in range(6)) for _ in range(70))
    docs = spark.range(300).select(F.col("id").alias("doc_id"), F.concat(F.lit(text), F.when(F.col("id") % 2 == 0, " tail").otherwise("")).alias("text"))
    got = suffix_dedup.dedup_bytes(docs).toPandas().set_index("doc_id")
    assert got.n_removed[0] == 0 and (got.n_removed[2:] == got.n_bytes[2:]).all() and got.n_removed[1] == got.n_bytes[1]


def _thue_morse(n):
    return "".join("ab"[bin(i).count("1") & 1] for i in range(n))


def test_words_that_a_polynomial_hash_confuses(spark):
    """Thue-Morse words and their complements hash alike modulo 2**64, whatever the base; they differ here."""
    one = _thue_morse(1024)
    other = one.translate(str.maketrans("ab", "ba"))
    words = [f"w{i}" for i in range(50)]
    docs = [(1, " ".join(words[:25] + [one] + words[26:])), (2, " ".join(words[:25] + [other] + words[26:])),
            (3, " ".join(words[:25] + [one] + words[26:]))]
    got = substring_dedup.dedup_words(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert {r["doc_id"]: r["n_removed"] for r in got} == {1: 0, 2: 0, 3: 50}
