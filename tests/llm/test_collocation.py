"""Phrase collocations against brute force."""

import random
import re
from collections import Counter

import duckdb
import numpy as np
import pytest

from martlake.llm import collocation, queries


def _pieces(text):
    low = re.sub("[A-Z]", lambda c: c.group().lower(), text or "")
    return [re.findall(r"[^\x20\x09]+", p) for p in re.split("[.,;:!?\x0a-\x0d]", low)]


def _brute(docs, top, least, dominance=100):
    f = {}
    for lang, text in docs:
        own = f.setdefault(lang or "und", Counter())
        for p in _pieces(text):
            own.update(tuple(p[i:i + m]) for m in range(1, 6) for i in range(len(p) - m + 1))
    out = []
    for lang, c in f.items():
        n = sum(v for g, v in c.items() if len(g) == 1)
        cand = {g: a for g, a in c.items() if len(g) > 1 and a >= least}
        inside = {}
        for g, a in cand.items():
            for i in range(len(g)):
                for j in range(i + 1, len(g) + 1):
                    if j - i < len(g):
                        inside[g[i:j]] = max(inside.get(g[i:j], 0), a)
        rows = []
        for g, a in cand.items():
            if 100 * inside.get(g, 0) >= dominance * a:
                continue
            score, k = min((1000 * a * n // (c[g[:k]] * c[g[k:]]), k) for k in range(1, len(g)))
            rows.append((-score, -a, " ".join(g).encode(), c[g[:k]], c[g[k:]], n))
        out += [(lang, i + 1, p.decode(), -a, x, y, n, -s) for i, (s, a, p, x, y, n) in enumerate(sorted(rows)[:top])]
    return sorted(out)


def _corpus(seed, size=40):
    rng = random.Random(seed)
    words = ["a", "b", "C", "d", "é", "ß", "日本", "f\x0b", "g.", "h,", "i\n", "(j)", "k\x1c", "\tl"]
    weights = [30, 20, 10, 6, 5, 4, 4, 3, 3, 2, 2, 2, 1, 1]
    fixed = ["the quick brown fox jumps", "a b c d é ß", "one two", "one two three"]
    docs = []
    for i in range(size):
        parts = [" ".join(rng.choices(words, weights, k=rng.randrange(30)))] + rng.choices(fixed, k=2)
        rng.shuffle(parts)
        docs.append((rng.choice(["x", "x", "y", None, "und"]), " ".join(parts)))
    return docs + [("x", None), ("y", ""), (None, "..."), ("z", "lonely words")]


def _rows(df):
    return sorted(tuple(r[c] for c in ("lang", "rank", "phrase", "a", "l", "r", "n", "score")) for r in df.collect())


@pytest.mark.parametrize("seed,top,least,more", [
    (1, 2000, 4, {"share": 1}),                                # everything counts
    (2, 5, 3, {"share": 8, "nodes": 200, "chunk": 40}),        # more rounds, small chunks, a bound that cuts
    (3, 12, 3, {"share": 2, "dominance": 60}),                 # longer phrases that hold only most of the occurrences
])
def test_collocations_match_brute_force(spark, seed, top, least, more):
    docs = _corpus(seed)
    got = collocation.collocations(spark.createDataFrame(docs, "lang string, text string"), top=top, least=least, **more)
    if more.get("dominance", 100) == 100:
        assert _rows(got) == _brute(docs, top, least)
    else:
        assert _rows(got) == _brute(docs, top, least, more["dominance"])


def test_the_bound_closes_the_frontier(spark, monkeypatch):
    """Frequent first words whose bound is below the settled score are never opened."""
    rng = random.Random(8)
    docs = [("x", " ".join(rng.choices([f"w{i}" for i in range(20)], k=40)) + f". rare{k % 4} pair{k % 4}") for k in range(80)]
    opened, made = [], collocation._requests
    monkeypatch.setattr(collocation, "_requests", lambda batch, *a: (opened.extend(r["phrase"] for r in batch), made(batch, *a))[1])
    got = collocation.collocations(spark.createDataFrame(docs, "lang string, text string"), top=4, least=5, share=30)
    assert _rows(got) == _brute(docs, 4, 5) and {r[2] for r in _rows(got)} == {f"rare{k} pair{k}" for k in range(4)}
    assert opened and not any(p.startswith("w") for p in opened)


def test_scores_are_exact_beyond_64_bits():
    a, n = 3 * 10 ** 12 + 7, 10 ** 16 + 1
    score, x, y = collocation.best_cut(a, n, [a + 1, a], [a + 3, a + 2])
    assert (score, x, y) == (1000 * a * n // ((a + 1) * (a + 3)), a + 1, a + 3)   # equal after flooring: the first cut
    assert 1000 * a * n > 1 << 64 and score == 1000 * a * n // (a * (a + 2))
    assert collocation.best_cut(100, 1000, [100, 200], [200, 100])[1:] == (100, 200)


def test_frontier_bounds_in_spark_are_exact(spark):
    row = ("x", "p q", 2, 3 * 10 ** 12, [4 * 10 ** 12], 5 * 10 ** 12, 10 ** 16)
    df = spark.createDataFrame([row], "lang string, phrase string, m int, f long, pre array<long>, last long, n long")
    (r,) = collocation._as_frontier(df).collect()
    assert r["own"] == 1000 * row[3] * row[6] // (row[4][0] * row[5]) and r["bound"] == 1000 * row[6] // row[4][0]


def test_collocations_odd_rows(odd, none):
    got = _rows(collocation.collocations(odd, least=4, chunk=1000, share=1))
    docs = [(r["lang"], r["text"]) for r in odd.select("lang", "text").collect()]
    assert got == _brute(docs, 2000, 4)
    assert got
    assert collocation.collocations(none).count() == 0


def test_sql_agrees_with_brute_force(spark, table_dir):
    docs = [(i, t, lang) for i, (lang, t) in enumerate(_corpus(5, 500))]
    path = table_dir(docs)
    want = _brute([(lang, t) for _, t, lang in docs], 2000, 100)
    con = duckdb.connect()
    con.execute(f"create view documents as select * from read_parquet('{path}/documents.parquet/*.parquet')")
    names = [d[0] for d in con.execute(queries.SQL["op11_collocations"]).description]
    assert sorted(con.fetchall()) == want and len(want) > 5
    assert names == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert _rows(queries.op11_collocations(spark, path)) == want
