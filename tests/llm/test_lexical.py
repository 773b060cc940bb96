"""Ranked lexical search against brute force."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from martlake.llm import lexical, queries

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def _terms(text):
    return [re.sub("[A-Z]", lambda c: c.group().lower(), t) for t in TERM.findall(text or "")]


def _brute(docs, items, top):
    own = [(i, Counter(_terms(t))) for i, t in docs]
    sizes = [sum(c.values()) for _, c in own]
    n_docs, length = sum(s > 0 for s in sizes), sum(sizes)
    out = []
    for item, text in items:
        found = []
        for (doc, c), n in zip(own, sizes):
            score = 0
            for term in _terms(text):
                if c[term]:
                    w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * sum(term in x for _, x in own) + 1)))
                    score += w * ((10 ** 9 * c[term]) // (1000 * c[term] + 8 * (25 + 75 * n * n_docs // length)))
            if score > 0:
                found.append((-score, doc))
        out += [(item, k + 1, doc, -s) for k, (s, doc) in enumerate(sorted(found)[:top])]
    return sorted(out)


def _rows(df):
    return sorted(tuple(r) for r in df.select("item_id", "rank", "doc_id", "score").collect())


@pytest.mark.parametrize("block_bytes", [1 << 24, 400])
def test_rank_matches_brute_force(spark, block_bytes, monkeypatch):
    monkeypatch.setattr(lexical, "TILE", 7)
    monkeypatch.setattr(lexical, "ITEMS", 3)
    rng = random.Random(4)
    words = ["Ab", "ab", "cé", "dß", "É", "e1", "f-g", "h.i", "日本", "k", " l"]
    docs = [(i, " ".join(rng.choices(words, k=rng.randrange(30)))) for i in range(1, 80)]
    docs += [(100 + i, docs[5][1]) for i in range(15)] + [(200, None), (201, ""), (202, "!?"), (203, "ab " * 900)]
    items = [(i, " ".join(rng.choices(words, k=rng.randrange(1, 9)))) for i in range(11)] + [(50, "nowhere"), (51, None), (52, "")]
    got = lexical.rank(spark.createDataFrame(docs, "doc_id long, text string"),
                       spark.createDataFrame(items, "item_id long, text string"), block_bytes=block_bytes)
    assert _rows(got) == _brute(docs, items, 10)


def test_column_tiles_stay_exact_and_share_large_weights():
    entries = [(t, i, w) for t, i, w in [(0, 0, 5), (1, 0, 26), (2, 1, 9), (3, 0, 4), (4, 1, 1), (9, 2, 10)]]
    tiles = lexical.column_tiles(entries, width=2, room=10)
    total = {}
    for cols, at, item, w in tiles:
        assert 1 <= len(cols) <= 2 and (np.diff(cols) > 0).all()
        sums = np.bincount(item, weights=w)
        assert sums.max() <= 10
        for a, i, x in zip(at, item, w):
            total[int(cols[a]), int(i)] = total.get((int(cols[a]), int(i)), 0) + int(x)
    assert total == {(t, i): w for t, i, w in entries}


def test_a_term_repeated_past_the_room(spark, monkeypatch):
    monkeypatch.setattr(lexical, "ROOM", 2_000)
    docs = [(i, "aa bb " * i + "cc") for i in range(12)]
    items = [(1, "aa " * 40 + "bb"), (2, "bb cc")]
    plan = lexical.column_tiles([(0, 0, 40 * 80)], room=lexical.ROOM)
    assert len(plan) == 2
    monkeypatch.setattr(lexical, "column_tiles", lambda own, made=lexical.column_tiles: made(own, room=2_000))
    got = lexical.rank(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    assert _rows(got) == _brute(docs, items, 10)


def test_search_odd_rows(spark, odd, none):
    items = spark.createDataFrame([(1, "quick fox"), (1, "quick fox"), (1, "lazy word5"), (None, "日本語"), (3, None)], "item_id long, text string")
    rows = lexical.rank(odd, items).collect()
    assert {(r["item_id"], r["rank"]) for r in rows if r["item_id"] is None} == {(None, 1)}
    assert [r["doc_id"] for r in rows if r["item_id"] is None] == [8]
    first = sorted((r["rank"], r["doc_id"]) for r in rows if r["item_id"] == 1)
    # two different texts under one id: three documents hold a fox, five are lazy or hold word5
    assert [r for r, _ in first] == [1, 1, 2, 2, 3, 3, 4, 5] and {d for _, d in first} == {1, 2, 6, 9}
    assert lexical.rank(none, items).count() == 0 and lexical.rank(odd, items.limit(0)).count() == 0


def test_search_query_reads_every_row(spark, table_dir):
    docs = [(i, f"word{i % 3} common", "en") for i in range(30)]
    path = table_dir(docs, items=[(7, "word1"), (8, "common")])
    assert _rows(queries.op13_search(spark, path)) == _brute([(i, t) for i, t, _ in docs], [(7, "word1"), (8, "common")], 10)
