"""SimHash groups against all-pairs brute force."""

import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from martlake.llm import queries, simhash
from martlake.llm.components import components


def _brute_fp(text, k=3):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    grams = [b" ".join(words[i:i + k]) for i in range(max(1, len(words) - k + 1))]
    h = [xxhash.xxh64_intdigest(g, seed=42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def _brute_groups(items, bits):
    """items: (id, fp) -> id -> smallest id reachable."""
    root = {i: i for i, _ in items}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for x, (i, a) in enumerate(items):
        for j, b in items[x + 1:]:
            if bin(a ^ b).count("1") <= bits:
                p, q = sorted((find(i), find(j)))
                root[q] = p
    return {i: find(i) for i, _ in items}


def _near(rng, n, flips):
    base = [rng.getrandbits(64) for _ in range(max(1, n // 12))]
    out = []
    for _ in range(n):
        x = rng.choice(base)
        for _ in range(rng.randint(0, flips)):
            x ^= 1 << rng.randrange(64)
        out.append(x)
    return sorted(set(out))


def test_fingerprint_matches_definition():
    rng = random.Random(1)
    for n in (0, 1, 2, 3, 4, 40):
        text = " \t".join(rng.choice(["A", "b", "Éa", "zZ", "q"]) for _ in range(n))
        assert simhash.simhash_text(text) == _brute_fp(text)
    assert simhash.simhash_text(None) == simhash.simhash_text(" \n") == 0


@pytest.mark.parametrize("bits", [0, 1, 2, 3])
def test_trie_pairs_match_brute_force(bits):
    rng = random.Random(bits)
    fp = np.array(_near(rng, 300, 4), dtype=np.uint64)
    group = np.sort(np.array([rng.randrange(3) for _ in fp]))
    fp = np.concatenate([np.sort(fp[group == g]) for g in range(3)])
    got = sorted((int(i), int(j)) for a, b in simhash.trie_pairs(fp, group, bits, leaf=4, block=50) for i, j in zip(a, b))
    want = [(i, j) for i in range(len(fp)) for j in range(i + 1, len(fp))
            if group[i] == group[j] and bin(int(fp[i] ^ fp[j])).count("1") <= bits]
    assert got == want


def test_trie_pairs_across_sides():
    rng = random.Random(9)
    fp = np.array(_near(rng, 200, 3), dtype=np.uint64)
    side = np.array([rng.randrange(2) for _ in fp])
    order = np.lexsort((fp, side))
    fp, side = fp[order], side[order]
    got = {(int(i), int(j)) for a, b in simhash.trie_pairs(fp, np.zeros(len(fp)), 2, side, leaf=4) for i, j in zip(a, b)}
    want = {(i, j) for i in np.flatnonzero(side == 0) for j in np.flatnonzero(side == 1) if bin(int(fp[i] ^ fp[j])).count("1") <= 2}
    assert got == want


@pytest.mark.parametrize("subtree", [5, 1000])
def test_links_and_components(spark, subtree):
    """Small subtrees force the cut of hot ones; groups must be the same."""
    rng = random.Random(3)
    fps = _near(rng, 400, 5)
    items = [(i * 3, fp) for i, fp in enumerate(fps)]
    df = spark.createDataFrame([(i, fp - (1 << 64) if fp >> 63 else fp) for i, fp in items], "rep long, fp long")
    got = {r["node"]: r["component"] for r in components(simhash.links(df, 2, subtree, chunk_rows=64)).collect()}
    want = _brute_groups(items, 2)
    assert {i: got.get(i, i) for i, _ in items} == want


def test_components_of_a_chain(spark):
    n = 300
    edges = spark.range(n).select((F.col("id") + 1).alias("a"), F.col("id").alias("b"))
    got = components(edges).toPandas()
    assert len(got) == n + 1 and (got.component == 0).all()
    assert components(edges.limit(0)).count() == 0
    assert components(spark.createDataFrame([(1, 1), (None, 2), (4, 3), (3, 4)], "a long, b long")).count() == 2


def test_components_of_a_zigzag(spark):
    """After one round node 5 hangs below 1 and 2, though neither of them hangs below another."""
    edges = spark.createDataFrame([(1, 10), (10, 5), (5, 11), (11, 2)], "a long, b long")
    assert {tuple(r) for r in components(edges).collect()} == {(i, 1) for i in (1, 2, 5, 10, 11)}


def test_query_against_brute_force(spark, table_dir):
    rng = random.Random(8)
    base = [[rng.choice(["alpha", "beta", "gamma", "delta", "eps", "zeta", "eta"]) for _ in range(60)] for _ in range(6)]
    docs = []
    for i in range(90):
        words = list(rng.choice(base))
        if i % 3:
            words[rng.randrange(60)] = "changed"
        docs.append((i * 2 + 1, " ".join(words), "en"))
    docs += [(500, None, None), (501, "  ", None), (502, "", None), (503, "One Two", None), (504, "one  two", None)]
    got = {r["doc_id"]: r for r in queries.op9_simhash(spark, table_dir(docs)).collect()}
    items = [(i, _brute_fp(t)) for i, t, _ in docs]
    want = _brute_groups(items, 2)
    assert {i: r["component_id"] for i, r in got.items()} == want
    assert all(got[i]["fingerprint"] == f"{fp:016x}" for i, fp in items)


def test_odd_rows(spark, odd, none):
    rows = [tuple(r) for r in simhash.simhash_groups(odd).collect()]
    assert len(rows) == odd.count()
    blank = {r[2] for r in rows if r[1] == 0}
    assert blank == {3}                        # nulls and wordless texts are one group
    kept = simhash.drop_near_duplicates(odd)
    assert kept.columns == odd.columns
    ids = sorted(r["doc_id"] for r in kept.filter("doc_id is not null").collect())
    assert ids == [1, 3, 6, 7, 8] and kept.filter("doc_id is null").count() == 2
    twice = odd.filter("doc_id = 2")           # repeated rows are one document
    assert simhash.drop_near_duplicates(twice).count() == 1
    assert simhash.simhash_groups(none).count() == 0 and simhash.drop_near_duplicates(none).count() == 0


def test_near_duplicates_of_an_id_with_several_texts(spark):
    """An id that repeats with another text is another document: it goes only with its own group."""
    rng = random.Random(12)
    text = [" ".join(f"w{rng.randrange(10**6)}" for _ in range(60)) for _ in range(4)]
    rows = [(1, text[0]), (5, text[0]), (5, text[1]), (6, text[2]), (6, text[3]), (6, text[3]), (7, text[2]), (None, text[0])]
    got = simhash.drop_near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(
        [(1, text[0]), (5, text[1]), (6, text[2]), (6, text[3]), (None, text[0])], key=repr)
