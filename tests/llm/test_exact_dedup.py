"""Exact deduplication by a stateful stream against brute force."""

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from martlake.llm import exact_dedup, queries

BLANK = re.compile(r"[\x20\x09-\x0D]")
COLS = ("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def _brute(docs):
    """Rows that repeat an id are told apart by nothing but their order, so rows come sorted."""
    groups = {}
    for n, (i, text) in enumerate(docs):
        groups.setdefault(BLANK.sub("", text or ""), []).append((-len(text or ""), i is None, i or 0, n))
    out = []
    for key, own in groups.items():
        keep = min(own)[3]
        out += [(docs[n][0], docs[keep][0], len(own), n == keep, hashlib.sha256(key.encode()).hexdigest()) for *_, n in own]
    return sorted(out, key=repr)


def _rows(df):
    return sorted((tuple(r[c] for c in COLS) for r in df.collect()), key=repr)


def _corpus(seed, n=120):
    rng = random.Random(seed)
    words = ["a", "B", "é", "\U0001F600", " ", "\t", "\n", "\x0b\x0c\r", "\x1c", " ", "\x00"]
    docs = [(i, "".join(rng.choices(words, k=rng.randrange(6)))) for i in rng.sample(range(10_000), n)]
    return docs + [(20_000 + i, "hot text") for i in range(n // 2)] + [(30_000, None), (30_001, ""), (30_002, " \n")]


def _table(spark, docs):
    return spark.createDataFrame(docs, "doc_id long, text string")


@pytest.mark.parametrize("weak", [None, lambda t: F.crc32(t.cast("binary")).cast("string").substr(1, 1).cast("binary")])
def test_dedup_matches_brute_force(spark, weak):
    """Also where digests collide: the check of full bytes tells the texts apart."""
    docs = _corpus(1)
    got = exact_dedup.dedup(_table(spark, docs).repartition(5), **({"digest": weak} if weak else {}))
    assert _rows(got) == _brute(docs)


def test_state_goes_on_with_new_files_only(spark, tmp_path):
    docs = _corpus(2)
    path, home = f"{tmp_path}/table", f"{tmp_path}/home"
    seen = 0
    for cut in (60, 130, len(docs)):
        _table(spark, docs[seen:cut]).repartition(3).write.mode("append").parquet(path)
        exact_dedup.ingest(spark, path, home, batch_bytes=1)       # a file a batch
        assert _rows(exact_dedup.resolve(spark, path, home)) == _brute(docs[:cut])
        seen = cut
    batches = {r["batch"] for r in spark.read.parquet(f"{home}/ledger").select("batch").distinct().collect()}
    exact_dedup.ingest(spark, path, home, batch_bytes=1)           # nothing new
    assert batches == {r["batch"] for r in spark.read.parquet(f"{home}/ledger").select("batch").distinct().collect()} and len(batches) >= 3
    total = exact_dedup.ledger(spark, home).agg(F.sum("n_rows")).first()[0]
    assert total == len(docs)
    # the state keeps digest, identifier and locator, never the text
    assert {f.name for f in spark.read.parquet(f"{home}/ledger").schema} == {"digest", "n_rows", "keep", "batch"}


def test_a_restarted_batch_counts_once(spark, tmp_path, monkeypatch):
    docs = _corpus(3)
    path, home = f"{tmp_path}/table", f"{tmp_path}/home"
    _table(spark, docs).repartition(4).write.parquet(path)
    made, calls = exact_dedup._rows, []

    def failing(table, id_col, text_col, digest, *more):
        @F.udf("binary")
        def stop(x):
            raise RuntimeError("lost")
        return made(table, id_col, text_col, lambda t: stop(t) if not calls else digest(t), *more)

    monkeypatch.setattr(exact_dedup, "_rows", failing)
    with pytest.raises(Exception, match="lost"):
        exact_dedup.ingest(spark, path, home)
    calls.append(1)
    monkeypatch.setattr(exact_dedup, "_rows", made)
    exact_dedup.ingest(spark, path, home)
    assert _rows(exact_dedup.resolve(spark, path, home)) == _brute(docs)


def test_filter_passes_every_hit_and_few_others(spark):
    hits = spark.range(3000).select(exact_dedup.sha256(F.col("id").cast("string")).alias("digest"))
    others = spark.range(10_000, 30_000).select(exact_dedup.sha256(F.col("id").cast("string")).alias("digest"))
    held = exact_dedup._filter_of(hits)
    assert hits.filter(held(F.col("digest"))).count() == 3000
    assert others.filter(held(F.col("digest"))).count() < 1000


def test_exact_odd_rows(odd, none):
    rows = [(r["doc_id"], r["text"]) for r in odd.select("doc_id", "text").collect()]
    got = _rows(exact_dedup.dedup(odd))
    assert len(got) == len(rows)
    assert [r[:3] + r[4:] for r in got] == [r[:3] + r[4:] for r in _brute(rows)]
    assert sum(r[3] for r in got) == len({r[4] for r in got})      # one row of each group stays, repeated ids too
    assert exact_dedup.dedup(none).count() == 0


def test_exact_query(spark, table_dir):
    docs = _corpus(4, 40)
    assert _rows(queries.op12_exact(spark, table_dir([(i, t, "en") for i, t in docs]))) == _brute(docs)
