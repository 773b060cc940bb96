"""Every stage of the pipeline against its brute-force rule, on one small corpus."""

import random

import public_tokenizers
import tiktoken

import corpus_pipeline
from martlake.llm import bpe, decontam, simhash
from martlake.llm.queries import VOCABULARY


def _corpus():
    rng = random.Random(13)
    vocab = ["".join(rng.choice("bcdfgklmnprst") + rng.choice("aeiou") for _ in range(rng.randint(1, 3))) for _ in range(300)]
    some = lambda n: [rng.choice(vocab) for _ in range(n)]
    items = [(j, " ".join(some(30))) for j in range(5)]
    docs, labels, kinds = [], [], {}
    for i in range(400):
        words, kind = some(rng.randint(40, 80)), "clean"
        if i % 4 == 1:
            kind = "toxic"
            for _ in range(3):
                words.insert(rng.randrange(len(words)), rng.choice(["zonkhead", "grumblor"]))
        elif i % 10 == 2:
            kind, words = "leak", words + items[i % 5][1].split()
        elif i % 10 == 4 and i > 10:
            kind, words = "copy", docs[i - i % 10][1].split()
        elif i % 10 == 6:
            kind, words = "secret", words + ["token=abcdef123456", "0123456789abcdef01234567"]
        kinds[i] = kind
        docs.append((i, " ".join(words), "en"))
        if i % 3:
            labels.append((i, 1, int(kind == "toxic")))
    return docs, labels, items, kinds


def test_pipeline(spark, table_dir):
    docs, labels, items, kinds = _corpus()
    sf = table_dir(docs, labels, items)
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "simhash_near_dedup", "decontamination", "secret_scan", "byte_bpe"]
    now = spark.read.parquet(f"{sf}/documents.parquet")
    columns, kept, frames = now.columns, [set(kinds)], {}
    for name, stage in corpus_pipeline.STAGES:
        now = spark.createDataFrame(stage(spark, now, sf).toPandas())
        frames[name] = now
        kept.append({r["doc_id"] for r in now.collect()})
        if name != "byte_bpe":
            assert now.columns == columns
    text = {i: t for i, t, _ in docs}
    assert kept[1] == {i for i in kinds if kinds[i] != "toxic"}
    # one document of each group within two bits stays: the smallest id
    fps = {i: simhash.simhash_text(text[i]) for i in kept[1]}
    group = {i: i for i in sorted(fps)}
    for i in sorted(fps):
        for j in sorted(fps):
            if j < i and bin(fps[i] ^ fps[j]).count("1") <= 2:
                low, high = sorted((group[i], group[j]))
                group = {k: low if g == high else g for k, g in group.items()}
    assert kept[2] == {i for i, g in group.items() if i == g}
    assert {i for i in kept[1] - kept[2]} >= {i for i in kept[1] if kinds[i] == "copy" and (i - i % 10) in kept[1]}
    leaks = {i for i in kept[2] for _, t in items
             if sum(x[2] for x in decontam.tile(decontam.word_ids(t), decontam.word_ids(text[i]))) >= 0.8 * len(t.split())}
    assert kept[3] == kept[2] - leaks and {kinds[i] for i in leaks} == {"leak"} and leaks
    assert kept[4] == kept[3] == kept[5]
    masked = {r["doc_id"]: r for r in frames["secret_scan"].collect()}
    for i, r in masked.items():
        want = text[i].replace("token=abcdef123456", "[SECRET]").replace("0123456789abcdef01234567", "[SECRET]")
        assert r["text"] == want and r["n_chars"] == len(want)
    path, pattern = public_tokenizers.path(VOCABULARY), public_tokenizers.PATTERN
    enc = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=bpe.read_ranks(path), special_tokens={})
    for r in frames["byte_bpe"].collect():
        assert r["n_tokens"] == len(enc.encode_ordinary(masked[r["doc_id"]]["text"]))
    whole = {r["doc_id"]: r["ids_sha256"] for r in corpus_pipeline.run(spark, sf).collect()}
    assert whole == {r["doc_id"]: r["ids_sha256"] for r in frames["byte_bpe"].collect()}


def test_stages_take_odd_rows(spark, odd, none, table_dir):
    sf = table_dir([(1, "a", "en")], [(1, 1, 0)], [(1, "the quick brown fox jumps over the lazy dog")])
    for docs in (odd, none):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, sf)
            assert name == "byte_bpe" or out.columns == docs.columns
            assert out.count() <= docs.count()
