"""One query for each operator, applied to its whole table with production parameters."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from martlake.llm import (
    bpe, collocation, decontam, exact_dedup, langid, lexical, quality, secret_scan, simhash, substring_dedup, suffix_dedup, toxicity, winnow)
from martlake.llm._common import crc_bucket, documents, held_out, labelled_sample, staged

VOCABULARY = "byte_bpe_multi_50k.tiktoken"
TRAIN_ROWS = 12_000   # bound of the labelled rows a classifier is fitted on


def _labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document."""
    docs = documents(spark, sf_dir)
    train = _labels(spark, sf_dir).filter(crc_bucket("doc_id", 3) != 1)
    model = quality.fit(docs, labelled_sample(docs, train, "quality", TRAIN_ROWS))
    return quality.add_score(docs, model).select(
        "doc_id", held_out("doc_id", 3, 1).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op2_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted language of every document."""
    docs = documents(spark, sf_dir, "doc_id", "text", "lang")
    model = langid.fit(docs.filter(crc_bucket("doc_id", 5) != 0))
    return langid.add_language(docs.select("doc_id", "text"), model).select(
        "doc_id", held_out("doc_id", 5, 0).alias("held_out"), "lang_pred", "score")


def op3_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document, through a ledger that has seen nothing yet."""
    docs = documents(spark, sf_dir)
    findings, _ = secret_scan.scan(docs)
    # the columns are made once a blob, and only these narrow rows meet the paths
    base = F.filter("found", lambda s: s["place"] < len(secret_scan.BASE))
    count = lambda kind: F.size(F.filter("found", lambda s: s["kind"] == kind)).cast("long")
    per_blob = secret_scan.by_blob(findings).select(
        "blob", count("assign").alias("n_assign"), count("access").alias("n_access"), count("hex").alias("n_hex"),
        F.sha2(secret_scan.span_text(base), 256).alias("base_sha256"), secret_scan.span_text(F.col("found")).alias("spans"))
    # written apart from the join: a blob of many paths is then split or broadcast
    per_blob = staged(per_blob, "secret-blobs")
    paths = docs.select("doc_id", secret_scan.content_address(F.col("text")).alias("blob"))
    return paths.join(per_blob, "blob", "left").select(
        "doc_id", *[F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("n_assign", "n_access", "n_hex")],
        F.coalesce("base_sha256", F.sha2(F.lit(""), 256)).alias("base_sha256"), F.coalesce("spans", F.lit("")).alias("spans"))


def op4_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Winnowing fingerprints of every document and of its edited text."""
    return winnow.compare_next(documents(spark, sf_dir))


def op5_suffix_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the 50-byte strings that start in an earlier one."""
    return suffix_dedup.dedup_bytes(documents(spark, sf_dir)).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item, whole or with its passages in another order."""
    return decontam.contaminated(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet")).select(
        "doc_id", "item_id", "n_words", "n_covered", F.round("coverage", 6).alias("coverage"),
        F.size("tiles").alias("n_tiles"))


def op7_substring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the 50-word passages that start in an earlier one."""
    return substring_dedup.dedup_words(documents(spark, sf_dir)).select(
        "doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op8_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of every document, and what they decode to."""
    return bpe.token_digests(documents(spark, sf_dir), public_tokenizers.path(VOCABULARY), public_tokenizers.PATTERN)


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SimHash fingerprint and near-duplicate component of every document."""
    groups = simhash.simhash_groups(documents(spark, sf_dir))
    return groups.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document."""
    docs = documents(spark, sf_dir)
    train = _labels(spark, sf_dir).filter(crc_bucket("doc_id", 4) != 2)
    model = toxicity.fit(labelled_sample(docs, train, "toxic", TRAIN_ROWS))
    return toxicity.add_score(docs, model).select(
        "doc_id", held_out("doc_id", 4, 2).alias("held_out"), "score",
        (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 2,000 best phrases of every language."""
    return collocation.collocations(documents(spark, sf_dir, "lang", "text"))


def op12_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact copies of every document, by a stream over the table's files."""
    return exact_dedup.dedup_table(spark, f"{sf_dir}/documents.parquet")


def op13_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best documents of every benchmark item."""
    return lexical.rank(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text"))


EXACT_SQL = """
    WITH t AS (SELECT doc_id, coalesce(text, '') AS text, regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]', '', 'g') AS content
               FROM documents),
    g AS (SELECT content, count(*) AS group_size, arg_min(doc_id, (-length(text), doc_id)) AS keep_id FROM t GROUP BY content)
    SELECT doc_id, keep_id, CAST(group_size AS BIGINT) AS group_size, doc_id = keep_id AS kept, sha256(content) AS text_sha256
    FROM t JOIN g USING (content)"""


COLLOCATION_SQL = """
    WITH t AS (SELECT coalesce(lang, 'und') AS lang, row_number() OVER () AS r,
               regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[.,;:!?\\x0A-\\x0D]') AS pieces FROM documents),
    p AS (SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS w FROM (SELECT lang, unnest(pieces) AS piece FROM t)),
    grams AS (SELECT lang, m, w[i:i + m - 1] AS g
              FROM (SELECT lang, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM p, (SELECT unnest(range(1, 6)) AS m))),
    f AS (SELECT lang, m, g, count(*) AS f FROM grams GROUP BY ALL),
    total AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM f WHERE m = 1 GROUP BY lang),
    c AS (SELECT lang, m, g, f AS a, n FROM f JOIN total USING (lang) WHERE f >= 100 AND m > 1),
    cuts AS (SELECT c.lang, c.m, c.g, c.a, c.n, k, x.f AS l, y.f AS r,
                    (CAST(1000 AS HUGEINT) * c.a * c.n) // (CAST(x.f AS HUGEINT) * y.f) AS score
             FROM (SELECT *, unnest(range(1, m)) AS k FROM c) c
             JOIN f x ON x.lang = c.lang AND x.g = c.g[:k] JOIN f y ON y.lang = c.lang AND y.g = c.g[k + 1:]),
    scored AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, k) = 1),
    inner_parts AS (SELECT lang, a, g[i:j] AS g FROM (SELECT lang, m, a, g, unnest(range(1, m + 1)) AS i FROM c),
                    (SELECT unnest(range(2, 5)) AS size), LATERAL (SELECT i + size - 1 AS j) WHERE j <= m AND size < m),
    longer AS (SELECT lang, g, max(a) AS most FROM inner_parts GROUP BY ALL),
    kept AS (SELECT s.lang, array_to_string(s.g, ' ') AS phrase, a, l, r, n, CAST(score AS BIGINT) AS score
             FROM scored s LEFT JOIN longer USING (lang, g) WHERE most IS NULL OR 100 * most < 100 * a)
    SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank, phrase, a, l, r, n, score
    FROM kept QUALIFY rank <= 2000"""


_TERMS = "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9A-Za-z\\x{80}-\\x{10FFFF}]+')"

SEARCH_SQL = f"""
    WITH d AS (SELECT doc_id, row_number() OVER () AS r, {_TERMS} AS t FROM documents),
    size AS (SELECT r, any_value(doc_id) AS doc_id, any_value(CAST(len(t) AS BIGINT)) AS n FROM d GROUP BY r),
    total AS (SELECT count(*) FILTER (n > 0) AS docs, CAST(sum(n) AS BIGINT) AS length FROM size),
    wanted AS (SELECT item_id, term, count(*) AS times FROM (SELECT item_id, unnest({_TERMS}) AS term FROM benchmark) GROUP BY ALL),
    tf AS (SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(t) AS term FROM d)
           WHERE term IN (SELECT term FROM wanted) GROUP BY ALL),
    w AS (SELECT term, CAST(floor(1000 * ln(CAST(2 * docs + 2 AS DOUBLE) / (2 * df + 1))) AS BIGINT) AS w
          FROM (SELECT term, count(*) AS df FROM tf GROUP BY term), total),
    impact AS (SELECT r, term, (1000000000 * tf) // (1000 * tf + 8 * (100 - 75 + (75 * n * docs) // length)) AS i
               FROM tf JOIN size USING (r), total),
    scores AS (SELECT item_id, doc_id, r, CAST(sum(times * w * i) AS BIGINT) AS score
               FROM wanted JOIN w USING (term) JOIN impact USING (term) JOIN size USING (r) GROUP BY ALL)
    SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
    FROM scores WHERE score > 0
    QUALIFY rank <= 10"""


def _secret_sql() -> str:
    """DuckDB form of op3: matches and the pieces between them, by list functions."""
    def one(i: int, r: secret_scan.Rule) -> str:
        re = r.pattern.replace("'", "''")
        return f"""
        SELECT doc_id, {i} AS place, '{r.kind}' AS kind, unnest(range(1, len(m) + 1)) AS k, m, g, p FROM (
            SELECT doc_id, regexp_extract_all(t, '{re}', 0) AS m, regexp_extract_all(t, '{re}', {r.group}) AS g,
                   string_split_regex(t, '{re}') AS p
            FROM (SELECT doc_id, coalesce(text, '') AS t FROM documents))"""

    rules = " UNION ALL ".join(one(i, r) for i, r in enumerate(secret_scan.RULES))
    least = " ".join(f"WHEN {i} THEN {r.least}" for i, r in enumerate(secret_scan.RULES))
    return f"""
    WITH raw AS ({rules}),
    placed AS (
        SELECT doc_id, place, kind, length(m[k]) AS size,
               list_sum([length(x) FOR x IN p[1:k]]) + coalesce(list_sum([length(x) FOR x IN m[1:k - 1]]), 0) AS s
        FROM raw WHERE length(g[k]) >= CASE place {least} END),
    spans AS (
        SELECT doc_id, place, kind, CAST(s AS BIGINT) AS s,
               kind || ':' || CAST(s AS BIGINT) || ':' || CAST(s + size AS BIGINT) AS span FROM placed),
    per_doc AS (
        SELECT doc_id, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access,
               count(*) FILTER (kind = 'hex') AS n_hex,
               coalesce(string_agg(span, ',' ORDER BY s, place) FILTER (place < {len(secret_scan.BASE)}), '') AS base,
               string_agg(span, ',' ORDER BY s, place) AS spans
        FROM spans GROUP BY doc_id)
    SELECT d.doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
           sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
    FROM documents d LEFT JOIN per_doc USING (doc_id)"""


QUERIES = {f.__name__: f for f in (op1_quality, op2_language, op3_secrets, op4_winnowing, op5_suffix_array, op6_decontamination, op7_substring, op8_bpe, op9_simhash,
                                   op10_toxicity, op11_collocations, op12_exact, op13_search)}
SQL: dict[str, str] = {"op3_secrets": _secret_sql(), "op11_collocations": COLLOCATION_SQL, "op12_exact": EXACT_SQL, "op13_search": SEARCH_SQL}
