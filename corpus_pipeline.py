"""Corpus pipeline over ``documents``: each stage works on all that its predecessor kept."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from martlake.llm import bpe, decontam, secret_scan, simhash, toxicity
from martlake.llm._common import crc_bucket, labelled_sample, staged
from martlake.llm.queries import TRAIN_ROWS, VOCABULARY

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def toxic_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Toxicity: documents with a score of 0.3 or more go."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").filter(crc_bucket("doc_id", 4) != 2)
    model = toxicity.fit(labelled_sample(docs, labels, "toxic", TRAIN_ROWS))
    return toxicity.drop_toxic(docs, model)


def near_copies_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """SimHash near-duplicates: the document with the smallest id of each group stays."""
    return simhash.drop_near_duplicates(docs, shingle=3, max_bits=2)


def benchmark_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Decontamination: documents that hold a benchmark item go."""
    return decontam.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def secrets_masked(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secret scan: every found span is masked, the document stays."""
    return secret_scan.redact(docs, length_col="n_chars")


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Byte-level BPE: token ids (little-endian 32-bit) and what they decode to, as digests."""
    coded = bpe.add_tokens(docs, public_tokenizers.path(VOCABULARY), public_tokenizers.PATTERN, share=5)
    return coded.select("doc_id", F.expr("cast(octet_length(ids) / 4 as long)").alias("n_tokens"), "ids",
                        F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", toxic_out),
    ("simhash_near_dedup", near_copies_out),
    ("decontamination", benchmark_out),
    ("secret_scan", secrets_masked),
    ("byte_bpe", tokens),
]

# Learned scores, XXH64 fingerprints and byte-pair encoding have no DuckDB form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
