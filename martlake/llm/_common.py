"""Helpers shared by the operators of this package."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from martlake.session import checkpoint_dir, ship  # noqa: F401

def staged(df: DataFrame, name: str, options: dict[str, str] | None = None) -> DataFrame:
    """Write ``df`` once to the folder in ``spark.checkpoint.dir`` and read it back: cuts
    lineage, keeps statistics, and survives a lost executor.  ``options`` are the writer's."""
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    schema = df.schema
    df.write.options(**(options or {})).parquet(path)
    return spark.read.schema(schema).parquet(path)


def documents(spark: SparkSession, sf_dir: str, *cols: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return df.select(*(cols or ("doc_id", "text")))


def parts(spark: SparkSession) -> int:
    """The scale knob of the operators: the session's shuffle partition count, which the
    user sizes to the input."""
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def fresh(df: DataFrame, name: str) -> str:
    """A helper column's name that no column of ``df`` has."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def held_out(id_col, n: int, rest: int):
    """Is the id's remainder ``rest``?  A null id is not held out."""
    return F.coalesce(crc_bucket(id_col, n) == rest, F.lit(False))


def crc_bucket(id_col, n: int):
    """crc32 of the id as text, modulo ``n`` (null for a null id)."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % F.lit(n)


def labelled_sample(docs: DataFrame, labels: DataFrame, label_col: str, rows: int, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """``(doc_id, text, label)`` of about ``rows`` labelled documents at most, chosen by a hash
    of the id on the narrow side before any text moves, and written once.  ``labels`` is
    already restricted to training ids; rows with a null id or label are left out."""
    flat = (labels.select(F.col(id_col).alias("doc_id"), F.col(label_col).cast("int").alias("label"))
            .filter("doc_id is not null and label is not null").groupBy("doc_id").agg(F.max("label").alias("label")))
    n = flat.count()
    if n > rows:
        rate = F.pmod(F.xxhash64(F.col("doc_id").cast("string"), F.lit(7)), F.lit(1_000_000))
        flat = flat.filter(rate < int(1e6 * rows / n))
    text = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return staged(text.join(flat, "doc_id"), "labelled")
