"""Parquet folders stored by buckets of a key: joins and groups on the key then need no exchange.

The folder says so itself, by an empty file named after the key and the number of buckets that is
written last.  Whoever overwrites the folder removes it, and a copy of the data files alone
hasn't got it: both are then read as plain Parquet, which gives the same rows.

Rows of a null key share a bucket.  Silver is written after the critical checks, which allow no
null order id.
"""

from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame, SparkSession

from martlake.sources.storage import create_once, list_names, remove

_MARK = re.compile(r"_bucketed_by_(\w+)_into_(\d+)$")


def write_bucketed(df: DataFrame, path: str, key: str, buckets: int) -> None:
    """``df`` at ``path``, replaced if there, one file a bucket, sorted by ``key``."""
    spark = df.sparkSession
    remove(spark, path)
    name = f"bucketed_{uuid.uuid4().hex}"
    try:
        (df.repartition(buckets, key).write.format("parquet").bucketBy(buckets, key).sortBy(key)
         .option("path", path).saveAsTable(name))
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")      # the files stay
    create_once(spark, f"{path}/_bucketed_by_{key}_into_{buckets}", "")


def read_bucketed(spark: SparkSession, path: str) -> DataFrame:
    """The folder with its buckets, where it has any, or as plain Parquet.  It is declared under a
    passing name only: the result holds the files and needs no catalog afterwards."""
    marks = [m for n in list_names(spark, path) if (m := _MARK.match(n))]
    plain = spark.read.parquet(path)
    if len(marks) != 1:
        return plain
    key, buckets = marks[0].groups()
    name = f"bucketed_{uuid.uuid4().hex}"
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in plain.schema)
    where = path.replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY ({key}) SORTED BY ({key}) "
              f"INTO {int(buckets)} BUCKETS LOCATION '{where}'")
    try:
        return spark.table(name)
    finally:
        spark.sql(f"DROP TABLE {name}")
