"""Exact deduplication as a stateful stream.

``ingest`` runs a Structured Streaming query over the files of a Parquet table that it hasn't seen: a row becomes
(digest of the normalised text, order, locator), and the state, keyed by the digest and kept on disk in RocksDB
without expiry, holds the number of rows, the stable identifier (the id of the row that stays) and the
content locator (file and row index) of its text.  Texts never enter the state.  Equal digests are combined in
each task before the shuffle, so a text of a third of all rows sends one row a task.  Each batch
writes the digests it changed to ``ledger/batch=N``, overwriting on a retry; the checkpoint lets a restarted job go on
where it stopped, and a later call take only new files.

``resolve`` checks full bytes on hits.  Only rows whose digest is held by more than one row are read with their texts
(a Bloom filter of these digests, whose size has a bound, goes to the executors; what it lets through needlessly
is harmless), and grouped by digest and full text: equal ones collapse in each task first.
A digest with two different texts is a collision: its rows are counted again by the text itself.
Every row then meets the state's entry of its digest.

The order in a group: most code points of the original text, then smallest id (null last), then locator.

Defined cases: null counts as empty; texts without anything but white space are equal to the empty one; rows
that repeat id and text are rows of one group, of which one stays; null ids are ids that come last; an empty table gives an
empty result; columns other than id and text are ignored.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from martlake.llm._common import parts, ship, staged
from martlake.session import checkpoint_dir

BLANK = " \t\n\x0b\x0c\r"
BATCH_BYTES = 4 << 20     # input of a micro-batch for each shuffle partition
PROBES = 4
MOST_BITS = 28            # the filter of digests has 2**28 bits (32 MB) at most

STREAM_CONF = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "256",
    # small states: no disk set aside beforehand for each store's logs
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
}
LEDGER = ("digest binary, n_rows long, keep struct<shorter:long,unnamed:boolean,doc_id:long,file:string,row:long>, batch long")

Digest = Callable[[Column], Column]


def normal(text: Column) -> Column:
    """The text without its white space; null counts as empty."""
    return F.translate(F.coalesce(text.cast("string"), F.lit("")), BLANK, "")


def sha256(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


def _rows(table: DataFrame, id_col: str, text_col: str, digest: Digest, *more: Column) -> DataFrame:
    """Digest, order and locator of every row of a Parquet table, as a stream or not."""
    text = F.col(text_col).cast("string")
    # one slash after the scheme, however the reader spells a local path
    file = F.regexp_replace(F.col("_metadata.file_path"), "^([a-z0-9]+):/+(?=[^/])", "$1:///")
    doc_id = F.col(id_col).cast("long")
    order = F.struct((-F.coalesce(F.char_length(text), F.lit(0))).cast("long").alias("shorter"), doc_id.isNull().alias("unnamed"),
                     doc_id.alias("doc_id"), file.alias("file"), F.col("_metadata.row_index").alias("row"))
    return table.select(digest(normal(text)).alias("digest"), order.alias("place"), *more)


def ingest(spark: SparkSession, path: str, home: str, id_col: str = "doc_id", text_col: str = "text", digest: Digest = sha256,
           batch_bytes: int = BATCH_BYTES) -> None:
    """Bring the state in ``home`` (a shared folder) up to the files of the Parquet table at ``path``."""
    own = spark.newSession()     # the settings of the state hold for this query alone
    for key in ("spark.sql.shuffle.partitions", "spark.sql.session.timeZone"):
        own.conf.set(key, spark.conf.get(key))
    for key, value in STREAM_CONF.items():
        own.conf.set(key, value)
    path = path.rstrip("/")
    # the file source takes a pattern where the table is one file
    source = (own.readStream.schema(spark.read.parquet(path).schema).option("maxBytesPerTrigger", str(batch_bytes * parts(spark)))
              .parquet(f"{path[:-1]}[{path[-1]}]"))
    state = _rows(source, id_col, text_col, digest).groupBy("digest").agg(F.count("*").alias("n_rows"), F.min("place").alias("keep"))

    def write(changed: DataFrame, batch: int) -> None:
        changed.write.mode("overwrite").parquet(f"{home}/ledger/batch={batch}")

    (state.writeStream.outputMode("update").option("checkpointLocation", f"{home}/state").foreachBatch(write)
     .trigger(availableNow=True).start().awaitTermination())


def ledger(spark: SparkSession, home: str) -> DataFrame:
    """``(digest, n_rows, keep)``: the state's present entry of every digest."""
    return (spark.read.schema(LEDGER).parquet(f"{home}/ledger").groupBy("digest")
            .agg(F.max_by(F.struct("n_rows", "keep"), "batch").alias("now")).select("digest", "now.*"))


def _filter_of(digests: DataFrame) -> Callable[[Column], Column]:
    """A test that all of ``digests`` pass and few others, by a Bloom filter of bounded size."""
    spark = digests.sparkSession
    bits = min(MOST_BITS, max(16, (10 * digests.count()).bit_length()))
    probe = F.array(*[F.shiftrightunsigned(F.xxhash64("digest", F.lit(k)), 64 - bits) for k in range(PROBES)])
    words = (digests.select(F.explode(probe).alias("at")).groupBy(F.shiftright("at", 6).alias("word"))
             .agg(F.bit_or(F.expr("shiftleft(1L, cast(at & 63 as int))")).alias("bits"))).toPandas()
    table = np.zeros(1 << (bits - 6), np.int64)
    table[words["word"].to_numpy(np.int64)] = words["bits"].to_numpy(np.int64)
    shared = spark.sparkContext.broadcast(table)

    @F.pandas_udf("boolean")
    def held(*at: pd.Series) -> pd.Series:
        ok = np.ones(len(at[0]), bool)
        for a in (x.to_numpy(np.int64) for x in at):
            ok &= (shared.value[a >> 6] >> (a & 63)) & 1 != 0
        return pd.Series(ok)

    return lambda digest: held(*[F.shiftrightunsigned(F.xxhash64(digest, F.lit(k)), 64 - bits) for k in range(PROBES)])


def resolve(spark: SparkSession, path: str, home: str, id_col: str = "doc_id", text_col: str = "text", digest: Digest = sha256) -> DataFrame:
    """``(doc_id, keep_id, group_size, kept, text_sha256)`` of every row of the table, by the state in ``home``."""
    ship(spark)
    state = staged(ledger(spark, home), "dedup-ledger")
    table = spark.read.parquet(path)
    rows = _rows(table, id_col, text_col, digest, normal(F.col(text_col)).alias("content"))
    hits = state.filter("n_rows > 1").select("digest")
    contents = rows.filter(_filter_of(hits)(F.col("digest"))).groupBy("digest", "content").agg(
        F.count("*").alias("n_rows"), F.min("place").alias("keep"))
    collisions = staged(contents.groupBy("digest").agg(F.count("*").alias("texts")).filter("texts > 1").select("digest"), "dedup-collisions")

    def decided(part: DataFrame, entries: DataFrame, on: list[str]) -> DataFrame:
        return part.join(entries, on).select(
            F.col("place.doc_id").alias("doc_id"), F.col("keep.doc_id").alias("keep_id"), F.col("n_rows").alias("group_size"),
            ((F.col("place.file") == F.col("keep.file")) & (F.col("place.row") == F.col("keep.row"))).alias("kept"), "text_sha256")

    named = rows.withColumn("text_sha256", F.lower(F.hex("digest")) if digest is sha256 else F.sha2("content", 256))
    if collisions.isEmpty():
        return decided(named.drop("content"), state, ["digest"])
    clear = decided(named.join(collisions, "digest", "left_anti").drop("content"), state, ["digest"])
    apart = named.join(collisions, "digest", "left_semi")
    texts = contents.join(collisions, "digest", "left_semi")
    return clear.unionByName(decided(apart, staged(texts, "dedup-texts"), ["digest", "content"]))


def new_home(spark: SparkSession) -> str:
    """An empty folder for a state, below the shared checkpoint folder."""
    return f"{checkpoint_dir(spark).rstrip('/')}/exact-dedup-{uuid.uuid4().hex}"


def dedup_table(spark: SparkSession, path: str, id_col: str = "doc_id", text_col: str = "text", digest: Digest = sha256,
                batch_bytes: int = BATCH_BYTES) -> DataFrame:
    """Every row of the Parquet table at ``path`` with its group's decision."""
    home = new_home(spark)
    ingest(spark, path, home, id_col, text_col, digest, batch_bytes)
    return resolve(spark, path, home, id_col, text_col, digest)


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", digest: Digest = sha256) -> DataFrame:
    """The same for a DataFrame, written first so that its rows have locators."""
    spark = docs.sparkSession
    path = f"{new_home(spark)}/input"
    docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).write.parquet(path)
    return dedup_table(spark, path, digest=digest)
