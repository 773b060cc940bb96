"""Exactly-once incremental bronze landing of one source table (S3 as a stream)."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql.types import StringType, StructField, StructType

from martlake.sources import contracts as K
from martlake.sources.csv_source import MULTILINE_TABLES
from martlake.sources.storage import list_names


def _landed(spark: SparkSession, path: str) -> int:
    return spark.read.parquet(path).count() if list_names(spark, f"{path}/_spark_metadata") else 0


def land_stream(spark: SparkSession, source_dir: str, table: str, bronze_dir: str, checkpoint: str) -> int:
    """Land every not-yet-seen CSV of ``table`` (file name pattern of the package)
    into ``bronze_dir/table`` as text Parquet; returns the rows landed by this run.

    ``trigger(availableNow=True)`` processes the backlog and stops; the file
    source's checkpoint remembers which files were landed, so re-running after a
    failure neither loses nor duplicates a file.  A file whose header names other
    columns, or the same in another order, fails the run (``enforceSchema``) and
    nothing of its batch is landed.  Rows are counted in the landed table, whose
    Parquet footers hold the number.
    """
    filename = next(f for f in K.SOURCE_FILES if K.table_name(f) == table)
    schema = StructType([StructField(c, StringType()) for c in K.EXPECTED_COLUMNS[table]])
    path = f"{bronze_dir}/{table}"
    before = _landed(spark, path)
    stream = (spark.readStream.schema(schema).option("header", True).option("enforceSchema", False)
              .option("multiLine", table in MULTILINE_TABLES).option("escape", '"')
              .option("pathGlobFilter", filename.replace(".csv", "*.csv")).csv(source_dir))
    q = (stream.writeStream.format("parquet").option("path", path)
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()
    return _landed(spark, path) - before
