"""Key, reference, domain and schema checks as distributed aggregates.

Each check returns a one-row (or small) DataFrame; nothing is collected.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def any_null(cols: Sequence[str]) -> Column:
    return reduce(lambda a, b: a | b, [F.col(c).isNull() for c in cols])


def key_profile(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows, duplicate keys (first occurrence not counted) and null keys.

    One shuffle: group on the key (nulls compare equal, as in pandas
    ``duplicated``), then fold the per-key counts.  A hot key costs one partial
    row per task thanks to map-side aggregation.
    """
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("rows"),
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).cast("bigint").alias("duplicates"),
        F.coalesce(F.sum(F.when(any_null(keys), F.col("n"))), F.lit(0)).cast("bigint").alias("null_keys"),
    )


def orphans(child: DataFrame, child_col: str, parent: DataFrame, parent_col: str) -> DataFrame:
    """Child rows whose value is absent from the parent (one row: ``orphans``).

    Null-safe: a null child only matches when the parent holds a null too.
    The parent side is reduced to its distinct keys before the anti join.
    """
    p = parent.select(F.col(parent_col).alias("__pk")).distinct()
    c = child.select(F.col(child_col).alias("__ck"))
    missing = c.join(p, c["__ck"].eqNullSafe(p["__pk"]), "left_anti")
    return missing.agg(F.count(F.lit(1)).alias("orphans"))


def domain_profile(df: DataFrame, col: str, valid: Iterable[str]) -> DataFrame:
    """Each distinct value with its row count and whether it is in the domain.

    A null value is outside the domain.
    """
    valid = list(valid)
    return (df.groupBy(col).agg(F.count(F.lit(1)).alias("rows"))
            .withColumn("in_domain", F.coalesce(F.col(col).isin(*valid), F.lit(False))))


def schema_diff(spark: SparkSession, tables: dict[str, DataFrame],
                expected: dict[str, Sequence[str]]) -> DataFrame:
    """Per table, expected vs actual column sets (missing / unexpected names).

    Column names are plan metadata, so this builds a tiny frame of names and
    compares them with set operations (``exceptAll`` both ways).
    """
    actual_rows = [(t, c) for t, df in tables.items() for c in df.columns]
    expected_rows = [(t, c) for t, cols in expected.items() for c in cols]
    schema = "table string, column string"
    actual = spark.createDataFrame(actual_rows, schema)
    want = spark.createDataFrame(expected_rows, schema)
    missing = want.exceptAll(actual).groupBy("table").agg(F.count(F.lit(1)).alias("missing"))
    unexpected = actual.exceptAll(want).groupBy("table").agg(F.count(F.lit(1)).alias("unexpected"))
    names = spark.createDataFrame([(t,) for t in expected], "table string")
    return (names.join(missing, "table", "left").join(unexpected, "table", "left")
            .select("table",
                    F.coalesce("missing", F.lit(0)).cast("bigint").alias("missing"),
                    F.coalesce("unexpected", F.lit(0)).cast("bigint").alias("unexpected"))
            .withColumn("passed", (F.col("missing") == 0) & (F.col("unexpected") == 0)))


def schema_failures(tables: dict[str, DataFrame], expected: dict[str, Sequence[str]]) -> dict[str, tuple]:
    """Driver-side view of the same comparison (plan metadata only, no job)."""
    out = {}
    for t, cols in expected.items():
        actual = set(tables[t].columns) if t in tables else set()
        out[t] = (sorted(set(cols) - actual), sorted(actual - set(cols)))
    return out
