"""Global rank and running sum without a single-partition window.

``Window.orderBy(...)`` with no ``partitionBy`` moves every row into one task.
Instead:

1. rows are range-partitioned by the whole order, (key, tiebreak): Spark samples
   the composite bounds itself, as many as the session has shuffle partitions, so
   rows that tie on the key spread over as many tasks as their number needs;
2. each partition is sorted and its rows numbered, and this is written once to
   the checkpoint folder.  Everything after reads those files, so a task that runs again finds
   the same partitions and numbers;
3. per-partition counts and exact sums (one row a partition) give offsets by a
   window over that small table, broadcast back (its size is the number of
   partitions);
4. the rank is offset + number: no further shuffle.  A running sum needs a window
   inside each partition.

Running sums stay DECIMAL until the caller casts them, so they are exact.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from martlake.functions import money
from martlake.session import materialize

ROW_BITS = 33     # monotonically_increasing_id: partition above, row number below


def global_rank(df: DataFrame, key_col: str, ascending: bool = True,
                tiebreak: Sequence[str] = (), value_col: str | None = None,
                partitions: int | None = None, rank_col: str = "rank", cum_col: str = "cum_value") -> DataFrame:
    """Add ``rank_col`` (1..n in (key, tiebreak) order) and, if ``value_col`` is
    given, ``cum_col`` = exact running sum of ``money(value_col)`` in that order.

    The key is numeric; rows with a null key come last in either direction.  ``partitions`` is the
    session's shuffle partition count by default.
    """
    k = F.col(key_col).cast("double")
    order = [F.col("__k").asc_nulls_last()] + [F.col(c).asc_nulls_last() for c in tiebreak]
    dealt = df.withColumn("__k", k if ascending else -k)
    # a stated number, so that adaptive execution doesn't merge the partitions of small inputs' samples
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = dealt.repartitionByRange(n, *order).sortWithinPartitions(*order)
    at = F.monotonically_increasing_id()
    val = money(value_col) if value_col else F.lit(0).cast("decimal(28,10)")
    d = materialize(dealt.select("*", F.shiftright(at, ROW_BITS).alias("__part"),
                                 at.bitwiseAND(F.lit((1 << ROW_BITS) - 1)).alias("__at"), val.alias("__v")))
    per_part = d.groupBy("__part").agg(F.count(F.lit(1)).alias("__n"), F.sum("__v").alias("__s"))
    # One row a partition: an unpartitioned window here is bounded.
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_part.select("__part", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__off_n"),
                              F.coalesce(F.sum("__s").over(before), F.lit(0)).alias("__off_s"))
    d = d.join(F.broadcast(offsets), "__part").withColumn(rank_col, F.col("__off_n") + F.col("__at") + 1)
    if value_col:
        running = Window.partitionBy("__part").orderBy("__at").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        d = d.withColumn(cum_col, F.col("__off_s") + F.sum("__v").over(running))
    return d.drop("__k", "__part", "__at", "__v", "__off_n", "__off_s")
