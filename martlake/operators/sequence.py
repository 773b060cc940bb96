"""Next event of the same entity (``lead``) that survives a hot entity.

``lead(ts).over(partitionBy(entity).orderBy(ts, id))`` sends all rows of an
entity to one task; an entity holding a third of the data would stall the
stage.  Here the window is split by time bucket, over one frame that is read once:

1. ``lead`` and ``lag`` inside ``(entity, bucket)`` windows; a row that lacks one of
   them is at its bucket's edge, so there are at most two a bucket;
2. a second window brings only an entity's edge rows together: the row after a
   bucket's last one is the first of the entity's next non-empty bucket.  All other
   rows stay dealt by ``(entity, bucket)``.

Ordering is total: ``(ts, id)``; equal timestamps are broken by ``id``.  Rows of an unknown (null)
entity make no sequence: they are dealt by their id and have no next event.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def next_in_sequence(df: DataFrame, entity: Sequence[str] | str, ts: str, tiebreak: str,
                     bucket: str = "month", next_ts: str = "next_ts", next_id: str = "next_id") -> DataFrame:
    """Add the timestamp and id of the entity's next event (null for the last)."""
    entity = [entity] if isinstance(entity, str) else list(entity)
    # Time-zone-free bucket (monotone in ts): calendar truncation of the date.
    if bucket == "day":
        bkt = F.to_date(F.col(ts))
    elif bucket in ("week", "month", "quarter", "year"):
        bkt = F.trunc(F.to_date(F.col(ts)), bucket)
    else:
        bkt = F.date_trunc(bucket, F.col(ts))
    event = F.struct(F.col(ts).alias("t"), F.col(tiebreak).alias("i"))
    unknown = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in entity])
    d = df.withColumn("__bkt", F.struct(bkt)).withColumn("__alone", F.when(unknown, F.struct(F.col(tiebreak))))
    w = Window.partitionBy(*entity, "__alone", "__bkt").orderBy(F.col(ts), F.col(tiebreak))
    d = d.withColumn("__next", F.lead(event).over(w)).withColumn("__edge", F.col("__next").isNull() | F.lag(event).over(w).isNull())
    d = d.withColumn("__cell", F.when(~F.col("__edge"), F.col("__bkt")))
    edges = Window.partitionBy(*entity, "__alone", "__cell").orderBy(F.col(ts), F.col(tiebreak))
    d = d.withColumn("__far", F.lead(event).over(edges))
    d = d.withColumn("__next", F.when(~unknown, F.coalesce("__next", "__far")))
    return (d.withColumn(next_ts, F.col("__next.t")).withColumn(next_id, F.col("__next.i"))
             .drop("__bkt", "__alone", "__next", "__edge", "__cell", "__far"))
