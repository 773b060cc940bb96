"""Table and column profiles.

Every profile is one aggregate pass (plus one grouped pass where duplicates
are counted); per-column statistics are computed in a single ``agg`` and then
unpivoted, so profiling a wide table is still one job.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martlake.operators.quantiles import quantiles


def table_profile(name: str, df: DataFrame) -> DataFrame:
    """Rows, columns and full-row duplicates (first occurrence not counted)."""
    per_row = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("__n"))
    return per_row.agg(F.lit(name).alias("table_name"),
                       F.coalesce(F.sum("__n"), F.lit(0)).cast("bigint").alias("rows"),
                       F.lit(len(df.columns)).cast("bigint").alias("columns"),
                       F.coalesce(F.sum(F.col("__n") - 1), F.lit(0)).cast("bigint").alias("duplicate_rows"))


def null_profile(name: str, df: DataFrame) -> DataFrame:
    """Null count and share per column, only columns with nulls (one pass, unpivoted)."""
    cols = df.columns
    agg = df.agg(F.count(F.lit(1)).alias("__rows"),
                 *[F.count_if(F.col(c).isNull()).alias(f"n{i}") for i, c in enumerate(cols)])
    stacked = agg.select("__rows", F.explode(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(f"n{i}").alias("nulls")) for i, c in enumerate(cols)
    ])).alias("s"))
    return (stacked.select(F.lit(name).alias("table_name"), "s.column_name", "s.nulls",
                           (F.col("s.nulls") / F.col("__rows")).alias("share"))
            .filter(F.col("nulls") > 0))


def describe(df: DataFrame, col: str, probs: Sequence[float], scale: float = 1.0) -> DataFrame:
    """Count, mean, sample std, min, exact percentiles (interpolated), max of ``col / scale``.

    Mean and deviation are Spark's mergeable centred moments (count, mean and M2, combined pairwise), so
    values of any size are neither cut nor overflow, and nearly equal ones don't cancel.
    Like any floating-point sum they can differ in the last digits with the order of rows.
    """
    base = df.select(F.col(col).cast("double").alias("x"))
    m = base.agg(F.count("x").alias("n"), F.avg("x").alias("_mean"), F.stddev_samp("x").alias("_std"), F.min("x").alias("_min"), F.max("x").alias("_max"))
    names = ["p" + f"{p * 100:g}".replace(".", "_") for p in probs]
    q = quantiles(base, "x", probs, names)
    qcols = [(q.select(F.col(nm) / F.lit(scale)).scalar()).alias(nm) for nm in names]
    return m.select(F.lit(col).alias("column_name"), F.col("n").alias("count"), (F.col("_mean") / F.lit(scale)).alias("mean"),
                    F.when(F.col("n") > 1, F.col("_std") / F.lit(scale)).alias("std"), (F.col("_min") / F.lit(scale)).alias("min"),
                    *qcols, (F.col("_max") / F.lit(scale)).alias("max"))


def zip_ambiguity(geo: DataFrame, lat_range=(-35.0, 6.0), lng_range=(-75.0, -30.0)) -> DataFrame:
    """Zips, zips with several city spellings / states, max rows per zip, coordinates outside the box."""
    z = "geolocation_zip_code_prefix"
    per_zip = geo.filter(F.col(z).isNotNull()).groupBy(z).agg(
        F.count(F.lit(1)).alias("rows"), F.countDistinct("geolocation_city").alias("cities"),
        F.countDistinct("geolocation_state").alias("states"),
        (F.max("geolocation_lat") - F.min("geolocation_lat")).alias("lat_span"),
        (F.max("geolocation_lng") - F.min("geolocation_lng")).alias("lng_span"))
    outside = geo.agg(F.count_if(~(F.coalesce(F.col("geolocation_lat").between(*lat_range), F.lit(False))
                                   & F.coalesce(F.col("geolocation_lng").between(*lng_range), F.lit(False))))
                      .alias("o")).select("o").scalar()
    return per_zip.agg(F.count(F.lit(1)).alias("zip_codes"),
                       F.count_if(F.col("cities") > 1).alias("zip_with_multiple_cities"),
                       F.count_if(F.col("states") > 1).alias("zip_with_multiple_states"),
                       F.max("rows").alias("max_rows_per_zip"),
                       F.max("lat_span").alias("max_lat_span"),
                       F.max("lng_span").alias("max_lng_span")).select(
        "*", outside.alias("coordinates_outside_box"))


def geo_summary(geo: DataFrame) -> DataFrame:
    """A10: rows, full-row duplicates, distinct zips."""
    dup = table_profile("geolocation", geo)
    zips = geo.agg(F.countDistinct("geolocation_zip_code_prefix").alias("z")).select("z").scalar()
    return dup.select("rows", F.col("duplicate_rows").alias("full_duplicates"), zips.alias("unique_zip_codes"))


def identity_profile(customers: DataFrame) -> DataFrame:
    """Customer ids, people, people with more than one customer id."""
    per_person = customers.filter(F.col("customer_unique_id").isNotNull()).groupBy("customer_unique_id").agg(
        F.countDistinct("customer_id").alias("ids"))
    ids = customers.agg(F.countDistinct("customer_id").alias("v")).select("v").scalar()
    return per_person.agg(ids.alias("customer_ids"), F.count(F.lit(1)).alias("unique_people"),
                          F.count_if(F.col("ids") > 1).alias("people_with_multiple_customer_ids"))


def status_completeness(orders: DataFrame,
                        cols=("order_approved_at", "order_delivered_carrier_date",
                              "order_delivered_customer_date")) -> DataFrame:
    """Per status, orders and the filled share of each lifecycle date (one grouped pass)."""
    return orders.filter(F.col("order_status").isNotNull()).groupBy("order_status").agg(
        F.count(F.lit(1)).alias("orders"),
        *[F.avg(F.col(c).isNotNull().cast("int")).alias(f"{c}_filled") for c in cols])


def cycle_times(orders: DataFrame) -> DataFrame:
    """Approval hours, delivery days and delay days as fractional values (from seconds)."""
    sec = lambda a, b: F.timestamp_diff("SECOND", F.col(a), F.col(b))
    return orders.select(
        "order_status",
        sec("order_purchase_timestamp", "order_approved_at").alias("approval_seconds"),
        sec("order_purchase_timestamp", "order_delivered_customer_date").alias("delivery_seconds"),
        sec("order_estimated_delivery_date", "order_delivered_customer_date").alias("delay_seconds"),
        "order_delivered_customer_date")


def cycle_time_anomalies(orders: DataFrame) -> DataFrame:
    """Approval or delivery before purchase, and delivered orders without a delivery date."""
    c = cycle_times(orders)
    return c.agg(F.count_if(F.col("approval_seconds") < 0).alias("approval_before_purchase"),
                 F.count_if(F.col("delivery_seconds") < 0).alias("delivery_before_purchase"),
                 F.count_if((F.col("order_status") == "delivered")
                            & F.col("order_delivered_customer_date").isNull()).alias("delivered_missing_date"))


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)
