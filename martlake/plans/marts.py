"""Gold marts (A4-A7) and the zip-level geolocation consolidation.

Every mart is one aggregation over a fact: partial (map-side) aggregation runs
before the shuffle, so a hot key costs one partial row per task, not its rows.
Presentation order (ORDER BY in the mart definitions) is applied only by
``ordered()`` when a caller wants it; stored marts are not globally sorted,
which would cost an extra range shuffle for no semantic gain.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martlake.functions import commercial, money, money_sum, month_start, ratio
from martlake.operators.quantiles import grouped_quantiles


# Columns of its fact that each mart reads: a fact made for one mart alone needs no others.
READS = {
    "mart_monthly_sales": ("order_id", "customer_unique_id", "order_status", "order_purchase_timestamp", "item_revenue"),
    "mart_category_performance": ("order_id", "category", "order_status", "price", "freight_value", "review_score", "is_late"),
    "mart_customer_value": ("customer_unique_id", "customer_state", "order_status", "order_purchase_timestamp", "item_revenue"),
    "mart_seller_performance": ("order_id", "seller_id", "seller_state", "order_status", "price", "review_score", "is_late")}


def mart_monthly_sales(fact_orders: DataFrame) -> DataFrame:
    """A4: per purchase month, distinct orders and people, GMV and mean order value."""
    m = (fact_orders.filter(commercial())
         .groupBy(month_start("order_purchase_timestamp").alias("order_month"))
         .agg(F.countDistinct("order_id").alias("orders"),
              F.countDistinct("customer_unique_id").alias("customers"),
              money_sum("item_revenue").alias("revenue")))
    return m.withColumn("avg_order_value", ratio("revenue", "orders"))


def mart_category_performance(fact_items: DataFrame) -> DataFrame:
    """A5: per category orders, GMV, freight, item-weighted review and late rate."""
    return (fact_items.filter(commercial())
            .groupBy("category")
            .agg(F.countDistinct("order_id").alias("orders"),
                 money_sum("price").alias("revenue"),
                 money_sum("freight_value").alias("freight_value"),
                 F.avg("review_score").alias("avg_review_score"),
                 F.avg(F.col("is_late").cast("int")).alias("late_rate")))


def modal(df: DataFrame, key: str, cols: Sequence[str]) -> DataFrame:
    """Per key the most frequent non-null value of each column (the smallest of tied ones).

    One pass: values are counted per (key, column, value), so a hot key is combined on the
    map side, and only these counts meet per key.
    """
    pairs = df.select(key, F.explode(F.array(*[
        F.struct(F.lit(i).alias("c"), F.col(c).alias("v")) for i, c in enumerate(cols)])).alias("p"))
    counts = pairs.select(key, "p.c", "p.v").filter("v is not null").groupBy(key, "c", "v").agg(F.count(F.lit(1)).alias("n"))
    return counts.groupBy(key).agg(*[
        F.min_by(F.when(F.col("c") == i, F.col("v")), F.when(F.col("c") == i, F.struct(-F.col("n"), F.col("v")))).alias(c)
        for i, c in enumerate(cols)])


def _most_frequent(col: str) -> Column:
    """Aggregate over counts ``__n`` of a key's values: the most frequent non-null one, the smallest of tied ones."""
    known = F.col(col).isNotNull()
    return F.min_by(F.when(known, F.col(col)), F.when(known, F.struct(-F.col("__n"), F.col(col)))).alias(col)


def mart_customer_value(fact_orders: DataFrame) -> DataFrame:
    """Per person modal state, orders, observed CLV, first/last purchase, repeat flag.

    One pass: sums per (person, state), of which a person has few, are added up per person.
    """
    per_state = fact_orders.filter(commercial()).groupBy("customer_unique_id", "customer_state").agg(
        F.count(F.lit(1)).alias("__n"),
        F.sum(money("item_revenue")).alias("__m"),
        F.min("order_purchase_timestamp").alias("first_order_at"),
        F.max("order_purchase_timestamp").alias("last_order_at"))
    return (per_state.groupBy("customer_unique_id").agg(
        _most_frequent("customer_state"), F.sum("__n").alias("orders"), F.sum("__m").cast("double").alias("observed_clv"),
        F.min("first_order_at").alias("first_order_at"), F.max("last_order_at").alias("last_order_at"))
        .withColumn("is_repeat_customer", F.col("orders") > 1))


def mart_seller_performance(fact_items: DataFrame) -> DataFrame:
    """Per seller modal state, orders, GMV, item-weighted review and late rate.

    One pass: an order's first row at a seller is numbered, so that distinct orders are a sum like the rest, and
    sums per (seller, state) are added up per seller.  Items dealt by order or by seller stay where they are.
    """
    one = Window.partitionBy("order_id", "seller_id").orderBy(F.lit(0))
    rows = fact_items.filter(commercial()).select(
        "order_id", "seller_id", "seller_state", "price", "review_score", F.col("is_late").cast("int").alias("__late"),
        (F.col("order_id").isNotNull() & (F.row_number().over(one) == 1)).alias("__first"))
    per_state = rows.groupBy("seller_id", "seller_state").agg(
        F.count(F.lit(1)).alias("__n"), F.count_if("__first").alias("__orders"), F.sum(money("price")).alias("__m"),
        F.sum("review_score").alias("__rs"), F.count("review_score").alias("__rn"),
        F.sum("__late").alias("__ls"), F.count("__late").alias("__ln"))
    return per_state.groupBy("seller_id").agg(
        _most_frequent("seller_state"), F.sum("__orders").alias("orders"), F.sum("__m").cast("double").alias("revenue"),
        ratio(F.sum("__rs"), F.sum("__rn")).alias("avg_review_score"),
        ratio(F.sum("__ls"), F.sum("__ln")).alias("late_rate"))


def geolocation_by_zip(geolocation: DataFrame) -> DataFrame:
    """One row per zip: median lat/lng (linear interpolation), modal city/state.

    Rows without a zip belong to none and drop out.  Both medians come from one pass of the
    exact quantile operator over (zip, axis).
    """
    zip_col = "geolocation_zip_code_prefix"
    axes = ("geolocation_lat", "geolocation_lng")
    known = geolocation.filter(F.col(zip_col).isNotNull())
    long = known.select(zip_col, F.explode(F.array(*[
        F.struct(F.lit(i).alias("axis"), F.col(c).cast("double").alias("at")) for i, c in enumerate(axes)])).alias("p"))
    # a prefix has five digits: at most 100,000 zips, with two axes each
    medians = grouped_quantiles(long.select(zip_col, "p.*"), [zip_col, "axis"], "at", [0.5], "q", max_groups=200_000)
    wide = medians.groupBy(zip_col).agg(*[F.max(F.when(F.col("axis") == i, F.col("q"))).alias(c) for i, c in enumerate(axes)])
    modes = modal(known, zip_col, ["geolocation_city", "geolocation_state"])
    return (known.select(zip_col).distinct().join(wide, zip_col, "left").join(modes, zip_col, "left")
            .select(zip_col, *axes, "geolocation_city", "geolocation_state"))


def ordered(mart_name: str, df: DataFrame) -> DataFrame:
    """Presentation order of the published marts."""
    if mart_name == "mart_monthly_sales":
        return df.orderBy("order_month")
    if mart_name in ("mart_category_performance", "mart_seller_performance"):
        return df.orderBy(F.col("revenue").desc())
    return df
