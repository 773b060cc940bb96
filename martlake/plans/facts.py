"""Order and order-item facts.

Both facts avoid fan-out by pre-aggregating every many-side (items, payments,
reviews) to the order grain *before* joining; this is semantic, not only a
speed-up.  All joins are LEFT joins from the fact grain, so orphan keys stay
visible as null dimensions.

Shuffle layout: everything keyed by ``order_id`` is joined first, then customers and the
other dimensions.  Silver is stored by buckets of ``order_id``, so on silver the per-order
aggregates and these joins need no exchange; on other sources each side is exchanged once.
Dimension joins (customers, products, sellers, translation) are left to AQE,
which broadcasts a side only when its measured size is under the threshold.
"""

from __future__ import annotations

from collections.abc import Collection

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martlake.functions import delivery_days, is_late, money_sum
from martlake.sources.bindings import RetailSources


def item_totals(items: DataFrame) -> DataFrame:
    """A1: per order item revenue, freight, item count and distinct sellers."""
    return items.groupBy("order_id").agg(
        money_sum("price").alias("item_revenue"),
        money_sum("freight_value").alias("freight_value"),
        F.count(F.lit(1)).alias("item_count"),
        F.countDistinct("seller_id").alias("seller_count"),
    )


def payments_by_order(payments: DataFrame) -> DataFrame:
    """A2: total paid per order."""
    return payments.groupBy("order_id").agg(money_sum("payment_value").alias("payment_value"))


def reviews_by_order(reviews: DataFrame) -> DataFrame:
    """A3: mean review score per order (orders with several reviews average them)."""
    return reviews.groupBy("order_id").agg(F.avg("review_score").alias("review_score"))


def _repeats(df: DataFrame, key: str) -> bool:
    """Does a key come twice?  Then a left join on it repeats rows, and can't be left out."""
    counts = df.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    return not counts.filter("n > 1").isEmpty()


def fact_orders(s: RetailSources, columns: Collection[str] | None = None) -> DataFrame:
    """One row per order with item totals, payments, reviews and delivery.

    With ``columns`` only these are made: totals per order (one row each) that none of them needs are
    not joined, nor are customers whose key does not repeat.  The rows are the same.
    """
    customers = s.customers.select("customer_id", "customer_unique_id", "customer_state")
    wanted = lambda *names: columns is None or not set(names).isdisjoint(columns)
    f = s.orders
    for names, totals in ((("item_revenue", "freight_value", "item_count", "seller_count"), lambda: item_totals(s.order_items)),
                          (("payment_value",), lambda: payments_by_order(s.order_payments)),
                          (("review_score",), lambda: reviews_by_order(s.order_reviews))):
        if wanted(*names):
            f = f.join(totals(), "order_id", "left")
        else:
            f = f.withColumns({n: F.lit(None) for n in names})
    if wanted("customer_unique_id", "customer_state") or _repeats(customers, "customer_id"):
        f = f.join(customers, "customer_id", "left")
    else:
        f = f.withColumns({"customer_unique_id": F.lit(None), "customer_state": F.lit(None)})
    f = _order_columns(f)
    return f if columns is None else f.select(*columns)


def _order_columns(f: DataFrame) -> DataFrame:
    return f.select(
        "order_id", "customer_id", "customer_unique_id", "customer_state", "order_status",
        "order_purchase_timestamp", "order_approved_at", "order_delivered_customer_date",
        "order_estimated_delivery_date",
        F.coalesce("item_revenue", F.lit(0.0)).alias("item_revenue"),
        F.coalesce("freight_value", F.lit(0.0)).alias("freight_value"),
        F.coalesce("item_count", F.lit(0).cast("bigint")).alias("item_count"),
        F.coalesce("seller_count", F.lit(0).cast("bigint")).alias("seller_count"),
        "payment_value", "review_score",
        delivery_days().alias("delivery_days"),
        is_late().alias("is_late"),
    )


def fact_order_items(s: RetailSources, columns: Collection[str] | None = None) -> DataFrame:
    """One row per order item with order, customer, product, seller and review.

    Items are joined to orders and to the per-order review mean on the same key
    first (one shuffle of items), then to the customer and the dimensions.

    With ``columns`` only these are made: a dimension that none of them needs is joined only if its
    key repeats, since then it repeats rows.  The rows are the same.  Products come first there, so that the
    items are left dealt by order: a count of distinct orders then exchanges them no more.
    """
    orders = s.orders.select("order_id", "customer_id", "order_status", "order_purchase_timestamp",
                             "order_delivered_customer_date", "order_estimated_delivery_date", is_late().alias("is_late"))
    customers = s.customers.select("customer_id", "customer_unique_id", "customer_state")
    products = s.products.select("product_id", "product_category_name", "is_category_missing")
    sellers = s.sellers.select("seller_id", "seller_state")
    translation = s.product_category_name_translation.select("product_category_name", "product_category_name_english")
    reviews = reviews_by_order(s.order_reviews)
    if columns is None:
        f = (s.order_items
             .join(orders, "order_id", "left")
             .join(reviews, "order_id", "left")
             .join(customers, "customer_id", "left")
             .join(products, "product_id", "left")
             .join(sellers, "seller_id", "left")
             .join(translation, "product_category_name", "left"))
        return _item_columns(f)

    f = s.order_items
    wanted = lambda *names: not set(names).isdisjoint(columns)
    absent = lambda f, *names: f.withColumns({n: F.lit(None) for n in names})
    if wanted("category", "is_category_missing") or _repeats(products, "product_id") or _repeats(translation, "product_category_name"):
        f = f.join(products.join(translation, "product_category_name", "left"), "product_id", "left")
    else:
        f = absent(f, "product_category_name", "is_category_missing", "product_category_name_english")
    f = f.join(orders, "order_id", "left")
    f = f.join(reviews, "order_id", "left") if wanted("review_score") else absent(f, "review_score")
    if wanted("customer_unique_id", "customer_state") or _repeats(customers, "customer_id"):
        f = f.join(customers, "customer_id", "left")
    else:
        f = absent(f, "customer_unique_id", "customer_state")
    f = f.join(sellers, "seller_id", "left") if wanted("seller_state") or _repeats(sellers, "seller_id") else absent(f, "seller_state")
    return _item_columns(f).select(*columns)


def _item_columns(f: DataFrame) -> DataFrame:
    return f.select(
        "order_id", "order_item_id", "product_id", "seller_id", "customer_id",
        "customer_unique_id", "customer_state", "order_status", "order_purchase_timestamp",
        "order_delivered_customer_date", "order_estimated_delivery_date", "price",
        "freight_value",
        F.coalesce("product_category_name_english", "product_category_name",
                   F.lit("unknown")).alias("category"),
        "is_category_missing", "seller_state", "review_score",
        "is_late",
    )
