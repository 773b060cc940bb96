"""Payment vs item reconciliation.

Both sides are aggregated to the order grain first (a many-to-many join of
payments and items would multiply values), then full-outer joined with a
side marker.  Amounts are exact decimal sums, so the tolerance tests are
exact as well.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martlake.functions import money


def reconciliation_frame(payments: DataFrame, items: DataFrame) -> DataFrame:
    """Per order: paid, item value, freight, side (both/left_only/right_only), |difference|."""
    pay = (payments.filter(F.col("order_id").isNotNull()).groupBy("order_id")
           .agg(F.coalesce(F.sum(money("payment_value")), F.lit(0)).alias("paid"))
           .withColumn("_on_pay", F.lit(True)))
    it = (items.filter(F.col("order_id").isNotNull()).groupBy("order_id")
          .agg(F.coalesce(F.sum(money("price")), F.lit(0)).alias("item_value"),
               F.coalesce(F.sum(money("freight_value")), F.lit(0)).alias("freight"))
          .withColumn("_on_items", F.lit(True)))
    j = pay.join(it, "order_id", "full_outer")
    side = (F.when(F.col("_on_pay") & F.col("_on_items"), "both")
            .when(F.col("_on_pay"), "left_only").otherwise("right_only"))
    return j.select("order_id", "paid", "item_value", "freight", side.alias("side"),
                    F.abs(F.col("paid") - F.col("item_value") - F.col("freight")).alias("abs_difference"))


def payment_reconciliation(payments: DataFrame, items: DataFrame, tolerance: float = 0.01) -> DataFrame:
    """Only-payments, only-items, comparable orders, mismatches and mismatch rate."""
    r = reconciliation_frame(payments, items)
    both = F.col("side") == "both"
    agg = r.agg(F.count_if(F.col("side") == "left_only").alias("only_payments"),
                F.count_if(F.col("side") == "right_only").alias("only_items"),
                F.count_if(both).alias("comparable_orders"),
                F.count_if(both & (F.col("abs_difference") > F.lit(tolerance))).alias("value_mismatches"))
    rate = F.when(F.col("comparable_orders") > 0,
                  F.col("value_mismatches") / F.col("comparable_orders")).otherwise(F.lit(0.0))
    return agg.withColumn("mismatch_rate", rate)


def reconciliation_profile(payments: DataFrame, items: DataFrame) -> DataFrame:
    """Orders compared, missing on one side, differences above 0.01 and above 1.00.

    A missing side gives a null difference, which is in neither count.
    """
    r = reconciliation_frame(payments, items)
    d = F.col("abs_difference")
    return r.agg(F.count(F.lit(1)).alias("orders_compared"),
                 F.count_if(F.col("side") != "both").alias("missing_on_one_side"),
                 F.count_if(d > F.lit(0.01)).alias("difference_gt_1_cent"),
                 F.count_if(d > F.lit(1.0)).alias("difference_gt_1_real"))
