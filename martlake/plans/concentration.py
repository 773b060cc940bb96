"""Seller concentration: cumulative share, top shares, HHI, Gini, weighted lateness.

The global order (revenue descending, seller_id tie-break) comes from the
range-partitioned rank operator, never from an unpartitioned window.  Totals are
scalar subqueries.  HHI is computed as sum(revenue^2) / total^2, which equals
sum(share^2); squares and rank-weighted revenue are summed exactly in parts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martlake.functions import money, money_sum, square_sum, weighted_sum
from martlake.operators.ranking import global_rank


def _totals(sellers: DataFrame):
    n = sellers.agg(F.count(F.lit(1)).alias("n")).select("n").scalar()
    total = sellers.agg(money_sum("revenue").alias("t")).select("t").scalar()
    return n, total


def seller_lorenz(sellers: DataFrame) -> DataFrame:
    """Per seller rank (revenue desc), cumulative revenue share, seller fraction."""
    n, total = _totals(sellers)
    r = global_rank(sellers.select("seller_id", "revenue"), "revenue", ascending=False,
                    tiebreak=["seller_id"], value_col="revenue")
    return r.select("seller_id", "revenue", "rank",
                    (F.col("cum_value").cast("double") / total).alias("cumulative_share"),
                    (F.col("rank") / n).alias("seller_fraction"))


def seller_concentration(sellers: DataFrame) -> DataFrame:
    """Sellers, top 1 % and top 10 % revenue share (ceil(n p) sellers), HHI, top seller share."""
    n, total = _totals(sellers)
    r = global_rank(sellers.select("seller_id", "revenue"), "revenue", ascending=False,
                    tiebreak=["seller_id"])
    k1, k10 = F.ceil(n * F.lit(0.01)), F.ceil(n * F.lit(0.10))
    agg = r.agg(
        F.count(F.lit(1)).alias("sellers"),
        money_sum(F.when(F.col("rank") <= k1, F.col("revenue"))).alias("_t1"),
        money_sum(F.when(F.col("rank") <= k10, F.col("revenue"))).alias("_t10"),
        square_sum("revenue").alias("_sq"),
        F.max("revenue").alias("_top"))
    return agg.select(
        "sellers",
        (F.col("_t1") / total).alias("top_1_pct_share"),
        (F.col("_t10") / total).alias("top_10_pct_share"),
        (F.col("_sq") / (total * total)).alias("hhi"),
        (F.col("_top") / total).alias("top_seller_share"))


def seller_gini(sellers: DataFrame) -> DataFrame:
    """Gini = 2 sum(i x_i) / (n sum x) - (n + 1) / n over ascending revenue.

    Ascending position i = n + 1 - descending rank; ties give the same sum in
    any order, so the descending rank of the Lorenz curve is reused.
    """
    n, total = _totals(sellers)
    r = global_rank(sellers.select("seller_id", "revenue"), "revenue", ascending=False,
                    tiebreak=["seller_id"])
    agg = r.agg(F.count(F.lit(1)).alias("sellers"), weighted_sum(F.lit(n) + 1 - F.col("rank"), "revenue").alias("_ix"))
    return agg.select("sellers",
                      (F.lit(2.0) * F.col("_ix") / (F.col("sellers") * total)
                       - (F.col("sellers") + 1) / F.col("sellers")).alias("gini"))


LATE_RATE_DECIMAL = "decimal(17,16)"


def seller_weighted_late(sellers: DataFrame, min_orders: int = 30) -> DataFrame:
    """Revenue-weighted late rate over sellers with >= min_orders and a known late rate."""
    s = sellers.filter((F.col("orders") >= min_orders) & F.col("late_rate").isNotNull())
    w = F.col("late_rate").cast(LATE_RATE_DECIMAL) * money("revenue")
    return s.agg(F.count(F.lit(1)).alias("sellers"),
                 (F.sum(w).cast("double") / money_sum("revenue")).alias("revenue_weighted_late_rate"))


def seller_risk_top(sellers: DataFrame, min_orders: int = 30, k: int = 10) -> DataFrame:
    """The k largest sellers (by revenue) among those with >= min_orders and a known late rate."""
    return (sellers.filter((F.col("orders") >= min_orders) & F.col("late_rate").isNotNull())
            .select("seller_id", "orders", "revenue", "avg_review_score", "late_rate")
            .orderBy(F.col("revenue").desc(), F.col("seller_id")).limit(k))
