"""Driver keys for seller concentration and the executive metric payload."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from martlake.functions import money_sum
from martlake.operators.ranking import global_rank
from martlake.plans import concentration as C
from martlake.plans import facts, marts
from martlake.plans.catalog import query, silver
from martlake.plans.oracle import msum, register, with_ctes
from martlake.session import materialize

register("seller_ranked", ("mart_seller_performance",), """
SELECT seller_id, revenue, orders, late_rate,
  row_number() OVER (ORDER BY revenue DESC, seller_id) AS rank,
  SUM(CAST(revenue AS DECIMAL(18,2))) OVER (ORDER BY revenue DESC, seller_id ROWS UNBOUNDED PRECEDING) AS cum
FROM mart_seller_performance""")
register("seller_totals", ("mart_seller_performance",), f"""
SELECT COUNT(*) AS n, {msum('revenue')} AS total FROM mart_seller_performance""")
register("seller_parts", ("seller_ranked",), """
SELECT *, cents // 100 // 1000000000 AS h1, cents // 100 % 1000000000 AS h0, cents % 100 * 100000000 AS low
FROM (SELECT *, CAST(CAST(revenue AS DECIMAL(18,2)) * 100 AS HUGEINT) AS cents FROM seller_ranked)""")


def _whole(product: str) -> str:
    """An exact sum of whole numbers as a double, by way of text (correctly rounded)."""
    return f"CAST(CAST(SUM(CAST({product} AS HUGEINT)) AS VARCHAR) AS DOUBLE)"


def _sellers(spark, sf_dir) -> DataFrame:
    # The seller mart is read by the rank bounds, the totals and the ranking:
    # compute it once (as the published gold table would be).
    return materialize(_mart(spark, sf_dir))


def _mart(spark, sf_dir):
    return marts.mart_seller_performance(facts.fact_order_items(silver(spark, sf_dir), marts.READS["mart_seller_performance"]))


@query("seller_lorenz", with_ctes(["seller_ranked", "seller_totals"], """
SELECT seller_id, revenue, rank, CAST(cum AS DOUBLE) / total AS cumulative_share, rank / n AS seller_fraction
FROM seller_ranked, seller_totals"""))
def q_seller_lorenz(spark, sf_dir):
    """Cumulative revenue share curve (two-phase global running sum)."""
    return C.seller_lorenz(_sellers(spark, sf_dir))


@query("seller_concentration", with_ctes(["seller_parts", "seller_totals"], f"""
SELECT COUNT(*) AS sellers,
  {msum('CASE WHEN rank <= ceil(n * 0.01::DOUBLE) THEN revenue END')} / ANY_VALUE(total) AS top_1_pct_share,
  {msum('CASE WHEN rank <= ceil(n * 0.10::DOUBLE) THEN revenue END')} / ANY_VALUE(total) AS top_10_pct_share,
  ({_whole('h1 * h1')} * 1e18 + {_whole('h1 * h0')} * 2e9 + {_whole('h0 * h0')}
    + ({_whole('h1 * low')} * 2e9 + {_whole('h0 * low')} * 2e0) / 1e10 + {_whole('low * low')} / 1e20) / (ANY_VALUE(total) * ANY_VALUE(total)) AS hhi,
  MAX(revenue) / ANY_VALUE(total) AS top_seller_share
FROM seller_parts, seller_totals"""))
def q_seller_concentration(spark, sf_dir):
    """Top 1 % and 10 % seller share, HHI, top seller share."""
    return C.seller_concentration(_sellers(spark, sf_dir))


@query("seller_gini", with_ctes(["seller_parts", "seller_totals"], f"""
SELECT COUNT(*) AS sellers,
  2.0::DOUBLE * ({_whole('(n + 1 - rank) * (cents // 100)')} + {_whole('(n + 1 - rank) * low')} / 1e10)
    / (COUNT(*) * ANY_VALUE(total)) - (COUNT(*) + 1) / COUNT(*) AS gini
FROM seller_parts, seller_totals"""))
def q_seller_gini(spark, sf_dir):
    """Gini coefficient of seller revenue."""
    return C.seller_gini(_sellers(spark, sf_dir))


@query("seller_weighted_late", with_ctes(["mart_seller_performance"], f"""
SELECT COUNT(*) AS sellers,
  CAST(CAST(SUM(CAST(CAST(late_rate AS VARCHAR) AS DECIMAL(17,16)) * CAST(revenue AS DECIMAL(18,2))) AS VARCHAR) AS DOUBLE) / {msum('revenue')}
    AS revenue_weighted_late_rate
FROM mart_seller_performance WHERE orders >= 30 AND late_rate IS NOT NULL"""))
def q_seller_weighted_late(spark, sf_dir):
    """Revenue-weighted late rate of sellers with at least 30 orders."""
    return C.seller_weighted_late(_mart(spark, sf_dir), 30)


@query("seller_risk_top", with_ctes(["mart_seller_performance"], """
SELECT seller_id, orders, revenue, avg_review_score, late_rate FROM mart_seller_performance
WHERE orders >= 30 AND late_rate IS NOT NULL ORDER BY revenue DESC, seller_id LIMIT 10"""))
def q_seller_risk_top(spark, sf_dir):
    """Ten largest sellers among those with at least 30 orders."""
    return C.seller_risk_top(_mart(spark, sf_dir), 30, 10)


# ------------------------------------------------------------------ executive payload
def executive_metrics(monthly: DataFrame, categories: DataFrame, sellers: DataFrame,
                      top_k: int = 5, seller_fraction: float = 0.10) -> DataFrame:
    """Period, revenue, top categories and top-10 % seller share, in long form
    ``(metric, position, label, value)``.  Reads only the aggregated marts."""
    period = monthly.agg(F.min("order_month").cast("string").alias("a"),
                         F.max("order_month").cast("string").alias("b"),
                         money_sum("revenue").alias("r"))
    fact = lambda metric, position, label, value: F.struct(
        F.lit(metric).alias("metric"), position.cast("bigint").alias("position"), label.cast("string").alias("label"),
        value.cast("double").alias("value"))
    none, zero = F.lit(None), F.lit(0)
    # each mart is aggregated once and its one row (or its top rows) turned into metric rows
    rows = [period.select(F.inline(F.array(fact("period_start", zero, F.col("a"), none), fact("period_end", zero, F.col("b"), none),
                                           fact("revenue", zero, none, F.col("r")))))]
    # Top-k report over the (small) category mart: at most k rows reach the window.
    top = categories.orderBy(F.col("revenue").desc(), F.col("category")).limit(top_k)
    pos = F.row_number().over(Window.orderBy(F.col("revenue").desc(), F.col("category")))
    top = top.select("category", "revenue", "avg_review_score", pos.alias("position"))
    rows.append(top.select(F.inline(F.array(
        fact("top_category_revenue", F.col("position"), F.col("category"), F.col("revenue")),
        fact("top_category_review", F.col("position"), F.col("category"), F.col("avg_review_score"))))))
    n = sellers.agg(F.count(F.lit(1)).alias("n")).select("n").scalar()
    k = F.greatest(F.lit(1).cast("bigint"), F.ceil(n * F.lit(seller_fraction)))
    ranked = global_rank(sellers.select("seller_id", "revenue"), "revenue", ascending=False, tiebreak=["seller_id"])
    share = ranked.agg(money_sum("revenue").alias("t"),
                       money_sum(F.when(F.col("rank") <= k, F.col("revenue"))).alias("top"))
    rows.append(share.select(F.inline(F.array(fact(
        "seller_top10_share", zero, none, F.when(F.col("t") > 0, F.col("top") / F.col("t")).otherwise(F.lit(0.0)))))))
    out = rows[0]
    for r in rows[1:]:
        out = out.union(r)
    return out


@query("executive_metrics", with_ctes(["mart_monthly_sales", "mart_category_performance", "seller_ranked", "seller_totals"], f"""
SELECT 'period_start' AS metric, CAST(0 AS BIGINT) AS position, CAST(MIN(order_month) AS VARCHAR) AS label,
  CAST(NULL AS DOUBLE) AS value FROM mart_monthly_sales
UNION ALL SELECT 'period_end', 0, CAST(MAX(order_month) AS VARCHAR), NULL FROM mart_monthly_sales
UNION ALL SELECT 'revenue', 0, NULL, {msum('revenue')} FROM mart_monthly_sales
UNION ALL SELECT 'top_category_revenue', rn, category, revenue FROM (
  SELECT category, revenue, row_number() OVER (ORDER BY revenue DESC, category) AS rn FROM mart_category_performance) WHERE rn <= 5
UNION ALL SELECT 'top_category_review', rn, category, avg_review_score FROM (
  SELECT category, avg_review_score, row_number() OVER (ORDER BY revenue DESC, category) AS rn FROM mart_category_performance) WHERE rn <= 5
UNION ALL SELECT 'seller_top10_share', 0, NULL,
  CASE WHEN ANY_VALUE(total) > 0 THEN {msum('CASE WHEN rank <= greatest(1, ceil(n * 0.10::DOUBLE)) THEN revenue END')} / {msum('revenue')}
       ELSE 0.0 END
FROM seller_ranked, seller_totals"""))
def q_executive_metrics(spark, sf_dir):
    """Executive metric payload from the aggregated marts only."""
    s = silver(spark, sf_dir)
    return executive_metrics(marts.mart_monthly_sales(facts.fact_orders(s, marts.READS["mart_monthly_sales"])),
                             marts.mart_category_performance(facts.fact_order_items(s, marts.READS["mart_category_performance"])),
                             materialize(marts.mart_seller_performance(facts.fact_order_items(s, marts.READS["mart_seller_performance"]))))
