"""Driver keys for seasonality, categories, delivery vs repurchase and regional value."""

from __future__ import annotations

from pyspark.sql import functions as F

from martlake.plans import analysis as A
from martlake.plans import facts, marts
from martlake.plans.catalog import query, silver
from martlake.plans.oracle import msum, register, with_ctes

W0, W1 = A.WINDOW
Y1, Y2 = A.YEARS
C0, C1 = A.CALENDAR_RANGE
WIN = f"order_purchase_timestamp >= TIMESTAMP '{W0}' AND order_purchase_timestamp < TIMESTAMP '{W1}'"

register("monthly_series", ("commercial_orders",), f"""
SELECT CAST(date_trunc('month', order_purchase_timestamp) AS TIMESTAMP) AS order_month,
  COUNT(DISTINCT order_id) AS orders, {msum('item_revenue')} AS revenue,
  {msum('item_revenue')} / NULLIF(COUNT(DISTINCT order_id), 0) AS avg_order_value
FROM commercial_orders GROUP BY 1""")
register("deliv_seq", ("fact_orders",), """
SELECT order_id, customer_unique_id, order_purchase_timestamp, is_late, review_score, delivery_days,
  CASE WHEN customer_unique_id IS NOT NULL THEN lead(order_purchase_timestamp) OVER w END AS next_purchase_at,
  CASE WHEN customer_unique_id IS NOT NULL THEN lead(order_id) OVER w END AS next_order_id
FROM fact_orders WHERE order_status = 'delivered'
WINDOW w AS (PARTITION BY customer_unique_id ORDER BY order_purchase_timestamp, order_id)""")
register("cat_window", ("commercial_items",), f"""
SELECT category, COUNT(DISTINCT order_id) AS orders, {msum('price')} AS revenue,
  {msum('freight_value')} AS freight_value, AVG(review_score) AS avg_review_score,
  AVG(CAST(is_late AS INTEGER)) AS late_rate
FROM commercial_items WHERE {WIN} GROUP BY category""")
register("win_items", ("commercial_items",), f"SELECT * FROM commercial_items WHERE {WIN}")
register("region_stats", ("mart_customer_value",), f"""
SELECT customer_state, COUNT(DISTINCT customer_unique_id) AS customers, {msum('observed_clv')} AS revenue,
  {msum('observed_clv')} / COUNT(observed_clv) AS avg_clv, AVG(CAST(is_repeat_customer AS INTEGER)) AS repeat_rate
FROM mart_customer_value WHERE customer_state IS NOT NULL GROUP BY customer_state""")


def _fo(spark, sf_dir):
    return facts.fact_orders(silver(spark, sf_dir))


def _fi(spark, sf_dir):
    return facts.fact_order_items(silver(spark, sf_dir))


@query("commercial_filter", with_ctes(["commercial_orders"], """
SELECT order_status, COUNT(*) AS orders FROM commercial_orders GROUP BY order_status"""))
def q_commercial_filter(spark, sf_dir):
    """Commercial filter (status NOT IN canceled/unavailable; null status drops out)."""
    from martlake.functions import commercial
    return _fo(spark, sf_dir).filter(commercial()).groupBy("order_status").agg(F.count(F.lit(1)).alias("orders"))


@query("yoy_pivot", with_ctes(["commercial_orders"], f"""
WITH m AS (SELECT year(order_purchase_timestamp) AS y, month(order_purchase_timestamp) AS mo,
             COUNT(DISTINCT order_id) AS orders, {msum('item_revenue')} AS revenue
           FROM commercial_orders GROUP BY 1, 2)
SELECT CAST(a.mo AS INTEGER) AS month, a.orders AS orders_{Y1}, b.orders AS orders_{Y2},
  b.orders / a.orders - 1 AS orders_growth, a.revenue AS revenue_{Y1}, b.revenue AS revenue_{Y2},
  b.revenue / a.revenue - 1 AS revenue_growth
FROM m a JOIN m b ON a.mo = b.mo AND a.y = {Y1} AND b.y = {Y2}"""))
def q_yoy_pivot(spark, sf_dir):
    """Year-over-year pivot of orders and revenue per calendar month."""
    return A.yoy_pivot(_fo(spark, sf_dir))


@query("calendar_month_mean", with_ctes(["monthly_series"], f"""
SELECT CAST(month(order_month) AS INTEGER) AS month, {msum('revenue')} / COUNT(*) AS mean_revenue,
  COUNT(*) AS years_observed
FROM monthly_series WHERE order_month >= TIMESTAMP '{C0}' AND order_month < TIMESTAMP '{C1}' GROUP BY 1"""))
def q_calendar_month_mean(spark, sf_dir):
    """Mean revenue per calendar month over a fixed range."""
    return A.calendar_month_mean(_fo(spark, sf_dir))


@query("monthly_top5", with_ctes(["monthly_series"], """
SELECT * FROM monthly_series ORDER BY revenue DESC, order_month LIMIT 5"""))
def q_monthly_top5(spark, sf_dir):
    """K2: five months with the highest revenue."""
    return A.monthly_top(_fo(spark, sf_dir), 5)


@query("category_window_top", with_ctes(["cat_window"], """
SELECT category, orders, revenue, revenue / NULLIF(orders, 0) AS avg_ticket, avg_review_score, late_rate
FROM cat_window ORDER BY revenue DESC, category LIMIT 10"""))
def q_category_window_top(spark, sf_dir):
    """Top 10 categories by GMV in the executive window."""
    return A.category_window_top(_fi(spark, sf_dir), 10)


@query("category_profile", with_ctes(["cat_window"], f"""
SELECT category, orders, revenue, freight_value, avg_review_score, late_rate,
  revenue / (SELECT {msum('revenue')} FROM cat_window) AS revenue_share,
  revenue / NULLIF(orders, 0) AS avg_ticket, freight_value / NULLIF(revenue, 0) AS freight_over_revenue
FROM cat_window"""))
def q_category_profile(spark, sf_dir):
    """Category GMV share, ticket and freight ratio in the window."""
    return A.category_profile(_fi(spark, sf_dir))


@query("category_quadrants", with_ctes(["cat_window"], """
WITH focus AS (SELECT * FROM cat_window WHERE orders >= 30),
 med AS (SELECT quantile_cont(late_rate, 0.5) AS ml, quantile_cont(avg_review_score, 0.5) AS mr FROM focus)
SELECT category, orders, revenue, late_rate, avg_review_score, ml AS median_late_rate, mr AS median_review_score,
  concat_ws('/', CASE WHEN late_rate > ml THEN 'late_high' ELSE 'late_low' END,
                 CASE WHEN avg_review_score > mr THEN 'review_high' ELSE 'review_low' END) AS quadrant
FROM focus, med"""))
def q_category_quadrants(spark, sf_dir):
    """Focus categories against median late rate and review."""
    return A.category_quadrants(_fi(spark, sf_dir), 30)


@query("state_share_window", with_ctes(["win_items"], f"""
WITH s AS (SELECT customer_state, {msum('price')} AS revenue FROM win_items GROUP BY customer_state)
SELECT customer_state, revenue, revenue / (SELECT {msum('revenue')} FROM s) AS revenue_share FROM s"""))
def q_state_share_window(spark, sf_dir):
    """State share of the window GMV."""
    return A.state_share_window(_fi(spark, sf_dir))


@query("scenario_levers", with_ctes(["win_items"], f"""
WITH g AS (SELECT {msum('price')} AS t FROM win_items),
 levers AS (
  SELECT 'top_category_cross_sell' AS lever, {msum('r')} AS b, 0.03::DOUBLE AS rate
  FROM (SELECT category, {msum('price')} AS r FROM win_items GROUP BY category ORDER BY r DESC, category LIMIT 5)
  UNION ALL
  SELECT 'top_state_growth', {msum('r')}, 0.01::DOUBLE
  FROM (SELECT customer_state, {msum('price')} AS r FROM win_items GROUP BY customer_state
        ORDER BY r DESC, customer_state NULLS LAST LIMIT 3)
  UNION ALL
  SELECT 'late_delivery_reduction', {msum('price')}, 0.25::DOUBLE FROM win_items WHERE is_late)
SELECT lever, t AS window_gmv, COALESCE(b, 0.0::DOUBLE) AS base_gmv, COALESCE(b, 0.0::DOUBLE) / t AS base_share, rate,
  COALESCE(b, 0.0::DOUBLE) * rate AS impact, COALESCE(b, 0.0::DOUBLE) * rate / t AS impact_share
FROM levers, g"""))
def q_scenario_levers(spark, sf_dir):
    """Cross-sell, state growth and late-delivery levers sized on the window."""
    return A.scenario_levers(_fi(spark, sf_dir))


@query("has_next_order", with_ctes(["deliv_seq"], """
SELECT order_id, customer_unique_id, order_purchase_timestamp, next_order_id IS NOT NULL AS has_next_order
FROM deliv_seq"""))
def q_has_next_order(spark, sf_dir):
    """Whether a delivered order is followed by another delivered order of the same person."""
    return A.delivered_sequence(_fo(spark, sf_dir)).select(
        "order_id", "customer_unique_id", "order_purchase_timestamp", "has_next_order")


@query("next_purchase", with_ctes(["deliv_seq"], """
SELECT order_id, customer_unique_id, order_purchase_timestamp, next_purchase_at, next_order_id FROM deliv_seq"""))
def q_next_purchase(spark, sf_dir):
    """Next purchase timestamp (and order) of the same person."""
    return A.delivered_sequence(_fo(spark, sf_dir)).select(
        "order_id", "customer_unique_id", "order_purchase_timestamp", "next_purchase_at", "next_order_id")


@query("late_vs_ontime", with_ctes(["deliv_seq"], """
SELECT is_late, COUNT(*) AS orders, AVG(CAST(next_order_id IS NOT NULL AS INTEGER)) AS repeat_rate,
  AVG(review_score) AS review, AVG(delivery_days) AS delivery_days
FROM deliv_seq WHERE is_late IS NOT NULL GROUP BY is_late"""))
def q_late_vs_ontime(spark, sf_dir):
    """Late vs on-time delivered orders: repeat rate, review, delivery days."""
    return A.late_vs_ontime(_fo(spark, sf_dir))


register("repurchase_frame", ("deliv_seq",), f"""
SELECT *, COALESCE(floor(date_diff('second', order_purchase_timestamp, next_purchase_at) / 86400.0)
                   BETWEEN 0 AND {A.REPURCHASE_DAYS}, false) AS repurchase_90d
FROM deliv_seq
WHERE order_purchase_timestamp <= (SELECT MAX(order_purchase_timestamp) FROM deliv_seq) - INTERVAL '{A.REPURCHASE_DAYS}' DAY
  AND is_late IS NOT NULL""")


@query("repurchase_90d", with_ctes(["repurchase_frame"], """
SELECT is_late, COUNT(*) AS orders, AVG(CAST(repurchase_90d AS INTEGER)) AS repurchase_90d, AVG(review_score) AS review
FROM repurchase_frame GROUP BY is_late"""))
def q_repurchase_90d(spark, sf_dir):
    """90-day repurchase by lateness on the censored cohort."""
    return A.repurchase_90d(_fo(spark, sf_dir))


@query("region_clv", with_ctes(["region_stats"], """
SELECT * FROM region_stats ORDER BY revenue DESC, customer_state LIMIT 10"""))
def q_region_clv(spark, sf_dir):
    """Top 10 states by customer revenue with mean CLV and repeat rate."""
    return A.region_clv(marts.mart_customer_value(_fo(spark, sf_dir)), 10)


@query("region_clv_index", with_ctes(["region_stats", "mart_customer_value"], f"""
SELECT customer_state, customers, revenue, avg_clv, repeat_rate,
  avg_clv / (SELECT {msum('observed_clv')} / COUNT(observed_clv) FROM mart_customer_value) AS clv_index,
  revenue / (SELECT {msum('revenue')} FROM region_stats) AS revenue_share
FROM region_stats WHERE customers >= 20"""))
def q_region_clv_index(spark, sf_dir):
    """CLV index against the national mean, revenue share, minimum customers."""
    return A.region_clv_index(marts.mart_customer_value(_fo(spark, sf_dir)), 20)
