"""Driver keys for the facts and marts."""

from __future__ import annotations

from martlake.plans import facts, marts
from martlake.plans.catalog import query, silver
from martlake.plans.oracle import msum, with_ctes


@query("fact_orders", with_ctes(["fact_orders"], "SELECT * FROM fact_orders"))
def q_fact_orders(spark, sf_dir):
    """Order fact (four left joins over pre-aggregated many-sides)."""
    return facts.fact_orders(silver(spark, sf_dir))


@query("fact_order_items", with_ctes(["fact_order_items"], "SELECT * FROM fact_order_items"))
def q_fact_order_items(spark, sf_dir):
    """Item fact with chained category translation."""
    return facts.fact_order_items(silver(spark, sf_dir))


@query("item_totals", with_ctes(["item_totals"], "SELECT * FROM item_totals"))
def q_item_totals(spark, sf_dir):
    """A1: item totals per order."""
    return facts.item_totals(silver(spark, sf_dir).order_items)


@query("payments_by_order", with_ctes(["pay_by_order"], "SELECT * FROM pay_by_order"))
def q_payments_by_order(spark, sf_dir):
    """A2: payments per order."""
    return facts.payments_by_order(silver(spark, sf_dir).order_payments)


@query("reviews_by_order", with_ctes(["rev_by_order"], "SELECT * FROM rev_by_order"))
def q_reviews_by_order(spark, sf_dir):
    """A3: mean review per order."""
    return facts.reviews_by_order(silver(spark, sf_dir).order_reviews)


@query("mart_monthly_sales", with_ctes(["mart_monthly_sales"], "SELECT * FROM mart_monthly_sales"))
def q_mart_monthly_sales(spark, sf_dir):
    """A4: monthly sales mart."""
    return marts.mart_monthly_sales(facts.fact_orders(silver(spark, sf_dir), marts.READS["mart_monthly_sales"]))


@query("mart_category_performance",
       with_ctes(["mart_category_performance"], "SELECT * FROM mart_category_performance"))
def q_mart_category_performance(spark, sf_dir):
    """A5: category mart."""
    return marts.mart_category_performance(facts.fact_order_items(silver(spark, sf_dir), marts.READS["mart_category_performance"]))


@query("mart_customer_value", with_ctes(["mart_customer_value"], "SELECT * FROM mart_customer_value"))
def q_mart_customer_value(spark, sf_dir):
    """Customer value mart."""
    return marts.mart_customer_value(facts.fact_orders(silver(spark, sf_dir), marts.READS["mart_customer_value"]))


@query("mart_seller_performance",
       with_ctes(["mart_seller_performance"], "SELECT * FROM mart_seller_performance"))
def q_mart_seller_performance(spark, sf_dir):
    """Seller mart."""
    return marts.mart_seller_performance(facts.fact_order_items(silver(spark, sf_dir), marts.READS["mart_seller_performance"]))


_GEO_BY_ZIP_SQL = with_ctes(["s_geolocation"], """
SELECT g.geolocation_zip_code_prefix, g.geolocation_lat, g.geolocation_lng, c.geolocation_city, s.geolocation_state
FROM (SELECT geolocation_zip_code_prefix, quantile_cont(geolocation_lat, 0.5) AS geolocation_lat,
        quantile_cont(geolocation_lng, 0.5) AS geolocation_lng FROM s_geolocation
      WHERE geolocation_zip_code_prefix IS NOT NULL GROUP BY 1) g
LEFT JOIN (SELECT geolocation_zip_code_prefix, geolocation_city FROM (
    SELECT geolocation_zip_code_prefix, geolocation_city, row_number() OVER (
      PARTITION BY geolocation_zip_code_prefix ORDER BY COUNT(*) DESC, geolocation_city) AS rn
    FROM s_geolocation WHERE geolocation_city IS NOT NULL GROUP BY 1, 2) WHERE rn = 1) c USING (geolocation_zip_code_prefix)
LEFT JOIN (SELECT geolocation_zip_code_prefix, geolocation_state FROM (
    SELECT geolocation_zip_code_prefix, geolocation_state, row_number() OVER (
      PARTITION BY geolocation_zip_code_prefix ORDER BY COUNT(*) DESC, geolocation_state) AS rn
    FROM s_geolocation WHERE geolocation_state IS NOT NULL GROUP BY 1, 2) WHERE rn = 1) s USING (geolocation_zip_code_prefix)
""")


@query("geolocation_by_zip", _GEO_BY_ZIP_SQL)
def q_geolocation_by_zip(spark, sf_dir):
    """Zip consolidation with exact medians and modal city/state."""
    return marts.geolocation_by_zip(silver(spark, sf_dir).geolocation)
