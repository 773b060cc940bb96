"""Driver keys for the pipeline gates: row preservation, gold contracts, layer counts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martlake.functions import money_sum
from martlake.operators.keys import key_profile
from martlake.plans import facts, marts
from martlake.plans.catalog import query
from martlake.plans.oracle import msum, with_ctes
from martlake.plans.q_quality import BRONZE_CTE
from martlake.sources import contracts as K
from martlake.sources.bindings import bind_sources
from martlake.sources.silver import to_silver

SILVER_CTE = {
    "customers": "s_customers", "geolocation": "s_geolocation", "order_items": "s_items",
    "order_payments": "s_payments", "order_reviews": "s_reviews", "orders": "s_orders",
    "products": "s_products", "sellers": "s_sellers", "product_category_name_translation": "s_translation",
}


def _count(df: DataFrame, layer: str, name: str) -> DataFrame:
    return df.agg(F.lit(layer).alias("layer"), F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("rows"))


def row_preservation(bronze, silver) -> DataFrame:
    """Bronze vs silver row count per source table (join of two count tables)."""
    b = reduce(DataFrame.unionByName, [_count(df, "bronze", t) for t, df in bronze.as_dict().items()])
    s = reduce(DataFrame.unionByName, [_count(df, "silver", t) for t, df in silver.as_dict().items()])
    j = b.select("table_name", F.col("rows").alias("bronze_rows")).join(
        s.select("table_name", F.col("rows").alias("silver_rows")), "table_name", "full_outer")
    return j.select("table_name", "bronze_rows", "silver_rows",
                    (F.col("silver_rows") - F.col("bronze_rows")).alias("difference"),
                    (F.coalesce(F.col("silver_rows") == F.col("bronze_rows"), F.lit(False))).alias("passed"))


@query("row_preservation", with_ctes(sorted(set(BRONZE_CTE.values()) | set(SILVER_CTE.values())),
                                     "\nUNION ALL\n".join(
    f"SELECT '{t}' AS table_name, b AS bronze_rows, s AS silver_rows, s - b AS difference, b = s AS passed "
    f"FROM (SELECT (SELECT COUNT(*) FROM {BRONZE_CTE[t]}) AS b, (SELECT COUNT(*) FROM {SILVER_CTE[t]}) AS s)"
    for t in K.EXPECTED_COLUMNS)))
def q_row_preservation(spark, sf_dir):
    """Silver keeps every bronze row.  Both sides are counts alone, so no column is read that the
    rules of silver don't need, and nothing is written; the pipeline counts its written files."""
    b = bind_sources(spark, sf_dir)
    return row_preservation(b, to_silver(b))


def gold_contracts(silver, fact_orders: DataFrame, fact_items: DataFrame, tolerance: float = 0.01) -> DataFrame:
    """Order grain, item grain, GMV reconciliation between the facts."""
    src_o = silver.orders.agg(F.count(F.lit(1)).alias("n")).select("n").scalar()
    src_i = silver.order_items.agg(F.count(F.lit(1)).alias("n")).select("n").scalar()
    ko = key_profile(fact_orders, ["order_id"])
    ki = key_profile(fact_items, ["order_id", "order_item_id"])
    order_grain = ko.select(
        F.lit("fact_orders order grain").alias("contract"),
        ((F.col("rows") == src_o) & (F.col("duplicates") == 0) & (F.col("null_keys") == 0)).alias("passed"),
        src_o.alias("source_rows"), F.col("rows").alias("fact_rows"), F.col("duplicates").alias("duplicate_keys"),
        F.lit(None).cast("double").alias("gmv_difference"))
    item_grain = ki.select(
        F.lit("fact_order_items item grain").alias("contract"),
        ((F.col("rows") == src_i) & (F.col("duplicates") == 0) & (F.col("null_keys") == 0)).alias("passed"),
        src_i.alias("source_rows"), F.col("rows").alias("fact_rows"), F.col("duplicates").alias("duplicate_keys"),
        F.lit(None).cast("double").alias("gmv_difference"))
    item_gmv = fact_items.agg(money_sum("price").alias("g")).select("g").scalar()
    gmv = fact_orders.agg(money_sum("item_revenue").alias("o")).select(
        F.lit("GMV reconciles between facts").alias("contract"),
        F.coalesce(F.abs(item_gmv - F.col("o")) < tolerance, F.lit(False)).alias("passed"),
        F.lit(None).cast("bigint").alias("source_rows"), F.lit(None).cast("bigint").alias("fact_rows"),
        F.lit(None).cast("bigint").alias("duplicate_keys"), (item_gmv - F.col("o")).alias("gmv_difference"))
    return order_grain.unionByName(item_grain).unionByName(gmv)


def _grain_sql(name, src, fact, keys):
    cols = ", ".join(keys)
    anynull = " OR ".join(f"{k} IS NULL" for k in keys)
    return (f"SELECT '{name}' AS contract, COALESCE(rows = src AND dup = 0 AND nul = 0, false) AS passed, "
            f"src AS source_rows, rows AS fact_rows, dup AS duplicate_keys, CAST(NULL AS DOUBLE) AS gmv_difference "
            f"FROM (SELECT CAST(SUM(n) AS BIGINT) AS rows, CAST(SUM(n - 1) AS BIGINT) AS dup, "
            f"CAST(COALESCE(SUM(CASE WHEN {anynull} THEN n END), 0) AS BIGINT) AS nul, (SELECT COUNT(*) FROM {src}) AS src "
            f"FROM (SELECT {cols}, COUNT(*) AS n FROM {fact} GROUP BY {cols}))")


@query("gold_contracts", with_ctes(["fact_orders", "fact_order_items", "s_orders", "s_items"], "\nUNION ALL\n".join([
    _grain_sql("fact_orders order grain", "s_orders", "fact_orders", ["order_id"]),
    _grain_sql("fact_order_items item grain", "s_items", "fact_order_items", ["order_id", "order_item_id"]),
    f"""SELECT 'GMV reconciles between facts', COALESCE(abs(g - o) < 0.01, false), NULL, NULL, NULL, g - o
FROM (SELECT (SELECT {msum('price')} FROM fact_order_items) AS g, (SELECT {msum('item_revenue')} FROM fact_orders) AS o)"""])))
def q_gold_contracts(spark, sf_dir):
    """Grain and GMV contracts of the gold facts."""
    s = to_silver(bind_sources(spark, sf_dir))
    return gold_contracts(s, facts.fact_orders(s), facts.fact_order_items(s))


def gold_relations(silver) -> dict[str, DataFrame]:
    """The rows of the six published gold relations (S7): the facts by their keys, each mart over a fact of
    the columns that it reads."""
    made = {"fact_orders": facts.fact_orders(silver, ("order_id",)),
            "fact_order_items": facts.fact_order_items(silver, ("order_id", "order_item_id"))}
    for name, columns in marts.READS.items():
        fact = facts.fact_orders if name in ("mart_monthly_sales", "mart_customer_value") else facts.fact_order_items
        made[name] = getattr(marts, name)(fact(silver, columns))
    return made


def gold_marts(fact_orders: DataFrame, fact_order_items: DataFrame) -> dict[str, DataFrame]:
    """The four marts over the two facts."""
    return {"mart_monthly_sales": marts.mart_monthly_sales(fact_orders),
            "mart_category_performance": marts.mart_category_performance(fact_order_items),
            "mart_customer_value": marts.mart_customer_value(fact_orders),
            "mart_seller_performance": marts.mart_seller_performance(fact_order_items)}


@query("layer_row_counts", with_ctes(
    sorted(set(BRONZE_CTE.values()) | set(SILVER_CTE.values()) | set(K.GOLD_TABLES)), "\nUNION ALL\n".join(
        [f"SELECT 'bronze' AS layer, '{t}' AS table_name, COUNT(*) AS rows FROM {BRONZE_CTE[t]}" for t in K.EXPECTED_COLUMNS]
        + [f"SELECT 'silver', '{t}', COUNT(*) FROM {SILVER_CTE[t]}" for t in K.EXPECTED_COLUMNS]
        + ["SELECT 'silver', 'geolocation_by_zip', COUNT(DISTINCT geolocation_zip_code_prefix) FROM s_geolocation"]
        + [f"SELECT 'gold', '{g}', COUNT(*) FROM {g}" for g in K.GOLD_TABLES])))
def q_layer_row_counts(spark, sf_dir):
    """Rows per layer and table (bronze, silver incl. geolocation_by_zip, gold)."""
    b = bind_sources(spark, sf_dir)
    s = to_silver(b)
    frames = [_count(df, "bronze", t) for t, df in b.as_dict().items()]
    frames += [_count(df, "silver", t) for t, df in s.as_dict().items()]
    frames.append(_count(marts.geolocation_by_zip(s.geolocation), "silver", "geolocation_by_zip"))
    frames += [_count(df, "gold", t) for t, df in gold_relations(s).items()]
    return reduce(DataFrame.unionByName, frames)
