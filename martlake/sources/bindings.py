"""Driver tables bound to the canonical nine-table retail schema.

The driver data is a TPC-H-like star schema.  These bindings re-express it as
the retail source package (orders, customers, items, payments, reviews,
products, category translation, sellers, geolocation) with the exact rules
written in FIXTURES.md section 2, so that every plan can run on it.  Each
binding is a lazy DataFrame: column pruning and filters reach the Parquet scan.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


# Schemas of tables read before in this process: reading one again starts no job to infer it.
_schemas: dict[str, StructType] = {}


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    if path not in _schemas:
        _schemas[path] = spark.read.parquet(path).schema
    return spark.read.schema(_schemas[path]).parquet(path)


class RetailSources:
    """The nine canonical source relations (typed, silver-ready).

    A relation is given as a DataFrame or as a function that makes it, which is called when
    the relation is first used: a query binds only the tables it reads.
    """

    NAMES = ("customers", "geolocation", "order_items", "order_payments", "order_reviews", "orders", "products",
             "sellers", "product_category_name_translation")

    def __init__(self, **relations: DataFrame | Callable[[], DataFrame]):
        odd = set(relations) ^ set(self.NAMES)
        if odd:
            raise TypeError(f"relations missing or unknown: {sorted(odd)}")
        self._relations = relations

    def __getattr__(self, name: str) -> DataFrame:
        relations = self.__dict__.get("_relations", {})
        if name not in relations:
            raise AttributeError(name)
        made = relations[name]
        if not isinstance(made, DataFrame):
            made = relations[name] = made()
        return made

    def as_dict(self) -> dict[str, DataFrame]:
        return {name: getattr(self, name) for name in self.NAMES}

    def map(self, change: Callable[[str, DataFrame], DataFrame]) -> RetailSources:
        """Every relation changed, each when it is first used."""
        return RetailSources(**{n: partial(lambda n: change(n, getattr(self, n)), n) for n in self.NAMES})


def _hours(n):
    return F.make_dt_interval(F.lit(0), n.cast("int"))


def _days(n):
    return F.make_dt_interval(n.cast("int"))


def bind_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read_table(spark, sf_dir, "orders")
    k, st, ts = F.col("o_orderkey"), F.col("o_orderstatus"), F.col("o_orderdate")
    status = (F.when(st == "O", "shipped")
              .when((st == "P") & (k % 5 == 0), "canceled")
              .when((st == "P") & (k % 5 == 1), "unavailable")
              .otherwise("delivered"))
    delivered_rule = (st != "O") & ~((st == "P") & (k % 5 < 2)) & (k % 997 != 0)
    return o.select(
        k.alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        status.alias("order_status"),
        ts.alias("order_purchase_timestamp"),
        F.when(k % 101 != 0, ts + _hours(k % 48)).alias("order_approved_at"),
        (ts + _days(1 + k % 7)).alias("order_delivered_carrier_date"),
        F.when(delivered_rule, ts + _hours(72 + k % 900)).alias("order_delivered_customer_date"),
        (ts + _days(F.lit(30))).alias("order_estimated_delivery_date"),
    )


def _nation(spark, sf_dir):
    return read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name")


def bind_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = read_table(spark, sf_dir, "customer")
    return (c.join(_nation(spark, sf_dir), F.col("c_nationkey") == F.col("n_nationkey"))
            .select(F.col("c_custkey").alias("customer_id"),
                    (F.col("c_custkey") - F.col("c_custkey") % 2).alias("customer_unique_id"),
                    F.col("c_nationkey").alias("customer_zip_code_prefix"),
                    F.col("c_mktsegment").alias("customer_city"),
                    F.col("n_name").alias("customer_state")))


def bind_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read_table(spark, sf_dir, "lineitem")
    return li.select(F.col("l_orderkey").alias("order_id"),
                     F.col("l_linenumber").alias("order_item_id"),
                     F.col("l_partkey").alias("product_id"),
                     F.col("l_suppkey").alias("seller_id"),
                     F.col("l_shipdate").alias("shipping_limit_date"),
                     F.col("l_extendedprice").alias("price"),
                     F.col("l_quantity").alias("freight_value"))


def bind_payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read_table(spark, sf_dir, "lineitem")
    o = read_table(spark, sf_dir, "orders")
    k = F.col("l_orderkey")
    from_items = (li.filter(k % 211 != 3)
                  .select(k.alias("order_id"),
                          F.col("l_linenumber").alias("payment_sequential"),
                          F.col("l_returnflag").alias("payment_type"),
                          F.lit(1).alias("payment_installments"),
                          (F.col("l_extendedprice") + F.col("l_quantity")
                           + F.when(k % 50 == 0, F.lit(1.5)).otherwise(F.lit(0.0))).alias("payment_value")))
    # Orders without any line item pay their order total in one payment.
    without_items = (o.join(li.select("l_orderkey"), F.col("o_orderkey") == F.col("l_orderkey"), "left_anti")
                     .select(F.col("o_orderkey").alias("order_id"),
                             F.lit(1).alias("payment_sequential"),
                             F.col("o_orderpriority").alias("payment_type"),
                             F.lit(1).alias("payment_installments"),
                             F.col("o_totalprice").alias("payment_value")))
    return from_items.unionByName(without_items)


def bind_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read_table(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    first = o.filter(k % 9 != 0).select(
        (k * 10).alias("review_id"), k.alias("order_id"),
        F.substring("o_orderpriority", 1, 1).cast("int").alias("review_score"))
    second = o.filter(k % 200 == 5).select(
        (k * 10 + 1).alias("review_id"), k.alias("order_id"), F.lit(1).alias("review_score"))
    # Columns the driver data has no source for are bound as typed nulls, so
    # the relation carries the full canonical schema.
    return first.unionByName(second).select(
        "review_id", "order_id", "review_score",
        F.lit(None).cast("string").alias("review_comment_title"),
        F.lit(None).cast("string").alias("review_comment_message"),
        F.lit(None).cast("timestamp_ntz").alias("review_creation_date"),
        F.lit(None).cast("timestamp_ntz").alias("review_answer_timestamp"))


PRODUCT_MEASURES = ("product_name_lenght", "product_description_lenght", "product_photos_qty",
                    "product_weight_g", "product_length_cm", "product_height_cm", "product_width_cm")


def bind_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = read_table(spark, sf_dir, "part")
    return p.select(F.col("p_partkey").alias("product_id"),
                    F.when(F.col("p_partkey") % 50 != 0, F.col("p_brand")).alias("product_category_name"),
                    *[F.lit(None).cast("double").alias(c) for c in PRODUCT_MEASURES])


def bind_translation(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = read_table(spark, sf_dir, "part")
    return (p.filter(F.col("p_brand") != "Brand#7")
            .select(F.col("p_brand").alias("product_category_name"),
                    F.concat(F.lit("en_"), F.col("p_brand")).alias("product_category_name_english"))
            .distinct())


def bind_sellers(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = read_table(spark, sf_dir, "supplier")
    return (s.join(_nation(spark, sf_dir), F.col("s_nationkey") == F.col("n_nationkey"))
            .select(F.col("s_suppkey").alias("seller_id"),
                    F.col("s_nationkey").alias("seller_zip_code_prefix"),
                    F.col("s_name").alias("seller_city"),
                    F.col("n_name").alias("seller_state")))


def bind_geolocation(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = read_table(spark, sf_dir, "customer")
    bal = F.col("c_acctbal") / F.lit(1000.0)
    return c.select(F.col("c_nationkey").alias("geolocation_zip_code_prefix"),
                    (bal - 1).alias("geolocation_lat"),
                    (F.lit(-40) - bal).alias("geolocation_lng"),
                    F.col("c_mktsegment").alias("geolocation_city"),
                    F.substring("c_mktsegment", 1, 1).alias("geolocation_state"))


def bind_sources(spark: SparkSession, sf_dir: str) -> RetailSources:
    """All nine canonical relations over the driver tables in ``sf_dir``."""
    binds = {"customers": bind_customers, "geolocation": bind_geolocation, "order_items": bind_items,
             "order_payments": bind_payments, "order_reviews": bind_reviews, "orders": bind_orders,
             "products": bind_products, "sellers": bind_sellers, "product_category_name_translation": bind_translation}
    return RetailSources(**{name: partial(bind, spark, sf_dir) for name, bind in binds.items()})
