"""Source contracts of the retail package.

Fixed values: these must equal the contract of the source data for the
checks to mean the same thing (file names, exact column sets, key lists,
references, status domain, date columns, coordinate box, thresholds).
"""

from __future__ import annotations

# The nine source files, in package order.
SOURCE_FILES = (
    "olist_customers_dataset.csv",
    "olist_geolocation_dataset.csv",
    "olist_order_items_dataset.csv",
    "olist_order_payments_dataset.csv",
    "olist_order_reviews_dataset.csv",
    "olist_orders_dataset.csv",
    "olist_products_dataset.csv",
    "olist_sellers_dataset.csv",
    "product_category_name_translation.csv",
)


def table_name(filename: str) -> str:
    """File name -> short table name (drop the ``olist_`` prefix and suffixes)."""
    name = filename.removeprefix("olist_")
    return name.removesuffix("_dataset.csv").removesuffix(".csv")


# Exact column set per table (order is free).
EXPECTED_COLUMNS: dict[str, tuple[str, ...]] = {
    "customers": ("customer_id", "customer_unique_id", "customer_zip_code_prefix",
                  "customer_city", "customer_state"),
    "geolocation": ("geolocation_zip_code_prefix", "geolocation_lat", "geolocation_lng",
                    "geolocation_city", "geolocation_state"),
    "order_items": ("order_id", "order_item_id", "product_id", "seller_id",
                    "shipping_limit_date", "price", "freight_value"),
    "order_payments": ("order_id", "payment_sequential", "payment_type",
                       "payment_installments", "payment_value"),
    "order_reviews": ("review_id", "order_id", "review_score", "review_comment_title",
                      "review_comment_message", "review_creation_date", "review_answer_timestamp"),
    "orders": ("order_id", "customer_id", "order_status", "order_purchase_timestamp",
               "order_approved_at", "order_delivered_carrier_date",
               "order_delivered_customer_date", "order_estimated_delivery_date"),
    "products": ("product_id", "product_category_name", "product_name_lenght",
                 "product_description_lenght", "product_photos_qty", "product_weight_g",
                 "product_length_cm", "product_height_cm", "product_width_cm"),
    "sellers": ("seller_id", "seller_zip_code_prefix", "seller_city", "seller_state"),
    "product_category_name_translation": ("product_category_name", "product_category_name_english"),
}

# Every join key or declared grain must be unique and filled.
KEY_CONTRACTS: tuple[tuple[str, str, tuple[str, ...]], ...] = (
    ("orders.order_id", "orders", ("order_id",)),
    ("customers.customer_id", "customers", ("customer_id",)),
    ("items.order_id+item_id", "order_items", ("order_id", "order_item_id")),
    ("payments.order_id+sequence", "order_payments", ("order_id", "payment_sequential")),
    ("products.product_id", "products", ("product_id",)),
    ("sellers.seller_id", "sellers", ("seller_id",)),
    ("translation.category", "product_category_name_translation", ("product_category_name",)),
)

# References (child table, column) -> (parent table, column).
FOREIGN_KEYS: tuple[tuple[str, str, str, str, str], ...] = (
    ("FK orders -> customers", "orders", "customer_id", "customers", "customer_id"),
    ("FK items -> orders", "order_items", "order_id", "orders", "order_id"),
    ("FK items -> products", "order_items", "product_id", "products", "product_id"),
    ("FK items -> sellers", "order_items", "seller_id", "sellers", "seller_id"),
    ("FK payments -> orders", "order_payments", "order_id", "orders", "order_id"),
    ("FK reviews -> orders", "order_reviews", "order_id", "orders", "order_id"),
)

# The order status domain.
VALID_STATUS = ("approved", "canceled", "created", "delivered", "invoiced",
                "processing", "shipped", "unavailable")

# Date columns coerced per table (bad text becomes null).
DATE_COLUMNS: dict[str, tuple[str, ...]] = {
    "orders": ("order_purchase_timestamp", "order_approved_at", "order_delivered_carrier_date",
               "order_delivered_customer_date", "order_estimated_delivery_date"),
    "order_items": ("shipping_limit_date",),
    "order_reviews": ("review_creation_date", "review_answer_timestamp"),
}
ORDER_DATE_COLUMNS = DATE_COLUMNS["orders"]

# Plausible coordinate box (latitude, longitude), inclusive.
LAT_RANGE = (-35.0, 6.0)
LNG_RANGE = (-75.0, -30.0)

# Warning thresholds and tolerances.
DELIVERED_DATE_FILLED_MIN = 0.999
MISSING_CATEGORY_MAX = 0.03
EXTREME_ROW_RATE_MAX = 0.05
TUKEY_FACTOR = 3.0
RECONCILE_TOLERANCE = 0.01
RECONCILE_MISMATCH_MAX = 0.02
MULTI_REVIEW_MAX = 0.01

# The six published gold relations.
GOLD_TABLES = ("fact_orders", "fact_order_items", "mart_monthly_sales",
               "mart_category_performance", "mart_customer_value", "mart_seller_performance")
