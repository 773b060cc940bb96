"""Driver keys for the data-quality operators and the 35-check report."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martlake.operators import keys as KO
from martlake.operators import outliers as OO
from martlake.operators import reconcile as RO
from martlake.plans import quality as Q
from martlake.plans.catalog import query
from martlake.plans.oracle import with_ctes
from martlake.session import written
from martlake.sources import contracts as K
from martlake.sources.bindings import bind_sources

# bronze relation name -> oracle CTE
BRONZE_CTE = {
    "customers": "r_customers", "geolocation": "r_geolocation", "order_items": "r_items",
    "order_payments": "r_payments", "order_reviews": "r_reviews_full", "orders": "r_orders",
    "products": "r_products", "sellers": "r_sellers",
    "product_category_name_translation": "r_translation",
}
_STATUS_LIST = ", ".join(f"'{s}'" for s in K.VALID_STATUS)


def _key_sql(table: str, keys) -> str:
    cols = ", ".join(keys)
    anynull = " OR ".join(f"{k} IS NULL" for k in keys)
    return (f"SELECT CAST(COALESCE(SUM(n), 0) AS BIGINT) AS rows, CAST(COALESCE(SUM(n - 1), 0) AS BIGINT) AS duplicates, "
            f"CAST(COALESCE(SUM(CASE WHEN {anynull} THEN n END), 0) AS BIGINT) AS null_keys "
            f"FROM (SELECT {cols}, COUNT(*) AS n FROM {BRONZE_CTE[table]} GROUP BY {cols})")


def _orphan_sql(child, ccol, parent, pcol, rows=None) -> str:
    return (f"SELECT COUNT(*) AS orphans FROM {rows or BRONZE_CTE[child]} c WHERE NOT EXISTS "
            f"(SELECT 1 FROM {BRONZE_CTE[parent]} p WHERE p.{pcol} IS NOT DISTINCT FROM c.{ccol})")


def _fence_sql(table: str, col: str) -> str:
    return (f"(SELECT q[2] + {K.TUKEY_FACTOR} * (q[2] - q[1]) FROM "
            f"(SELECT quantile_cont({col}, [0.25, 0.75]) AS q FROM {table}))")


_RECON_CTE = """
SELECT order_id, paid, item_value, freight,
  CASE WHEN on_pay AND on_items THEN 'both' WHEN on_pay THEN 'left_only' ELSE 'right_only' END AS side,
  abs(paid - item_value - freight) AS abs_difference
FROM (SELECT order_id, COALESCE(SUM(CAST(payment_value AS DECIMAL(18,2))), 0) AS paid, true AS on_pay
      FROM {pay} WHERE order_id IS NOT NULL GROUP BY order_id) p
FULL OUTER JOIN (SELECT order_id, COALESCE(SUM(CAST(price AS DECIMAL(18,2))), 0) AS item_value,
      COALESCE(SUM(CAST(freight_value AS DECIMAL(18,2))), 0) AS freight, true AS on_items
      FROM {items} WHERE order_id IS NOT NULL GROUP BY order_id) i USING (order_id)"""

_RECON_SQL = f"""
SELECT COUNT(*) FILTER (WHERE side = 'left_only') AS only_payments,
  COUNT(*) FILTER (WHERE side = 'right_only') AS only_items,
  COUNT(*) FILTER (WHERE side = 'both') AS comparable_orders,
  COUNT(*) FILTER (WHERE side = 'both' AND abs_difference > {K.RECONCILE_TOLERANCE}) AS value_mismatches,
  CASE WHEN COUNT(*) FILTER (WHERE side = 'both') > 0
       THEN COUNT(*) FILTER (WHERE side = 'both' AND abs_difference > {K.RECONCILE_TOLERANCE})
            / COUNT(*) FILTER (WHERE side = 'both') ELSE 0.0 END AS mismatch_rate
FROM recon"""

_MULTI_REVIEW_SQL = """
SELECT COUNT(*) AS reviewed_orders, COUNT(*) FILTER (WHERE n > 1) AS multi_review_orders,
  AVG(CAST(n > 1 AS INTEGER)) AS multi_review_rate
FROM (SELECT order_id, COUNT(DISTINCT review_id) AS n FROM {rev} WHERE order_id IS NOT NULL GROUP BY order_id)"""


def _register_shared_ctes():
    from martlake.plans.oracle import register
    register("recon", ("r_payments", "r_items"), _RECON_CTE.format(pay="r_payments", items="r_items"))


_register_shared_ctes()


# ---------------------------------------------------------------- key contracts
def _key_contracts_sql():
    parts = []
    for name, table, keys in K.KEY_CONTRACTS:
        parts.append(f"SELECT '{name}' AS contract, '{table}' AS table_name, rows, duplicates, null_keys, "
                     f"duplicates = 0 AND null_keys = 0 AS passed FROM ({_key_sql(table, keys)})")
    needs = sorted({BRONZE_CTE[t] for _, t, _ in K.KEY_CONTRACTS})
    return with_ctes(needs, "\nUNION ALL\n".join(parts))


@query("key_contracts", _key_contracts_sql())
def q_key_contracts(spark, sf_dir):
    """Duplicate and null key counts for the seven key contracts."""
    b = bind_sources(spark, sf_dir).as_dict()
    frames = [KO.key_profile(b[table], list(keys)).select(
        F.lit(name).alias("contract"), F.lit(table).alias("table_name"), "rows", "duplicates", "null_keys",
        ((F.col("duplicates") == 0) & (F.col("null_keys") == 0)).alias("passed"))
        for name, table, keys in K.KEY_CONTRACTS]
    return reduce(DataFrame.unionByName, frames)


# ---------------------------------------------------------------- references
# The bound tables have no orphans.  So that the check is seen to find some, every child value
# divisible by STRAY_STEP is moved out of the parent's range, and one divisible by STRAY_NULL is null.
STRAY_STEP, STRAY_BY, STRAY_NULL = 101, 1_000_000_000_000, 307


def _stray_sql(child, col):
    return (f"(SELECT CASE WHEN {col} % {STRAY_NULL} = 0 THEN NULL WHEN {col} % {STRAY_STEP} = 0 THEN {col} + {STRAY_BY} "
            f"ELSE {col} END AS {col} FROM {BRONZE_CTE[child]})")


def _fk_sql():
    parts = [f"SELECT '{name}' AS \"check\", orphans, orphans = 0 AS passed "
             f"FROM ({_orphan_sql(c, cc, p, pc, _stray_sql(c, cc))})" for name, c, cc, p, pc in K.FOREIGN_KEYS]
    needs = sorted({BRONZE_CTE[t] for _, c, _, p, _ in K.FOREIGN_KEYS for t in (c, p)})
    return with_ctes(needs, "\nUNION ALL\n".join(parts))


@query("fk_orphans", _fk_sql())
def q_fk_orphans(spark, sf_dir):
    """Orphan child rows for the six references (null-safe anti joins), with strays planted."""
    b = bind_sources(spark, sf_dir).as_dict()

    def strays(table, col):
        k = F.col(col).cast("long")
        return b[table].select(F.when(k % STRAY_NULL == 0, None).when(k % STRAY_STEP == 0, k + STRAY_BY).otherwise(k).alias(col))

    frames = [KO.orphans(strays(c, cc), cc, b[p], pc).select(
        F.lit(name).alias("check"), "orphans", (F.col("orphans") == 0).alias("passed"))
        for name, c, cc, p, pc in K.FOREIGN_KEYS]
    return reduce(DataFrame.unionByName, frames)


# ---------------------------------------------------------------- domain
@query("status_domain", with_ctes(["r_orders"], f"""
SELECT order_status, COUNT(*) AS rows, COALESCE(order_status IN ({_STATUS_LIST}), false) AS in_domain
FROM r_orders GROUP BY order_status"""))
def q_status_domain(spark, sf_dir):
    """Order statuses with counts and domain membership (null is outside)."""
    return KO.domain_profile(bind_sources(spark, sf_dir).orders, "order_status", K.VALID_STATUS)


# ---------------------------------------------------------------- outliers
@query("tukey_outliers", with_ctes(["r_items"], f"""
SELECT pu AS price_upper, fu AS freight_value_upper,
  COUNT(*) FILTER (WHERE price > pu) AS price_extreme,
  COUNT(*) FILTER (WHERE freight_value > fu) AS freight_value_extreme,
  COUNT(*) FILTER (WHERE price > pu OR freight_value > fu) AS extreme_rows,
  COUNT(*) AS rows,
  COUNT(*) FILTER (WHERE price > pu OR freight_value > fu) / COUNT(*) AS row_rate
FROM r_items, (SELECT {_fence_sql('r_items', 'price')} AS pu, {_fence_sql('r_items', 'freight_value')} AS fu)
GROUP BY pu, fu"""))
def q_tukey_outliers(spark, sf_dir):
    """Extreme fences Q3 + 3 IQR for price and freight, counts and row rate."""
    return OO.tukey_outliers(bind_sources(spark, sf_dir).order_items, ["price", "freight_value"], K.TUKEY_FACTOR)


@query("outlier_value_share", with_ctes(["r_items"], f"""
SELECT AVG(CAST(x AS INTEGER)) AS extreme_row_rate,
  COALESCE(CAST(SUM(CAST(CASE WHEN x THEN price END AS DECIMAL(18,2))) AS DOUBLE), 0.0)
    / CAST(SUM(CAST(price AS DECIMAL(18,2))) AS DOUBLE) AS extreme_price_revenue_share,
  COALESCE(CAST(SUM(CAST(CASE WHEN x THEN freight_value END AS DECIMAL(18,2))) AS DOUBLE), 0.0)
    / CAST(SUM(CAST(freight_value AS DECIMAL(18,2))) AS DOUBLE) AS extreme_freight_share,
  ANY_VALUE(pu) AS price_threshold, ANY_VALUE(fu) AS freight_value_threshold
FROM (SELECT price, freight_value, pu, fu, COALESCE(price > pu, false) OR COALESCE(freight_value > fu, false) AS x
      FROM r_items, (SELECT {_fence_sql('r_items', 'price')} AS pu, {_fence_sql('r_items', 'freight_value')} AS fu))"""))
def q_outlier_value_share(spark, sf_dir):
    """Share of revenue and freight carried by extreme rows."""
    return OO.outlier_value_share(bind_sources(spark, sf_dir).order_items)


# ---------------------------------------------------------------- reconciliation
@query("payment_reconciliation", with_ctes(["recon"], _RECON_SQL))
def q_payment_reconciliation(spark, sf_dir):
    """Payments vs items + freight per order (full outer join with side marker)."""
    b = bind_sources(spark, sf_dir)
    return RO.payment_reconciliation(b.order_payments, b.order_items, K.RECONCILE_TOLERANCE)


@query("reconciliation_profile", with_ctes(["recon"], """
SELECT COUNT(*) AS orders_compared, COUNT(*) FILTER (WHERE side <> 'both') AS missing_on_one_side,
  COUNT(*) FILTER (WHERE abs_difference > 0.01) AS difference_gt_1_cent,
  COUNT(*) FILTER (WHERE abs_difference > 1.0) AS difference_gt_1_real
FROM recon"""))
def q_reconciliation_profile(spark, sf_dir):
    """Wider reconciliation profile."""
    b = bind_sources(spark, sf_dir)
    return RO.reconciliation_profile(b.order_payments, b.order_items)


@query("multi_review_rate", with_ctes(["r_reviews_full"], _MULTI_REVIEW_SQL.format(rev="r_reviews_full")))
def q_multi_review_rate(spark, sf_dir):
    """Share of orders with more than one distinct review."""
    return Q.multi_review_rate(bind_sources(spark, sf_dir).order_reviews)


# ---------------------------------------------------------------- schema
# The bound tables keep their contract.  So that the check is seen to find both kinds of failure, two
# tables are also written altered: one without a column, one with another.
ALTERED = {"sellers without seller_state": ("sellers", 1, 0), "customers with loyalty": ("customers", 0, 1)}


def _schema_sql():
    given = {t: (t, 0, 0) for t in K.EXPECTED_COLUMNS}
    return with_ctes(sorted(set(BRONZE_CTE.values())), "\nUNION ALL\n".join(
        f"SELECT '{name}' AS \"table\", CAST({missing} AS BIGINT) AS missing, CAST({unexpected} AS BIGINT) AS unexpected, "
        f"{'false' if missing or unexpected else 'true'} AS passed, COUNT(*) AS rows FROM {BRONZE_CTE[t]}"
        for name, (t, missing, unexpected) in (given | ALTERED).items()))


@query("schema_contracts", _schema_sql())
def q_schema_contracts(spark, sf_dir):
    """Column-set equality per table as written and read back, with the rows read: the nine tables as
    they are bound, and the two altered ones."""
    tables = bind_sources(spark, sf_dir).as_dict()
    tables["sellers without seller_state"] = tables["sellers"].drop("seller_state")
    tables["customers with loyalty"] = tables["customers"].withColumn("loyalty", F.lit(1))
    tables = {t: written(df) for t, df in tables.items()}
    expected = K.EXPECTED_COLUMNS | {name: K.EXPECTED_COLUMNS[t] for name, (t, _, _) in ALTERED.items()}
    counts = reduce(DataFrame.unionByName, [df.agg(F.lit(t).alias("table"), F.count(F.lit(1)).alias("rows")) for t, df in tables.items()])
    return KO.schema_diff(spark, tables, expected).join(counts, "table")


# ---------------------------------------------------------------- 35-check report
def _report_sql() -> str:
    parts = []
    cid = 0
    for t in K.EXPECTED_COLUMNS:
        cid += 1
        parts.append(f"SELECT {cid} AS check_id, 'schema {t}' AS \"check\", 'critical' AS severity, true AS passed, 0.0::DOUBLE AS observed")
    for name, table, keys in K.KEY_CONTRACTS:
        cid += 1
        parts.append(f"SELECT {cid}, '{name} unique and filled', 'critical', COALESCE(duplicates = 0 AND null_keys = 0, false), "
                     f"CAST(duplicates + null_keys AS DOUBLE) FROM ({_key_sql(table, keys)})")
    fails = " + ".join(f"COUNT(*) FILTER (WHERE {c} IS NOT NULL AND TRY_CAST({c} AS TIMESTAMP) IS NULL)"
                       for c in K.ORDER_DATE_COLUMNS)
    oa = f"""(SELECT COUNT(*) FILTER (WHERE customer_id IS NULL) AS null_customer,
  {fails} AS parse_failures,
  COUNT(*) FILTER (WHERE NOT COALESCE(order_status IN ({_STATUS_LIST}), false)) AS bad_status,
  COUNT(*) FILTER (WHERE order_approved_at IS NOT NULL AND order_approved_at < order_purchase_timestamp) AS approval_before,
  COUNT(*) FILTER (WHERE order_approved_at IS NOT NULL AND NOT COALESCE(order_approved_at >= order_purchase_timestamp, false)) AS approval_fail,
  COUNT(*) FILTER (WHERE COALESCE(order_status = 'delivered', false) AND order_delivered_customer_date IS NOT NULL
                   AND order_delivered_customer_date < order_purchase_timestamp) AS delivery_before,
  COUNT(*) FILTER (WHERE COALESCE(order_status = 'delivered', false) AND order_delivered_customer_date IS NOT NULL
                   AND NOT COALESCE(order_delivered_customer_date >= order_purchase_timestamp, false)) AS delivery_fail,
  AVG(CASE WHEN order_status = 'delivered' THEN CAST(order_delivered_customer_date IS NULL AS INTEGER) END) AS delivered_missing_rate
  FROM r_orders)"""
    cid += 1
    parts.append(f"SELECT {cid}, 'orders.customer_id filled', 'critical', COALESCE(null_customer = 0, false), CAST(null_customer AS DOUBLE) FROM {oa}")
    cid += 1
    parts.append(f"SELECT {cid}, 'order dates parseable', 'critical', COALESCE(parse_failures = 0, false), CAST(parse_failures AS DOUBLE) FROM {oa}")
    cid += 1
    parts.append(f"SELECT {cid}, 'status inside domain', 'critical', COALESCE(bad_status = 0, false), CAST(bad_status AS DOUBLE) FROM {oa}")
    for name, c, cc, p, pc in K.FOREIGN_KEYS:
        cid += 1
        parts.append(f"SELECT {cid}, '{name}', 'critical', COALESCE(orphans = 0, false), CAST(orphans AS DOUBLE) FROM ({_orphan_sql(c, cc, p, pc)})")
    cid += 1
    parts.append(f"""SELECT {cid}, 'price and freight non negative', 'critical',
  COALESCE(COUNT(*) FILTER (WHERE NOT COALESCE(price >= 0 AND freight_value >= 0, false)) = 0, false),
  CAST(COUNT(*) FILTER (WHERE price < 0 OR freight_value < 0) AS DOUBLE) FROM r_items""")
    cid += 1
    parts.append(f"""SELECT {cid}, 'review_score between 1 and 5', 'critical',
  COALESCE(COUNT(*) FILTER (WHERE NOT COALESCE(review_score BETWEEN 1 AND 5, false)) = 0, false),
  CAST(COUNT(*) FILTER (WHERE NOT COALESCE(review_score BETWEEN 1 AND 5, false)) AS DOUBLE) FROM r_reviews_full""")
    cid += 1
    parts.append(f"SELECT {cid}, 'approval after purchase', 'critical', COALESCE(approval_fail = 0, false), CAST(approval_before AS DOUBLE) FROM {oa}")
    cid += 1
    parts.append(f"SELECT {cid}, 'delivery after purchase', 'critical', COALESCE(delivery_fail = 0, false), CAST(delivery_before AS DOUBLE) FROM {oa}")
    cid += 1
    parts.append(f"SELECT {cid}, 'delivered order has delivery date', 'warning', COALESCE((1 - delivered_missing_rate) > {K.DELIVERED_DATE_FILLED_MIN}, false), delivered_missing_rate FROM {oa}")
    cid += 1
    parts.append(f"""SELECT {cid}, 'missing category monitored', 'warning', COALESCE(rate < {K.MISSING_CATEGORY_MAX}, false), rate
  FROM (SELECT AVG(CAST(product_category_name IS NULL AS INTEGER)) AS rate FROM r_products)""")
    cid += 1
    parts.append(f"""SELECT {cid}, 'extreme price/freight monitored', 'warning', COALESCE(rate < {K.EXTREME_ROW_RATE_MAX}, false), rate
  FROM (SELECT AVG(CAST(COALESCE(price > pu, false) OR COALESCE(freight_value > fu, false) AS INTEGER)) AS rate
        FROM r_items, (SELECT {_fence_sql('r_items', 'price')} AS pu, {_fence_sql('r_items', 'freight_value')} AS fu))""")
    cid += 1
    parts.append(f"""SELECT {cid}, 'coordinates in plausible range', 'warning', COALESCE(outside = 0, false), CAST(outside AS DOUBLE)
  FROM (SELECT COUNT(*) FILTER (WHERE NOT (COALESCE(geolocation_lat BETWEEN {K.LAT_RANGE[0]} AND {K.LAT_RANGE[1]}, false)
        AND COALESCE(geolocation_lng BETWEEN {K.LNG_RANGE[0]} AND {K.LNG_RANGE[1]}, false))) AS outside FROM r_geolocation)""")
    cid += 1
    parts.append(f"""SELECT {cid}, 'payments reconcile items + freight', 'warning',
  COALESCE(mismatch_rate < {K.RECONCILE_MISMATCH_MAX} AND only_items = 0, false), CAST(mismatch_rate AS DOUBLE) FROM ({_RECON_SQL})""")
    cid += 1
    parts.append(f"""SELECT {cid}, 'multiple reviews per order monitored', 'warning',
  COALESCE(multi_review_rate < {K.MULTI_REVIEW_MAX}, false), multi_review_rate FROM ({_MULTI_REVIEW_SQL.format(rev='r_reviews_full')})""")
    needs = sorted(set(BRONZE_CTE.values()) | {"recon"})
    return with_ctes(needs, "\nUNION ALL\n".join(parts))


REPORT_SQL = _report_sql()


@query("quality_report", REPORT_SQL)
def q_quality_report(spark, sf_dir):
    """§2.9: the 35 checks (schema, keys, dates, domain, references, ranges, outliers,
    coordinates, reconciliation, multi-review), one row each."""
    return Q.quality_report(spark, bind_sources(spark, sf_dir)).select("check_id", "check", "severity", "passed", "observed")


@query("quality_gate_summary", f"""
WITH report AS ({REPORT_SQL.replace(chr(10), chr(10) + '  ')})
SELECT severity, COUNT(*) AS total, COUNT(*) FILTER (WHERE NOT passed) AS failed,
  severity = 'critical' AND COUNT(*) FILTER (WHERE NOT passed) > 0 AS blocks_publish
FROM report GROUP BY severity""")
def q_quality_gate_summary(spark, sf_dir):
    """Gate summary by severity."""
    return Q.gate_summary(Q.quality_report(spark, bind_sources(spark, sf_dir)))
