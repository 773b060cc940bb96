"""The 35-check data-quality report and its severity gate.

Checks run on the landed (bronze) relations, independent of silver.  Work is
grouped by grain, not by check.  What a row's own columns tell (dates, domain,
ranges) is summed at the scan.  One narrow exchange by order serves the key, reference,
reconciliation and multi-review checks of the four order-keyed tables, and each
of the other tables is aggregated once.  The
one-row results are turned into check rows with ``inline``, so Spark can't
prune them apart into a scan per check.

A row is ``(check_id, check, severity, passed, observed, expectation,
evidence)``: ``observed`` is the number the check is decided by (violating
rows or a rate), ``evidence`` a JSON object that names what failed.

If any schema check fails the report holds only the nine schema checks
(the short circuit is a driver-side decision on plan metadata, no job runs).
"""

from __future__ import annotations

import json
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from martlake.functions import money, null_safe_bool
from martlake.operators.keys import key_profile, schema_failures
from martlake.operators.outliers import extreme_flags
from martlake.sources import contracts as K
from martlake.sources.bindings import RetailSources
from martlake.sources.csv_source import timestamp

REPORT_SCHEMA = ("check_id int, check string, severity string, passed boolean, observed double, "
                 "expectation string, evidence string")


def parse_ts(col: str, dtype) -> Column:
    """Coerce a date column: text is parsed (bad text -> null), typed values pass through."""
    if isinstance(dtype, StringType):
        return timestamp(F.col(col))
    return F.col(col).cast("timestamp_ntz")


def schema_checks(spark: SparkSession, bronze: dict[str, DataFrame]) -> tuple[DataFrame, bool]:
    diffs = schema_failures(bronze, K.EXPECTED_COLUMNS)
    rows = []
    for i, t in enumerate(K.EXPECTED_COLUMNS, start=1):
        missing, unexpected = diffs[t]
        bad = len(missing) + len(unexpected)
        rows.append((i, f"schema {t}", "critical", bad == 0, float(bad), "exactly the declared columns",
                     json.dumps({"missing": missing, "unexpected": unexpected})))
    return spark.createDataFrame(rows, REPORT_SCHEMA), all(r[3] for r in rows)


def _check(check_id: int, name: str, passed: Column, observed, expectation: str, severity: str = "critical",
           **evidence) -> Column:
    facts = F.struct(*[F.col(v).alias(k) if isinstance(v, str) else v.alias(k) for k, v in evidence.items()])
    number = F.col(observed) if isinstance(observed, str) else observed
    return F.struct(F.lit(check_id).alias("check_id"), F.lit(name).alias("check"), F.lit(severity).alias("severity"),
                    F.coalesce(passed, F.lit(False)).alias("passed"), number.cast("double").alias("observed"),
                    F.lit(expectation).alias("expectation"),
                    F.to_json(facts, {"ignoreNullFields": "false"}).alias("evidence"))


def _rows(frame: DataFrame, *checks: Column) -> DataFrame:
    """One row a check from a one-row frame."""
    return frame.select(F.inline(F.array(*checks)))


def _key_check(check_id: int, name: str, duplicates="duplicates", null_keys="null_keys") -> Column:
    return _check(check_id, f"{name} unique and filled", (F.col(duplicates) == 0) & (F.col(null_keys) == 0),
                  F.col(duplicates) + F.col(null_keys), "no duplicate and no null key",
                  duplicates=duplicates, null_keys=null_keys)


def order_flags(orders: DataFrame) -> DataFrame:
    """One row: what an order's own columns tell, summed at the scan (no key is needed)."""
    dtypes = {f.name: f.dataType for f in orders.schema.fields}
    at = {c: parse_ts(c, dtypes[c]) for c in K.ORDER_DATE_COLUMNS}
    bought, approved = at["order_purchase_timestamp"], at["order_approved_at"]
    arrived, delivered = at["order_delivered_customer_date"], null_safe_bool(F.col("order_status") == "delivered")
    bad_status = ~null_safe_bool(F.col("order_status").isin(*K.VALID_STATUS))
    flags = {"null_customer": F.col("customer_id").isNull(), "bad_status": bad_status,
             "approval_before": approved < bought, "delivery_before": delivered & (arrived < bought),
             "approval_fail": approved.isNotNull() & ~null_safe_bool(approved >= bought),
             "delivery_fail": delivered & arrived.isNotNull() & ~null_safe_bool(arrived >= bought),
             "delivered": delivered, "undated": delivered & arrived.isNull(),
             **{f"unparsed_{c}": F.col(c).isNotNull() & at[c].isNull() for c in K.ORDER_DATE_COLUMNS}}
    total = orders.agg(*[F.count_if(f).alias(n) for n, f in flags.items()], F.min(F.when(bad_status, F.col("order_status"))).alias("status"))
    return total.withColumn("undated_rate", F.when(F.col("delivered") > 0, F.col("undated") / F.col("delivered")))


SPARES = 1024   # parts in which rows without an order id are dealt


def order_metrics(b: dict[str, DataFrame]) -> DataFrame:
    """Everything that needs the order key, as one row: keys, references, reconciliation, reviews per order.

    Only (order_id, spare, kind, sub, amount) of orders (o), items (i), payments (p) and reviews (r) is
    exchanged, once, by order: both the count by (order, kind, second key) and that by order are
    made where the rows then lie.  ``amount`` is what was paid, less what the items cost.  Rows without an order id, which may
    be any share of bad data, are dealt by their second key (``spare``), so they don't meet in one task.
    """
    def part(kind: str, second: str | None, amount: Column | None = None) -> DataFrame:
        sub = F.col(second).cast("string") if second else F.lit(None).cast("string")
        return b[{"o": "orders", "i": "order_items", "p": "order_payments", "r": "order_reviews"}[kind]].select(
            "order_id", F.lit(kind).alias("kind"), sub.alias("sub"),
            (F.lit(None).cast("decimal(28,10)") if amount is None else amount).alias("amount"))

    zero = F.lit(0).cast("decimal(28,10)")
    cost = -(F.coalesce(money("price"), zero) + F.coalesce(money("freight_value"), zero))
    kinds = ("o", "i", "p", "r")
    rows = reduce(DataFrame.unionAll, [part("o", None), part("i", "order_item_id", cost.cast("decimal(28,10)")),
                                       part("p", "payment_sequential", money("payment_value")), part("r", "review_id")])
    spare = F.when(F.col("order_id").isNull(), F.pmod(F.xxhash64("kind", "sub"), F.lit(SPARES)).cast("int"))
    where = ["order_id", "spare"]
    per_key = (rows.withColumn("spare", spare).repartition(*where).groupBy(*where, "kind", "sub")
               .agg(F.count(F.lit(1)).alias("n"), F.sum("amount").alias("amount")))
    of = lambda kind, value: F.sum(F.when(F.col("kind") == kind, value).otherwise(0))
    per_order = per_key.groupBy(*where).agg(
        *[of(k, F.col("n")).alias(k) for k in kinds],
        *[of(k, F.col("n") - 1).alias(f"twice_{k}") for k in kinds],
        *[of(k, F.when(F.col("sub").isNull(), F.col("n")).otherwise(0)).alias(f"unnamed_{k}") for k in ("i", "p")],
        of("r", F.col("sub").isNotNull().cast("long")).alias("reviews"), F.coalesce(F.sum("amount"), F.lit(0)).alias("gap"))
    known = F.col("order_id").isNotNull()
    both = known & (F.col("p") > 0) & (F.col("i") > 0)
    total = per_order.agg(
        *[F.sum(f"twice_{k}").alias(f"twice_{k}") for k in kinds],
        *[F.sum(F.when(~known, F.col(k)).otherwise(0)).alias(f"nowhere_{k}") for k in kinds],
        *[F.sum(F.when(known, F.col(f"unnamed_{k}")).otherwise(0)).alias(f"unnamed_{k}") for k in ("i", "p")],
        *[F.sum(F.when(known & (F.col("o") == 0), F.col(k)).otherwise(0)).alias(f"lost_{k}") for k in ("i", "p", "r")],
        F.count_if(both).alias("comparable"),
        F.count_if(both & (F.abs("gap") > F.lit(K.RECONCILE_TOLERANCE))).alias("mismatches"),
        F.count_if(known & (F.col("i") > 0) & (F.col("p") == 0)).alias("only_items"),
        F.count_if(known & (F.col("p") > 0) & (F.col("i") == 0)).alias("only_payments"),
        F.count_if(known & (F.col("r") > 0)).alias("reviewed"),
        F.count_if(known & (F.col("reviews") > 1)).alias("multi_reviewed"))
    share = lambda a, b: F.when(F.col(b) > 0, F.col(a) / F.col(b))
    return (total.select(*[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in total.columns])
            .withColumn("null_o", F.col("nowhere_o"))
            .withColumns({f"null_{k}": F.col(f"nowhere_{k}") + F.col(f"unnamed_{k}") for k in ("i", "p")})
            # a child without an order id has a parent only if an order lacks its id too
            .withColumns({f"orphan_{k}": F.col(f"lost_{k}") + F.when(F.col("nowhere_o") == 0, F.col(f"nowhere_{k}")).otherwise(0)
                          for k in ("i", "p", "r")})
            .withColumn("mismatch_rate", F.coalesce(share("mismatches", "comparable"), F.lit(0.0)))
            .withColumn("multi_rate", share("multi_reviewed", "reviewed")))


def item_orphans(b: dict[str, DataFrame]) -> DataFrame:
    """Items whose product or seller is unknown, both by one scan of the items: the values are
    counted per (reference, value) first and only these meet the parents."""
    pairs = b["order_items"].select(F.explode(F.array(
        F.struct(F.lit("product_id").alias("ref"), F.col("product_id").cast("string").alias("v")),
        F.struct(F.lit("seller_id").alias("ref"), F.col("seller_id").cast("string").alias("v")))).alias("x")).select("x.*")
    parents = (b["products"].select(F.lit("product_id").alias("ref"), F.col("product_id").cast("string").alias("v"))
               .union(b["sellers"].select(F.lit("seller_id").alias("ref"), F.col("seller_id").cast("string").alias("v"))))
    met = (pairs.withColumn("child", F.lit(1).cast("long")).withColumn("parent", F.lit(0).cast("long"))
           .union(parents.withColumn("child", F.lit(0).cast("long")).withColumn("parent", F.lit(1).cast("long")))
           .groupBy("ref", "v").agg(F.sum("child").alias("child"), F.sum("parent").alias("parent")))
    lost = F.when(F.col("parent") == 0, F.col("child")).otherwise(0)
    return met.agg(*[F.coalesce(F.sum(F.when(F.col("ref") == r, lost)), F.lit(0)).alias(f"orphan_{r}") for r in ("product_id", "seller_id")],
                   *[F.min(F.when((F.col("ref") == r) & (F.col("parent") == 0), F.col("v"))).alias(f"example_{r}")
                     for r in ("product_id", "seller_id")])


def customer_metrics(b: dict[str, DataFrame]) -> DataFrame:
    """Customer key and the orders' reference to it, over one grouping by customer."""
    rows = (b["customers"].select("customer_id", F.lit(1).cast("long").alias("c"), F.lit(0).cast("long").alias("o"))
            .union(b["orders"].select("customer_id", F.lit(0).cast("long"), F.lit(1).cast("long"))))
    per = rows.groupBy("customer_id").agg(F.sum("c").alias("c"), F.sum("o").alias("o"))
    zero = lambda x: F.coalesce(F.sum(x), F.lit(0))
    return per.agg(zero(F.greatest(F.col("c") - 1, F.lit(0))).alias("duplicates"),
                   zero(F.when(F.col("customer_id").isNull(), F.col("c"))).alias("null_keys"),
                   zero(F.when(F.col("c") == 0, F.col("o"))).alias("orphans"))


def quality_report(spark: SparkSession, bronze_sources: RetailSources) -> DataFrame:
    b = bronze_sources.as_dict()
    schema_df, schema_ok = schema_checks(spark, b)
    if not schema_ok:
        return schema_df
    first_key = len(K.EXPECTED_COLUMNS) + 1
    key_id = {name: first_key + i for i, (name, _, _) in enumerate(K.KEY_CONTRACTS)}
    ref_id = {name: first_key + len(K.KEY_CONTRACTS) + 3 + i for i, (name, *_) in enumerate(K.FOREIGN_KEYS)}
    n = first_key + len(K.KEY_CONTRACTS)                    # 17
    after = n + 3 + len(K.FOREIGN_KEYS)                     # 26

    def ref(name: str, col: str, **more) -> Column:
        return _check(ref_id[name], name, F.col(col) == 0, col, "every value exists in the parent", orphans=col, **more)

    unparsed = [f"unparsed_{c}" for c in K.ORDER_DATE_COLUMNS]
    all_unparsed = reduce(lambda x, y: x + y, map(F.col, unparsed))
    by_row = _rows(
        order_flags(b["orders"]),
        _check(n, "orders.customer_id filled", F.col("null_customer") == 0, "null_customer", "no null", nulls="null_customer"),
        _check(n + 1, "order dates parseable", all_unparsed == 0, all_unparsed, "every filled date is a timestamp",
               **{c: f"unparsed_{c}" for c in K.ORDER_DATE_COLUMNS}),
        _check(n + 2, "status inside domain", F.col("bad_status") == 0, "bad_status", f"one of {', '.join(K.VALID_STATUS)}",
               rows="bad_status", example="status"),
        _check(after + 2, "approval after purchase", F.col("approval_fail") == 0, "approval_before", "approval >= purchase",
               before="approval_before", before_or_unknown="approval_fail"),
        _check(after + 3, "delivery after purchase", F.col("delivery_fail") == 0, "delivery_before", "delivery >= purchase",
               before="delivery_before", before_or_unknown="delivery_fail"),
        _check(after + 4, "delivered order has delivery date", (1 - F.col("undated_rate")) > K.DELIVERED_DATE_FILLED_MIN,
               "undated_rate", f"share filled > {K.DELIVERED_DATE_FILLED_MIN}", "warning", delivered="delivered", undated="undated"))
    by_order = _rows(
        order_metrics(b),
        _key_check(key_id["orders.order_id"], "orders.order_id", "twice_o", "null_o"),
        _key_check(key_id["items.order_id+item_id"], "items.order_id+item_id", "twice_i", "null_i"),
        _key_check(key_id["payments.order_id+sequence"], "payments.order_id+sequence", "twice_p", "null_p"),
        ref("FK items -> orders", "orphan_i"), ref("FK payments -> orders", "orphan_p"), ref("FK reviews -> orders", "orphan_r"),
        _check(after + 8, "payments reconcile items + freight",
               (F.col("mismatch_rate") < K.RECONCILE_MISMATCH_MAX) & (F.col("only_items") == 0), "mismatch_rate",
               f"mismatch rate < {K.RECONCILE_MISMATCH_MAX} and no order without payment", "warning", mismatches="mismatches",
               comparable="comparable", only_items="only_items", only_payments="only_payments"),
        _check(after + 9, "multiple reviews per order monitored", F.col("multi_rate") < K.MULTI_REVIEW_MAX, "multi_rate",
               f"rate < {K.MULTI_REVIEW_MAX}", "warning", reviewed="reviewed", several="multi_reviewed"))
    scores = _rows(b["order_reviews"].agg(F.count_if(~null_safe_bool(F.col("review_score").between(1, 5))).alias("outside")),
                   _check(after + 1, "review_score between 1 and 5", F.col("outside") == 0, "outside", "1 <= review_score <= 5", rows="outside"))
    by_customer = _rows(customer_metrics(b), _key_check(key_id["customers.customer_id"], "customers.customer_id"),
                        ref("FK orders -> customers", "orphans"))
    by_item_ref = _rows(item_orphans(b), ref("FK items -> products", "orphan_product_id", example="example_product_id"),
                        ref("FK items -> sellers", "orphan_seller_id", example="example_seller_id"))
    small = [_rows(key_profile(b[table], list(keys)), _key_check(key_id[name], name)) for name, table, keys in K.KEY_CONTRACTS
             if table in ("products", "sellers", "product_category_name_translation")]

    share = lambda cond: F.avg(cond.cast("int")).alias("rate")
    category = _rows(b["products"].agg(share(F.col("product_category_name").isNull())), _check(
        after + 5, "missing category monitored", F.col("rate") < K.MISSING_CATEGORY_MAX, "rate",
        f"share missing < {K.MISSING_CATEGORY_MAX}", "warning", missing_share="rate"))
    _, _, extreme = extreme_flags(b["order_items"], ["price", "freight_value"], K.TUKEY_FACTOR)
    price, freight = F.col("price"), F.col("freight_value")
    prices = b["order_items"].agg(
        share(extreme), F.count_if((price < 0) | (freight < 0)).alias("negative"),
        F.count_if(~null_safe_bool((price >= 0) & (freight >= 0))).alias("not_positive"))
    prices = _rows(
        prices,
        _check(after, "price and freight non negative", F.col("not_positive") == 0, "negative", "price and freight >= 0",
               negative="negative", negative_or_null="not_positive"),
        _check(after + 6, "extreme price/freight monitored", F.col("rate") < K.EXTREME_ROW_RATE_MAX, "rate",
               f"share of extreme rows < {K.EXTREME_ROW_RATE_MAX}", "warning", extreme_share="rate"))
    inside = (null_safe_bool(F.col("geolocation_lat").between(*K.LAT_RANGE))
              & null_safe_bool(F.col("geolocation_lng").between(*K.LNG_RANGE)))
    box = _rows(b["geolocation"].agg(F.count_if(~inside).alias("outside")), _check(
        after + 7, "coordinates in plausible range", F.col("outside") == 0, "outside",
        f"latitude in {K.LAT_RANGE}, longitude in {K.LNG_RANGE}", "warning", rows="outside"))
    return reduce(DataFrame.unionByName, [schema_df, by_row, by_order, by_customer, by_item_ref, *small, category, prices, scores, box])


def multi_review_rate(reviews: DataFrame) -> DataFrame:
    """Share of reviewed orders with more than one distinct review id."""
    per_order = (reviews.filter(F.col("order_id").isNotNull()).groupBy("order_id")
                 .agg(F.countDistinct("review_id").alias("n")))
    return per_order.agg(F.count(F.lit(1)).alias("reviewed_orders"),
                         F.count_if(F.col("n") > 1).alias("multi_review_orders"),
                         F.avg((F.col("n") > 1).cast("int")).alias("multi_review_rate"))


def gate_summary(report: DataFrame) -> DataFrame:
    """Per severity total and failed checks; ``blocks_publish`` for failed criticals."""
    return (report.groupBy("severity")
            .agg(F.count(F.lit(1)).alias("total"), F.count_if(~F.col("passed")).alias("failed"))
            .withColumn("blocks_publish", (F.col("severity") == "critical") & (F.col("failed") > 0)))


def any_critical_failed(report: DataFrame) -> bool:
    """Driver-side gate decision: a single boolean from a filtered existence test."""
    return not report.filter((F.col("severity") == "critical") & ~F.col("passed")).isEmpty()
