"""Driver keys for profiling (A9-A14, A20-A22) and typing operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from martlake.functions import strip
from martlake.operators import outliers as OO
from martlake.operators import profile as PO
from martlake.plans.catalog import query
from martlake.plans.oracle import STRIP, with_ctes
from martlake.plans.q_quality import BRONZE_CTE
from martlake.sources import contracts as K
from martlake.sources.bindings import bind_sources
from martlake.sources.csv_source import timestamp
from martlake.sources.silver import fill_category

DESCRIBE_PROBS = (0.5, 0.9, 0.95, 0.99, 0.999)


def _pname(p: float) -> str:
    return "p" + f"{p * 100:g}".replace(".", "_")


@query("table_profile", with_ctes(sorted(set(BRONZE_CTE.values())), "\nUNION ALL\n".join(
    f"SELECT '{t}' AS table_name, CAST(COALESCE(SUM(n), 0) AS BIGINT) AS rows, "
    f"CAST({len(cols)} AS BIGINT) AS columns, CAST(COALESCE(SUM(n - 1), 0) AS BIGINT) AS duplicate_rows "
    f"FROM (SELECT *, COUNT(*) AS n FROM {BRONZE_CTE[t]} GROUP BY ALL)"
    for t, cols in K.EXPECTED_COLUMNS.items())))
def q_table_profile(spark, sf_dir):
    """Rows, columns and full-row duplicates per source table."""
    b = bind_sources(spark, sf_dir).as_dict()
    return PO.union_all([PO.table_profile(t, b[t]) for t in K.EXPECTED_COLUMNS])


@query("null_profile", with_ctes(sorted(set(BRONZE_CTE.values())), "SELECT * FROM (" + "\nUNION ALL\n".join(
    f"SELECT '{t}' AS table_name, '{c}' AS column_name, COUNT(*) FILTER (WHERE {c} IS NULL) AS nulls, "
    f"COUNT(*) FILTER (WHERE {c} IS NULL) / COUNT(*) AS share FROM {BRONZE_CTE[t]}"
    for t, cols in K.EXPECTED_COLUMNS.items() for c in cols) + ") WHERE nulls > 0"))
def q_null_profile(spark, sf_dir):
    """Columns with nulls, count and share, per source table."""
    b = bind_sources(spark, sf_dir).as_dict()
    return PO.union_all([PO.null_profile(t, b[t]) for t in K.EXPECTED_COLUMNS])


DIGITS = 5


def _describe_sql(src: str, name: str, x: str, scale: float, probs=DESCRIBE_PROBS) -> str:
    qs = ", ".join(f"quantile_cont(CAST({x} AS DOUBLE), {p}) / {scale}::DOUBLE AS {_pname(p)}" for p in probs)
    return f"""SELECT '{name}' AS column_name, n AS count, round(mean / {scale}::DOUBLE, {DIGITS}) AS mean,
  round(CASE WHEN n > 1 THEN std / {scale}::DOUBLE END, {DIGITS}) AS std,
  mn / {scale}::DOUBLE AS min, {', '.join(_pname(p) for p in probs)}, mx / {scale}::DOUBLE AS max
FROM (SELECT COUNT({x}) AS n, avg(CAST({x} AS DOUBLE)) AS mean, stddev_samp(CAST({x} AS DOUBLE)) AS std,
        MIN({x}) AS mn, MAX({x}) AS mx, {qs} FROM {src})"""


def _compared(described):
    """Floating-point moments differ in their last digits with the order of rows: the keys compare fewer."""
    return described.withColumns({c: F.round(c, DIGITS) for c in ("mean", "std")})


@query("describe_percentiles", with_ctes(["r_items"], "\nUNION ALL\n".join(
    _describe_sql("r_items", c, c, 1.0) for c in ("price", "freight_value"))))
def q_describe_percentiles(spark, sf_dir):
    """Count, mean, std, min, exact percentiles and max of price and freight."""
    items = bind_sources(spark, sf_dir).order_items
    return PO.union_all([_compared(PO.describe(items, c, DESCRIBE_PROBS)) for c in ("price", "freight_value")])


_CYCLE = (("approval_hours", "order_purchase_timestamp", "order_approved_at", 3600.0),
          ("delivery_days", "order_purchase_timestamp", "order_delivered_customer_date", 86400.0),
          ("delay_days", "order_estimated_delivery_date", "order_delivered_customer_date", 86400.0))


@query("cycle_time_stats", with_ctes(["r_orders"], "\nUNION ALL\n".join(
    _describe_sql(f"(SELECT date_diff('second', {a}, {b}) AS v FROM r_orders)", name, "v", scale)
    for name, a, b, scale in _CYCLE)))
def q_cycle_time_stats(spark, sf_dir):
    """Approval hours, delivery days and delay days described (fractional, from seconds)."""
    o = bind_sources(spark, sf_dir).orders
    frames = []
    for name, a, b, scale in _CYCLE:
        v = o.select(F.timestamp_diff("SECOND", F.col(a), F.col(b)).alias(name))
        frames.append(_compared(PO.describe(v, name, DESCRIBE_PROBS, scale)))
    return PO.union_all(frames)


@query("cycle_time_anomalies", with_ctes(["r_orders"], """
SELECT COUNT(*) FILTER (WHERE date_diff('second', order_purchase_timestamp, order_approved_at) < 0) AS approval_before_purchase,
  COUNT(*) FILTER (WHERE date_diff('second', order_purchase_timestamp, order_delivered_customer_date) < 0) AS delivery_before_purchase,
  COUNT(*) FILTER (WHERE order_status = 'delivered' AND order_delivered_customer_date IS NULL) AS delivered_missing_date
FROM r_orders"""))
def q_cycle_time_anomalies(spark, sf_dir):
    """approval/delivery before purchase and delivered orders without a date."""
    return PO.cycle_time_anomalies(bind_sources(spark, sf_dir).orders)


@query("status_completeness", with_ctes(["r_orders"], """
SELECT order_status, COUNT(*) AS orders,
  AVG(CAST(order_approved_at IS NOT NULL AS INTEGER)) AS order_approved_at_filled,
  AVG(CAST(order_delivered_carrier_date IS NOT NULL AS INTEGER)) AS order_delivered_carrier_date_filled,
  AVG(CAST(order_delivered_customer_date IS NOT NULL AS INTEGER)) AS order_delivered_customer_date_filled
FROM r_orders WHERE order_status IS NOT NULL GROUP BY order_status"""))
def q_status_completeness(spark, sf_dir):
    """Lifecycle date completeness by status."""
    return PO.status_completeness(bind_sources(spark, sf_dir).orders)


@query("identity_profile", with_ctes(["r_customers"], """
SELECT (SELECT COUNT(DISTINCT customer_id) FROM r_customers) AS customer_ids, COUNT(*) AS unique_people,
  COUNT(*) FILTER (WHERE ids > 1) AS people_with_multiple_customer_ids
FROM (SELECT customer_unique_id, COUNT(DISTINCT customer_id) AS ids FROM r_customers
      WHERE customer_unique_id IS NOT NULL GROUP BY customer_unique_id)"""))
def q_identity_profile(spark, sf_dir):
    """Customer ids vs people."""
    return PO.identity_profile(bind_sources(spark, sf_dir).customers)


@query("geo_summary", with_ctes(["r_geolocation"], """
SELECT CAST(SUM(n) AS BIGINT) AS rows, CAST(SUM(n - 1) AS BIGINT) AS full_duplicates,
  (SELECT COUNT(DISTINCT geolocation_zip_code_prefix) FROM r_geolocation) AS unique_zip_codes
FROM (SELECT *, COUNT(*) AS n FROM r_geolocation GROUP BY ALL)"""))
def q_geo_summary(spark, sf_dir):
    """A10: geolocation rows, full duplicates and distinct zips."""
    return PO.geo_summary(bind_sources(spark, sf_dir).geolocation)


@query("zip_ambiguity", with_ctes(["r_geolocation"], f"""
SELECT COUNT(*) AS zip_codes, COUNT(*) FILTER (WHERE cities > 1) AS zip_with_multiple_cities,
  COUNT(*) FILTER (WHERE states > 1) AS zip_with_multiple_states, MAX(rows) AS max_rows_per_zip,
  MAX(lat_span) AS max_lat_span, MAX(lng_span) AS max_lng_span,
  (SELECT COUNT(*) FILTER (WHERE NOT (COALESCE(geolocation_lat BETWEEN {K.LAT_RANGE[0]} AND {K.LAT_RANGE[1]}, false)
        AND COALESCE(geolocation_lng BETWEEN {K.LNG_RANGE[0]} AND {K.LNG_RANGE[1]}, false))) FROM r_geolocation)
    AS coordinates_outside_box
FROM (SELECT geolocation_zip_code_prefix, COUNT(*) AS rows, COUNT(DISTINCT geolocation_city) AS cities,
        COUNT(DISTINCT geolocation_state) AS states, MAX(geolocation_lat) - MIN(geolocation_lat) AS lat_span,
        MAX(geolocation_lng) - MIN(geolocation_lng) AS lng_span
      FROM r_geolocation WHERE geolocation_zip_code_prefix IS NOT NULL GROUP BY 1)"""))
def q_zip_ambiguity(spark, sf_dir):
    """Zip ambiguity profile summary."""
    return PO.zip_ambiguity(bind_sources(spark, sf_dir).geolocation, K.LAT_RANGE, K.LNG_RANGE)


# The bound dates are typed and clean.  Text is made of them so that some can't be parsed: by the
# order key a word, a date that doesn't exist, an empty text, or the date with a fraction of a second.
def _date_text_sql(c: str) -> str:
    return (f"CASE WHEN order_id % 13 = 0 THEN 'not a date' WHEN order_id % 17 = 0 THEN '1998-02-30 10:00:00' "
            f"WHEN order_id % 19 = 0 THEN '' WHEN order_id % 23 = 0 THEN strftime({c}, '%Y-%m-%d %H:%M:%S') || '.250' "
            f"ELSE strftime({c}, '%Y-%m-%d %H:%M:%S') END")


def _date_text(c: str):
    k, text = F.col("order_id"), F.date_format(F.col(c), "yyyy-MM-dd HH:mm:ss")
    return (F.when(k % 13 == 0, "not a date").when(k % 17 == 0, "1998-02-30 10:00:00").when(k % 19 == 0, "")
            .when(k % 23 == 0, F.concat(text, F.lit(".250"))).otherwise(text))


def _per_column(df, cols, **measures):
    """One pass: each measure (a function of the column name) of each column, then a row a column."""
    one = df.agg(*[m(c).alias(f"{n}_{i}") for i, c in enumerate(cols) for n, m in measures.items()])
    return one.select(F.inline(F.array(*[F.struct(F.lit(c).alias("column_name"), *[F.col(f"{n}_{i}").alias(n) for n in measures])
                                         for i, c in enumerate(cols)])))


@query("date_parse_failures", with_ctes(["r_orders"], "\nUNION ALL\n".join(
    f"SELECT '{c}' AS column_name, COUNT(t) AS non_null, COUNT(*) FILTER (WHERE t IS NOT NULL AND TRY_CAST(t AS TIMESTAMP) IS NULL) "
    f"AS parse_failures FROM (SELECT {_date_text_sql(c)} AS t FROM r_orders)" for c in K.ORDER_DATE_COLUMNS)))
def q_date_parse_failures(spark, sf_dir):
    """Per order date column, filled values that do not parse as timestamps."""
    text = bind_sources(spark, sf_dir).orders.select(*[_date_text(c).alias(c) for c in K.ORDER_DATE_COLUMNS])
    return _per_column(text, K.ORDER_DATE_COLUMNS, non_null=F.count,
                       parse_failures=lambda c: F.count_if(F.col(c).isNotNull() & timestamp(F.col(c)).isNull()))


@query("coerce_timestamps", with_ctes(["r_orders"], "\nUNION ALL\n".join(
    f"SELECT '{c}' AS column_name, COUNT(t) AS text_values, COUNT(TRY_CAST(t AS TIMESTAMP)) AS parsed, "
    f"COUNT(*) FILTER (WHERE TRY_CAST(t AS TIMESTAMP) = {c}) AS round_trip_equal "
    f"FROM (SELECT {c}, {_date_text_sql(c)} AS t FROM r_orders)" for c in K.ORDER_DATE_COLUMNS)))
def q_coerce_timestamps(spark, sf_dir):
    """Order dates as text, coerced by the pipeline's own rule (bad text becomes null)."""
    o = bind_sources(spark, sf_dir).orders
    both = o.select(*[_date_text(c).alias(c) for c in K.ORDER_DATE_COLUMNS], *[F.col(c).alias(f"was_{c}") for c in K.ORDER_DATE_COLUMNS])
    return _per_column(both, K.ORDER_DATE_COLUMNS, text_values=F.count, parsed=lambda c: F.count(timestamp(F.col(c))),
                       round_trip_equal=lambda c: F.count_if(timestamp(F.col(c)) == F.col(f"was_{c}")))


_STRIP_TARGETS = (("customers", ("customer_city", "customer_state")),
                  ("sellers", ("seller_city", "seller_state")),
                  ("geolocation", ("geolocation_city", "geolocation_state")),
                  ("order_payments", ("payment_type",)))
# The bound text has no outer white space: values of even length are padded on both sides.
_PAD = (9, 160, 8195, 28, 32)


def _padded_sql(c: str) -> str:
    pad = " || ".join(f"chr({n})" for n in _PAD)
    return f"CASE WHEN length({c}) % 2 = 0 THEN {pad} || {c} || {pad} ELSE {c} END"


def _padded(c: str):
    pad = F.lit("".join(map(chr, _PAD)))
    return F.when(F.char_length(c) % 2 == 0, F.concat(pad, F.col(c), pad)).otherwise(F.col(c))


@query("strip_strings", with_ctes(sorted({BRONZE_CTE[t] for t, _ in _STRIP_TARGETS}), "\nUNION ALL\n".join(
    f"SELECT '{t}' AS table_name, '{c}' AS column_name, COUNT(x) AS non_null, COUNT(*) FILTER (WHERE {STRIP.format(c='x')} <> x) AS changed, "
    f"COUNT(*) FILTER (WHERE {STRIP.format(c='x')} = y) AS restored FROM (SELECT {_padded_sql(c)} AS x, {c} AS y FROM {BRONZE_CTE[t]})"
    for t, cols in _STRIP_TARGETS for c in cols)))
def q_strip_strings(spark, sf_dir):
    """Padded values that stripping changes, and those it brings back, per string column."""
    b = bind_sources(spark, sf_dir).as_dict()
    return PO.union_all([_per_column(
        b[t], cols, non_null=lambda c: F.count(_padded(c)), changed=lambda c: F.count_if(strip(_padded(c)) != _padded(c)),
        restored=lambda c: F.count_if(strip(_padded(c)) == F.col(c))).select(F.lit(t).alias("table_name"), "*")
        for t, cols in _STRIP_TARGETS])


@query("category_missing_fill", with_ctes(["s_products"], """
SELECT COUNT(*) AS products, COUNT(*) FILTER (WHERE is_category_missing) AS missing,
  COUNT(*) FILTER (WHERE product_category_name = 'unknown') AS unknown_category,
  AVG(CAST(is_category_missing AS INTEGER)) AS missing_rate
FROM s_products"""))
def q_category_missing_fill(spark, sf_dir):
    """Missing-category flag then fill with 'unknown'."""
    p = fill_category(bind_sources(spark, sf_dir).products)
    return p.agg(F.count(F.lit(1)).alias("products"), F.count_if("is_category_missing").alias("missing"),
                  F.count_if(F.col("product_category_name") == "unknown").alias("unknown_category"),
                  F.avg(F.col("is_category_missing").cast("int")).alias("missing_rate"))


@query("winsor_histogram", with_ctes(["r_items"], """
WITH b AS (SELECT quantile_cont(price, 0.99) AS cap, MIN(price) AS lo FROM r_items),
 v AS (SELECT least(price, cap) AS v, cap, lo, (cap - lo) / 40.0::DOUBLE AS width FROM r_items, b WHERE price IS NOT NULL)
SELECT CAST(bin AS INTEGER) AS bin, ANY_VALUE(lo) + bin * ANY_VALUE(width) AS bin_start, COUNT(*) AS count
FROM (SELECT *, CASE WHEN width = 0 THEN 0 ELSE least(floor((v - lo) / width), 39) END AS bin FROM v)
GROUP BY bin"""))
def q_winsor_histogram(spark, sf_dir):
    """Price clipped at P99, 40-bin histogram."""
    return OO.winsor_histogram(bind_sources(spark, sf_dir).order_items, "price", 40, 0.99)
