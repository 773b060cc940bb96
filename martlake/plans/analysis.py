"""Business analyses on the gold facts and marts (seasonality, categories,
delivery vs repurchase, regional value, scenario levers).

Shares of a grand total use a scalar subquery for the total (computed once,
never joined to the detail).  Money totals are exact decimal sums.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martlake.functions import commercial, day_floor, money_sum, month_start, ntz, ratio
from martlake.operators.quantiles import quantiles
from martlake.operators.sequence import next_in_sequence

# Driver parameters (the executive window and the compared years are
# parameters because the driver data spans other years than the source).
WINDOW = ("1998-03-01", "1998-09-01")
YEARS = (1997, 1998)
CALENDAR_RANGE = ("1997-01-01", "1998-08-01")
REPURCHASE_DAYS = 90


def in_window(ts="order_purchase_timestamp", start=WINDOW[0], end=WINDOW[1]):
    """Half-open window [start, end) on a timestamp_ntz column."""
    return (F.col(ts) >= ntz(start)) & (F.col(ts) < ntz(end))


# ------------------------------------------------------------------ seasonality
def monthly_series(fact_orders: DataFrame) -> DataFrame:
    """Monthly orders and GMV (commercial filter)."""
    return (fact_orders.filter(commercial())
            .groupBy(month_start("order_purchase_timestamp").alias("order_month"))
            .agg(F.countDistinct("order_id").alias("orders"), money_sum("item_revenue").alias("revenue"))
            .withColumn("avg_order_value", ratio("revenue", "orders")))


def yoy_pivot(fact_orders: DataFrame, years=YEARS) -> DataFrame:
    """Month x year pivot of orders and revenue, months present in both years, growth."""
    y1, y2 = years
    m = (fact_orders.filter(commercial())
         .withColumn("year", F.year("order_purchase_timestamp"))
         .withColumn("month", F.month("order_purchase_timestamp")))
    p = (m.groupBy("month").pivot("year", [y1, y2])
         .agg(F.countDistinct("order_id").alias("orders"), money_sum("item_revenue").alias("revenue")))
    p = p.filter(F.col(f"{y1}_orders").isNotNull() & (F.col(f"{y1}_orders") > 0)
                 & F.col(f"{y2}_orders").isNotNull() & (F.col(f"{y2}_orders") > 0))
    return p.select(
        "month",
        F.col(f"{y1}_orders").alias(f"orders_{y1}"), F.col(f"{y2}_orders").alias(f"orders_{y2}"),
        (F.col(f"{y2}_orders") / F.col(f"{y1}_orders") - 1).alias("orders_growth"),
        F.col(f"{y1}_revenue").alias(f"revenue_{y1}"), F.col(f"{y2}_revenue").alias(f"revenue_{y2}"),
        (F.col(f"{y2}_revenue") / F.col(f"{y1}_revenue") - 1).alias("revenue_growth"))


def calendar_month_mean(fact_orders: DataFrame, start=CALENDAR_RANGE[0], end=CALENDAR_RANGE[1]) -> DataFrame:
    """Mean monthly revenue per calendar month over [start, end), with years observed."""
    s = monthly_series(fact_orders).filter(
        (F.col("order_month") >= ntz(start)) & (F.col("order_month") < ntz(end)))
    return (s.groupBy(F.month("order_month").alias("month"))
            .agg(money_sum("revenue").alias("_rev"), F.count(F.lit(1)).alias("years_observed"))
            .select("month", (F.col("_rev") / F.col("years_observed")).alias("mean_revenue"), "years_observed"))


def monthly_top(fact_orders: DataFrame, k: int = 5) -> DataFrame:
    """K2: the k months with the highest revenue (a top-k report)."""
    return monthly_series(fact_orders).orderBy(F.col("revenue").desc(), F.col("order_month")).limit(k)


# ------------------------------------------------------------------ categories
def category_window(fact_items: DataFrame, start=WINDOW[0], end=WINDOW[1]) -> DataFrame:
    """Per category inside the window: orders, GMV, freight, review, late rate."""
    return (fact_items.filter(commercial() & in_window(start=start, end=end))
            .groupBy("category")
            .agg(F.countDistinct("order_id").alias("orders"),
                 money_sum("price").alias("revenue"),
                 money_sum("freight_value").alias("freight_value"),
                 F.avg("review_score").alias("avg_review_score"),
                 F.avg(F.col("is_late").cast("int")).alias("late_rate")))


def category_window_top(fact_items: DataFrame, k: int = 10, **window) -> DataFrame:
    """Top-k categories by GMV in the window, with ticket, review, late rate."""
    c = category_window(fact_items, **window)
    return (c.select("category", "orders", "revenue", ratio("revenue", "orders").alias("avg_ticket"),
                     "avg_review_score", "late_rate")
            .orderBy(F.col("revenue").desc(), F.col("category")).limit(k))


def category_profile(fact_items: DataFrame, **window) -> DataFrame:
    """Every category in the window with GMV share, ticket and freight/GMV ratio."""
    c = category_window(fact_items, **window)
    total = c.agg(money_sum("revenue").alias("t")).select("t").scalar()
    return c.select("category", "orders", "revenue", "freight_value", "avg_review_score", "late_rate",
                    (F.col("revenue") / total).alias("revenue_share"),
                    ratio("revenue", "orders").alias("avg_ticket"),
                    ratio("freight_value", "revenue").alias("freight_over_revenue"))


def category_quadrants(fact_items: DataFrame, min_orders: int = 30, **window) -> DataFrame:
    """Focus categories (>= min_orders) against the focus medians of late rate and review."""
    focus = category_window(fact_items, **window).filter(F.col("orders") >= min_orders)
    med_late = quantiles(focus, "late_rate", [0.5], ["m"]).select("m").scalar()
    med_review = quantiles(focus, "avg_review_score", [0.5], ["m"]).select("m").scalar()
    late_side = F.when(F.col("late_rate") > F.col("median_late_rate"), "late_high").otherwise("late_low")
    review_side = F.when(F.col("avg_review_score") > F.col("median_review_score"), "review_high").otherwise("review_low")
    return (focus.select("category", "orders", "revenue", "late_rate", "avg_review_score",
                         med_late.alias("median_late_rate"), med_review.alias("median_review_score"))
            .withColumn("quadrant", F.concat_ws("/", late_side, review_side)))


def state_share_window(fact_items: DataFrame, **window) -> DataFrame:
    """GMV per customer state inside the window and its share of the window GMV."""
    start, end = window.get("start", WINDOW[0]), window.get("end", WINDOW[1])
    s = (fact_items.filter(commercial() & in_window(start=start, end=end))
         .groupBy("customer_state").agg(money_sum("price").alias("revenue")))
    total = s.agg(money_sum("revenue").alias("t")).select("t").scalar()
    return s.withColumn("revenue_share", F.col("revenue") / total)


def scenario_levers(fact_items: DataFrame, top_categories: int = 5, top_states: int = 3,
                    category_uplift: float = 0.03, state_uplift: float = 0.01,
                    late_reduction: float = 0.25, **window) -> DataFrame:
    """Opportunity sizing on the window: top-category cross-sell, top-state growth,
    late-delivery reduction (GMV exposed to late delivery times the reduction)."""
    start, end = window.get("start", WINDOW[0]), window.get("end", WINDOW[1])
    w = fact_items.filter(commercial() & in_window(start=start, end=end))
    gmv = w.agg(money_sum("price").alias("t")).select("t").scalar()
    cats = (w.groupBy("category").agg(money_sum("price").alias("r"))
            .orderBy(F.col("r").desc(), F.col("category")).limit(top_categories)
            .agg(money_sum("r").alias("b")).withColumn("lever", F.lit("top_category_cross_sell"))
            .withColumn("rate", F.lit(category_uplift)))
    states = (w.groupBy("customer_state").agg(money_sum("price").alias("r"))
              .orderBy(F.col("r").desc(), F.col("customer_state").asc_nulls_last()).limit(top_states)
              .agg(money_sum("r").alias("b")).withColumn("lever", F.lit("top_state_growth"))
              .withColumn("rate", F.lit(state_uplift)))
    late = (w.filter(F.col("is_late")).agg(money_sum("price").alias("b"))
            .withColumn("lever", F.lit("late_delivery_reduction")).withColumn("rate", F.lit(late_reduction)))
    levers = cats.unionByName(states).unionByName(late)
    return levers.select(
        "lever", gmv.alias("window_gmv"), F.coalesce("b", F.lit(0.0)).alias("base_gmv"),
        (F.coalesce("b", F.lit(0.0)) / gmv).alias("base_share"), "rate",
        (F.coalesce("b", F.lit(0.0)) * F.col("rate")).alias("impact"),
        (F.coalesce("b", F.lit(0.0)) * F.col("rate") / gmv).alias("impact_share"))


# ------------------------------------------------------------------ delivery vs repurchase
def delivered_sequence(fact_orders: DataFrame, bucket: str = "month") -> DataFrame:
    """Delivered orders with the person's next delivered order (ts, order_id tie-break)."""
    d = fact_orders.filter(F.col("order_status") == "delivered").select(
        "order_id", "customer_unique_id", "order_purchase_timestamp", "is_late", "review_score", "delivery_days")
    s = next_in_sequence(d, "customer_unique_id", "order_purchase_timestamp", "order_id", bucket,
                         next_ts="next_purchase_at", next_id="next_order_id")
    return s.withColumn("has_next_order", F.col("next_order_id").isNotNull())


def late_vs_ontime(fact_orders: DataFrame) -> DataFrame:
    """Delivered orders by lateness: orders, repeat rate, review, delivery days."""
    s = delivered_sequence(fact_orders).filter(F.col("is_late").isNotNull())
    return s.groupBy("is_late").agg(F.count(F.lit(1)).alias("orders"),
                                    F.avg(F.col("has_next_order").cast("int")).alias("repeat_rate"),
                                    F.avg("review_score").alias("review"),
                                    F.avg("delivery_days").alias("delivery_days"))


def repurchase_frame(fact_orders: DataFrame, days: int = REPURCHASE_DAYS) -> DataFrame:
    """A30 input: delivered orders with a uniform ``days`` opportunity window.

    repurchase = whole days to the next purchase in [0, days]; the cohort keeps
    purchases at or before max(purchase) - days with a known lateness.
    """
    s = delivered_sequence(fact_orders)
    gap = day_floor("order_purchase_timestamp", "next_purchase_at")
    s = s.withColumn("repurchase_90d", F.coalesce(gap.between(0, days), F.lit(False)))
    last = (fact_orders.filter(F.col("order_status") == "delivered")
            .agg(F.max("order_purchase_timestamp").alias("m")).select("m").scalar())
    cutoff = last - F.make_dt_interval(F.lit(days))
    return s.filter((F.col("order_purchase_timestamp") <= cutoff) & F.col("is_late").isNotNull())


def repurchase_90d(fact_orders: DataFrame, days: int = REPURCHASE_DAYS) -> DataFrame:
    """Repurchase within the window by lateness, on the censored cohort."""
    e = repurchase_frame(fact_orders, days)
    return e.groupBy("is_late").agg(F.count(F.lit(1)).alias("orders"),
                                    F.avg(F.col("repurchase_90d").cast("int")).alias("repurchase_90d"),
                                    F.avg("review_score").alias("review"))


# ------------------------------------------------------------------ regional value
def region_stats(customer_value: DataFrame) -> DataFrame:
    """Per state customers, revenue, mean CLV and repeat rate (null state dropped)."""
    return (customer_value.filter(F.col("customer_state").isNotNull())
            .groupBy("customer_state")
            .agg(F.countDistinct("customer_unique_id").alias("customers"),
                 money_sum("observed_clv").alias("revenue"),
                 (money_sum("observed_clv") / F.count("observed_clv")).alias("avg_clv"),
                 F.avg(F.col("is_repeat_customer").cast("int")).alias("repeat_rate")))


def region_clv(customer_value: DataFrame, k: int = 10) -> DataFrame:
    """The k states with the most revenue."""
    return region_stats(customer_value).orderBy(F.col("revenue").desc(), F.col("customer_state")).limit(k)


def region_clv_index(customer_value: DataFrame, min_customers: int = 20) -> DataFrame:
    """CLV index against the national mean and revenue share, for states with enough customers."""
    national = customer_value.agg((money_sum("observed_clv") / F.count("observed_clv")).alias("m")).select("m").scalar()
    r = region_stats(customer_value)
    total = r.agg(money_sum("revenue").alias("t")).select("t").scalar()
    return (r.withColumn("clv_index", F.col("avg_clv") / national)
             .withColumn("revenue_share", F.col("revenue") / total)
             .filter(F.col("customers") >= min_customers))
