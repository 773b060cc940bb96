"""Tukey extreme fences, their value share, and the winsorised histogram."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martlake.functions import money_sum
from martlake.operators.quantiles import grouped_quantiles, quantiles


def upper_fences(df: DataFrame, cols: Sequence[str], factor: float = 3.0) -> dict[str, Column]:
    """Per column a scalar subquery: Q3 + factor * (Q3 - Q1), exact quartiles with interpolation.

    One quantile pass over the unpivoted columns serves them all.
    """
    long = df.select(F.explode(F.array(*[
        F.struct(F.lit(i).alias("which"), F.col(c).cast("double").alias("at")) for i, c in enumerate(cols)])).alias("x"))
    q = grouped_quantiles(long.select("x.*"), ["which"], "at", [0.25, 0.75], ["q1", "q3"], max_groups=len(cols))
    row = q.agg(*[F.max(F.when(F.col("which") == i, F.col("q3") + F.lit(factor) * (F.col("q3") - F.col("q1")))).alias(f"u{i}")
                  for i in range(len(cols))])
    return {c: row.select(f"u{i}").scalar() for i, c in enumerate(cols)}


def extreme_flags(df: DataFrame, cols: Sequence[str], factor: float = 3.0) -> tuple[dict, dict, Column]:
    """Per column fence (scalar subquery) and flag; plus the union flag.

    A null value is never extreme.  The fences are one-row subqueries, so the
    detail rows are never joined or shuffled to apply them.
    """
    fences = upper_fences(df, cols, factor)
    flags = {c: F.coalesce(F.col(c) > fences[c], F.lit(False)) for c in cols}
    any_flag = reduce(lambda a, b: a | b, flags.values())
    return fences, flags, any_flag


def tukey_outliers(df: DataFrame, cols: Sequence[str] = ("price", "freight_value"),
                   factor: float = 3.0) -> DataFrame:
    """One row with each fence, the per-column extreme counts and the row rate."""
    fences, flags, any_flag = extreme_flags(df, cols, factor)
    counts = df.agg(F.count(F.lit(1)).alias("rows"),
                    *[F.count_if(flags[c]).alias(f"{c}_extreme") for c in cols],
                    F.count_if(any_flag).alias("extreme_rows"))
    return counts.select(
        *[fences[c].alias(f"{c}_upper") for c in cols],
        *[f"{c}_extreme" for c in cols],
        "extreme_rows", "rows",
        (F.col("extreme_rows") / F.col("rows")).alias("row_rate"))


def outlier_value_share(df: DataFrame, price: str = "price", freight: str = "freight_value",
                        factor: float = 3.0) -> DataFrame:
    """Row rate of extreme rows and the revenue / freight share they carry."""
    fences, _, any_flag = extreme_flags(df, [price, freight], factor)
    agg = df.agg(
        F.avg(any_flag.cast("int")).alias("extreme_row_rate"),
        money_sum(F.when(any_flag, F.col(price))).alias("_xp"),
        money_sum(price).alias("_p"),
        money_sum(F.when(any_flag, F.col(freight))).alias("_xf"),
        money_sum(freight).alias("_f"))
    return agg.select(
        "extreme_row_rate",
        (F.coalesce("_xp", F.lit(0.0)) / F.col("_p")).alias("extreme_price_revenue_share"),
        (F.coalesce("_xf", F.lit(0.0)) / F.col("_f")).alias("extreme_freight_share"),
        fences[price].alias(f"{price}_threshold"),
        fences[freight].alias(f"{freight}_threshold"))


def winsor_histogram(df: DataFrame, col: str, bins: int = 40, clip_p: float = 0.99) -> DataFrame:
    """Clip at the exact P99, then equal-width histogram counts over [min, clipped max].

    Bin edges follow the usual histogram rule: ``bins`` equal bins between the
    smallest value and the clip value, the last bin closed on the right.
    """
    cap = quantiles(df, col, [clip_p], ["cap"]).select("cap").scalar()
    v = df.select(F.least(F.col(col), cap).alias("v")).filter(F.col("v").isNotNull())
    lo = df.agg(F.min(col).alias("m")).select("m").scalar()
    width = (cap - lo) / F.lit(float(bins))
    raw = F.floor((F.col("v") - lo) / width)
    b = F.when(width == 0, F.lit(0)).otherwise(F.least(raw, F.lit(bins - 1))).cast("int")
    return (v.groupBy(b.alias("bin")).agg(F.count(F.lit(1)).alias("count"))
            .select("bin", (lo + F.col("bin") * width).alias("bin_start"), "count"))
