"""Exact quantiles (linear interpolation) by radix selection.

``percentile`` keeps every distinct value of a group in one aggregation buffer, and sorting or
collapsing distinct values shuffles about as many rows as there are.  Here only counts of bins
move, however many rows there are:

1. values are counted in bins of a monotone function of the value: steps of 1/22 in its
   logarithm, signed, about 64,000 bins for all doubles.  Counts are combined on the map side;
   the bins that hold the wanted ranks (two a probability) are found by a running sum;
2. the rows inside those bins are counted in ``BINS`` equal steps between the bin's smallest and
   largest value, which narrows each to a relative width below 10^-6;
3. the distinct values left there are counted, and the running sum names the values at the ranks.

Each pass reads the narrow (group, value) projection again and meets the bins of the pass before: one row a bin,
``2 * len(probs)`` a group at most, broadcast where the number of groups has a bound; otherwise Spark's
size check decides, and a hot group of a shuffled join is split by adaptive execution.  Every pass's result feeds only the next, so the
plan is linear and lazy.  The functions that pick bins are monotone in floating point too, so
ties share a bin and the result is exact; it matches pandas ``quantile`` / SQL ``quantile_cont``.

A NaN is no value, like a null.  Infinities have bins of their own.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BINS = 65_536
BROADCAST_ROWS = 1_000_000   # about 100 bytes each
_STEPS = 22.0         # bins for a factor e
_SHIFT = 746.0        # above -ln of the smallest double


def _log_bin(v: Column) -> Column:
    """Bin of a value; monotone, and infinities lie beyond every finite value."""
    size = F.least(F.ln(F.abs(v)), F.lit(800.0)) + F.lit(_SHIFT)
    return F.when(v == 0, F.lit(0)).otherwise(F.floor(F.signum(v) * size * F.lit(_STEPS)).cast("int"))


def _even_bin(v: Column, lo: Column, hi: Column) -> Column:
    """Bin among ``BINS`` equal steps of [lo, hi]; a single value is one bin."""
    return F.when(lo == hi, F.lit(0)).otherwise(F.floor((v - lo) / (hi - lo) * F.lit(BINS - 1.0)).cast("int"))


def _placed(counted: DataFrame, within: list[str], order: str) -> DataFrame:
    """Ranks (first, next) that each counted row covers inside its window."""
    before = Window.partitionBy(*within).orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return counted.withColumn("__end", F.sum("__c").over(before)).withColumn("__begin", F.col("__end") - F.col("__c"))


def _held(wanted: Column) -> Column:
    """The wanted (id, rank) inside a counted row, ranks counted from its beginning."""
    own = F.filter(wanted, lambda w: (w["rank"] >= F.col("__begin")) & (w["rank"] < F.col("__end")))
    return F.transform(own, lambda w: F.struct(w["id"].alias("id"), (w["rank"] - F.col("__begin")).alias("rank")))


def grouped_quantiles(df: DataFrame, group_cols: Sequence[str], value_col: str,
                      probs: Sequence[float], names: Sequence[str] | str | None = None,
                      max_groups: int | None = None) -> DataFrame:
    """One row per group with at least one value; one column per prob.

    ``group_cols`` may be empty for a single global row.  Rows with a null group are left out.
    ``max_groups`` is a bound of the number of groups that the caller vouches for; where it keeps
    the wanted bins to ``BROADCAST_ROWS`` rows they are broadcast and no row is shuffled.
    """
    if isinstance(names, str):
        names = [names]
    names = list(names) if names else [f"q{int(round(p * 1000)):03d}" for p in probs]
    groups = [f"__g{i}" for i in range(max(1, len(group_cols)))]
    own = [F.col(c).alias(g) for c, g in zip(group_cols, groups)] or [F.lit(0).alias(groups[0])]
    v = df.select(*own, F.col(value_col).cast("double").alias("__v"))
    v = v.filter(F.col("__v").isNotNull() & ~F.isnan("__v") & F.expr(" and ".join(f"{g} is not null" for g in groups)))
    x, lo, hi = F.col("__v"), F.col("__lo"), F.col("__hi")
    bins = 2 * len(probs) * (max_groups or 0 if group_cols else 1)
    small = F.broadcast if 0 < bins <= BROADCAST_ROWS else lambda d: d

    counts = [F.count(F.lit(1)).alias("__c"), F.min("__v").alias("__lo"), F.max("__v").alias("__hi")]
    first = _placed(v.groupBy(*groups, _log_bin(x).alias("__bin")).agg(*counts), groups, "__bin")
    first = first.withColumn("__n", F.sum("__c").over(Window.partitionBy(*groups)))
    ranks = []
    for i, p in enumerate(probs):
        h = (F.col("__n") - 1) * F.lit(float(p))
        ranks += [F.struct(F.lit(2 * i).alias("id"), F.floor(h).cast("bigint").alias("rank")),
                  F.struct(F.lit(2 * i + 1).alias("id"), F.ceil(h).cast("bigint").alias("rank"))]
    state = first.withColumn("__wanted", _held(F.array(*ranks))).filter(F.size("__wanted") > 0).select(*groups, "__n", "__wanted", "__lo", "__hi")

    interval = [*groups, "__n", "__wanted", "__lo", "__hi"]
    inside = v.join(small(state), groups).filter((x >= lo) & (x <= hi))
    second = inside.groupBy(*interval, _even_bin(x, lo, hi).alias("__bin")).agg(
        F.count(F.lit(1)).alias("__c"), F.min("__v").alias("__lo2"), F.max("__v").alias("__hi2"))
    state = (_placed(second, [*groups, "__lo"], "__bin").withColumn("__wanted", _held(F.col("__wanted"))).filter(F.size("__wanted") > 0)
             .select(*groups, "__n", "__wanted", F.col("__lo2").alias("__lo"), F.col("__hi2").alias("__hi")))

    inside = v.join(small(state), groups).filter((x >= lo) & (x <= hi))
    last = _placed(inside.groupBy(*interval, "__v").agg(F.count(F.lit(1)).alias("__c")), [*groups, "__lo"], "__v")
    at = last.select(*groups, "__n", "__v", F.explode(_held(F.col("__wanted"))).alias("__at"))
    picked = at.groupBy(*groups, "__n").agg(*[F.max(F.when(F.col("__at.id") == i, F.col("__v"))).alias(f"__q{i}")
                                             for i in range(2 * len(probs))])
    out = []
    for i, (p, name) in enumerate(zip(probs, names)):
        h = (F.col("__n") - 1) * F.lit(float(p))
        frac, below, above = h - F.floor(h), F.col(f"__q{2 * i}"), F.col(f"__q{2 * i + 1}")
        out.append(F.when((frac == 0) | (below == above), below).otherwise(below + (above - below) * frac).alias(name))
    return picked.select(*[F.col(g).alias(c) for g, c in zip(groups, group_cols)], *out)


def quantiles(df: DataFrame, value_col: str, probs: Sequence[float], names: Sequence[str] | None = None) -> DataFrame:
    """Global exact quantiles as a one-row DataFrame (no row if there is no value)."""
    return grouped_quantiles(df, [], value_col, probs, names)
