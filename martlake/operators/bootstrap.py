"""Cluster bootstrap of a difference of means (B1), naive row bootstrap (B2).

Resampling whole clusters with replacement is approximated by the Poisson
bootstrap (each cluster gets an independent Poisson(1) weight per iteration;
see the public literature on the Poisson/"online" bootstrap).  It needs no
shuffle of the rows and no random-number state:

* rows are reduced to per-cluster totals first (sum and count per group);
* every cluster is drawn in every iteration.  Its weight comes from a 32-bit integer
  mix of ``md5(cluster:seed)`` and the iteration, through the inverse of the Poisson
  distribution function (a table up to 2^-32, the uniforms' step) -- deterministic, so a
  recomputed task after an executor loss draws the same weights;
* a task adds up its clusters' weighted totals by iteration, batch by batch in numpy, and
  hands on ``iterations`` rows, which a grouped aggregate by iteration sums.

``poisson`` draws for a number ``m`` of clusters at once (the sum of ``m`` Poisson(1) weights is
one Poisson(m) weight): below ``SMALL`` by the distribution function, from there on by a transformed
rejection (Hoermann's PTRS, published 1993), with ``TRIES`` pairs of uniforms, of which all
fail once in 10^15 draws at most.  ``bootstrap_diff`` uses it only if asked to
(``equal_together``): clusters of equal totals are then one row with one draw an iteration.

Interval = exact 2.5 / 97.5 percentiles over the valid iterations.
"""

from __future__ import annotations

import math
import warnings
from collections.abc import Iterator, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martlake.operators.quantiles import quantiles
from martlake.session import materialize, ship

MASK32 = 0xFFFFFFFF
GOLDEN = 0x9E3779B1
MIX = 0x45D9F3B
SMALL = 10               # means below this are drawn by inversion
TRIES = 24
HALF_STEP = 0.5 / 4294967296.0
COUNTERS = 64            # counters of one iteration: two a try
CHUNK = 50               # iterations that one task draws in a row for a distinct total
BLOCK = 1 << 18          # draws held in memory at a time


def _cdf(mean: int) -> list[float]:
    """Poisson distribution function P(X <= k), k = 0, 1, ... until what is left is below 2^-33."""
    out, term, k = [], math.exp(-mean), 0
    total = term
    while 1.0 - total > 2.0 ** -33 or k < mean:
        out.append(total)
        k += 1
        term *= mean / k
        total += term
    return [*out, total]


POISSON_CDF = [_cdf(m) for m in range(1, SMALL)]
LN_FACTORIAL = [math.log(math.factorial(k)) for k in range(10)]   # Stirling's series serves from 10 on


def cluster_seed(cluster: Column, seed: int) -> Column:
    """32-bit seed of a cluster: first 8 hex digits of md5('<cluster>:<seed>')."""
    text = F.concat(cluster.cast("string"), F.lit(f":{seed}"))
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint")


def uniform(h: Column, it: Column) -> Column:
    """Uniform [0, 1) from a cluster seed and an iteration (integer mixing, 32-bit)."""
    x = h.bitwiseXOR((it.cast("bigint") * F.lit(GOLDEN)).bitwiseAND(F.lit(MASK32)))
    x = (F.shiftright(x, 16).bitwiseXOR(x) * F.lit(MIX)).bitwiseAND(F.lit(MASK32))
    x = (F.shiftright(x, 16).bitwiseXOR(x) * F.lit(MIX)).bitwiseAND(F.lit(MASK32))
    x = F.shiftright(x, 16).bitwiseXOR(x)
    return x / F.lit(4294967296.0)


def _inside(h: Column, counter: Column) -> Column:
    """Uniform in the open interval (0, 1)."""
    return uniform(h, counter) + F.lit(HALF_STEP)


def _inverted(m: Column, u: Column) -> Column:
    """Poisson(m) of a uniform by its distribution function, m below ``SMALL``; written out, so that
    it stays in generated code."""
    drawn = [sum((u >= F.lit(c)).cast("int") for c in row) for row in POISSON_CDF]
    out = F.when(m == 1, drawn[0])
    for i, w in enumerate(drawn[1:], start=2):
        out = out.when(m == i, w)
    return out


def _hat(mu: Column) -> Column:
    return F.lit(0.931) + F.lit(2.53) * F.sqrt(mu)


def _slope(b: Column) -> Column:
    return F.lit(-0.059) + F.lit(0.02483) * b


def _inner(u: Column) -> Column:
    return F.lit(0.5) - F.abs(u - F.lit(0.5))


def _candidate(mu: Column, b: Column, us: Column, u: Column) -> Column:
    return F.floor((F.lit(2.0) * _slope(b) / us + b) * (u - F.lit(0.5)) + mu + F.lit(0.43)).cast("double")


def _taken(mu: Column, b: Column, us: Column, v: Column, k: Column) -> Column:
    """Is the candidate k of a try of transformed rejection taken?  The logarithm of its probability is
    exact to 10^-11."""
    n = F.greatest(k, F.lit(10.0))
    series = (F.lit(1 / 12) - (F.lit(1 / 360) - F.lit(1 / 1260) / (n * n)) / (n * n)) / n
    table = F.element_at(F.array(*map(F.lit, LN_FACTORIAL)), F.greatest(k, F.lit(0.0)).cast("int") + 1)
    density = (F.when(k < len(LN_FACTORIAL), k * F.ln(mu) - mu - table)
               .otherwise(k * F.ln(mu / n) + (k - mu) - F.lit(0.5) * F.ln(F.lit(2 * math.pi) * n) - series))
    inside = (us >= 0.07) & (v <= F.lit(0.9277) - F.lit(3.6224) / (b - F.lit(2.0)))
    outside = (k < 0) | ((us < 0.013) & (v > us))
    hat = F.ln(v) + F.ln(F.lit(1.1239) + F.lit(1.1328) / (b - F.lit(3.4))) - F.ln(_slope(b) / (us * us) + b)
    return inside | (~outside & (hat <= density))


def poisson(df: DataFrame, m: str, h: str, it: str, out: str = "w") -> DataFrame:
    """Add ``out``: a Poisson(m) draw (m = 1, 2, ...) for a 32-bit seed ``h`` and an iteration ``it``.

    The first try's parts are columns of their own, so each is computed once and in generated
    code; the few rows that it rejects go through the other tries.
    """
    first = F.col(it).cast("bigint") * F.lit(COUNTERS)
    mu = F.col(m).cast("double")
    d = df.withColumns({"__u": uniform(F.col(h), first), "__v": _inside(F.col(h), first + 1), "__mu": mu, "__b": _hat(mu)})
    d = d.withColumn("__x", F.col("__u") + F.lit(HALF_STEP)).withColumn("__us", _inner(F.col("__x")))
    mu, b, us = F.col("__mu"), F.col("__b"), F.col("__us")
    d = d.withColumn("__k", _candidate(mu, b, us, F.col("__x")))
    d = d.withColumn("__ok", _taken(mu, b, us, F.col("__v"), F.col("__k")))

    def again(acc: Column, t: Column) -> Column:
        u, v = _inside(F.col(h), first + t * 2), _inside(F.col(h), first + t * 2 + 1)
        k = _candidate(mu, b, _inner(u), u)
        return F.when(acc["ok"], acc).otherwise(F.struct(k.alias("k"), _taken(mu, b, _inner(u), v, k).alias("ok")))

    rest = F.aggregate(F.sequence(F.lit(1), F.lit(TRIES - 1)), F.struct(F.lit(0.0).alias("k"), F.lit(False).alias("ok")), again, lambda x: x["k"])
    large = F.when(F.col("__ok"), F.col("__k")).otherwise(F.greatest(rest, F.lit(0.0))).cast("bigint")
    w = F.when(F.col(m) < SMALL, _inverted(F.col(m), F.col("__u")).cast("bigint")).otherwise(large)
    return d.withColumn(out, w).drop("__u", "__v", "__x", "__mu", "__b", "__us", "__k", "__ok")


def cluster_totals(df: DataFrame, cluster: str, group: str, value: str, group_a, group_b) -> DataFrame:
    """Per cluster: sum and count of ``value`` in group A and in group B (eligible rows only)."""
    missing = {cluster, group, value} - set(df.columns)
    if missing:
        raise KeyError(f"bootstrap input lacks {sorted(missing)}")
    s = (df.select(F.col(cluster).alias("c"), F.col(group).alias("g"), F.col(value).alias("v"))
         .dropna().filter(F.col("g").isin(group_a, group_b))
         .withColumn("v", F.col("v").try_cast("double")).dropna(subset=["v"]))
    in_a, in_b = F.col("g") == F.lit(group_a), F.col("g") == F.lit(group_b)
    return s.groupBy("c").agg(
        F.coalesce(F.sum(F.when(in_a, F.col("v"))), F.lit(0.0)).alias("sa"), F.count_if(in_a).alias("ca"),
        F.coalesce(F.sum(F.when(in_b, F.col("v"))), F.lit(0.0)).alias("sb"), F.count_if(in_b).alias("cb"))


def _each(totals: DataFrame, iterations: int) -> DataFrame:
    """Weighted sums of every iteration, each cluster drawn on its own."""
    spark = totals.sparkSession
    ship(spark)
    rules = [math.ceil(c * 4294967296.0) for c in POISSON_CDF[0]]

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        steps = [np.uint32(c) for c in rules if c <= MASK32]
        turns = np.arange(iterations, dtype=np.uint32) * np.uint32(GOLDEN)
        sums, seen = np.zeros((iterations, 4)), False
        for batch in batches:
            h = batch.column("h").to_numpy().astype(np.uint32)
            parts = np.stack([batch.column(c).to_numpy(zero_copy_only=False).astype(float) for c in ("sa", "ca", "sb", "cb")], axis=1)
            many = max(1, BLOCK // max(1, len(h)))
            for at in range(0, iterations if len(h) else 0, many):
                x = turns[at:at + many, None] ^ h[None, :]
                for _ in range(2):
                    x ^= x >> 16
                    x *= np.uint32(MIX)
                x ^= x >> 16
                w = np.zeros(x.shape, np.uint8)
                for c in steps:
                    w += x >= c
                sums[at:at + many] += w.astype(float) @ parts
                seen = True
        if seen:
            yield pa.RecordBatch.from_pydict({"it": np.arange(iterations)} | dict(zip(("wsa", "wca", "wsb", "wcb"), sums.T.copy(), strict=True)))

    # the totals of a small table may be one partition
    dealt = totals.select("h", "sa", "ca", "sb", "cb").repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "h")
    return (dealt.mapInArrow(run, "it long, wsa double, wca double, wsb double, wcb double")
            .groupBy("it").agg(*[F.sum(c).alias(c) for c in ("wsa", "wca", "wsb", "wcb")]))


def _together(totals: DataFrame, iterations: int) -> DataFrame:
    """The same with one draw for clusters of equal totals."""
    equal = totals.groupBy("sa", "ca", "sb", "cb").agg(F.count(F.lit(1)).alias("m"), F.min("h").alias("h"))
    # the distinct totals may be few: their iterations are dealt out in chunks
    chunks = equal.select("*", F.explode(F.sequence(F.lit(0), F.lit(iterations - 1), F.lit(CHUNK))).alias("from"))
    chunks = chunks.repartition(int(totals.sparkSession.conf.get("spark.sql.shuffle.partitions")), "h", "from")
    reps = chunks.select("*", F.explode(F.sequence(F.col("from"), F.least(F.col("from") + CHUNK, F.lit(iterations)) - 1)).alias("it"))
    reps = poisson(reps, "m", "h", "it")
    w = F.col("w")
    return reps.groupBy("it").agg(F.sum(w * F.col("sa")).alias("wsa"), F.sum(w * F.col("ca")).alias("wca"),
                                  F.sum(w * F.col("sb")).alias("wsb"), F.sum(w * F.col("cb")).alias("wcb"))


def bootstrap_diff(df: DataFrame, *, cluster: str, group: str, value: str, group_a=True, group_b=False,
                   iterations: int = 2000, seed: int = 42, probs: Sequence[float] = (0.025, 0.975),
                   validate: bool = True, equal_together: bool = False) -> DataFrame:
    """One row: observed A - B difference of means, interval, iteration and cluster counts.

    Every cluster is drawn in every iteration; with ``equal_together`` clusters of equal totals are
    drawn at once, which gives an interval of the same distribution."""
    if iterations <= 0:
        raise ValueError(f"{iterations} iterations asked for, at least one is needed")
    # Per-cluster totals are read by the validation, the observed difference and
    # the resampling: written once to the checkpoint folder.
    totals = materialize(cluster_totals(df, cluster, group, value, group_a, group_b))
    stats = totals.agg(F.count(F.lit(1)).alias("clusters"), F.sum("sa").alias("sa"), F.sum("ca").alias("ca"),
                       F.sum("sb").alias("sb"), F.sum("cb").alias("cb"))
    if validate:
        row = stats.first()  # one aggregate row
        if not row or not row["clusters"]:
            raise ValueError("nothing to resample: every row has a null or another group")
        if not row["ca"] or not row["cb"]:
            raise ValueError("one of the two groups has no row")

    totals = totals.withColumn("h", cluster_seed(F.col("c"), seed))
    per_it = _together(totals, iterations) if equal_together else _each(totals, iterations)
    per_it = materialize(per_it)  # `iterations` rows
    valid = per_it.filter((F.col("wca") > 0) & (F.col("wcb") > 0)).select(
        (F.col("wsa") / F.col("wca") - F.col("wsb") / F.col("wcb")).alias("diff"))
    ci = quantiles(valid, "diff", probs, ["ci_low", "ci_high"])
    if validate:
        _check_resamples(valid.count(), iterations)
    n_valid = valid.agg(F.count(F.lit(1)).alias("n")).select("n").scalar()
    out = stats.select(
        (F.col("sa") / F.col("ca") - F.col("sb") / F.col("cb")).alias("difference"),
        ci.select("ci_low").scalar().alias("ci_low"), ci.select("ci_high").scalar().alias("ci_high"),
        F.lit(iterations).cast("bigint").alias("iterations"), n_valid.alias("valid_iterations"),
        F.col("clusters"))
    return out


def _check_resamples(valid: int, iterations: int, limit: float = 0.05) -> None:
    """Error if no resample held both groups, warning if more than ``limit`` of them lacked one."""
    if not valid:
        raise ValueError(f"none of {iterations} resamples holds both groups")
    lost = iterations - valid
    if lost > limit * iterations:
        warnings.warn(f"{lost} of {iterations} resamples lack one group and are left out", stacklevel=3)
