"""Driver keys for the cluster / naive bootstrap of late-vs-on-time repurchase."""

from __future__ import annotations

from pyspark.sql import functions as F

from martlake.operators import bootstrap as B
from martlake.plans import analysis as A
from martlake.plans import facts
from martlake.plans.catalog import query, silver
from martlake.plans.oracle import with_ctes

ITERATIONS = 2000
SEED = 42


def _e(x: float) -> str:
    """A literal that every dialect reads as a double."""
    return f"{x:.17e}"


def _between(values: str, p: float) -> str:
    """Linear interpolation lo + (hi - lo) * fraction, written out: engines round their own form of it differently."""
    h = f"((COUNT(*) - 1) * {_e(p)})"
    lo, hi = (f"({values})[CAST({f}({h}) AS BIGINT) + 1]" for f in ("floor", "ceil"))
    return f"{lo} + ({hi} - {lo}) * ({h} - floor({h}))"


def _sql(src_cte: str, src_select: str, iterations=ITERATIONS, seed=SEED, method: str | None = None) -> str:
    weights = " + ".join(f"CASE WHEN u >= {_e(c)} THEN 1 ELSE 0 END" for c in B.POISSON_CDF[0])
    label = f"'{method}' AS method, " if method else ""
    return f"""
SELECT {label}(SELECT SUM(sa) / SUM(ca) - SUM(sb) / SUM(cb) FROM t) AS difference,
  {_between("list_sort(list(diff))", 0.025)} AS ci_low, {_between("list_sort(list(diff))", 0.975)} AS ci_high,
  CAST({iterations} AS BIGINT) AS iterations, COUNT(*) AS valid_iterations, (SELECT COUNT(*) FROM t) AS clusters
FROM (
  SELECT it, SUM(w * sa) / SUM(w * ca) - SUM(w * sb) / SUM(w * cb) AS diff
  FROM (SELECT it, sa, ca, sb, cb, {weights} AS w
        FROM (SELECT *, xor(x2 >> 16, x2) / {_e(4294967296.0)} AS u
              FROM (SELECT *, (xor(x1 >> 16, x1) * {B.MIX}) & {B.MASK32} AS x2
                    FROM (SELECT *, (xor(x0 >> 16, x0) * {B.MIX}) & {B.MASK32} AS x1
                          FROM (SELECT t.*, r.it, xor(h, (r.it * {B.GOLDEN}) & {B.MASK32}) AS x0
                                FROM (SELECT *, ('0x' || substr(md5(CAST(c AS VARCHAR) || ':{seed}'), 1, 8))::BIGINT AS h FROM t) t,
                                     range(0, {iterations}) r(it))))))
  GROUP BY it HAVING SUM(w * ca) > 0 AND SUM(w * cb) > 0)"""


def _totals_cte(src: str, cluster: str, value: str) -> str:
    return f"""t AS (
  SELECT c, COALESCE(SUM(v) FILTER (WHERE g = true), 0.0) AS sa, COUNT(*) FILTER (WHERE g = true) AS ca,
         COALESCE(SUM(v) FILTER (WHERE g = false), 0.0) AS sb, COUNT(*) FILTER (WHERE g = false) AS cb
  FROM (SELECT {cluster} AS c, is_late AS g, TRY_CAST({value} AS DOUBLE) AS v FROM {src}
        WHERE {cluster} IS NOT NULL AND is_late IS NOT NULL AND {value} IS NOT NULL AND is_late IN (true, false))
  WHERE v IS NOT NULL GROUP BY c)"""


def _boot_sql(src: str, deps, cluster: str, value: str, method=None) -> str:
    body = f"WITH {_totals_cte(src, cluster, value)}\n{_sql(src, '', method=method)}"
    return with_ctes(deps, body)


def _eligible(spark, sf_dir):
    s = A.delivered_sequence(facts.fact_orders(silver(spark, sf_dir))).filter(F.col("is_late").isNotNull())
    return s.withColumn("has_next", F.col("has_next_order").cast("double"))


_NEXT = "(SELECT *, CAST(next_order_id IS NOT NULL AS DOUBLE) AS has_next FROM deliv_seq WHERE is_late IS NOT NULL)"


@query("bootstrap_cluster_diff", _boot_sql(_NEXT, ["deliv_seq"], "customer_unique_id", "has_next"))
def q_bootstrap_cluster_diff(spark, sf_dir):
    """B1: late minus on-time repeat rate, cluster (person) Poisson bootstrap interval."""
    return B.bootstrap_diff(_eligible(spark, sf_dir), cluster="customer_unique_id", group="is_late",
                            value="has_next", iterations=ITERATIONS, seed=SEED)


@query("bootstrap_naive_diff", _boot_sql(_NEXT, ["deliv_seq"], "order_id", "has_next"))
def q_bootstrap_naive_diff(spark, sf_dir):
    """B2: the same difference with every order its own cluster (naive row bootstrap)."""
    return B.bootstrap_diff(_eligible(spark, sf_dir), cluster="order_id", group="is_late",
                            value="has_next", iterations=ITERATIONS, seed=SEED)


_R90 = "(SELECT *, CAST(repurchase_90d AS DOUBLE) AS r90 FROM repurchase_frame)"


@query("bootstrap_90d_diff", _boot_sql(_R90, ["repurchase_frame"], "customer_unique_id", "r90"))
def q_bootstrap_90d_diff(spark, sf_dir):
    """B1 on the censored 90-day cohort."""
    e = A.repurchase_frame(facts.fact_orders(silver(spark, sf_dir))).withColumn(
        "r90", F.col("repurchase_90d").cast("double"))
    return B.bootstrap_diff(e, cluster="customer_unique_id", group="is_late", value="r90",
                            iterations=ITERATIONS, seed=SEED)


def _comparison_sql():
    a = _sql(_NEXT, "", method="cluster by customer_unique_id")
    b = _sql(_NEXT, "", method="naive by order")
    body = (f"WITH {_totals_cte(_NEXT, 'customer_unique_id', 'has_next')}\n{a}")
    body2 = (f"WITH {_totals_cte(_NEXT, 'order_id', 'has_next')}\n{b}")
    return with_ctes(["deliv_seq"], f"SELECT * FROM ({body}) UNION ALL SELECT * FROM ({body2})")


@query("bootstrap_comparison", _comparison_sql())
def q_bootstrap_comparison(spark, sf_dir):
    """Cluster vs naive interval side by side."""
    e = _eligible(spark, sf_dir)
    a = B.bootstrap_diff(e, cluster="customer_unique_id", group="is_late", value="has_next",
                         iterations=ITERATIONS, seed=SEED)
    b = B.bootstrap_diff(e, cluster="order_id", group="is_late", value="has_next",
                         iterations=ITERATIONS, seed=SEED, validate=False)
    return (a.select(F.lit("cluster by customer_unique_id").alias("method"), "*")
            .unionByName(b.select(F.lit("naive by order").alias("method"), "*")))
