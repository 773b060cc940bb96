"""Queries over small tables of the driver's schema, made here: repeated keys, rows without a partner."""

import datetime as dt
import hashlib

import numpy as np
import pytest


@pytest.fixture(scope="module")
def sf(spark, tmp_path_factory):
    """Order 1 to 60 in three lines at most; customer 4, part 3 and supplier 2 come twice, the latter from two nations."""
    at = str(tmp_path_factory.mktemp("tables"))
    day = dt.datetime(1997, 1, 1)
    orders = [(k, 1 + k % 9, "OPF"[k % 3], 10.0 * k, day + dt.timedelta(days=3 * k), f"{1 + k % 5}-X") for k in range(1, 61)]
    lines = [(k, n, 1 + (k + n) % 6, 1 + (k * n) % 4, 7.25 * n + k, float(n), "N", day + dt.timedelta(days=k))
             for k in range(2, 64) for n in range(1, 2 + k % 3)]
    rows = {
        "nation": ([(0, "AA"), (1, "BB")], "n_nationkey int, n_name string"),
        "customer": ([(k, k % 2, "SEG", 100.0 * k) for k in (1, 2, 3, 4, 4, 5, 6, 7)],
                     "c_custkey long, c_nationkey int, c_mktsegment string, c_acctbal double"),
        "supplier": ([(1, 0, "s1"), (2, 0, "s2"), (2, 1, "s2"), (3, 1, "s3")], "s_suppkey long, s_nationkey int, s_name string"),
        "part": ([(k, f"Brand#{5 + k % 3}") for k in (1, 2, 3, 3, 4, 5)], "p_partkey long, p_brand string"),
        "orders": (orders, "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string"),
        "lineitem": (lines, "l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long, l_extendedprice double, l_quantity double, "
                            "l_returnflag string, l_shipdate timestamp_ntz")}
    for name, (r, schema) in rows.items():
        spark.createDataFrame(r, schema).write.parquet(f"{at}/{name}.parquet")
    return at


def test_schema_contracts_meet_both_failures(spark, sf):
    import __spark_entry__ as entry
    got = {r["table"]: (r["missing"], r["unexpected"], r["passed"], r["rows"]) for r in entry.queries()["schema_contracts"](spark, sf).collect()}
    assert got.pop("sellers without seller_state") == (1, 0, False, 4)
    assert got.pop("customers with loyalty") == (0, 1, False, 8)
    assert got["sellers"] == (0, 0, True, 4) and len(got) == 9 and all(passed for _, _, passed, _ in got.values())


def _weights(cluster: str, iterations: int, seed: int = 42) -> list[int]:
    """Poisson(1) weights of one cluster, written out apart from the operator."""
    import math
    cdf = [math.exp(-1.0) * sum(1.0 / math.factorial(j) for j in range(k + 1)) for k in range(14)]
    h, out = int(hashlib.md5(f"{cluster}:{seed}".encode()).hexdigest()[:8], 16), []
    for it in range(iterations):
        x = h ^ (it * 0x9E3779B1 & 0xFFFFFFFF)
        for _ in range(2):
            x = (x >> 16 ^ x) * 0x45D9F3B & 0xFFFFFFFF
        u = (x >> 16 ^ x) / 2 ** 32
        out.append(sum(u >= c for c in cdf))
    return out


def test_bootstrap_draws_every_cluster_on_its_own(spark):
    """Clusters of equal totals have weights of their own in each iteration."""
    from martlake.operators.bootstrap import bootstrap_diff
    rows = [(f"c{i}", i % 2 == 0, float(i % 4 < 2)) for i in range(60)] + [(f"c{i}", i % 2 == 1, 2.5) for i in range(7)]
    got = bootstrap_diff(spark.createDataFrame(rows, "c string, g boolean, v double"), cluster="c", group="g", value="v", iterations=120).first()
    w = {f"c{i}": np.array(_weights(f"c{i}", 120)) for i in range(60)}
    mean = lambda g: sum(w[c] * v for c, at, v in rows if at == g) / sum(w[c] for c, at, _ in rows if at == g)
    low, high = np.quantile(mean(True) - mean(False), [0.025, 0.975])
    assert (got["ci_low"], got["ci_high"]) == pytest.approx((low, high), rel=1e-12)
    assert got["clusters"] == 60 and got["valid_iterations"] == 120


@pytest.mark.parametrize("key", ["mart_seller_performance", "mart_category_performance", "mart_monthly_sales", "mart_customer_value"])
def test_narrow_fact_keeps_the_rows(spark, sf, key):
    """A mart over the columns that it reads is the mart over the whole fact, though customers, parts and suppliers repeat."""
    from martlake.plans import facts, marts
    from martlake.plans.catalog import silver
    fact = facts.fact_orders if key in ("mart_monthly_sales", "mart_customer_value") else facts.fact_order_items
    s, make = silver(spark, sf), getattr(marts, key)
    whole, narrow = ([*map(str, sorted(make(f).collect(), key=str))] for f in (fact(s), fact(s, marts.READS[key])))
    assert whole == narrow and whole
    a, b = fact(s).select(*marts.READS[key]), fact(s, marts.READS[key])
    assert sorted(map(str, a.collect())) == sorted(map(str, b.collect()))


def test_seller_mart_makes_the_fact_once(spark, sf):
    """The lines are exchanged by order once, and dimensions that give no column to the mart are not joined."""
    from martlake.plans import facts, marts
    from martlake.plans.catalog import silver
    from martlake.sources.bindings import RetailSources
    s = silver(spark, sf)
    s = RetailSources(**s.as_dict() | {"customers": s.customers.dropDuplicates(["customer_id"]), "products": s.products.dropDuplicates(["product_id"])})
    plan = marts.mart_seller_performance(facts.fact_order_items(s, marts.READS["mart_seller_performance"]))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("l_shipdate") <= 1 and plan.count("l_extendedprice#") and "p_partkey" not in plan and "c_custkey" not in plan
    assert plan.count("lineitem.parquet") <= 1 and sum("Join" in line for line in plan.splitlines()) <= 4


def test_seller_mart_over_several_states(spark):
    """Distinct orders, the most frequent state and the means of a seller whose rows name several states."""
    from martlake.plans.marts import mart_seller_performance
    rows = [("s", 1, "B", 1.5, 4.0, True), ("s", 1, "A", 1.0, 2.0, False), ("s", 2, "A", 0.25, None, None), ("s", 2, "B", 1.0, 3.0, None),
            ("s", 3, None, 2.0, None, True), ("s", None, None, 1.0, None, None), (None, 1, None, 4.0, None, None), (None, 1, "C", 4.0, None, None)]
    df = spark.createDataFrame([(*r, "delivered") for r in rows], "seller_id string, order_id long, seller_state string, price double, "
                               "review_score double, is_late boolean, order_status string")
    got = {r["seller_id"]: tuple(r)[1:] for r in mart_seller_performance(df).collect()}
    assert got == {"s": ("A", 3, 6.75, 3.0, pytest.approx(2 / 3)), None: ("C", 1, 8.0, None, None)}


def test_counts_of_facts_by_their_keys(spark, sf):
    """Rows that repeated customers, parts and suppliers add to the facts are counted."""
    import __spark_entry__ as entry
    from martlake.plans import facts
    from martlake.plans.catalog import silver
    s = silver(spark, sf)
    got = {r["table_name"]: r["rows"] for r in entry.queries()["layer_row_counts"](spark, sf).filter("layer = 'gold'").collect()}
    assert got["fact_orders"] == facts.fact_orders(s).count() > s.orders.count()
    assert got["fact_order_items"] == facts.fact_order_items(s).count() > s.order_items.count()
