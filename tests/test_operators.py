"""Operators against brute force on hand-made frames (nulls, ties, hot keys)."""

import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from martlake.operators import bootstrap as B
from martlake.operators.keys import domain_profile, key_profile, orphans
from martlake.operators.quantiles import grouped_quantiles, quantiles
from martlake.operators.ranking import global_rank
from martlake.operators.reconcile import payment_reconciliation, reconciliation_profile
from martlake.operators.sequence import next_in_sequence
from martlake.plans import concentration as C


def test_grouped_quantiles_match_pandas_with_ties_nulls_and_a_hot_group(spark):
    rng = np.random.default_rng(7)
    rows = [("hot", float(v)) for v in rng.integers(0, 50, 3000)]          # one group holds most rows
    rows += [("even", 1.0), ("even", 2.0), ("even", 3.0), ("even", 10.0)]  # even count -> interpolation
    rows += [("ties", 5.0)] * 7 + [("nulls", None), ("nulls", 4.0)] + [("allnull", None)]
    df = spark.createDataFrame(rows, "g string, v double")
    probs = [0.0, 0.25, 0.5, 0.75, 0.99, 1.0]
    got = {r["g"]: r for r in grouped_quantiles(df, ["g"], "v", probs).collect()}
    pdf = pd.DataFrame(rows, columns=["g", "v"])
    for g, sub in pdf.dropna().groupby("g"):
        for i, p in enumerate(probs):
            assert got[g][f"q{int(round(p * 1000)):03d}"] == pytest.approx(sub.v.quantile(p), rel=1e-12)
    assert "allnull" not in got


def test_global_quantiles_one_row(spark):
    df = spark.createDataFrame([(float(x),) for x in [3, 1, 2, 2, 9]], "v double")
    r = quantiles(df, "v", [0.25, 0.5], ["a", "b"]).collect()
    assert len(r) == 1 and r[0]["a"] == 2.0 and r[0]["b"] == 2.0


def test_global_rank_and_running_sum_match_sorted_cumsum(spark):
    rng = np.random.default_rng(3)
    rev = np.round(rng.choice([0.0, 10.0, 10.0, 55.5], 500) + rng.integers(0, 3, 500), 2)
    pdf = pd.DataFrame({"seller_id": [f"s{i:04d}" for i in range(500)], "revenue": rev})
    df = spark.createDataFrame(pdf)
    got = global_rank(df, "revenue", ascending=False, tiebreak=["seller_id"], value_col="revenue",
                      partitions=16).toPandas().sort_values("rank")
    want = pdf.sort_values(["revenue", "seller_id"], ascending=[False, True]).reset_index(drop=True)
    assert list(got.seller_id) == list(want.seller_id)
    assert list(got["rank"]) == list(range(1, 501))
    assert np.allclose(got.cum_value.astype(float).to_numpy(), want.revenue.cumsum().to_numpy())


def test_rank_spreads_equal_keys(spark):
    """Three quarters of the rows tie on the key: the tiebreak shares them among the tasks."""
    df = spark.range(0, 40_000, 1, 4).select(F.when(F.col("id") % 4 < 3, 5.0).otherwise(F.col("id") / 100).alias("v"),
                                             F.concat(F.lit("s"), F.lpad(F.pmod(F.col("id") * 7919, F.lit(40_000)), 6, "0")).alias("s"))
    got = global_rank(df, "v", ascending=False, tiebreak=["s"], value_col="v", partitions=16)
    sizes = [r["count"] for r in got.groupBy(F.spark_partition_id()).count().collect()]
    assert max(sizes) < 3 * 40_000 / 16
    pdf = got.toPandas().sort_values("rank").reset_index(drop=True)
    want = df.toPandas().sort_values(["v", "s"], ascending=[False, True]).reset_index(drop=True)
    assert list(pdf["rank"]) == list(range(1, 40_001)) and list(pdf.s) == list(want.s)
    assert float(pdf.cum_value.iloc[-1]) == pytest.approx(want.v.sum())


def test_concentration_edge_cases(spark):
    equal = spark.createDataFrame([(f"s{i}", 10.0) for i in range(10)], "seller_id string, revenue double")
    g = C.seller_gini(equal).first()
    assert g["gini"] == pytest.approx(0.0, abs=1e-12)
    c = C.seller_concentration(equal).first()
    assert c["hhi"] == pytest.approx(0.1) and c["top_10_pct_share"] == pytest.approx(0.1)
    mono = spark.createDataFrame([("a", 100.0)] + [(f"s{i}", 0.0) for i in range(9)], "seller_id string, revenue double")
    assert C.seller_concentration(mono).first()["hhi"] == pytest.approx(1.0)
    assert C.seller_gini(mono).first()["gini"] == pytest.approx(0.9)


def test_next_in_sequence_matches_shift_with_equal_timestamps(spark):
    import datetime as dt
    base = dt.datetime(2018, 1, 1)
    rows = []
    for i in range(200):  # one hot person across many months, plus ties on timestamp
        rows.append(("hot", i, base + dt.timedelta(days=(i // 2) * 9)))
    rows += [("solo", 1000, base), ("pair", 1001, base), ("pair", 1002, base), (None, 1003, base),
             (None, 1004, base + dt.timedelta(days=40))]
    df = spark.createDataFrame(rows, "p string, oid int, ts timestamp_ntz")
    got = next_in_sequence(df, "p", "ts", "oid", "month").toPandas().set_index("oid")
    pdf = pd.DataFrame(rows, columns=["p", "oid", "ts"]).sort_values(["p", "ts", "oid"])
    pdf["nxt"] = pdf.groupby("p").oid.shift(-1)      # an unknown person makes no sequence
    for oid, nxt in zip(pdf.oid, pdf.nxt):
        g = got.loc[oid, "next_id"]
        assert (pd.isna(g) and pd.isna(nxt)) or g == nxt, oid


def test_sequence_reads_its_input_once(spark, tmp_path):
    spark.range(5000).select((F.col("id") % 3).alias("p"), F.col("id").alias("oid"), F.timestamp_seconds(F.col("id") * 86_400).cast(
        "timestamp_ntz").alias("ts")).write.parquet(f"{tmp_path}/t")
    got = next_in_sequence(spark.read.parquet(f"{tmp_path}/t"), "p", "ts", "oid", "month")
    rows = {r["oid"]: r["next_id"] for r in got.collect()}
    assert all(rows[i] == i + 3 for i in range(4997)) and [rows[i] for i in (4997, 4998, 4999)] == [None] * 3
    plan = got._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert plan.count("FileScan parquet") == 1 and "Join" not in plan


def test_describe_neither_cuts_nor_overflows(spark):
    from martlake.operators.profile import describe
    rng = np.random.default_rng(2)
    for scale in (1e-7, 1.0, 1e5, 1e30):
        x = rng.random(2000) * scale + scale
        r = describe(spark.createDataFrame([(float(v),) for v in x], "x double").repartition(7), "x", [0.5]).first()
        assert r["mean"] == pytest.approx(x.mean(), rel=1e-12) and r["std"] == pytest.approx(x.std(ddof=1), rel=1e-10)
    near = describe(spark.range(10_000).select((F.lit(1e9) + (F.col("id") % 2) * 1e-3).alias("x")), "x", [0.5]).first()
    assert near["std"] == pytest.approx(0.0005, rel=1e-3)          # centred: no cancellation
    assert describe(spark.createDataFrame([(4.0,)], "x double"), "x", [0.5]).first()["std"] is None


def test_concentration_of_very_small_and_very_large_revenue(spark):
    for scale in (0.0004, 12.34, 1e16):
        x = [scale * k for k in (1, 2, 3, 10)]
        df = spark.createDataFrame([(f"s{i}", v) for i, v in enumerate(x)], "seller_id string, revenue double")
        c, g = C.seller_concentration(df).first(), C.seller_gini(df).first()
        assert c["hhi"] == pytest.approx(sum(v * v for v in x) / sum(x) ** 2, rel=1e-12)
        assert g["gini"] == pytest.approx(2 * sum(i * v for i, v in enumerate(sorted(x), 1)) / (4 * sum(x)) - 5 / 4, rel=1e-12)


def test_key_profile_counts_duplicates_after_first_and_null_keys(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (1, "a"), (2, None), (2, None), (None, "x")], "k int, j string")
    r = key_profile(df, ["k", "j"]).first()
    assert (r["rows"], r["duplicates"], r["null_keys"]) == (6, 3, 3)


def test_orphans_null_rule(spark):
    child = spark.createDataFrame([(1,), (2,), (None,)], "k int")
    parent = spark.createDataFrame([(1,)], "k int")
    assert orphans(child, "k", parent, "k").first()["orphans"] == 2
    parent_null = spark.createDataFrame([(1,), (None,)], "k int")
    assert orphans(child, "k", parent_null, "k").first()["orphans"] == 1


def test_domain_profile_null_is_outside(spark):
    df = spark.createDataFrame([("delivered",), ("weird",), (None,)], "s string")
    got = {r["s"]: r["in_domain"] for r in domain_profile(df, "s", ["delivered"]).collect()}
    assert got == {"delivered": True, "weird": False, None: False}


def test_reconciliation_sides_and_tolerance(spark):
    pay = spark.createDataFrame([(1, 110.0), (2, 50.01), (3, 50.02), (4, 9.0)], "order_id int, payment_value double")
    items = spark.createDataFrame([(1, 100.0, 10.0), (2, 40.0, 10.0), (3, 40.0, 10.0), (5, 1.0, 0.0)],
                                  "order_id int, price double, freight_value double")
    r = payment_reconciliation(pay, items).first()
    assert (r["only_payments"], r["only_items"], r["comparable_orders"], r["value_mismatches"]) == (1, 1, 3, 1)
    assert r["mismatch_rate"] == pytest.approx(1 / 3)
    p = reconciliation_profile(pay, items).first()
    assert (p["orders_compared"], p["missing_on_one_side"], p["difference_gt_1_cent"]) == (5, 2, 1)


def test_ninety_day_floor_is_inclusive(spark):
    from martlake.functions import day_floor
    import datetime as dt
    t0 = dt.datetime(2018, 1, 1)
    rows = [(t0, t0), (t0, t0 + dt.timedelta(days=90)), (t0, t0 + dt.timedelta(days=90, hours=22)),
            (t0, t0 + dt.timedelta(days=91)), (t0, t0 - dt.timedelta(hours=1)), (t0, None)]
    df = spark.createDataFrame(rows, "a timestamp_ntz, b timestamp_ntz")
    got = [r[0] for r in df.select(F.coalesce(day_floor("a", "b").between(0, 90), F.lit(False))).collect()]
    assert got == [True, True, True, False, False, False]


@pytest.mark.parametrize("m,n", [(1, 200_000), (7, 100_000), (9, 100_000), (10, 200_000), (1000, 100_000), (10 ** 9, 50_000)])
def test_poisson_draws_have_the_right_moments(spark, m, n):
    df = B.poisson(spark.range(n).select(F.lit(m).cast("bigint").alias("m"), F.lit(12345).cast("bigint").alias("h"), "id"), "m", "h", "id")
    mean, var, skew = df.agg(F.avg("w"), F.var_samp("w"), F.skewness("w")).first()
    assert mean == pytest.approx(m, abs=5 * math.sqrt(m / n))
    assert var == pytest.approx(m, rel=0.03) and skew == pytest.approx(m ** -0.5, abs=0.05)


@pytest.mark.parametrize("m", [3, 10, 64])
def test_poisson_draws_follow_the_distribution(spark, m):
    """Chi-square against the exact probabilities, for inversion and for rejection."""
    n = 200_000
    df = B.poisson(spark.range(n).select(F.lit(m).cast("bigint").alias("m"), F.lit(99).cast("bigint").alias("h"), "id"), "m", "h", "id")
    seen = {r["w"]: r["count"] for r in df.groupBy("w").count().collect()}
    expect = {k: n * math.exp(k * math.log(m) - m - math.lgamma(k + 1)) for k in range(6 * m)}
    usual = [k for k, e in expect.items() if e >= 10]
    chi = sum((seen.get(k, 0) - expect[k]) ** 2 / expect[k] for k in usual)
    assert chi < len(usual) + 5 * math.sqrt(2 * len(usual))


def test_bootstrap_draws_once_for_equal_clusters(spark):
    """Half a million clusters of four kinds are four rows an iteration."""
    df = spark.range(500_000).select(F.col("id").alias("c"), (F.col("id") % 2 == 0).alias("g"), (F.col("id") % 4 < 2).cast("double").alias("v"))
    got = B.bootstrap_diff(df, cluster="c", group="g", value="v", iterations=400).first()
    assert got["clusters"] == 500_000 and got["difference"] == 0.0
    half = (got["ci_high"] - got["ci_low"]) / 2        # 1.96 standard errors of a difference of two shares of 1/2
    assert half == pytest.approx(1.96 * math.sqrt(2 * 0.25 / 250_000), rel=0.2) and got["ci_low"] < 0 < got["ci_high"]


def test_bootstrap_validation_errors(spark):
    df = spark.createDataFrame([("c1", True, 1.0), ("c2", True, 0.0)], "c string, g boolean, v double")
    with pytest.raises(ValueError):
        B.bootstrap_diff(df, cluster="c", group="g", value="v", iterations=0)
    with pytest.raises(KeyError):
        B.bootstrap_diff(df, cluster="nope", group="g", value="v", iterations=10)
    with pytest.raises(ValueError):  # group B is empty
        B.bootstrap_diff(df, cluster="c", group="g", value="v", iterations=10)


def test_cluster_interval_wider_than_naive_when_clusters_correlate(spark):
    rng = np.random.default_rng(11)
    rows = []
    for c in range(300):  # strong within-person correlation, 8 orders each
        late = bool(c % 2)
        base = float(rng.random() < (0.3 if late else 0.5))
        rows += [(f"p{c}", f"o{c}_{k}", late, base) for k in range(8)]
    df = spark.createDataFrame(rows, "c string, o string, g boolean, v double")
    cl = B.bootstrap_diff(df, cluster="c", group="g", value="v", iterations=300).first()
    nv = B.bootstrap_diff(df, cluster="o", group="g", value="v", iterations=300).first()
    assert cl["ci_low"] < cl["difference"] < cl["ci_high"]
    assert (cl["ci_high"] - cl["ci_low"]) > 1.5 * (nv["ci_high"] - nv["ci_low"])
    assert math.isclose(cl["difference"], nv["difference"])


def test_strip_removes_tabs_and_newlines_but_keeps_nulls(spark):
    from martlake.functions import strip
    df = spark.createDataFrame([(" \tsao paulo\n",), ("\r\n",), (None,), ("a b",)], "s string")
    assert [r[0] for r in df.select(strip("s")).collect()] == ["sao paulo", "", None, "a b"]


def test_money_keeps_digits_below_a_cent(spark):
    from martlake.functions import money_sum
    df = spark.createDataFrame([(0.004,), (0.004,), (1.005,), (None,)], "x double")
    assert df.agg(money_sum("x").alias("s")).first()["s"] == 1.013


def test_strip_removes_what_python_strips(spark):
    from martlake.functions import strip
    spaces = [chr(c) for c in range(0x110000) if chr(c).isspace()]
    df = spark.createDataFrame([(c + " a" + c + "b " + c,) for c in spaces], "t string")
    got = {r["t"]: r["s"] for r in df.select("t", strip("t").alias("s")).collect()}
    assert len(got) == len(spaces) and all(s == t.strip() for t, s in got.items())


def test_zip_without_a_code_is_no_zip(spark):
    from martlake.plans.marts import geolocation_by_zip
    df = spark.createDataFrame([(1, -20.0, -40.0, "a", "S"), (1, -22.0, None, "b", None), (1, -23.0, -42.0, "b", "S"),
                                (None, 0.0, 0.0, "c", "T"), (2, None, None, None, None)],
                               "geolocation_zip_code_prefix int, geolocation_lat double, geolocation_lng double, "
                               "geolocation_city string, geolocation_state string")
    got = sorted(tuple(r) for r in geolocation_by_zip(df).collect())
    assert got == [(1, -22.0, -41.0, "b", "S"), (2, None, None, None, None)]


def test_global_rank_puts_null_keys_last(spark):
    from martlake.operators.ranking import global_rank
    df = spark.createDataFrame([("a", 9.0), ("b", None), ("c", 10.0), ("d", None)], "id string, v double")
    for up, want in ((False, "cabd"), (True, "acbd")):
        got = global_rank(df, "v", ascending=up, tiebreak=["id"], partitions=4).orderBy("rank").collect()
        assert "".join(r["id"] for r in got) == want and [r["rank"] for r in got] == [1, 2, 3, 4]


def test_bootstrap_needs_resamples_with_both_groups(spark):
    import warnings
    import pytest
    from martlake.operators.bootstrap import _check_resamples
    with pytest.raises(ValueError, match="resamples"):
        _check_resamples(0, 10)
    with pytest.warns(UserWarning, match="left out"):
        _check_resamples(90, 100)
    with warnings.catch_warnings():
        warnings.simplefilter("error")
        _check_resamples(96, 100)


def _exchanges(df):
    """Executed plan's exchanges: (partitioning, rows written), each once."""
    found = {}

    def walk(node):
        name = node.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            return walk(node.executedPlan())
        if name.endswith("QueryStageExec"):
            return walk(node.plan())
        if name == "ShuffleExchangeExec":
            rows = node.metrics().get("shuffleRecordsWritten")
            found[node.id()] = (node.outputPartitioning().toString(), rows.get().value())
        for i in range(node.children().size()):
            walk(node.children().apply(i))
    walk(df._jdf.queryExecution().executedPlan())
    return list(found.values())


def test_quantiles_exchange_bins_not_rows(spark):
    """Ten times the rows, two thirds of them in one group: the exchanges carry no more rows than bins."""
    sent = []
    for n in (100_000, 1_000_000):
        rows = spark.range(0, n, 1, 4).select(F.when(F.col("id") % 3 < 2, 0).otherwise(F.col("id") % 30).alias("g"),
                                              F.round(F.rand(1) * 100 + 50, 1).alias("x"))
        q = grouped_quantiles(rows, ["g"], "x", [0.5], "m", max_groups=30)
        got = {r["g"]: r["m"] for r in q.collect()}
        pdf = rows.toPandas()
        assert got == {g: pytest.approx(x) for g, x in pdf.groupby("g").x.median().items()}
        sent.append(sum(r for _, r in _exchanges(q)))
    assert sent[1] < 1.5 * sent[0] and sent[1] < 60_000


def test_quantiles_of_extreme_values(spark):
    inf, tiny = float("inf"), 5e-324
    values = [0.0, -0.0, tiny, -tiny, 1e308, -1e308, 1.0, 1.0 + 2 ** -52, 1.0 + 2 ** -51, -3.5, 1e-300, 2e-300, inf, -inf, 7.25]
    df = spark.createDataFrame([(x,) for x in values] + [(None,), (float("nan"),)], "v double")
    probs = [i / (len(values) - 1) for i in range(len(values))]
    got = quantiles(df, "v", probs, [f"q{i}" for i in range(len(probs))]).first()
    h = [(len(values) - 1) * p for p in probs]
    want = [sorted(values)[round(x)] for x in h]
    assert [got[f"q{i}"] for i in range(len(probs)) if h[i] == round(h[i])] == [w for w, x in zip(want, h) if x == round(x)]


def test_hot_group_of_quantiles_without_broadcasts(spark):
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        rows = spark.range(60_000).select(F.when(F.col("id") % 3 < 2, 0).otherwise(F.col("id") % 30).alias("g"), F.rand(1).alias("x"))
        got = {r["g"]: r["m"] for r in grouped_quantiles(rows, ["g"], "x", [0.5], "m").collect()}
        assert got == {g: pytest.approx(x) for g, x in rows.toPandas().groupby("g").x.median().items()}
    finally:
        for k, v in old.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)


def test_schema_diff_names_what_is_missing_and_unexpected(spark):
    from martlake.operators.keys import schema_diff
    tables = {"a": spark.range(2).withColumn("x", F.lit(1)), "b": spark.range(2), "c": spark.range(2).withColumn("extra", F.lit(1))}
    got = {r["table"]: (r["missing"], r["unexpected"], r["passed"])
           for r in schema_diff(spark, tables, {"a": ("id", "x"), "b": ("id", "x"), "c": ("id",)}).collect()}
    assert got == {"a": (0, 0, True), "b": (1, 0, False), "c": (0, 1, False)}
