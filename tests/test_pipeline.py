"""End-to-end and negative runs on the nine-CSV mini source (one delivered, reconciled order)."""

import csv
import json
import os
import re
import tempfile

import pytest

from martlake.plans.pipeline import (
    _publish, build_gold, collect_metrics, current_gold, load_gold_marts, register_views, run_pipeline)
from martlake.sources import contracts as K

ROWS = {
    "olist_customers_dataset.csv": [K.EXPECTED_COLUMNS["customers"],
                                    ("customer-1", "unique-1", "12345", "sao paulo", "SP")],
    "olist_geolocation_dataset.csv": [K.EXPECTED_COLUMNS["geolocation"], ("12345", "-23.5", "-46.6", "sao paulo", "SP")],
    "olist_order_items_dataset.csv": [K.EXPECTED_COLUMNS["order_items"],
                                      ("order-1", "1", "product-1", "seller-1", "2018-01-05 00:00:00", "100.0", "10.0")],
    "olist_order_payments_dataset.csv": [K.EXPECTED_COLUMNS["order_payments"], ("order-1", "1", "credit_card", "1", "110.0")],
    "olist_order_reviews_dataset.csv": [K.EXPECTED_COLUMNS["order_reviews"],
                                        ("review-1", "order-1", "5", "otimo", 'entrega "correta"\nsegunda linha',
                                         "2018-01-12 00:00:00", "2018-01-13 00:00:00")],
    "olist_orders_dataset.csv": [K.EXPECTED_COLUMNS["orders"],
                                 ("order-1", "customer-1", "delivered", "2018-01-01 10:00:00", "2018-01-01 11:00:00",
                                  "2018-01-02 10:00:00", "2018-01-10 10:00:00", "2018-01-12 10:00:00")],
    "olist_products_dataset.csv": [K.EXPECTED_COLUMNS["products"], ("product-1", "toys", "10", "20", "1", "500", "20", "10", "10")],
    "olist_sellers_dataset.csv": [K.EXPECTED_COLUMNS["sellers"], ("seller-1", "12345", "sao paulo", "SP")],
    "product_category_name_translation.csv": [K.EXPECTED_COLUMNS["product_category_name_translation"], ("toys", "toys")],
}


def write_source(tmp, rows=ROWS, skip=()):
    src = os.path.join(tmp, "source")
    os.makedirs(src, exist_ok=True)
    for name, data in rows.items():
        if name in skip:
            continue
        with open(os.path.join(src, name), "w", newline="", encoding="utf-8") as fh:
            w = csv.writer(fh, quoting=csv.QUOTE_MINIMAL)
            for r in data:
                w.writerow(r)
    return src


@pytest.fixture()
def tmp():
    return tempfile.mkdtemp(prefix="martlake-test-", dir=os.environ.get("TMPDIR", "/tmp"))


def test_pipeline_materialises_six_gold_relations_and_preserves_rows(spark, tmp):
    manifest = run_pipeline(spark, write_source(tmp), os.path.join(tmp, "data"), run_id="r1")
    assert manifest["row_preservation"]["passed"]
    assert set(manifest["bronze"].values()) == {1}
    assert set(manifest["gold"]) == set(K.GOLD_TABLES)
    assert manifest["gold"]["fact_orders"] == 1 and manifest["gold"]["fact_order_items"] == 1
    assert len(manifest["quality_checks"]) == 35
    assert all(c["passed"] for c in manifest["quality_checks"] if c["severity"] == "critical")
    gold = current_gold(spark, os.path.join(tmp, "data", "gold"))
    fo = spark.read.parquet(f"{gold}/fact_orders").first()
    assert (fo["item_revenue"], fo["payment_value"], fo["review_score"], fo["is_late"]) == (100.0, 110.0, 5.0, False)
    reviews = spark.read.parquet(os.path.join(tmp, "data", "silver", "order_reviews")).first()
    assert reviews["review_comment_message"] == 'entrega "correta"\nsegunda linha'


def test_duplicate_item_key_is_a_critical_failure(spark, tmp):
    rows = dict(ROWS)
    items = ROWS["olist_order_items_dataset.csv"]
    rows["olist_order_items_dataset.csv"] = items + [items[1]]
    with pytest.raises(ValueError, match="critical"):
        run_pipeline(spark, write_source(tmp, rows), os.path.join(tmp, "data"))


def test_missing_source_file_is_reported_before_landing(spark, tmp):
    with pytest.raises(FileNotFoundError, match="olist_sellers_dataset.csv"):
        run_pipeline(spark, write_source(tmp, skip=("olist_sellers_dataset.csv",)), os.path.join(tmp, "data"))


def test_missing_column_returns_only_schema_checks(spark, tmp):
    from martlake.plans.quality import quality_report
    from martlake.sources.csv_source import read_sources, typed_sources
    rows = dict(ROWS)
    rows["olist_sellers_dataset.csv"] = [r[:3] for r in ROWS["olist_sellers_dataset.csv"]]
    report = quality_report(spark, typed_sources(read_sources(spark, write_source(tmp, rows)), parse_dates=False))
    got = report.collect()
    assert len(got) == 9
    bad = [r for r in got if not r["passed"]]
    assert [r["check"] for r in bad] == ["schema sellers"]
    assert json.loads(bad[0]["evidence"]) == {"missing": ["seller_state"], "unexpected": []}


def test_quality_negatives(spark, tmp):
    from martlake.plans.quality import quality_report
    from martlake.sources.csv_source import read_sources, typed_sources
    rows = dict(ROWS)
    o = list(ROWS["olist_orders_dataset.csv"][1])
    o[2], o[4] = "lost", "not a date"
    rows["olist_orders_dataset.csv"] = [ROWS["olist_orders_dataset.csv"][0], tuple(o)]
    it = list(ROWS["olist_order_items_dataset.csv"][1])
    it[5], it[3] = "-1.0", "seller-x"
    rows["olist_order_items_dataset.csv"] = [ROWS["olist_order_items_dataset.csv"][0], tuple(it)]
    rv = list(ROWS["olist_order_reviews_dataset.csv"][1])
    rv[2] = "6"
    rows["olist_order_reviews_dataset.csv"] = [ROWS["olist_order_reviews_dataset.csv"][0], tuple(rv)]
    p = list(ROWS["olist_products_dataset.csv"][1])
    p[1] = "NA"
    rows["olist_products_dataset.csv"] = [ROWS["olist_products_dataset.csv"][0], tuple(p)]
    report = quality_report(spark, typed_sources(read_sources(spark, write_source(tmp, rows)), parse_dates=False))
    rows = {r["check"]: r for r in report.collect()}
    failed = {c for c, r in rows.items() if not r["passed"]}
    assert json.loads(rows["order dates parseable"]["evidence"])["order_approved_at"] == 1
    assert json.loads(rows["status inside domain"]["evidence"]) == {"rows": 1, "example": "lost"}
    assert json.loads(rows["FK items -> sellers"]["evidence"]) == {"orphans": 1, "example": "seller-x"}
    assert all(r["expectation"] for r in rows.values())
    assert {"order dates parseable", "status inside domain", "FK items -> sellers",
            "price and freight non negative", "review_score between 1 and 5",
            "missing category monitored"} <= failed


def test_mart_loader_errors_and_metrics(spark, tmp):
    gold_dir = os.path.join(tmp, "gold")
    with pytest.raises(ValueError, match="missing"):
        load_gold_marts(spark, gold_dir)
    run_dir = os.path.join(gold_dir, "runs", "x")
    spark.createDataFrame([], "order_month timestamp_ntz, revenue double").write.parquet(f"{run_dir}/mart_monthly_sales")
    spark.createDataFrame([], "category string, revenue double, avg_review_score double").write.parquet(
        f"{run_dir}/mart_category_performance")
    spark.createDataFrame([], "seller_id string, revenue double").write.parquet(f"{run_dir}/mart_seller_performance")
    _publish(spark, gold_dir, run_dir)
    with pytest.raises(ValueError, match="empty"):
        load_gold_marts(spark, gold_dir)

    import datetime as dt
    run2 = os.path.join(gold_dir, "runs", "y")
    spark.createDataFrame([(dt.datetime(2018, 1, 1), 250.0)], "order_month timestamp_ntz, revenue double").write.parquet(
        f"{run2}/mart_monthly_sales")
    spark.createDataFrame([("toys", 250.0, 5.0)], "category string, revenue double, avg_review_score double").write.parquet(
        f"{run2}/mart_category_performance")
    spark.createDataFrame([("seller-1", 250.0)], "seller_id string, revenue double").write.parquet(
        f"{run2}/mart_seller_performance")
    _publish(spark, gold_dir, run2)
    m = {(r["metric"], r["position"]): r for r in collect_metrics(spark, gold_dir).collect()}
    assert m[("revenue", 0)]["value"] == 250.0
    assert m[("top_category_revenue", 1)]["label"] == "toys"
    assert m[("seller_top10_share", 0)]["value"] == 1.0


def _changed(table_file, row=1, **cells):
    rows = dict(ROWS)
    head, values = ROWS[table_file][0], list(ROWS[table_file][row])
    for name, value in cells.items():
        values[list(head).index(name)] = value
    rows[table_file] = [head, tuple(values)]
    return rows


def test_failed_run_leaves_the_published_gold(spark, tmp):
    data = os.path.join(tmp, "data")
    run_pipeline(spark, write_source(tmp), data, run_id="r1")
    gold = os.path.join(data, "gold")
    published = current_gold(spark, gold)
    with pytest.raises(FileExistsError):
        build_gold(spark, f"{data}/silver", gold, run_id="r1")
    items = spark.read.parquet(f"{data}/silver/order_items")
    broken = os.path.join(tmp, "broken")
    for table in K.EXPECTED_COLUMNS:
        spark.read.parquet(f"{data}/silver/{table}").write.parquet(f"{broken}/{table}")
    items.write.mode("append").parquet(f"{broken}/order_items")
    with pytest.raises(ValueError, match="contract"):
        build_gold(spark, broken, gold, run_id="r2")
    assert current_gold(spark, gold) == published and os.listdir(os.path.join(gold, "runs")) == ["r1"]
    assert spark.read.parquet(f"{published}/fact_order_items").count() == 1
    build_gold(spark, f"{data}/silver", gold, run_id="r3")
    assert current_gold(spark, gold).endswith("r3") and len(os.listdir(os.path.join(gold, "_published"))) >= 2


def test_extra_relation_in_a_run_is_refused(spark, tmp):
    from martlake.plans.pipeline import check_gold, read_layer
    from martlake.sources.bindings import RetailSources
    data = os.path.join(tmp, "data")
    run_pipeline(spark, write_source(tmp), data, run_id="r1")
    silver = RetailSources(**read_layer(spark, f"{data}/silver"))
    spark.range(1).write.parquet(f"{data}/gold/runs/r1/another")
    with pytest.raises(ValueError, match="six"):
        check_gold(spark, silver, f"{data}/gold/runs/r1")


def test_of_many_publishers_of_one_pointer_one_wins(spark, tmp_path):
    from concurrent.futures import ThreadPoolExecutor
    from threading import Barrier
    from martlake.sources.storage import create_once, list_names
    gate = Barrier(8)

    def publish(i):
        gate.wait()
        try:
            create_once(spark, f"{tmp_path}/p/000000000001.json", json.dumps({"run_dir": i}))
            return i
        except FileExistsError:
            return None

    os.makedirs(f"{tmp_path}/p")
    with ThreadPoolExecutor(8) as pool:
        won = [i for i in pool.map(publish, range(8)) if i is not None]
    assert len(won) == 1 and [n for n in list_names(spark, f"{tmp_path}/p") if not n.startswith(".")] == ["000000000001.json"]
    assert json.loads(open(f"{tmp_path}/p/000000000001.json").read()) == {"run_dir": won[0]}


def test_views_over_the_published_gold(spark, tmp):
    data = os.path.join(tmp, "data")
    run_pipeline(spark, write_source(tmp), data)
    assert set(register_views(spark, f"{data}/gold")) == set(K.GOLD_TABLES)
    assert spark.sql("SELECT sum(revenue) AS r FROM mart_monthly_sales").first()["r"] == 100.0


def test_bronze_is_the_source_and_tokens_go_at_typing(spark, tmp):
    rows = _changed("olist_products_dataset.csv", product_category_name="NA")
    data = os.path.join(tmp, "data")
    run_pipeline(spark, write_source(tmp, rows), data)
    assert spark.read.parquet(f"{data}/bronze/products").first()["product_category_name"] == "NA"
    silver = spark.read.parquet(f"{data}/silver/products").first()
    assert (silver["product_category_name"], silver["is_category_missing"]) == ("unknown", True)


def test_timestamps_do_not_depend_on_the_session_zone(spark, tmp):
    import datetime as dt
    from martlake.sources.csv_source import read_sources, typed_sources
    rows = _changed("olist_orders_dataset.csv", order_purchase_timestamp="2017-10-15 00:00:00")
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/Sao_Paulo")
    try:
        got = typed_sources(read_sources(spark, write_source(tmp, rows))).orders.first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert got["order_purchase_timestamp"] == dt.datetime(2017, 10, 15)


def test_fractions_are_kept_or_refused_never_cut(spark, tmp):
    from martlake.plans.quality import quality_report
    from martlake.sources.csv_source import read_sources, typed_sources
    rows = _changed("olist_order_reviews_dataset.csv", review_score="5.9")
    rows["olist_order_items_dataset.csv"] = _changed("olist_order_items_dataset.csv", order_item_id="1.5")["olist_order_items_dataset.csv"]
    typed = typed_sources(read_sources(spark, write_source(tmp, rows)), parse_dates=False)
    assert typed.order_reviews.first()["review_score"] == 5.9 and typed.order_items.first()["order_item_id"] is None
    report = {r["check"]: r for r in quality_report(spark, typed).collect()}
    assert not report["review_score between 1 and 5"]["passed"]


def test_order_tables_join_without_exchange(spark, tmp):
    """Facts over bucketed silver: nothing is exchanged by order, and the rows are those over plain silver."""
    from martlake.operators import reconcile
    from martlake.plans import facts, pipeline
    from martlake.sources.bindings import RetailSources, bind_sources
    from martlake.sources.bucketed import read_bucketed, write_bucketed
    from martlake.sources.silver import to_silver
    source = to_silver(bind_sources(spark, "/root/testdata/sf0.001"))
    for table, df in source.as_dict().items():
        if table in pipeline.BY_ORDER:
            write_bucketed(df, f"{tmp}/s/{table}", "order_id", 5)
        else:
            df.write.parquet(f"{tmp}/s/{table}")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        silver = RetailSources(**pipeline.read_layer(spark, f"{tmp}/s"))
        for make in (facts.fact_orders, facts.fact_order_items):
            over, plain = make(silver), make(source)
            rows = sorted(map(str, over.collect()))
            assert rows == sorted(map(str, plain.collect())) and rows
            plan = over._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
            assert "SelectedBucketsCount: 5 out of 5" in plan
            assert not re.search(r"Exchange hashpartitioning\(order_id", plan)
            assert re.search(r"Exchange hashpartitioning\(customer_id", plan)
        r = reconcile.payment_reconciliation(silver.order_payments, silver.order_items)
        r.collect()
        assert "Exchange hashpartitioning(order_id" not in r._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    # written over, the folder is plain again
    source.order_payments.limit(3).write.mode("overwrite").parquet(f"{tmp}/s/order_payments")
    assert read_bucketed(spark, f"{tmp}/s/order_payments").count() == 3
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("bucketed_")]
