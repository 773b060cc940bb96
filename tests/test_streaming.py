"""Incremental landing lands each file once."""

import os
import shutil
import tempfile

import pytest
from pyspark.errors import StreamingQueryException

from martlake.streaming import land_stream
from tests.test_pipeline import write_source


def test_stream_landing_is_exactly_once(spark):
    tmp = tempfile.mkdtemp(prefix="martlake-stream-", dir=os.environ.get("TMPDIR", "/tmp"))
    src = write_source(tmp)
    bronze, ckpt = os.path.join(tmp, "bronze"), os.path.join(tmp, "ckpt")
    assert land_stream(spark, src, "orders", bronze, ckpt) == 1
    assert land_stream(spark, src, "orders", bronze, ckpt) == 0
    shutil.copy(os.path.join(src, "olist_orders_dataset.csv"), os.path.join(src, "olist_orders_dataset_2.csv"))
    assert land_stream(spark, src, "orders", bronze, ckpt) == 1
    assert spark.read.parquet(os.path.join(bronze, "orders")).count() == 2


def test_columns_in_another_order_are_refused(spark):
    tmp = tempfile.mkdtemp(prefix="martlake-stream-", dir=os.environ.get("TMPDIR", "/tmp"))
    src = write_source(tmp)
    with open(os.path.join(src, "olist_sellers_dataset.csv"), "w", encoding="utf-8") as f:
        f.write("seller_state,seller_city,seller_zip_code_prefix,seller_id\nSP,sao paulo,12345,seller-1\n")
    bronze = os.path.join(tmp, "bronze")
    with pytest.raises(StreamingQueryException):
        land_stream(spark, src, "sellers", bronze, os.path.join(tmp, "ckpt"))
    assert not [n for _, _, names in os.walk(bronze) for n in names if n.startswith("part-") and "_temporary" not in n]
