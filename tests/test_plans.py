"""What the plans must and must not hold, whatever the data."""

import re

import pytest
from pyspark.sql import functions as F

from lakeloom.operators import compare, history, quality, rows
from tests.helpers import plan
from tests.oracle import DATA

FOLDER = DATA.format("0.001")

@pytest.fixture
def orders(spark):
    return spark.read.parquet(f"{FOLDER}/orders.parquet")


def test_newest_limits_groups_before_the_shuffle(orders):
    text = plan(rows.newest(orders, ["o_custkey"], [F.col("o_orderdate").desc()]))
    assert text.count("WindowGroupLimit") == 2 and text.count("Exchange") == 1


def test_filters_and_columns_reach_the_scan(orders):
    text = plan(quality.valid(quality.quarantine(orders, {"big": "o_totalprice > 1000"})).select("o_orderkey"))
    assert "PushedFilters: [IsNotNull(o_totalprice)" in text or "o_totalprice" in re.search("DataFilters: .*", text).group()
    assert "o_orderpriority" not in re.search("ReadSchema: .*", text).group()


def test_compare_shuffles_once_and_combines_first(orders):
    text = plan(compare.compare(orders, orders.limit(10)))
    assert "partial_sum" in text
    assert text.count("Exchange hashpartitioning") == 1


def test_history_never_partitions_rows_by_the_key_alone(spark):
    events = spark.read.parquet(f"{FOLDER}/events.parquet").select("user_id", "ts", "event_type")
    text = plan(history.scd2(events, ["user_id"], "ts"))
    assert "Exchange hashpartitioning(user_id" in text  # versions, after partial aggregation
    for exchange in re.findall(r"Exchange hashpartitioning\(user_id#\d+L, \d+\)", text):
        raise AssertionError(exchange)


def test_snapshot_history_shuffles_rows_once(spark):
    frame = spark.range(100).select((F.col("id") % 7).alias("k"), F.floor(F.col("id") / 7).cast("int").alias("v"), F.lit("x").alias("s"))
    text = plan(history.scd2_from_snapshots(frame, ["k"], "v"))
    assert text.count("Exchange hashpartitioning") == 1
