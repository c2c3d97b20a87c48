"""Plans: what reaches the scan, what is broadcast, what stays out of Python."""

from __future__ import annotations

import re

import pytest

from millrace import registry
from millrace.operators import joins
from millrace.operators.dedup import first_per_key
from millrace.operators.filters import month_slice, recent_visitors
from millrace.plans import reports
from millrace.plans.bookings import booking_mart
from millrace.registry import views
from millrace.schemas import VIDEO_EVENTS
from millrace.sources import tables

SF_DIR = "/root/testdata/sf0.001"
BATCH = [n for n in registry.queries() if not n.startswith("stream_")]


def plan(df) -> str:
    return df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )


@pytest.mark.parametrize("name", BATCH)
def test_no_python_and_no_cross_join(spark, name):
    text = plan(registry.queries()[name](spark, SF_DIR))
    for word in ("EvalPython", "InPandas", "InArrow", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert word not in text


def test_month_filter_prunes_mart_folders(spark, folder):
    path = folder("mart")
    tables.write_mart(views.mart(spark, SF_DIR), path)
    text = plan(reports.daily_bookings(month_slice(tables.load_mart(spark, path), "2024-01-15")))
    assert re.search(r"PartitionFilters: .*booking_date#\d+ >= 2024-01-01", text)
    assert "ReadSchema: struct<invitee_id:string,channel:string>" in text


def test_month_filter_reaches_a_timestamp_scan(spark):
    mart = booking_mart(views.marketing(spark, SF_DIR))
    text = plan(reports.daily_bookings(month_slice(mart, "2024-01-15")))
    assert "GreaterThanOrEqual(ts,2024-01-01T00:00)" in text and "LessThan(ts,2024-02-01T00:00)" in text


def test_day_filter_prunes_layer_folders(spark, folder):
    path = folder("events")
    rows = views.video_events(spark, SF_DIR)
    for day in ("2026-03-10", "2026-03-11"):
        tables.write_layer(tables.with_day(rows, day), path)
    got = tables.read_day(spark, path, "2026-03-11", VIDEO_EVENTS)
    assert re.search(r"PartitionFilters: .*ingest_date#\d+ = 2026-03-11", plan(got))
    assert got.count() == rows.count()


def test_dedup_limits_each_side_of_the_shuffle(spark):
    text = plan(first_per_key(views.table(spark, SF_DIR, "lineitem"), ["l_orderkey"]))
    assert "row_number(), 1, Partial" in text and "row_number(), 1, Final" in text


def test_small_dimension_is_broadcast_and_large_is_not(spark, frame):
    facts = frame([(i % 3, i) for i in range(30)], "k int, a int")
    dimension = spark.range(50).selectExpr("cast(id as int) as k", "id as b")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        small = joins.lookup_join(facts, dimension, ["k"])
        large = joins.lookup_join(facts, dimension, ["k"], broadcast_rows=10)
        assert "BroadcastHashJoin" in plan(small) and "BroadcastHashJoin" not in plan(large)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_large_insert_shuffles_each_side_once(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        new = views.table(spark, SF_DIR, "orders")
        target = views.table(spark, SF_DIR, "lineitem").withColumnRenamed("l_orderkey", "o_orderkey")
        text = plan(joins.insert_if_absent(new, target, "o_orderkey", broadcast_rows=0))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    tree = text.split("(1) Scan")[0]
    assert len(re.findall(r"\bExchange\b", tree)) == 2 and "LeftAnti" in tree
    assert "ReadSchema: struct<l_orderkey:bigint>" in text


def test_documents_are_parsed_once(spark):
    rows = views.table(spark, SF_DIR, "events").select(views.booking_body().alias("body"))
    from millrace.plans.bookings import booking_silver

    assert plan(booking_silver(rows).valid).count("parseJson") == 1


def test_a_hot_key_is_split_as_the_join_runs(spark, frame):
    """Most rows of the right side under one key: the join's own task is cut into several."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "32k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        right = spark.range(60_000, numPartitions=8).selectExpr("cast(if(id % 10 = 0, id, 1) as int) as k", "id as b")
        left = spark.range(2_000).selectExpr("cast(id as int) as k", "id as a")
        joined = joins.skew_left_join(left, right, ["k"])
        joined.collect()
        assert "skew=true" in joined._jdf.queryExecution().executedPlan().toString()
    finally:
        for key in settings:
            spark.conf.unset(key)


def test_the_day_of_visitors_reaches_the_scan(spark, folder):
    path = folder("visitors")
    spark.createDataFrame([("v", "2024-01-14T08:00:00Z")], "visitor_key string, created_at string").write.parquet(path)
    assert "GreaterThanOrEqual(created_at,2024-01-14)" in plan(recent_visitors(spark.read.parquet(path), "2024-01-15"))
