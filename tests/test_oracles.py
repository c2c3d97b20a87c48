"""Every registered query against its SQL."""

from __future__ import annotations

import os

import pytest

import __spark_entry__ as entry_file
from millrace import registry
from millrace.operators import joins
from oracle import connect, differences

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
QUERIES = registry.queries()
ORACLES = registry.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", QUERIES)
def test_query_matches_sql(spark, duck, name):
    assert differences(duck, QUERIES[name](spark, SF_DIR), ORACLES[name]) == []


@pytest.mark.parametrize(
    "name",
    [
        "video_gold", "visitors_events_left", "events_stats_left", "spend_first_match", "booking_gold",
        "of_media_table", "point_read", "insert_if_absent", "load_leads", "owner_merge",
    ],
)
def test_query_matches_sql_on_the_routes_for_large_inputs(spark, duck, monkeypatch, name):
    """Nothing is broadcast."""
    monkeypatch.setattr(joins, "BROADCAST_ROWS", 0)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert differences(duck, QUERIES[name](spark, SF_DIR), ORACLES[name]) == []
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


def test_entry(spark):
    rows = entry_file.entry(spark)
    assert rows.columns == ["booking_date", "channel", "bookings"]
    assert rows.count() > 0
