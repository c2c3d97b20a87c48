"""What keeps a large batch of bookings cheap: one reading of a payload, no bodies kept, input dealt out."""

from __future__ import annotations

import json
import re

import pytest
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.plans import bookings
from millrace.registry.views import stream_table
from millrace.streaming import flows
from samples import booking

@pytest.fixture
def frames(spark):
    """The class of this session's frames, to watch its methods."""
    return type(spark.range(0))


def plan_of(rows: DataFrame, capsys) -> str:
    rows.explain("extended")
    return capsys.readouterr().out


def test_a_payload_is_read_once(frame, capsys):
    judged = bookings.booking_silver(frame([(booking("i1"),)], "body string")).judged
    optimized = plan_of(judged, capsys).split("== Optimized Logical Plan ==")[1].split("== Physical Plan ==")[0]
    # a path of its own is looked up only for the reasons, as a variant
    kinds = set(re.findall(r"scheduled_event\.start_time, (\w+)", optimized))
    assert "VariantType" in kinds and "StringType" not in kinds


def test_odd_payloads_are_judged_as_by_paths(frame):
    whole = json.loads(booking("i1"))

    def with_event(**event):
        payload = whole["payload"]
        return json.dumps({"payload": payload | {"scheduled_event": payload["scheduled_event"] | event}})

    def with_payload(**fields):
        return json.dumps({"payload": whole["payload"] | fields})

    host = "payload.scheduled_event.event_memberships[0]"
    hosts = [f"{host}.user_email", f"{host}.user_name"]
    cases = {
        with_payload(email=None): [],
        with_payload(email=7, name=True): [],
        with_payload(email={"a": [1, None]}): [],
        with_payload(tracking=None): ["payload.tracking"],
        with_payload(tracking="text"): [],
        with_payload(tracking={"utm_campaign": 1.50}): [],
        with_payload(uri=None): ["payload.uri"],
        with_event(event_memberships=[]): hosts,
        with_event(event_memberships={"user_email": "e"}): hosts,
        with_event(event_memberships=[None]): hosts,
        with_event(event_memberships=["x", {"user_email": "e", "user_name": "n"}]): hosts,
        with_event(event_memberships=[{"user_email": None, "user_name": 3}, 5]): [],
    }
    judged = bookings.booking_silver(frame([(c,) for c in cases], "body string")).judged
    got = {r.body: r for r in judged.collect()}
    assert {body: r.reasons or [] for body, r in got.items()} == cases
    flats = [got[body].flat for body in cases]
    assert flats[0].email is None and (flats[1].email, flats[1].name) == ("7", "true") and flats[2].email == '{"a":[1,null]}'
    assert flats[4].campaign is None and flats[5].campaign == "1.5"
    assert flats[11].employee_email is None and flats[11].employee_name == "3"
    for body in ("[]", '"text"', '{"payload": 3}', '{"payload": null}'):
        reasons = bookings.booking_silver(frame([(body,)], "body string")).judged.first().reasons
        assert "payload.uri" in reasons and "payload.email" in reasons and "payload.tracking" in reasons


def test_bodies_of_valid_rows_are_not_kept(spark, frame, frames, folder, monkeypatch):
    kept = []
    persist = frames.persist

    def seen(rows, level=StorageLevel.DISK_ONLY):
        kept.append(sorted((r.body is None, r.reasons is None) for r in rows.select("body", "reasons").collect()))
        return persist(rows, level)

    monkeypatch.setattr(frames, "persist", seen)
    frame([(booking("i1"),), ("{broken",)], "body string").coalesce(1).write.text(folder("inbox"))
    lines = spark.readStream.text(folder("inbox"))
    landed = lines.select(F.col("value").alias("body"), F.lit("f").alias("file_path"), F.current_timestamp().alias("file_time"))
    flows.run_bookings(spark, landed, folder("out"), frame([], "pos int, date string, channel string, spend double"), "2024-01-15")
    assert kept == [[(False, False), (True, True)]]
    assert [r.body for r in spark.read.parquet(f"{folder('out')}/quarantine").collect()] == ["{broken"]


def test_a_table_of_one_row_group_is_dealt_out(spark, frame, folder):
    rows = frame([(n, "x" * 20) for n in range(300)], "id int, v string")
    rows.coalesce(1).write.parquet(f"{folder('d')}/one.parquet")
    before = {k: spark.conf.get(k, None) for k in ("spark.sql.adaptive.coalescePartitions.enabled",)}
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    seen = []
    try:
        stream = stream_table(spark, folder("d"), "one")
        query = stream.writeStream.foreachBatch(
            lambda batch, _: seen.extend(batch.groupBy(F.spark_partition_id()).count().collect())
        ).option("checkpointLocation", folder("c")).trigger(availableNow=True).start()
        query.awaitTermination()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert sum(r["count"] for r in seen) == 300 and len(seen) > 1
