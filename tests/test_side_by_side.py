"""What lets a large batch of bookings use all tasks there are: an inbox of many files, warehouse tables filled side by side."""

from __future__ import annotations

import threading
from pathlib import Path

import pytest

from millrace.registry import streams
from millrace.streaming import flows, runs
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F
from samples import booking


def test_a_large_table_fills_many_files_and_two_batches(spark, folder, monkeypatch):
    rows = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    n = rows.count()
    monkeypatch.setattr(streams, "INBOX_LINES", -(-n // 10))
    monkeypatch.setattr(streams, "scratch", lambda spark, name: folder("out"))
    got = streams.stream_files(spark, "/root/testdata/sf0.001")
    lines = [f for part in ("inbox", "archive") for f in Path(folder("out"), part).rglob("part-*.txt")]
    assert len(lines) == 10 and sum(len(f.read_text().splitlines()) for f in lines) == n
    assert spark.read.parquet(f"{folder('out')}/flow/bronze").select("ingest_ts").distinct().count() == 2
    assert got.count() == rows.where("event_type != 'error'").select("event_id").distinct().count()


def run(spark, frame, folder):
    frame([(booking("i1"),), (booking("i2"),)], "body string").coalesce(1).write.text(folder("inbox"))
    lines = spark.readStream.text(folder("inbox"))
    landed = lines.select(F.col("value").alias("body"), F.lit("f").alias("file_path"), F.current_timestamp().alias("file_time"))
    flows.run_bookings(spark, landed, folder("out"), frame([], "pos int, date string, channel string, spend double"), "2024-01-15")


def test_warehouse_tables_are_filled_side_by_side(spark, frame, folder, monkeypatch):
    both, insert = threading.Barrier(2, timeout=60), runs.insert_batch

    def met(*args):
        both.wait()
        insert(*args)

    monkeypatch.setattr(runs, "insert_batch", met)
    run(spark, frame, folder)
    for name in ("events", "marketing"):
        assert {r.invitee_id for r in spark.read.parquet(f"{folder('out')}/warehouse/{name}/batch_id=*").collect()} == {"i1", "i2"}


def test_a_failed_insert_stops_the_flow(spark, frame, folder, monkeypatch):
    insert = runs.insert_batch

    def broken(batch, batch_id, step, root, *rest):
        if root.endswith("marketing"):
            raise ValueError("broken")
        insert(batch, batch_id, step, root, *rest)

    monkeypatch.setattr(runs, "insert_batch", broken)
    with pytest.raises(StreamingQueryException, match="broken"):
        run(spark, frame, folder)
    assert not spark.streams.active
