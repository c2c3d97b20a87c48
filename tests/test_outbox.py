"""Claims and acknowledgements: each message is sent once, whatever stops the sender."""

from __future__ import annotations

from collections import Counter

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.plans import reports
from millrace.streaming import outbox, runs

SCHEMA = T.StructType([T.StructField("lead_id", T.StringType()), T.StructField("text", T.StringType())])


@pytest.fixture
def box(spark, frame, folder):
    root = folder("out")

    def land(batch, *rows):
        runs.write_batch(frame(list(rows), "lead_id string, text string"), f"{root}/pending", batch)

    return root, land


def take(spark, root):
    claimed = outbox.claim(spark, root, SCHEMA, "lead_id")
    return claimed, None if claimed is None else sorted((r.lead_id, r.text) for r in claimed.messages.collect())


def test_a_message_is_claimed_once(spark, box):
    root, land = box
    assert take(spark, root) == (None, None)
    land(0, ("a", "first"), ("b", "x"), ("b", "y"), (None, "no key"))
    claimed, rows = take(spark, root)
    assert claimed.run == 1 and rows == [("a", "first"), ("b", "x")]
    outbox.acknowledge(spark, root, claimed)
    outbox.acknowledge(spark, root, claimed)  # again, after a restart
    assert take(spark, root) == (None, None)
    land(1, ("a", "later"), ("c", "z"))
    claimed, rows = take(spark, root)
    assert claimed.run == 2 and rows == [("c", "z")]


def test_a_stopped_sender_goes_on_with_the_same_claim(spark, box):
    root, land = box
    land(0, ("a", "first"), ("b", "x"))
    _, before = take(spark, root)
    # posted in part, then stopped; other messages arrive, and a later one for a claimed key
    land(1, ("a", "second"), ("c", "z"))
    claimed, again = take(spark, root)
    assert claimed.run == 1 and again == before
    outbox.acknowledge(spark, root, claimed)
    claimed, rest = take(spark, root)
    assert claimed.run == 2 and rest == [("c", "z")]
    outbox.acknowledge(spark, root, claimed)
    done = [(r.lead_id, r.run) for r in outbox.delivered(spark, root, SCHEMA).collect()]
    assert Counter(done) == Counter([("a", 1), ("b", 1), ("c", 2)])


def test_meetings_from_bitmaps(spark, frame):
    rows = [("ann", 1, "m1"), ("ann", 1, "m1"), ("ann", 2, "m1"), ("ann", 2, None), ("bob", 2, "m1"), ("bob", None, "m2"), (None, 3, "m3"), ("cy", 4, None), ("dee", None, None)]
    rows += [("eve", w, f"e{w}-{n % 300}") for w in range(5) for n in range(400)]
    month = frame(rows, "employee_name string, week int, booking_id string")
    cube = reports.meeting_cube(month)
    got, want = reports.meeting_load_of_cube(cube), reports.meeting_load_distinct(month)
    assert got.dtypes == want.dtypes and sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))
    # any other union of the bitmaps is exact as well: meetings of a week, whoever held them
    weeks = cube.groupBy("week", "bucket").agg(F.bitmap_or_agg("meetings").alias("m")).groupBy("week").agg(F.sum(F.bitmap_count("m")).alias("n"))
    known = month.where("employee_name is not null").groupBy("week").agg(F.countDistinct("booking_id").alias("n"))
    assert sorted(map(repr, weeks.collect())) == sorted(map(repr, known.collect()))
