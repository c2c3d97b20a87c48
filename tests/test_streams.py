"""Streams: every row of a batch, last arrival wins, restarts and replays add nothing."""

from __future__ import annotations

import json
import os

import pytest

from millrace.plans import bookings, leads
from millrace.schemas import BRONZE, LEAD_GOLD
from millrace.sources import landing
from millrace.streaming import flows, runs
from samples import booking, lead, owner, put

SPEND = [(0, "2024-01-14", "facebook_paid_ads", 1.5), (1, "2024-01-14", "facebook_paid_ads", 9.0)]


@pytest.fixture
def spend(frame):
    return frame(SPEND, "pos int, date string, channel string, spend double")


def later(path, seconds):
    """Arrival order is the files' own time."""
    os.utime(path, (1_700_000_000 + seconds, 1_700_000_000 + seconds))


def run(spark, inbox, root, spend, per_batch=100):
    stream = landing.stream_bodies(spark, inbox, files_per_batch=per_batch)
    flows.run_bookings(spark, stream, root, spend, "2024-01-15")


def gold(spark, root):
    log = runs.read_log(spark, f"{root}/gold", flows.BOOKING_GOLD_LOG)
    return {r.invitee_id: r for r in runs.latest(log, "invitee_id").collect()}


def test_bookings_stream_equals_batch(spark, folder, spend):
    inbox, root = folder("inbox"), folder("out")
    docs = [booking(f"i{n}") for n in range(7)] + ["{broken", booking("x", drop=["email"])]
    for n, body in enumerate(docs):
        put(inbox, f"{n}.json", body)
    run(spark, inbox, root, spend, per_batch=2)
    batch = bookings.booking_silver(landing.bodies(spark, inbox).select("body"))
    want = {r.invitee_id: r for r in bookings.booking_gold(batch.valid, spend, "2024-01-15").collect()}
    got = gold(spark, root)
    assert set(got) == set(want) == {f"i{n}" for n in range(7)}
    assert all(got[k].spend == want[k].spend == 1.5 for k in want)
    bad = spark.read.parquet(f"{root}/quarantine")
    assert {r.body for r in bad.collect()} == set(docs[-2:])
    assert spark.read.parquet(f"{root}/bronze").count() == len(docs)


def test_last_arrival_wins_and_restart_adds_nothing(spark, folder, spend):
    inbox, root = folder("inbox"), folder("out")
    put(inbox, "a.json", booking("i1", status="first"))
    put(inbox, "b.json", booking("i1", status="second"))
    later(f"{inbox}/a.json", 20)
    later(f"{inbox}/b.json", 10)
    run(spark, inbox, root, spend)
    assert gold(spark, root)["i1"].status == "first"
    before = spark.read.parquet(f"{root}/gold").count()
    run(spark, inbox, root, spend)
    assert spark.read.parquet(f"{root}/gold").count() == before == 2
    put(inbox, "c.json", booking("i1", status="third"))
    later(f"{inbox}/c.json", 5)
    run(spark, inbox, root, spend)
    got = gold(spark, root)
    assert len(got) == 1 and got["i1"].status == "third"


def test_nothing_arrived(spark, folder, spend):
    inbox, root = folder("inbox"), folder("out")
    os.makedirs(inbox)
    run(spark, inbox, root, spend)
    assert gold(spark, root) == {}


def test_replayed_batch_replaces_itself(spark, frame, folder):
    root = folder("log")
    runs.write_batch(frame([(1,), (2,)], "k int"), root, 0)
    runs.write_batch(frame([(1,), (2,)], "k int"), root, 0)
    runs.write_batch(frame([(3,)], "k int"), root, 1)
    assert spark.read.parquet(root).count() == 3


def test_compaction_keeps_current_rows(spark, frame, folder):
    root, out = folder("log"), folder("current")
    runs.write_batch(frame([("a", 1), ("b", 1)], "k string, v int"), root, 0)
    runs.write_batch(frame([("a", 2)], "k string, v int"), root, 1)
    runs.compact(spark.read.parquet(root), "k", out)
    assert sorted((r.k, r.v) for r in spark.read.parquet(out).collect()) == [("a", 2), ("b", 1)]


def test_compaction_goes_on_from_the_last_one(spark, frame, folder):
    root, first, second = folder("log"), folder("first"), folder("second")
    runs.write_batch(frame([("a", 1), ("b", 1)], "k string, v int"), root, 0)
    runs.write_batch(frame([("a", 2)], "k string, v int"), root, 1)
    runs.compact(spark.read.parquet(root), "k", first)
    runs.write_batch(frame([("c", 3), ("b", 4)], "k string, v int"), root, 2)
    runs.compact(spark.read.parquet(root), "k", second, previous=spark.read.parquet(first))
    whole = runs.latest(spark.read.parquet(root), "k")
    got = sorted((r.k, r.v) for r in spark.read.parquet(second).collect())
    assert got == sorted((r.k, r.v) for r in whole.collect()) == [("a", 2), ("b", 4), ("c", 3)]


def run_leads(spark, inbox, root, owners, per_batch=100):
    stream = landing.stream_bodies(spark, inbox, files_per_batch=per_batch)
    flows.run_leads(spark, stream, root, landing.read_owners(spark, owners))


def test_leads_through_all_layers(spark, folder):
    inbox, owners, root = folder("inbox"), folder("owners"), folder("out")
    for n in range(4):
        put(inbox, f"{n}.json", lead(f"L{n}"))
        put(owners, f"L{n}.json", owner(lead_owner=f"owner {n}"))
    put(inbox, "5.json", lead("alone"))
    put(inbox, "6.json", json.dumps({"lead_id": "no event"}))
    run_leads(spark, inbox, root, owners, per_batch=2)
    silver = spark.read.parquet(f"{root}/silver")
    assert {r.doc_id for r in silver.collect()} == {"L0", "L1", "L2", "L3", "alone"}
    warehouse = runs.read_log(spark, f"{root}/warehouse", flows.LEAD_WAREHOUSE)
    assert sorted((r.lead_id, r.lead_owner) for r in warehouse.collect()) == [
        (f"L{n}", f"owner {n}") for n in range(4)
    ]
    assert spark.read.parquet(f"{root}/outbox").count() == 4
    assert [r.doc_id for r in spark.read.parquet(f"{root}/quarantine").collect()] == ["alone"]
    assert spark.read.parquet(f"{root}/rejected").count() == 1
    batch = leads.lead_gold(
        leads.lead_silver(
            spark.read.schema(BRONZE).parquet(f"{root}/bronze").where("doc_id is not null"),
            landing.read_owners(spark, owners),
        )
    ).valid
    log = runs.read_log(spark, f"{root}/gold", flows.LEAD_GOLD_LOG)
    want = sorted(map(repr, batch.select(*LEAD_GOLD).collect()))
    assert sorted(map(repr, runs.latest(log, "lead_id").select(*LEAD_GOLD).collect())) == want


def test_second_delivery_is_not_inserted_again(spark, folder):
    inbox, owners, root = folder("inbox"), folder("owners"), folder("out")
    put(owners, "L1.json", owner())
    put(inbox, "1.json", lead("L1"))
    run_leads(spark, inbox, root, owners)
    put(inbox, "2.json", lead("L1", funnel="changed"))
    run_leads(spark, inbox, root, owners)
    warehouse = runs.read_log(spark, f"{root}/warehouse", flows.LEAD_WAREHOUSE)
    assert [(r.lead_id, r.funnel) for r in warehouse.collect()] == [("L1", "web")]
    log = runs.read_log(spark, f"{root}/gold", flows.LEAD_GOLD_LOG)
    assert [r.funnel for r in runs.latest(log, "lead_id").collect()] == ["changed"]
    assert spark.read.parquet(f"{root}/outbox").count() == 2


def test_archived_files_are_read_once(spark, folder, spend):
    inbox, root = folder("inbox"), folder("out")
    for n in range(3):
        put(inbox, f"{n}.json", booking(f"i{n}"))
        stream = landing.stream_bodies(spark, inbox, archive=folder("done"))
        flows.run_bookings(spark, stream, root, spend, "2024-01-15")
    assert set(gold(spark, root)) == {"i0", "i1", "i2"}
    assert spark.read.parquet(f"{root}/bronze").count() == 3


def test_bodies_by_line(spark, folder):
    inbox = folder("inbox")
    put(inbox, "many.json", booking("a") + "\n" + booking("b"))
    rows = landing.bodies(spark, inbox, whole_files=False)
    ids = rows.select(landing.invitee_id_of(rows["body"]).alias("i")).collect()
    assert sorted(r.i for r in ids) == ["a", "b"]
