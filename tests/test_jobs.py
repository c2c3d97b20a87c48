"""The jobs end to end, from landing folders to a report."""

from __future__ import annotations

import json

import pytest

from millrace.__main__ import run
from samples import booking, lead, owner, put
from test_video import event, visitor

DAY = "2024-01-15"


def test_video_jobs(spark, folder):
    landed, layers = folder("landed"), {n: folder(n) for n in ("bronze", "silver", "gold")}
    at = "2024-01-14T08:00:00Z"
    put(f"{landed}/events/ingest_date={DAY}", "0.json", json.dumps([event("e1", at=at), event("e2", at=at, media="m9")]))
    put(f"{landed}/events/ingest_date={DAY}", "1.json", json.dumps([event("e1", at=at)]))
    put(f"{landed}/events/ingest_date={DAY}", "2.json", "{cut")
    put(f"{landed}/visitors/ingest_date={DAY}", "0.json", json.dumps([visitor("v1", at)]))
    stats = [{"date": "2024-01-14", "load_count": 1, "play_count": 1, "hours_watched": 2.5}]
    put(f"{landed}/media_stats/ingest_date={DAY}/media_id=m1", "0.json", json.dumps(stats))

    def job(name, *more):
        return run(spark, [f"video-{name}", *more, "--day", DAY])

    bronze, silver, gold = (["--" + n, p] for n, p in layers.items())
    assert job("bronze", "--landed", landed, *bronze, "--media", "m1") == ["visitors", "events", "media_stats"]
    assert job("silver", *bronze, *silver) == ["visitors", "events", "media_stats"]
    assert job("gold", *silver, *gold) == ["engagement"]
    rows = spark.read.parquet(f"{layers['gold']}/engagement").collect()
    assert [(r.visitor_key, r.event_key, r.hours_watched) for r in rows] == [("v1", "e1", 2.5)]
    bad = spark.read.parquet(f"{layers['bronze']}/bad_pages").collect()
    assert [(r.body, r.feed) for r in bad] == [("{cut", "events")]


def test_video_bronze_without_landing(spark, folder):
    assert run(spark, ["video-bronze", "--landed", folder("no"), "--bronze", folder("b"), "--day", DAY]) == []


def test_booking_jobs_up_to_a_report(spark, folder):
    landed, root, spend = folder("landed"), folder("root"), folder("spend")
    for n in range(3):
        put(landed, f"{n}.json", booking(f"i{n}"))
    put(landed, "again.json", booking("i0", status="moved"))
    rows = [{"channel": "facebook_paid_ads", "date": "2024-01-14", "spend": 2.5}]
    put(spend, "spend_data_2024-01-14.json", json.dumps(rows))
    stray = [{"channel": "facebook_paid_ads", "date": "2024-01-14", "spend": 999}]
    put(spend, "spend_data_2024-01-13.json", json.dumps(stray))
    run(spark, ["bookings", "--landed", landed, "--root", root, "--spend", spend, "--day", DAY])
    spark.sql(f"CREATE DATABASE IF NOT EXISTS jobs LOCATION '{folder('warehouse')}'")
    try:
        run(spark, ["marketing", "--root", root, "--table", "jobs.marketing"])
        assert run(spark, ["refresh", "--mart", folder("mart"), "--table", "jobs.marketing"]) == 3
    finally:
        spark.sql("DROP DATABASE jobs CASCADE")
    run(spark, ["report", "--mart", folder("mart"), "--out", folder("out"), "--name", "cost_per_booking", "--day", DAY])
    row = spark.read.parquet(folder("out")).first()
    assert (row.channel, row.total_spend, row.booked_calls, row.Average_CPB) == ("facebook_paid_ads", 7.5, 3, 2.5)


def test_lead_job(spark, folder):
    put(folder("landed"), "1.json", lead("L1"))
    put(folder("owners"), "L1.json", owner())
    run(spark, ["leads", "--landed", folder("landed"), "--root", folder("root"), "--owners", folder("owners")])
    assert spark.read.parquet(f"{folder('root')}/warehouse").first().lead_id == "L1"


def test_unknown_job_is_refused(spark):
    with pytest.raises(SystemExit):
        run(spark, ["nothing"])
