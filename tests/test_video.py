"""Video feeds and layers on small pages."""

from __future__ import annotations

import json
import os

import pytest

from millrace.plans import video as v
from millrace.schemas import MEDIA_STATS, VIDEO_EVENTS, VIDEO_GOLD, VISITORS
from millrace.sources import landing, tables
from samples import put

DAY = "2026-03-11"


def event(key, visitor="v1", media="m1", at="2026-03-10T08:00:00Z", seen=0.5, **more):
    return {
        "received_at": at, "event_key": key, "ip": "1.2.3.4", "country": "AT", "region": None, "city": "Graz",
        "percent_viewed": seen, "visitor_key": visitor, "media_id": media, "media_name": "Intro",
        "conversion_type": "none", **more,
    }


def visitor(key, at="2026-03-10T08:00:00Z"):
    return {"visitor_key": key, "created_at": at, "last_active_at": at, "load_count": 3, "play_count": 2}


def pages(frame, *page_rows):
    return frame([(json.dumps(rows),) for rows in page_rows], "body string")


@pytest.fixture
def feeds(frame):
    events = pages(
        frame,
        [event("e1"), event("e2", seen="0.25"), event("e1")],
        [event("e3", seen=None, media="m2"), event("old", at="2026-03-09T23:59:59Z"), event("e4", visitor="gone")],
        [],
    )
    stats = frame(
        [("m1", json.dumps([
            {"date": "2026-03-10", "load_count": 5, "play_count": 4, "hours_watched": "1.5"},
            {"date": "2026-03-09", "load_count": 1, "play_count": 1, "hours_watched": None},
        ]))],
        "media_id string, body string",
    )
    # the newest page need not come first
    visitors = pages(frame, [visitor("v0", "2026-03-01T00:00:00Z")], [visitor("v1"), visitor("v2"), visitor("v1")])
    return {
        "events": v.bronze_events(events, DAY),
        "media_stats": v.bronze_stats(stats, DAY),
        "visitors": v.bronze_visitors(visitors, DAY),
    }


def test_feeds(feeds):
    events = feeds["events"].collect()
    assert sorted(r.event_key for r in events) == ["e1", "e1", "e2", "e3", "e4"]
    assert {r.event_key: r.percent_viewed for r in events} == {"e1": 0.5, "e2": 0.25, "e3": None, "e4": 0.5}
    assert [(r.media_id, r.date, r.hours_watched) for r in feeds["media_stats"].collect()] == [
        ("m1", "2026-03-10", 1.5)
    ]
    assert sorted(r.visitor_key for r in feeds["visitors"].collect()) == ["v1", "v1", "v2"]
    for name, schema in (("events", VIDEO_EVENTS), ("media_stats", MEDIA_STATS), ("visitors", VISITORS)):
        assert [(f.name, f.dataType) for f in feeds[name].schema] == [(f.name, f.dataType) for f in schema]


def test_bad_pages_are_set_aside_and_never_lost(frame):
    good, bad = json.dumps([event("e1")]), ["{cut", '{"error": "limit"}', "[1, 2"]
    rows = frame([(x,) for x in (good, "[]", *bad)], "body string")
    split = landing.split_pages(rows)
    assert sorted(r.body for r in split.valid.collect()) == sorted([good, "[]"])
    assert sorted(r.body for r in split.quarantine.collect()) == sorted(bad)
    assert landing.feed_rows(split.valid, VIDEO_EVENTS).count() == 1
    assert landing.feed_rows(rows, VIDEO_EVENTS).count() == 1


def test_bad_elements_are_set_aside_one_by_one(frame):
    whole, bare = event("e1"), {"event_key": "e2"}
    wrong = {**event("e3"), "percent_viewed": "much"}
    rows = frame([(json.dumps([whole, bare, 5, None, wrong]),), ("[1, 2]",)], "body string")
    split = landing.split_feed(rows, VIDEO_EVENTS)
    assert [r.event_key for r in split.valid.collect()] == ["e1"]
    bad = {r.element: r.reasons for r in split.quarantine.collect()}
    assert len(bad) == 6 and bad["5"][0] == "object" and bad[json.dumps(wrong).replace(": ", ":").replace(", ", ",")] == ["percent_viewed is a number"]


def test_whole_numbers_come_in_any_form(frame):
    one = {**visitor("v1"), "load_count": 12.0, "play_count": "7"}
    rows = landing.feed_rows(frame([(json.dumps([one]),)], "body string"), VISITORS).first()
    assert (rows.load_count, rows.play_count) == (12, 7)
    bad = {**one, "load_count": 1.5}
    assert landing.split_feed(frame([(json.dumps([bad]),)], "body string"), VISITORS).quarantine.first().reasons == ["load_count is a number"]


def test_media_choice(frame):
    rows = v.bronze_events(pages(frame, [event("a"), event("b", media="m2")]), DAY, ["m2"])
    assert [r.event_key for r in rows.collect()] == ["b"]


def test_media_choice_by_table(frame):
    page = json.dumps([{"date": "2026-03-10", "load_count": 1, "play_count": 1, "hours_watched": None}])
    stats = frame([("m1", page), ("m2", page)], "media_id string, body string")
    assert v.bronze_stats(stats, DAY, frame([("m2",)], "media_id string")).first().media_id == "m2"


def write_all(spark, feeds, root, day=DAY):
    for name, rows in feeds.items():
        v.write_bronze(rows, f"{root}/bronze", name, day)
    written = v.write_silver(spark, f"{root}/bronze", f"{root}/silver", day)
    return written, v.write_gold(spark, f"{root}/silver", f"{root}/gold", day)


def test_chain(spark, feeds, folder):
    root = folder("video")
    assert write_all(spark, feeds, root) == (["visitors", "events", "media_stats"], ["engagement"])
    gold = spark.read.parquet(f"{root}/gold/engagement")
    assert gold.columns == [*VIDEO_GOLD, "event_date", "ingest_date"]
    got = {(r.visitor_key, r.event_key): r for r in gold.collect()}
    # "gone" is no visitor of the window, v2 has no events, m2 has no figures
    assert set(got) == {("v1", "e1"), ("v1", "e2"), ("v1", "e3"), ("v2", None)}
    assert (got["v1", "e1"].date, got["v1", "e1"].hours_watched) == ("2026-03-10", 1.5)
    assert got["v1", "e3"].date is None and str(got["v1", "e3"].event_date) == "2026-03-10"
    assert got["v2", None].event_date is None


def test_chain_twice_gives_the_same(spark, feeds, folder):
    root = folder("video")
    write_all(spark, feeds, root)
    first = sorted(map(repr, spark.read.parquet(f"{root}/gold/engagement").collect()))
    silver = {t: spark.read.parquet(f"{root}/silver/{t}").count() for t in feeds}
    write_all(spark, feeds, root)
    assert sorted(map(repr, spark.read.parquet(f"{root}/gold/engagement").collect())) == first
    assert {t: spark.read.parquet(f"{root}/silver/{t}").count() for t in feeds} == silver


def test_days_stay_apart_and_history_joins_them(spark, feeds, folder):
    root = folder("video")
    write_all(spark, feeds, root)
    later = {**feeds, "visitors": feeds["visitors"].replace("Intro", "Other").limit(1)}
    write_all(spark, later, root, "2026-03-12")
    assert sorted(os.listdir(f"{root}/silver/visitors"))[-2:] == ["ingest_date=2026-03-11", "ingest_date=2026-03-12"]
    assert spark.read.parquet(f"{root}/silver/events").count() == 8
    assert v.history(spark, f"{root}/silver", "events").count() == 4
    days = {r.ingest_date.isoformat() for r in v.history(spark, f"{root}/silver", "events").collect()}
    assert days == {"2026-03-12"}


def test_without_events_two_tables_are_kept(spark, feeds, folder):
    root = folder("video")
    write_all(spark, feeds, root)
    quiet = {**feeds, "events": feeds["events"].where("false")}
    written, gold = write_all(spark, quiet, root, "2026-03-12")
    assert written == ["visitors", "media_stats"] and gold == ["visitors", "media_stats"]
    days = {t: {str(r.ingest_date) for r in spark.read.parquet(f"{root}/gold/{t}").collect()} for t in ("engagement", "visitors")}
    assert days == {"engagement": {DAY}, "visitors": {"2026-03-12"}}


def test_nothing_landed(spark, folder):
    root = folder("video")
    assert v.write_silver(spark, f"{root}/bronze", f"{root}/silver", DAY) == []
    assert v.write_gold(spark, f"{root}/silver", f"{root}/gold", DAY) == ["visitors", "media_stats"]


def test_other_failures_than_a_missing_path_are_raised(spark, folder):
    path = folder("broken")
    os.makedirs(path)
    with open(os.path.join(path, "part.parquet"), "w") as out:
        out.write("no parquet")
    with pytest.raises(Exception):
        tables.optional_table(spark, path, VISITORS).collect()
    assert tables.optional_table(spark, folder("absent"), VISITORS).isEmpty()


def test_pages_behind_a_short_one_are_stale(frame):
    full, short, empty, broken = "[{},{}]", "[{}]", "[]", "{cut"
    rows = [("a", 1, full), ("a", 2, full), ("a", 3, short), ("a", 4, full), ("b", 1, empty), ("b", 2, full), ("c", 1, full), ("c", 2, broken), ("c", 3, full), ("d", 7, full), (None, 1, full)]
    pages = frame(rows, "media string, page int, body string")
    kept = sorted((r.media or "", r.page) for r in landing.until_short_page(pages, "media", "page", 2).collect())
    assert kept == [("", 1), ("a", 1), ("a", 2), ("a", 3), ("b", 1), ("c", 1), ("c", 2), ("d", 7)]


def test_pages_are_parsed_once(spark, frame, folder):
    """Rows, bad rows and bad pages of a landed day from one pass, each where it belongs."""
    whole = {n: "1" if n == "percent_viewed" else n for n in VIDEO_EVENTS.names}
    good = json.dumps([whole, {"event_key": "half"}, None])
    split = landing.split_landed(frame([(good,), ("[]",), ("{cut",), (None,)], "body string"), VIDEO_EVENTS)
    assert split.valid.columns == VIDEO_EVENTS.names and split.valid.count() == 1
    bad = [(r.body, r.element, r.reasons[0]) for r in split.quarantine.collect()]
    assert sorted(bad, key=str) == sorted([("{cut", None, "array"), (None, None, "array"), (None, '{"event_key":"half"}', "received_at"), (None, None, "object")], key=str)


def test_broken_spend_files_are_set_aside(spark, folder):
    put(folder("spend"), "spend_data_2024-01-14.json", json.dumps([{"date": "2024-01-14", "channel": "c", "spend": 1.5}, {"date": "d", "channel": None, "spend": None}]))
    put(folder("spend"), "spend_data_2024-01-13.json", "[{")
    put(folder("spend"), "spend_data_2024-01-12.json", json.dumps([{"date": "x", "channel": "c", "spend": "much"}]))
    rows = landing.read_spend(spark, folder("spend"), broken=folder("broken")).collect()
    assert sorted((r.pos, r.channel, r.spend) for r in rows) == [(0, "c", 1.5), (1, None, None)]
    bad = spark.read.parquet(folder("broken")).collect()
    assert sorted((r.file_path[-7:-5], r.reasons) for r in bad) == [("12", ["numbers"]), ("13", ["array", "objects", "numbers"])]
