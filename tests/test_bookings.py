"""Booking documents: flatten, required fields, channel, spend."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from millrace.plans import bookings as b
from millrace.schemas import BOOKING_GOLD, BOOKING_SILVER, CHANNELS
from millrace.sources import landing
from samples import booking, put


def split(frame, *bodies):
    return b.booking_silver(frame([(x,) for x in bodies], "body string"))


def test_flatten(frame):
    got = split(frame, booking())
    assert got.valid.columns == BOOKING_SILVER
    assert got.valid.first().asDict() == {
        "invitee_id": "inv1", "email": "ann@example.org", "name": "Ann", "status": "active",
        "booking_created_at": "2024-01-01T00:00:00.000000Z", "booking_id": "ev-inv1",
        "start_time": "2024-01-10T09:00:00.000000Z", "end_time": "2024-01-10T09:30:00.000000Z",
        "event_name": "Intro call", "event_type_id": "d639ecd3-8718-4068-955a-436b10d72c78",
        "channel": "facebook_paid_ads", "employee_email": "eve@example.org", "employee_name": "Eve",
        "campaign": "spring",
    }
    assert got.quarantine.count() == 0


@pytest.mark.parametrize("type_id, channel", [*CHANNELS.items(), ("other", None)])
def test_channel(frame, type_id, channel):
    body = booking(scheduled_event__event_type=f"https://host/types/{type_id}")
    assert split(frame, body).valid.first().channel == channel


def test_optional_campaign(frame):
    assert split(frame, booking(tracking={})).valid.first().campaign is None


def test_empty_id_is_kept(frame):
    assert split(frame, booking(uri="https://host/invitees/")).valid.first().invitee_id == ""


def test_present_null_is_allowed_where_only_copied(frame):
    row = split(frame, booking(name=None, scheduled_event__name=None)).valid.first()
    assert row.name is None and row.event_name is None


@pytest.mark.parametrize(
    "body, reason",
    [
        (booking(drop=["email"]), "payload.email"),
        (booking(drop=["scheduled_event__end_time"]), "payload.scheduled_event.end_time"),
        (booking(uri=None), "payload.uri"),
        (booking(tracking=None), "payload.tracking"),
        (
            booking(scheduled_event__event_memberships=[]),
            "payload.scheduled_event.event_memberships[0].user_email",
        ),
        ("{not json", "body"),
        ("", "body"),
    ],
)
def test_missing_field_goes_to_quarantine(frame, body, reason):
    got = split(frame, body, booking("other"))
    assert [r.invitee_id for r in got.valid.collect()] == ["other"]
    bad = got.quarantine.collect()
    assert len(bad) == 1 and bad[0].body == body and reason in bad[0].reasons


SPEND = [
    (0, "2024-01-14", "facebook_paid_ads", 1.5),
    (1, "2024-01-14", "facebook_paid_ads", 9.0),
    (2, "2024-01-14", "youtube_paid_ads", None),
    (3, "2024-01-09", "facebook_paid_ads", 4.0),
]
SPEND_DDL = "pos int, date string, channel string, spend double"


def test_spend_is_the_first_row_of_the_day_before(frame):
    silver = split(frame, booking()).valid
    gold = b.booking_gold(silver, frame(SPEND, SPEND_DDL), "2024-01-15")
    assert gold.columns == BOOKING_GOLD
    assert gold.first().spend == 1.5


def test_spend_of_the_day_before_the_meeting(frame):
    silver = split(frame, booking()).valid
    row = b.booking_gold(
        silver, frame(SPEND, SPEND_DDL), "2024-01-15", spend_on="booking_date", keep_day=True
    ).first()
    assert (row.spend, row.spend_date) == (4.0, "2024-01-09")


def test_first_row_counts_even_when_null(frame):
    rows = [(0, "2024-01-14", "x", None), (1, "2024-01-14", "x", 2.0)]
    assert b.first_spend(frame(rows, SPEND_DDL)).first().spend is None


def test_no_spend_gives_null(frame):
    silver = split(frame, booking()).valid
    assert b.booking_gold(silver, frame([], SPEND_DDL), "2024-01-15").first().spend is None
    with pytest.raises(ValueError):
        b.with_spend(silver, frame([], SPEND_DDL), spend_on="never")


def test_unknown_channel_never_matches_spend(frame):
    silver = split(frame, booking(scheduled_event__event_type="x/other")).valid
    spend = frame([(0, "2024-01-14", None, 5.0)], SPEND_DDL)
    assert b.booking_gold(silver, spend, "2024-01-15").first().spend is None


def test_spend_files_keep_array_order(spark, folder):
    root = folder("spend")
    put(root, "spend_data_2024-01-13.json", '[{"date":"2024-01-13","channel":"a","spend":7}]')
    put(
        root, "spend_data_2024-01-14.json",
        '[{"channel":"a","date":"2024-01-14","spend":3.5},\n {"channel":"a","date":"2024-01-14","spend":"4"}]',
    )
    one_day = landing.read_spend(spark, root, "2024-01-14")
    assert [(r.pos, r.spend) for r in one_day.orderBy("pos").collect()] == [(0, 3.5), (1, 4.0)]
    assert landing.read_spend(spark, root).count() == 3
    assert landing.read_spend(spark, root, "2024-01-01").count() == 0
    firsts = {(r.channel, r.date): r.spend for r in b.first_spend(landing.read_spend(spark, root)).collect()}
    assert firsts == {("a", "2024-01-13"): 7.0, ("a", "2024-01-14"): 3.5}


def test_load_bookings_adds_only_new(frame):
    gold = split(frame, booking("a"), booking("b"), booking("b")).valid
    stamp = F.lit("2024-01-15 00:00:00").cast("timestamp")
    got = b.load_bookings(gold, frame([("a",)], "invitee_id string"), stamp)
    assert [r.invitee_id for r in got.collect()] == ["b"]
    again = b.load_bookings(gold, got.unionByName(got).select("invitee_id").union(frame([("a",)], "i string")))
    assert again.count() == 0
