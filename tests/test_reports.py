"""Report rules on small marts: nulls, empty months, totals that must agree."""

from __future__ import annotations

import pytest

from millrace.operators.filters import month_slice
from millrace.plans import reports as r
from millrace.plans.bookings import booking_mart, refresh_mart
from millrace.sources import tables

DDL = (
    "invitee_id string, booking_id string, status string, start_time string, channel string,"
    " employee_name string, spend double"
)
ROWS = [
    ("i1", "b1", "active", "2024-01-01T09:00:00.000000Z", "fb", "ann", 10.0),
    ("i2", "b1", "active", "2024-01-01T09:30:00.000000Z", "fb", "ann", 10.0),
    ("i3", "b2", "canceled", "2024-01-02T10:00:00.000000Z", "fb", "bob", None),
    ("i4", "b3", "active", "2024-01-09T10:00:00Z", "yt", "ann", 4.0),
    ("i5", "b4", "active", "2024-01-09T11:00:00.000000Z", None, None, 99.0),
    (None, "b5", "active", "2024-01-10T11:00:00.000000Z", "yt", "bob", 0.5),
    ("i7", None, "active", "2024-01-31T23:59:59.000000Z", "yt", "bob", 0.25),
    ("i8", "b8", "active", "2024-02-01T00:00:00.000000Z", "yt", "bob", 7.0),
]


@pytest.fixture
def mart(frame):
    return booking_mart(frame(ROWS, DDL))


@pytest.fixture
def month(mart):
    return month_slice(mart, "2024-01-20")


def rows(df):
    return [tuple(x) for x in df.collect()]


def test_costs_and_kpis(month):
    costs = r.cost_per_booking(month)
    assert sorted(rows(costs)) == [("fb", 20.0, 3, 20.0 / 3), ("yt", 4.75, 2, 2.375)]
    k = r.booking_kpis(costs).first()
    assert (k.total_bookings, k.total_spend) == (5, 24.75)
    assert k.average_cpb == pytest.approx((20.0 / 3 + 2.375) / 2)
    assert k.weighted_cpb == pytest.approx(24.75 / 5)
    assert (k.total_spend_text, k.average_cpb_text, k.total_bookings_text) == ("$25", "$4.52", "5")


def test_spend_counted_once(month):
    got = {x.channel: x.total_spend for x in r.cost_per_booking_once(month).collect()}
    assert got == {"fb": 10.0, "yt": 4.75}


def test_zero_calls_give_null_ratio(frame):
    month = month_slice(booking_mart(frame([(None, "b", "a", ROWS[0][3], "fb", "ann", 3.0)], DDL)), "2024-01-01")
    assert rows(r.cost_per_booking(month)) == [("fb", 3.0, 0, None)]


def test_null_channel_is_in_hours_but_not_in_channels(month):
    daily = r.daily_bookings(month)
    volume = r.hour_weekday(month)
    assert sum(x.bookings for x in daily.collect()) == 5
    assert sum(x.booking_count for x in volume.collect()) == 6


def test_totals_agree(month):
    daily, volume = r.daily_bookings(month), r.hour_weekday(month)
    calls = {x.channel: x.booked_calls for x in r.cost_per_booking(month).collect()}
    last = {}
    for x in sorted(r.cumulative_bookings(daily).collect()):
        last[x.channel] = x.cumulative_bookings
    assert last == calls
    total = sum(x.booking_count for x in volume.collect())
    by_day = r.bookings_by_weekday(volume).collect()
    assert sum(x.booking_count for x in r.bookings_by_hour(volume).collect()) == total
    assert sum(x.booking_count for x in by_day) == total
    assert sum(x.share for x in by_day) == pytest.approx(1.0)


def test_heatmap_columns(month):
    wide = r.heatmap(r.hour_weekday(month))
    assert wide.columns == [
        "hour", "Friday", "Monday", "Saturday", "Sunday", "Thursday", "Tuesday", "Wednesday"
    ]
    cells = {x.hour: x.asDict() for x in wide.collect()}
    assert cells[9]["Monday"] == 2 and cells[9]["Friday"] is None
    # present in the slice, but its only id is null: counted as 0, not left out
    assert cells[11]["Wednesday"] == 0


def test_meeting_load(month):
    load = r.meeting_load(month)
    assert sorted(rows(load)) == [("ann", 3, 2, 1.5), ("bob", 2, 3, 2 / 3)]
    assert rows(r.meeting_kpis(load)) == [(5, 2, 3)]
    assert sorted(rows(r.meeting_load_distinct(month))) == [("ann", 2, 2, 1.0), ("bob", 2, 3, 2 / 3)]
    assert sum(x.meeting_count for x in r.weekly_trend(month).collect()) == 5


def test_empty_month(mart):
    empty = month_slice(mart, "2030-05-01")
    k = r.booking_kpis(r.cost_per_booking(empty)).first()
    assert (k.total_bookings, k.total_spend, k.average_cpb, k.weighted_cpb) == (0, 0.0, None, None)
    assert k.total_spend_text == "$0"
    assert rows(r.meeting_kpis(r.meeting_load(empty))) == [(0, None, None)]
    for report in (r.daily_bookings, r.cost_per_booking, r.hour_weekday, r.meeting_load, r.weekly_trend):
        assert report(empty).count() == 0


def test_week_start_orders_the_turn_of_the_year(frame):
    days = ["2024-12-29T10:00:00Z", "2024-12-31T10:00:00Z"]
    mart = booking_mart(frame([(d, d, "a", d, "fb", "ann", 1.0) for d in days], DDL))
    trend = r.weekly_trend_by_start(month_slice(mart, "2024-12-05")).orderBy("week_start")
    assert [x.week for x in trend.collect()] == [52, 1]


def test_sorted_by(month):
    costs = r.cost_per_booking(month)
    assert [x.channel for x in r.sorted_by(costs, "Average_CPB").collect()] == ["yt", "fb"]
    assert [x.channel for x in r.sorted_by(costs, "channel", ascending=False).collect()] == ["yt", "fb"]


def test_dashboard_equals_single_reports(mart, month):
    board = r.dashboard(mart, "2024-01-20")
    daily, costs = r.daily_bookings(month), r.cost_per_booking(month)
    volume, load = r.hour_weekday(month), r.meeting_load(month)
    singles = {
        "daily_bookings": daily, "cost_per_booking": costs, "booking_kpis": r.booking_kpis(costs),
        "cumulative_bookings": r.cumulative_bookings(daily), "heatmap": r.heatmap(volume),
        "bookings_by_hour": r.bookings_by_hour(volume), "bookings_by_weekday": r.bookings_by_weekday(volume),
        "meeting_load": load, "meeting_kpis": r.meeting_kpis(load), "weekly_trend": r.weekly_trend(month),
    }
    assert set(board) == {"cube", *singles}
    for name, single in singles.items():
        assert sorted(map(repr, board[name].collect())) == sorted(map(repr, single.collect())), name
        assert board[name].columns == single.columns
    board["cube"].unpersist()


def test_refresh_mart_replaces_and_counts(spark, frame, folder):
    path = folder("mart")
    frame(ROWS, DDL).createOrReplaceTempView("marketing_small")
    assert refresh_mart(spark, path, "marketing_small") == len(ROWS)
    frame(ROWS[:3], DDL).createOrReplaceTempView("marketing_small")
    assert refresh_mart(spark, path, "marketing_small") == 3
    assert dict(tables.load_mart(spark, path).dtypes)["booking_date"] == "date"
