"""Column functions on the values that set them apart from their near relatives."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from millrace.functions import dates, documents, numbers, text


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


@pytest.mark.parametrize(
    "url, segment", [("h/a/b", "b"), ("h/a/", ""), ("plain", "plain"), ("", ""), (None, None)]
)
def test_last_segment(spark, url, segment):
    assert one(spark, text.last_segment(F.lit(url).cast("string"))) == segment


@pytest.mark.parametrize(
    "raw, plain",
    [
        ("a%20b+c", "a b c"), ("100%", "100%"), ("%zz%41", "%zzA"), ("%C3%A9", "é"),
        ("%2B", "+"), ("%%41", "%A"), (None, None),
    ],
)
def test_unquote_plus(spark, raw, plain):
    assert one(spark, text.unquote_plus(F.lit(raw).cast("string"))) == plain


def test_unquote_leaves_plus(spark):
    assert one(spark, text.unquote(F.lit("a+b%20c%zz"))) == "a+b c%zz"


@pytest.mark.parametrize(
    "raw, cut",
    [
        ("2026-03-10T01:02:03.123456+00:00", "2026-03-10 01:02:03"),
        ("2026-03-10T01:02:03+00:00", "2026-03-10 01:02:03"),
        ("2026-03-10", "2026-03-10"),
        ("2026-03-10T01:02:03+02:00", "2026-03-10 01:02:03"),
    ],
)
def test_trim_timestamp(spark, raw, cut):
    assert one(spark, text.trim_timestamp(F.lit(raw))) == cut


def test_lead_message_writes_none(spark):
    message = text.lead_message(F.lit("Ann"), F.lit("a@b"), F.lit(None), F.lit("web"), F.lit(3))
    assert one(spark, message) == "New Lead: Ann | a@b | Owner: None | Funnel: web | Status: 3"


@pytest.mark.parametrize("amount", [0.0, 12345.5, 12346.5, 2.675, 0.125, 0.5, 1.5, -3.14159, 1e9])
@pytest.mark.parametrize("decimals", [0, 2])
def test_money_text_rounds_as_python(spark, amount, decimals):
    assert one(spark, text.money_text(F.lit(amount), decimals)) == f"${amount:,.{decimals}f}"


def test_object_key(spark):
    assert one(spark, text.object_key("gold/lead_", F.lit(7))) == "gold/lead_7.json"


def test_field_tells_null_from_absent(spark):
    doc = documents.parse(F.lit('{"a": {"b": null, "c": 1}}'))
    assert one(spark, documents.has_key(doc, "a.b")) is True
    assert one(spark, documents.has_value(doc, "a.b")) is False
    assert one(spark, documents.has_key(doc, "a.d")) is False
    assert one(spark, documents.field(doc, "a.c")) == "1"


def test_bad_json_parses_to_null(spark):
    assert one(spark, documents.parse(F.lit("{bad")).isNull())


def test_merge_right_wins_keeps_null(spark):
    left = documents.top_level(documents.parse(F.lit('{"a": 1, "b": 2, "n": {"x": [1]}}')))
    right = documents.top_level(documents.parse(F.lit('{"b": null, "c": "z"}')))
    merged = documents.merge_right_wins(left, right)
    import json

    assert json.loads(one(spark, F.to_json(merged))) == {"a": 1, "b": None, "n": {"x": [1]}, "c": "z"}


def test_json_text_writes_nulls(spark):
    row = documents.json_text(F.lit(1).alias("a"), F.lit(None).cast("string").alias("b"))
    assert one(spark, row) == '{"a":1,"b":null}'


def test_first_element_of_empty_array(spark):
    assert one(spark, documents.first_element(F.array().cast("array<int>"))) is None


@pytest.mark.parametrize("raw, value", [("0.5", 0.5), ("1", 1.0), (None, None)])
def test_number(spark, raw, value):
    assert one(spark, documents.number(F.lit(raw).cast("string"))) == value


@pytest.mark.parametrize("raw", ["2024-01-01T10:00:00Z", "2024-01-01T10:00:00.123456Z", "2024-01-01 10:00:00"])
def test_to_timestamp_takes_both_forms(spark, raw):
    assert one(spark, dates.to_timestamp(F.lit(raw))).hour == 10


@pytest.mark.parametrize(
    "raw, day",
    [("2024-02-03T23:59:00-05:00", dt.date(2024, 2, 3)), ("soon", None), (None, None), ("2024-02-03", dt.date(2024, 2, 3))],
)
def test_to_day(spark, raw, day):
    assert one(spark, dates.to_day(F.lit(raw).cast("string"))) == day


@pytest.mark.parametrize(
    "day, name, week", [("2024-12-30", "Monday", 1), ("2023-01-01", "Sunday", 52), ("2024-02-29", "Thursday", 9)]
)
def test_calendar_columns(spark, day, name, week):
    cols = dates.calendar_columns(F.lit(day + " 05:06:07").cast("timestamp"))
    row = spark.range(1).select(*[c.alias(n) for n, c in cols.items()]).first()
    assert (row.hour, row.day_of_week, row.week) == (5, name, week)
    assert row.booking_date == dt.date.fromisoformat(day)


def test_day_before_and_text(spark):
    assert one(spark, dates.day_text(dates.day_before("2024-03-01"))) == "2024-02-29"
    assert one(spark, dates.day_column(None)) == one(spark, F.current_date())


def test_ratio_by_zero_is_null(spark):
    assert one(spark, numbers.ratio(F.lit(1), F.lit(0))) is None


@pytest.mark.parametrize("raw, value", [(None, 0.0), (float("nan"), 0.0), (2.5, 2.5)])
def test_fill_zero(spark, raw, value):
    assert one(spark, numbers.fill_zero(F.lit(raw).cast("double"))) == value


def test_lookup_miss_is_null(spark):
    assert one(spark, documents.lookup(F.lit("q"), {"a": "b"})) is None
    assert one(spark, documents.lookup(F.lit("a"), {"a": "b"})) == "b"
