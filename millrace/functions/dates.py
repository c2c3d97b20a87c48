"""Dates and times. Nothing here reads the clock unless ``as_of`` is left out."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F

from millrace.schemas import WEEKDAYS


def day_column(as_of: date | str | None) -> Column:
    """The processing day as a constant; today (session zone) when it is left out."""
    return F.current_date() if as_of is None else F.lit(str(as_of)).cast("date")


def day_before(as_of: date | str | None) -> Column:
    return F.date_sub(day_column(as_of), 1)


def day_text(day: Column) -> Column:
    return F.date_format(day, "yyyy-MM-dd")


def to_timestamp(text: Column) -> Column:
    """ISO-8601 text, with or without fractions and zone, to timestamp; bad text raises."""
    return F.to_timestamp(text)


def to_day(text: Column) -> Column:
    """Leading day of ISO-8601 text or of a timestamp; null when there is none."""
    return text.try_cast("date")


def weekday_name(day: Column) -> Column:
    """Full English weekday name."""
    return F.get(F.array(*[F.lit(name) for name in WEEKDAYS]), F.weekday(day))


def calendar_columns(start: Column) -> dict[str, Column]:
    """The four calendar columns of the bookings mart."""
    return {
        "booking_date": F.to_date(start),
        "hour": F.hour(start),
        "day_of_week": weekday_name(start),
        "week": F.weekofyear(start),
    }


def week_start(day: Column) -> Column:
    """Monday of the ISO week, to order weeks across a year's turn."""
    return F.trunc(day, "week")


def month_of(day: Column, as_of: date | str | None) -> Column:
    """True inside the calendar month of ``as_of``; a half-open range, so that it prunes."""
    first = F.trunc(day_column(as_of), "MM")
    return (day >= first) & (day < F.add_months(first, 1))
