"""Reports on the bookings mart.

Each report takes the month slice (see ``operators.filters.month_slice``) or, for a whole
dashboard, the much smaller cube of it. They group first and name weekdays, shares and ratios on
the handful of grouped rows; partial aggregation makes a hot channel or employee one row per
task. Rows with a null group key are left out, and null ids are not counted.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from millrace.functions import dates, numbers, text
from millrace.operators.filters import month_slice
from millrace.schemas import WEEKDAYS
from millrace.session import checkpointed


class Measures(NamedTuple):
    """How to add up bookings, meetings and spend of an input."""

    bookings: Column
    meetings: Column
    spend: Column


def row_measures() -> Measures:
    """One input row per booking."""
    return Measures(F.count("invitee_id"), F.count("booking_id"), numbers.money_sum(F.col("spend")))


def cube_measures() -> Measures:
    """Input from ``booking_cube``."""
    return Measures(F.sum("bookings"), F.sum("meetings"), F.sum("spend"))


CUBE_KEYS = ["booking_date", "hour", "day_of_week", "week", "channel", "employee_name"]


def booking_cube(bookings: DataFrame) -> DataFrame:
    """Additive figures per day, hour, channel and employee: all that the reports need.

    Its size is set by the calendar, the channels and the staff, not by the bookings.
    """
    rows = row_measures()
    return bookings.groupBy(*CUBE_KEYS).agg(
        rows.bookings.alias("bookings"), rows.meetings.alias("meetings"), rows.spend.alias("spend")
    )


def daily_bookings(source: DataFrame, measures: Measures | None = None) -> DataFrame:
    """Bookings per day and channel."""
    m = measures or row_measures()
    known = source.where(F.col("booking_date").isNotNull() & F.col("channel").isNotNull())
    return known.groupBy("booking_date", "channel").agg(m.bookings.alias("bookings"))


def cost_per_booking(source: DataFrame, measures: Measures | None = None) -> DataFrame:
    """Spend, calls and their ratio per channel; a day's spend counts once per booking."""
    m = measures or row_measures()
    grouped = (
        source.where(F.col("channel").isNotNull())
        .groupBy("channel")
        .agg(m.spend.cast("double").alias("total_spend"), m.bookings.alias("booked_calls"))
    )
    return _with_cpb(grouped)


def _with_cpb(grouped: DataFrame) -> DataFrame:
    return grouped.withColumn(
        "Average_CPB", numbers.ratio(F.col("total_spend"), F.col("booked_calls"))
    )


def cost_per_booking_once(bookings: DataFrame, spend_day: str = "booking_date") -> DataFrame:
    """``cost_per_booking`` with each channel's spend counted once per ``spend_day``."""
    daily = (
        bookings.where(F.col("channel").isNotNull())
        .groupBy("channel", spend_day)
        .agg(F.max("spend").alias("spend"), F.count("invitee_id").alias("calls"))
    )
    grouped = daily.groupBy("channel").agg(
        numbers.money_sum(F.col("spend")).cast("double").alias("total_spend"),
        F.sum("calls").alias("booked_calls"),
    )
    return _with_cpb(grouped)


def sorted_by(report: DataFrame, column: str, ascending: bool = True) -> DataFrame:
    """A report in the order the reader picked."""
    return report.orderBy(F.col(column).asc() if ascending else F.col(column).desc())


def booking_kpis(costs: DataFrame) -> DataFrame:
    """Totals over the channels of ``cost_per_booking``, as numbers and as text.

    ``average_cpb`` is the plain mean of the channels' ratios; ``weighted_cpb`` is total spend
    over total calls.
    """
    spend = F.coalesce(F.sum(F.col("total_spend").cast(numbers.MONEY)).cast("double"), F.lit(0.0))
    calls = F.coalesce(F.sum("booked_calls"), F.lit(0))
    totals = costs.agg(
        calls.alias("total_bookings"),
        spend.alias("total_spend"),
        F.avg("Average_CPB").alias("average_cpb"),
    )
    return totals.select(
        "*",
        numbers.ratio(F.col("total_spend"), F.col("total_bookings")).alias("weighted_cpb"),
        F.col("total_bookings").cast("string").alias("total_bookings_text"),
        text.money_text(F.col("total_spend"), 0).alias("total_spend_text"),
        text.money_text(F.col("average_cpb"), 2).alias("average_cpb_text"),
    )


def cumulative_bookings(daily: DataFrame) -> DataFrame:
    """Running total of ``daily_bookings`` per channel; a channel has one row per day at most."""
    so_far = (
        Window.partitionBy("channel")
        .orderBy("booking_date")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return daily.withColumn("cumulative_bookings", F.sum("bookings").over(so_far))


def hour_weekday(source: DataFrame, measures: Measures | None = None) -> DataFrame:
    """Bookings per hour and weekday, whatever their channel."""
    m = measures or row_measures()
    known = source.where(F.col("hour").isNotNull() & F.col("day_of_week").isNotNull())
    return known.groupBy("hour", "day_of_week").agg(m.bookings.alias("booking_count"))


def heatmap(volume: DataFrame) -> DataFrame:
    """``hour_weekday`` with one column per weekday, alphabetical; null where nothing was booked."""
    return volume.groupBy("hour").agg(
        *[
            F.sum(F.when(F.col("day_of_week") == day, F.col("booking_count"))).alias(day)
            for day in sorted(WEEKDAYS)
        ]
    )


def bookings_by_hour(volume: DataFrame) -> DataFrame:
    """``hour_weekday`` added up per hour."""
    return volume.groupBy("hour").agg(F.sum("booking_count").alias("booking_count"))


def bookings_by_weekday(volume: DataFrame) -> DataFrame:
    """``hour_weekday`` added up per weekday, with the share of all; seven rows at most."""
    days = volume.groupBy("day_of_week").agg(F.sum("booking_count").alias("booking_count"))
    everything = Window.partitionBy(F.lit(0))
    share = numbers.ratio(F.col("booking_count"), F.sum("booking_count").over(everything))
    return days.withColumn("share", share)


def weekly_trend(source: DataFrame, measures: Measures | None = None) -> DataFrame:
    """Meetings per employee and ISO week."""
    m = measures or row_measures()
    known = source.where(F.col("employee_name").isNotNull() & F.col("week").isNotNull())
    return known.groupBy("employee_name", "week").agg(m.meetings.alias("meeting_count"))


def weekly_trend_by_start(bookings: DataFrame) -> DataFrame:
    """``weekly_trend`` with the Monday of each week, which orders across a year's turn."""
    known = bookings.where(F.col("employee_name").isNotNull() & F.col("booking_date").isNotNull())
    return known.groupBy(
        "employee_name", "week", dates.week_start(F.col("booking_date")).alias("week_start")
    ).agg(F.count("booking_id").alias("meeting_count"))


def meeting_load(source: DataFrame, measures: Measures | None = None) -> DataFrame:
    """Meetings, distinct weeks and meetings per week of each employee.

    Grouped by week first, so that distinct weeks are counted on one row per week.
    """
    m = measures or row_measures()
    by_week = (
        source.where(F.col("employee_name").isNotNull())
        .groupBy("employee_name", "week")
        .agg(m.meetings.alias("meetings"))
    )
    load = by_week.groupBy("employee_name").agg(
        F.sum("meetings").alias("meeting_count"), F.count("week").alias("week_count")
    )
    return _with_weekly_mean(load)


def _with_weekly_mean(load: DataFrame) -> DataFrame:
    mean = numbers.ratio(F.col("meeting_count"), F.col("week_count"))
    return load.withColumn("avg_meeting_per_week", mean)


def meeting_load_distinct(bookings: DataFrame) -> DataFrame:
    """``meeting_load`` that counts a meeting once, however many invitees it has.

    Spark groups by the distinct values first, so no task holds the set of an employee's meetings.
    """
    load = (
        bookings.where(F.col("employee_name").isNotNull())
        .groupBy("employee_name")
        .agg(
            F.countDistinct("booking_id").alias("meeting_count"),
            F.countDistinct("week").alias("week_count"),
        )
    )
    return _with_weekly_mean(load)


def numbered_meetings(bookings: DataFrame) -> DataFrame:
    """``booking_id`` and a number for each, side by side for meetings of one employee and week.

    Numbers run on within a task, so bitmaps of them are dense. They are written, for a number must stay the same if an executor is lost.
    """
    of = bookings.where(F.col("employee_name").isNotNull() & F.col("booking_id").isNotNull())
    ids = of.groupBy("booking_id").agg(F.min("employee_name").alias("_by"), F.min("week").alias("_week"))
    order = ["_by", "_week", "booking_id"]
    placed = ids.repartitionByRange(*order).sortWithinPartitions(*order)
    return checkpointed(placed.select("booking_id", F.monotonically_increasing_id().alias("number")))


def meeting_cube(bookings: DataFrame) -> DataFrame:
    """Meetings of each employee and week as bitmaps, from which any union of them is counted exactly.

    Its size is set by the calendar and the staff, and a bit for each meeting. Meetings without an id leave a row without bits.
    """
    known = bookings.where(F.col("employee_name").isNotNull()).select("employee_name", "week", "booking_id").distinct()
    numbered = known.join(numbered_meetings(bookings), "booking_id", "left")
    return numbered.groupBy("employee_name", "week", F.bitmap_bucket_number("number").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("number")).alias("meetings")
    )


def meeting_load_of_cube(cube: DataFrame) -> DataFrame:
    """``meeting_load_distinct`` from ``meeting_cube`` alone."""
    # bitmaps of a bucket are put together; a week is in the cube once for each bucket
    joined = cube.groupBy("employee_name", "bucket").agg(F.bitmap_or_agg("meetings").alias("meetings"))
    meetings = joined.groupBy("employee_name").agg(F.sum(F.bitmap_count("meetings")).alias("meeting_count"))
    weeks = cube.groupBy("employee_name").agg(F.countDistinct("week").alias("week_count"))
    return _with_weekly_mean(meetings.join(weeks, "employee_name"))


def meeting_kpis(load: DataFrame) -> DataFrame:
    """Total, least and most meetings over the employees of ``meeting_load``."""
    return load.agg(
        F.coalesce(F.sum("meeting_count"), F.lit(0)).alias("total_meetings"),
        F.min("meeting_count").alias("min_meetings"),
        F.max("meeting_count").alias("max_meetings"),
    )


def dashboard(
    mart: DataFrame, as_of: date | str | None = None, prepare: Callable[[DataFrame], DataFrame] | None = None
) -> dict[str, DataFrame]:
    """All reports of a month, in reading order, from one pass over the mart.

    The cube is cached for the ten reports; call ``unpersist`` on ``cube`` when done.
    ``prepare`` may change the slice first, for example to filter it.
    """
    month = month_slice(mart, as_of)
    cube = booking_cube(prepare(month) if prepare else month).cache()
    m = cube_measures()
    daily = daily_bookings(cube, m)
    costs = cost_per_booking(cube, m)
    volume = hour_weekday(cube, m)
    load = meeting_load(cube, m)
    return {
        "cube": cube,
        "daily_bookings": daily.orderBy("booking_date", "channel"),
        "cost_per_booking": costs.orderBy("channel"),
        "booking_kpis": booking_kpis(costs),
        "cumulative_bookings": cumulative_bookings(daily).orderBy("booking_date", "channel"),
        "heatmap": heatmap(volume).orderBy("hour"),
        "bookings_by_hour": bookings_by_hour(volume).orderBy("hour"),
        "bookings_by_weekday": bookings_by_weekday(volume).orderBy("day_of_week"),
        "meeting_load": load.orderBy("employee_name"),
        "meeting_kpis": meeting_kpis(load),
        "weekly_trend": weekly_trend(cube, m).orderBy("employee_name", "week"),
    }
