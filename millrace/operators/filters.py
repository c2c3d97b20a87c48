"""Row filters of the feeds and the reports."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions import dates, numbers
from millrace.operators.joins import keep_matching


def recent_visitors(visitors: DataFrame, as_of: date | str | None) -> DataFrame:
    """Visitors created yesterday or later.

    ISO-8601 text is not less than a day's text just if its leading day is not, and the bare column reaches the scan.
    """
    return since_yesterday(visitors, "created_at", as_of)


def since_yesterday(feed: DataFrame, column: str, as_of: date | str | None) -> DataFrame:
    """Feed rows from yesterday on.

    The column is ISO-8601 text, for which text order is time order, or a date or timestamp;
    either way the bare column is compared, so the bound reaches the scan.
    """
    since: Column = dates.day_before(as_of)
    if feed.schema[column].dataType.simpleString() == "string":
        since = dates.day_text(since)
    return feed.where(F.col(column) >= since)


def of_media(feed: DataFrame, media: Iterable[str] | DataFrame) -> DataFrame:
    """Feed rows of the wanted media: a short list, or a frame with ``media_id``."""
    if isinstance(media, DataFrame):
        return keep_matching(feed, media, "media_id")
    return feed.where(F.col("media_id").isin(*media))


def month_slice(
    mart: DataFrame, as_of: date | str | None, status: str | None = None
) -> DataFrame:
    """Bookings of the calendar month of ``as_of``, with missing spend as 0.

    ``status`` may keep one booking status; by default cancelled bookings count too.
    """
    kept = mart.where(dates.month_of(F.col("booking_date"), as_of))
    if status is not None:
        kept = kept.where(F.col("status") == status)
    return fill_spend(kept)


def fill_spend(mart: DataFrame) -> DataFrame:
    return mart.withColumn("spend", numbers.fill_zero(F.col("spend")))
