"""Video statistics: landed pages -> bronze -> silver -> gold, by ingest day."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions import dates
from millrace.operators.dedup import dedup_by, latest_per_key
from millrace.operators.filters import of_media, recent_visitors, since_yesterday
from millrace.operators.joins import lookup_join, skew_left_join
from millrace.schemas import MEDIA_STATS, VIDEO_EVENTS, VIDEO_GOLD, VIDEO_KEYS, VIDEO_SCHEMAS, VISITORS
from millrace.sources import landing, tables

def bronze_events(
    pages: DataFrame, as_of: date | str | None, media: Iterable[str] | DataFrame | None = None
) -> DataFrame:
    """Events of all landed pages since yesterday, for the wanted media."""
    return recent_media(landing.feed_rows(pages, VIDEO_EVENTS), "received_at", as_of, media)


def recent_media(
    rows: DataFrame, time: str, as_of: date | str | None, media: Iterable[str] | DataFrame | None = None
) -> DataFrame:
    """Rows since yesterday, for the wanted media."""
    rows = since_yesterday(rows, time, as_of)
    return rows if media is None else of_media(rows, media)


def bronze_stats(
    pages: DataFrame, as_of: date | str | None, media: Iterable[str] | DataFrame | None = None
) -> DataFrame:
    """Daily media figures since yesterday; ``pages`` carries the ``media_id`` of each page."""
    rows = landing.media_feed_rows(pages, MEDIA_STATS, F.col("media_id"))
    return recent_media(rows, "date", as_of, media)


def bronze_visitors(pages: DataFrame, as_of: date | str | None) -> DataFrame:
    """Recently created visitors of all landed pages, in whatever order the pages come."""
    return recent_visitors(landing.feed_rows(pages, VISITORS), as_of)


def ingest(
    spark: SparkSession,
    landed: str,
    bronze: str,
    day: date | str,
    media: Iterable[str] | DataFrame | None = None,
) -> list[str]:
    """The day's landed pages of every feed to bronze; returns the tables written.

    Pages lie under ``landed/<table>/ingest_date=<day>``, those of the daily figures one level
    deeper under ``media_id=<id>``. A feed without pages is skipped. Pages that are no JSON arrays
    go to ``bronze/bad_pages``, elements that break a rule to ``bronze/bad_rows``, both with the reasons.
    Pages are read and parsed once: the judged elements are held on the executors' disks while the three are written.
    """
    recent = {
        "visitors": lambda rows: recent_visitors(rows, day),
        "events": lambda rows: recent_media(rows, "received_at", day, media),
        "media_stats": lambda rows: recent_media(rows, "date", day, media),
    }
    written = []
    for table, rows_of in recent.items():
        schema = VIDEO_SCHEMAS[table]
        if table == "media_stats":
            schema = T.StructType([f for f in schema if f.name != "media_id"])
        folder = f"{landed}/{table}/{tables.DAY}={day}"
        pages = tables.if_present(lambda: landing.read_pages(spark, folder))
        if pages is None:
            continue
        with landing.split_landed(pages, schema).on_disk() as split:
            broken = tables.with_day(split.quarantine.withColumn("feed", F.lit(table)), day)
            for name, kept, column in (("bad_pages", "body is not null", "body"), ("bad_rows", "body is null", "element")):
                bad = broken.where(kept).select(column, "reasons", "feed", tables.DAY)
                tables.write_layer(bad, f"{bronze}/{name}", [tables.DAY, "feed"])
            if write_bronze(rows_of(split.valid).select(*VIDEO_SCHEMAS[table].names), bronze, table, day):
                written.append(table)
    return written


def write_bronze(rows: DataFrame, root: str, table: str, day: date | str) -> bool:
    """Replace the day's rows of one table, in folders by media; False when there are none.

    The folder column is a copy: a folder name cannot tell an empty id from a missing one.
    """
    some = tables.has_rows(rows)
    if table == "visitors":
        tables.write_day(rows, f"{root}/{table}", day)
    else:
        tables.write_day(rows.withColumn("media", F.col("media_id")), f"{root}/{table}", day, by=["media"])
    return some


def write_silver(spark: SparkSession, bronze: str, silver: str, day: date | str) -> list[str]:
    """Bronze day to silver day for every table, one row per business key.

    A table without bronze rows has none for the day. Returns the tables with rows.
    """
    written = []
    for table, keys in VIDEO_KEYS.items():
        rows = tables.read_day(spark, f"{bronze}/{table}", day, VIDEO_SCHEMAS[table])
        tables.write_day(rows.transform(dedup_by(keys)), f"{silver}/{table}", day)
        if tables.has_rows(rows):
            written.append(table)
    return written


def read_silver(spark: SparkSession, silver: str, day: date | str) -> dict[str, DataFrame]:
    """The three silver tables of a day; a missing one is empty."""
    return {
        table: tables.read_day(spark, f"{silver}/{table}", day, schema)
        for table, schema in VIDEO_SCHEMAS.items()
    }


def with_event_day(events: DataFrame) -> DataFrame:
    return events.withColumn("event_date", dates.to_day(F.col("received_at")))


def visitors_with_events(visitors: DataFrame, events: DataFrame) -> DataFrame:
    """Every visitor with each of its events, or with nulls."""
    return skew_left_join(visitors, events, ["visitor_key"])


def events_with_stats(events: DataFrame, stats: DataFrame, **limits) -> DataFrame:
    """Events with the figures of their media and day; needs ``event_date``.

    Adds ``date``, the stats side's own day text and null on a miss, and ``hours_watched``.
    """
    figures = stats.select(
        "media_id", dates.to_day(F.col("date")).alias("event_date"), "date", "hours_watched"
    )
    return lookup_join(events, figures, ["media_id", "event_date"], **limits)


def video_gold(visitors: DataFrame, events: DataFrame, stats: DataFrame) -> DataFrame:
    """Visitors x events x daily media figures: 14 columns and ``event_date``.

    Figures are attached to the events before the visitors are. The result is the same, as the
    figures' keys come from the event, and rows that have no event never enter that join.
    """
    enriched = events_with_stats(with_event_day(events), stats)
    joined = skew_left_join(
        visitors.select("visitor_key", "created_at", "load_count", "play_count"),
        enriched,
        ["visitor_key"],
        # who has events is told by the events, before the figures are joined to them
        present=events,
    )
    return joined.select(*VIDEO_GOLD, "event_date")


def write_gold(spark: SparkSession, silver: str, gold: str, day: date | str) -> list[str]:
    """Gold of a day, as that day of three tables. Without events, visitors and figures are kept instead.

    All three are replaced for the day, so none keeps what an earlier run left; other days stay as they are.
    """
    parts = read_silver(spark, silver, day)
    some = tables.has_rows(parts["events"])
    joined = video_gold(parts["visitors"], parts["events"], parts["media_stats"])
    tables.write_day(joined if some else joined.limit(0), f"{gold}/engagement", day)
    for table in ("visitors", "media_stats"):
        tables.write_day(parts[table].limit(0) if some else parts[table], f"{gold}/{table}", day)
    return ["engagement"] if some else ["visitors", "media_stats"]


def history(spark: SparkSession, layer: str, table: str) -> DataFrame:
    """All ingest days of a layer table as one, the latest day's row for each business key."""
    rows = spark.read.parquet(f"{layer}/{table}")
    return across_days(rows, VIDEO_KEYS[table])


def across_days(rows: DataFrame, keys: list[str]) -> DataFrame:
    others = [c for c in sorted(rows.columns) if c not in (*keys, tables.DAY)]
    return latest_per_key(rows, keys, [tables.DAY, *others])
