"""Fixed schemas, business keys and lookup values."""

from __future__ import annotations

from pyspark.sql import types as T


def _strings(*names: str) -> list[T.StructField]:
    return [T.StructField(name, T.StringType()) for name in names]


def _longs(*names: str) -> list[T.StructField]:
    return [T.StructField(name, T.LongType()) for name in names]


VIDEO_EVENTS = T.StructType(
    _strings("received_at", "event_key", "ip", "country", "region", "city")
    + [T.StructField("percent_viewed", T.DoubleType())]
    + _strings("visitor_key", "media_id", "media_name")
)

MEDIA_STATS = T.StructType(
    _strings("media_id", "date")
    + _longs("load_count", "play_count")
    + [T.StructField("hours_watched", T.DoubleType())]
)

VISITORS = T.StructType(
    _strings("visitor_key", "created_at", "last_active_at") + _longs("load_count", "play_count")
)

SPEND = T.StructType(_strings("date", "channel") + [T.StructField("spend", T.DoubleType())])

# Raw webhook bodies as they are kept in bronze.
BRONZE = T.StructType(
    _strings("doc_id", "body", "file_path")
    + [T.StructField("file_time", T.TimestampType()), T.StructField("ingest_ts", T.TimestampType())]
)

# Columns that say when a row arrived, oldest first. ``body`` settles what is left.
ARRIVAL = ["ingest_ts", "file_time", "file_path"]

VIDEO_SCHEMAS = {"visitors": VISITORS, "events": VIDEO_EVENTS, "media_stats": MEDIA_STATS}

# Business key of each video table.
VIDEO_KEYS = {
    "visitors": ["visitor_key"],
    "events": ["event_key"],
    "media_stats": ["media_id", "date"],
}

# Columns of the video gold table, in order.
VIDEO_GOLD = [
    "visitor_key", "created_at", "load_count", "play_count",
    "event_key", "ip", "country", "region", "city", "percent_viewed", "media_id", "media_name",
    "date", "hours_watched",
]

# Event type id of a booking -> advertising channel.
CHANNELS = {
    "d639ecd3-8718-4068-955a-436b10d72c78": "facebook_paid_ads",
    "dbb4ec50-38cd-4bcd-bbff-efb7b5a6f098": "youtube_paid_ads",
    "bb339e98-7a67-4af2-b584-8dbf95564312": "tiktok_paid_ads",
}

# Columns of a booking in silver; gold adds the spend.
BOOKING_SILVER = [
    "invitee_id", "email", "name", "status", "booking_created_at",
    "booking_id", "start_time", "end_time", "event_name", "event_type_id", "channel",
    "employee_email", "employee_name", "campaign",
]
BOOKING_GOLD = [*BOOKING_SILVER[:-1], "spend", "campaign"]

# Columns of a lead in gold, all required.
LEAD_GOLD = [
    "lead_id", "display_name", "lead_email", "lead_owner", "funnel", "status_label", "date_created",
]

# Weekday names, Monday first.
WEEKDAYS = ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"]
