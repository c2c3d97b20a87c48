"""Meeting bookings: bronze documents -> silver -> gold with spend -> mart."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions import dates, documents, text
from millrace.operators.joins import insert_if_absent, lookup_join
from millrace.operators.required import Split, split_required
from millrace.plans.leads import first_arrival
from millrace.schemas import ARRIVAL, BOOKING_GOLD, BOOKING_SILVER, CHANNELS
from millrace.sources import tables

_DOC = "__doc"
FLAT = "flat"
_EVENT = "payload.scheduled_event"
_HOST = f"{_EVENT}.event_memberships[0]"

# What is read of a payload, in one pass over it: a path of its own for each field would go through the document from its root again.
_PAYLOAD = (
    "struct<uri string, email string, name string, status string, created_at string, tracking variant, scheduled_event struct<"
    "uri string, start_time string, end_time string, name string, event_type string, "
    "event_memberships array<struct<user_email string, user_name string>>>>"
)
_READ = "__payload"

# Flat column -> where it stands in the document. Of an address the last segment is taken.
_ADDRESSES = {
    "invitee_id": "payload.uri",
    "booking_id": f"{_EVENT}.uri",
    "event_type_id": f"{_EVENT}.event_type",
}
_COPIES = {
    "email": "payload.email",
    "name": "payload.name",
    "status": "payload.status",
    "booking_created_at": "payload.created_at",
    "start_time": f"{_EVENT}.start_time",
    "end_time": f"{_EVENT}.end_time",
    "event_name": f"{_EVENT}.name",
    "employee_email": f"{_HOST}.user_email",
    "employee_name": f"{_HOST}.user_name",
}
_TRACKING = "payload.tracking"


def _flat(payload: Column) -> Column:
    columns = {n: text.last_segment(documents.inside(payload, path, "payload")) for n, path in _ADDRESSES.items()}
    columns |= {n: documents.inside(payload, path, "payload") for n, path in _COPIES.items()}
    columns["campaign"] = documents.field(payload["tracking"], "utm_campaign")
    return F.struct(*[c.alias(n) for n, c in columns.items()])


def _rules(doc: Column, payload: Column, flat: str) -> dict[str, Column]:
    """What a booking document must hold.

    A field that is only copied has to be present but may be a JSON null; one that is cut or
    looked into has to have a value. The campaign is optional. Presence is looked up in the
    document only where the flat value is null.
    """
    rules = {"body": doc.isNotNull()}
    rules |= {path: F.col(f"{flat}.{n}").isNotNull() for n, path in _ADDRESSES.items()}
    rules[_TRACKING] = payload["tracking"].isNotNull() & ~F.is_variant_null(payload["tracking"])
    rules |= {
        path: F.col(f"{flat}.{n}").isNotNull() | documents.has_key(doc, path)
        for n, path in _COPIES.items()
    }
    return rules


def booking_silver(bronze: DataFrame, channels: Mapping[str, str] = CHANNELS) -> Split:
    """Flat bookings out of bronze ``body`` documents, and the documents that lack a field.

    Other columns of ``bronze``, such as arrival times, are carried along. The judged rows, from one parse, are the columns of ``bronze``,
    ``flat`` with the fields of the document, and the reasons.
    """
    kept = [c for c in bronze.columns if c not in ("body", *BOOKING_SILVER)]
    parsed = documents.with_parsed(bronze, "body", _DOC)
    parsed = documents.with_once(parsed, _READ, documents.field(F.col(_DOC), "payload", _PAYLOAD))
    parsed = documents.with_once(parsed, FLAT, _flat(F.col(_READ)))
    judged = split_required(parsed, _rules(F.col(_DOC), F.col(_READ), FLAT)).judged.drop(_DOC, _READ)

    def valid(rows: DataFrame) -> DataFrame:
        channel = documents.lookup(F.col("event_type_id"), dict(channels))
        return rows.select(*kept, f"{FLAT}.*").withColumn("channel", channel).select(*BOOKING_SILVER, *kept)

    return Split(judged, valid, lambda rows: rows.drop(FLAT))


def first_spend(spend: DataFrame, position: tuple[str, ...] = ("file_path", "pos")) -> DataFrame:
    """The first spend row of each channel and day, in file and array order.

    An aggregate, not a sort: there are few channels and days, however many rows they have.
    """
    order = [c for c in position if c in spend.columns]
    first = F.min_by("spend", order[0] if len(order) == 1 else F.struct(*order))
    return spend.groupBy("channel", "date").agg(first.alias("spend"))


def with_spend(
    bookings: DataFrame,
    spend: DataFrame,
    as_of: date | str | None = None,
    spend_on: str = "processing_day",
    keep_day: bool = False,
    **limits,
) -> DataFrame:
    """Bookings with their channel's spend of the day before; null when there is none.

    The day is the day before ``as_of``, or with ``spend_on='booking_date'`` the day before each
    meeting starts. ``keep_day`` leaves that day in the result as ``spend_date``.
    """
    if spend_on == "processing_day":
        day = dates.day_before(as_of)
        # one day of spend is all this join can meet
        spend = spend.where(F.col("date") == dates.day_text(day))
    elif spend_on == "booking_date":
        day = F.date_sub(F.to_date(F.col("start_time")), 1)
    else:
        raise ValueError(f"unknown spend_on: {spend_on}")
    daily = first_spend(spend).withColumnRenamed("date", "spend_date")
    dated = bookings.withColumn("spend_date", dates.day_text(day))
    joined = lookup_join(dated, daily, ["channel", "spend_date"], **limits)
    return joined if keep_day else joined.drop("spend_date")


def booking_gold(silver: DataFrame, spend: DataFrame, as_of: date | str | None = None, **options) -> DataFrame:
    """The 15 gold columns, then whatever else ``silver`` carries."""
    joined = with_spend(silver, spend, as_of, **options)
    return joined.select(*BOOKING_GOLD, *[c for c in joined.columns if c not in BOOKING_GOLD])


def load_bookings(new: DataFrame, target: DataFrame, loaded_at: Column | None = None) -> DataFrame:
    """Gold rows that a warehouse table lacks, the first to arrive of each booking, stamped with the load time.

    The stamp is ``loaded_at``, else the arrival of the row, which a replay does not change.
    """
    order = first_arrival(new, [c for c in new.columns if c not in ARRIVAL])
    rows = insert_if_absent(new, target, "invitee_id", order)
    arrived = F.col("ingest_ts") if "ingest_ts" in new.columns else F.current_timestamp()
    return rows.withColumn("inserted_at", arrived if loaded_at is None else loaded_at)


def booking_mart(marketing: DataFrame) -> DataFrame:
    """``marketing`` with the start as a timestamp and its four calendar columns."""
    start = F.col("start_time")
    if marketing.schema["start_time"].dataType.simpleString() == "string":
        start = dates.to_timestamp(start)
    timed = marketing.withColumn("start_time", start)
    return timed.withColumns(dates.calendar_columns(F.col("start_time")))


def refresh_mart(spark: SparkSession, path: str, table: str = "marketing") -> int:
    """Bring the mart up to the catalog table, writing only days that changed; returns the rows it has now."""
    return refresh_by_day(spark, path, table).rows


def refresh_by_day(spark: SparkSession, path: str, table: str = "marketing") -> tables.Refresh:
    """The same; returns also which booking days were written and which are gone."""
    return tables.refresh_days(booking_mart(tables.marketing_table(spark, table)), path, "booking_date")
