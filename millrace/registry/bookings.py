"""Booking documents, lookups and load."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.functions import documents
from millrace.operators.joins import docs_for_keys, insert_if_absent
from millrace.plans import bookings as b
from millrace.registry.views import (
    AS_OF, BOOKINGS_SQL, CHANNEL_OF, CHANNEL_SQL, MART_SQL, SPEND_SQL, booking_body, marketing, scratch,
    spend, table,
)
from millrace.schemas import BOOKING_SILVER
from millrace.sources import landing, tables


def _bronze(spark, d):
    return table(spark, d, "events").select(booking_body().alias("body"))


def booking_flatten(spark, d):
    return b.booking_silver(_bronze(spark, d), CHANNEL_OF).valid


def landing_files(spark, d):
    """Booking documents by way of a landing folder of text files, one document per line."""
    path = scratch(spark, "landing")
    _bronze(spark, d).write.text(path)
    landed = landing.bodies(spark, path, whole_files=False)
    bronze = landing.bronze_rows(landed, landing.invitee_id_of(F.col("body")))
    return b.booking_silver(bronze, CHANNEL_OF).valid.select("doc_id", *BOOKING_SILVER)


def json_export(spark, d):
    """Gold as JSON lines, read back: nulls are written out, so each line has every field."""
    path = scratch(spark, "export")
    rows = marketing(spark, d).select("invitee_id", "channel", "spend")
    tables.write_json(rows, path)
    doc = F.col("doc")
    lines = documents.with_parsed(spark.read.text(path), "value", "doc")
    return lines.select(
        documents.field(doc, "invitee_id").alias("invitee_id"),
        documents.field(doc, "channel").alias("channel"),
        documents.field(doc, "spend", "double").alias("spend"),
        (documents.has_key(doc, "channel") & documents.has_key(doc, "spend")).alias("whole"),
    )


def required_fields_split(spark, d):
    """Bookings without a host are set aside with the two fields they lack; documents are read and parsed once."""
    judged = b.booking_silver(_bronze(spark, d), CHANNEL_OF).judged
    return judged.select(
        "flat.invitee_id",
        F.when(F.col("reasons").isNull(), "valid").otherwise("quarantine").alias("side"),
        F.coalesce(F.array_join("reasons", " "), F.lit("")).alias("reasons"),
    )


def booking_gold(spark, d):
    """Documents to gold with the spend of the day before processing."""
    silver = b.booking_silver(_bronze(spark, d), CHANNEL_OF).valid
    return b.booking_gold(silver, spend(spark, d), AS_OF)


def spend_first_match(spark, d):
    """Spend of the day before each meeting; the first row of that day and channel."""
    rows = marketing(spark, d).drop("spend")
    return b.with_spend(rows, spend(spark, d), spend_on="booking_date", keep_day=True).select(
        "invitee_id", "channel", "spend_date", "spend"
    )


def first_spend(spark, d):
    return b.first_spend(spend(spark, d))


def spend_files(spark, d):
    """A spend file per event, read as JSON arrays with their positions."""
    one = F.struct("date", "channel", "spend")
    two = F.struct("date", F.lit("other").alias("channel"), F.col("pos").cast("string").alias("spend"))
    files = spend(spark, d).select(F.to_json(F.array(one, two)).alias("body"))
    return landing.spend_rows(files).select("pos", "date", "channel", "spend")


def spend_quarantine(spark, d):
    """Spend files of which some are cut off, some hold a word for a number, some a bare number among the objects."""
    rows = spend(spark, d).withColumn("file_path", F.col("pos").cast("string"))
    whole = F.to_json(F.array(F.struct("date", "channel", "spend")))
    wrong = F.to_json(F.array(F.struct("date", "channel", F.lit("much").alias("spend"))))
    kind = F.col("pos") % 4
    body = F.when(kind == 0, F.concat(F.lit("["), whole)).when(kind == 1, wrong).when(kind == 2, F.lit("[7]")).otherwise(whole)
    split = landing.split_spend(rows.select("file_path", body.alias("body")))
    good = split.valid.select("file_path", F.lit("").alias("reasons"), "spend")
    return good.unionByName(split.quarantine.select("file_path", F.array_join("reasons", " ").alias("reasons"), F.lit(None).cast("double").alias("spend")))


def channel_lookup(spark, d):
    return table(spark, d, "events").select(
        "event_id", documents.lookup(F.col("event_type"), CHANNEL_OF).alias("channel")
    )


def insert_if_absent_orders(spark, d):
    """Orders that have no returned line: the target holds the returned ones, many times."""
    target = table(spark, d, "lineitem").where("l_returnflag = 'R'").select(
        F.col("l_orderkey").alias("o_orderkey")
    )
    return insert_if_absent(table(spark, d, "orders"), target, "o_orderkey")


def load_bookings(spark, d):
    """Line items as bookings by order and line, into a table that holds the returned ones."""
    new = table(spark, d, "lineitem").select(
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("invitee_id"), "l_partkey", "l_suppkey"
    )
    target = table(spark, d, "lineitem").where("l_returnflag = 'R'").select(
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("invitee_id")
    )
    return b.load_bookings(new, target, F.lit("2024-01-15 00:00:00").cast("timestamp_ntz"))


def point_read(spark, d):
    """Documents that have a label, read by key."""
    docs = table(spark, d, "documents").select("doc_id", F.md5("text").alias("text_md5"))
    return docs_for_keys(table(spark, d, "labels"), docs, "doc_id")


QUERIES = {
    "booking_flatten": (
        booking_flatten, f"WITH {BOOKINGS_SQL} SELECT {', '.join(BOOKING_SILVER)} FROM bookings"
    ),
    "landing_files": (
        landing_files,
        f"WITH {BOOKINGS_SQL} SELECT invitee_id AS doc_id, {', '.join(BOOKING_SILVER)} FROM bookings",
    ),
    "json_export": (
        json_export, f"WITH {MART_SQL} SELECT invitee_id, channel, spend, true AS whole FROM mart"
    ),
    "required_fields_split": (
        required_fields_split,
        """SELECT CAST(event_id AS VARCHAR) AS invitee_id,
          CASE WHEN event_type = 'error' THEN 'quarantine' ELSE 'valid' END AS side,
          CASE WHEN event_type = 'error' THEN
            'payload.scheduled_event.event_memberships[0].user_email '
            || 'payload.scheduled_event.event_memberships[0].user_name' ELSE '' END AS reasons
        FROM events""",
    ),
    "booking_gold": (
        booking_gold,
        f"""WITH {BOOKINGS_SQL}, {SPEND_SQL}
        SELECT b.* EXCLUDE (ts), s.spend FROM bookings b LEFT JOIN daily_spend s
        ON b.channel = s.channel AND s.date = '2024-01-14'""",
    ),
    "spend_first_match": (
        spend_first_match,
        f"""WITH {SPEND_SQL}, rows AS (
          SELECT CAST(event_id AS VARCHAR) AS invitee_id, {CHANNEL_SQL} AS channel,
            strftime(CAST(ts AS DATE) - 1, '%Y-%m-%d') AS spend_date FROM events)
        SELECT r.*, s.spend FROM rows r LEFT JOIN daily_spend s
        ON r.channel = s.channel AND r.spend_date = s.date""",
    ),
    "first_spend": (first_spend, f"WITH {SPEND_SQL} SELECT channel, date, spend FROM daily_spend"),
    "spend_files": (
        spend_files,
        f"""WITH {SPEND_SQL} SELECT 0 AS pos, date, channel, spend FROM spend_rows
        UNION ALL SELECT 1, date, 'other', CAST(pos AS DOUBLE) FROM spend_rows""",
    ),
    "spend_quarantine": (
        spend_quarantine,
        f"""WITH {SPEND_SQL} SELECT CAST(pos AS VARCHAR) AS file_path,
          CASE pos % 4 WHEN 0 THEN 'array objects numbers' WHEN 1 THEN 'numbers' WHEN 2 THEN 'objects numbers' ELSE '' END AS reasons,
          CASE WHEN pos % 4 = 3 THEN spend END AS spend FROM spend_rows""",
    ),
    "channel_lookup": (channel_lookup, f"SELECT event_id, {CHANNEL_SQL} AS channel FROM events"),
    "insert_if_absent": (
        insert_if_absent_orders,
        """SELECT * FROM orders o WHERE NOT EXISTS (
          SELECT 1 FROM lineitem l WHERE l.l_orderkey = o.o_orderkey AND l.l_returnflag = 'R')""",
    ),
    "load_bookings": (
        load_bookings,
        """WITH new AS (
          SELECT l_orderkey || '-' || l_linenumber AS invitee_id, l_partkey, l_suppkey FROM lineitem
          QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_partkey, l_suppkey) = 1)
        SELECT *, TIMESTAMP '2024-01-15 00:00:00' AS inserted_at FROM new
        WHERE invitee_id NOT IN (
          SELECT l_orderkey || '-' || l_linenumber FROM lineitem WHERE l_returnflag = 'R')""",
    ),
    "point_read": (
        point_read,
        """SELECT doc_id, md5(text) AS text_md5 FROM documents
        WHERE doc_id IN (SELECT doc_id FROM labels)""",
    ),
}
