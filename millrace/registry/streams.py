"""Streaming forms, run over all that has arrived and read back."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions import documents
from millrace.operators.joins import insert_if_absent
from millrace.registry.leads import GOLD_SQL
from millrace.registry.views import (
    AS_OF, BOOKINGS_SQL, CHANNEL_OF, SPEND_SQL, booking_body, lead_body, owners, scratch, spend, stream_table, table,
)
from millrace.schemas import BOOKING_GOLD, BRONZE, LEAD_GOLD
from millrace.sources import landing
from millrace.streaming import flows, keyed, runs

_FILE = ["file_path", "file_time"]
# Lines of an inbox file at most; each file is one task's.
INBOX_LINES = 250_000


def stream_upsert(spark, d):
    """Turns of a conversation as deliveries of one document; the last turn stands."""
    root = scratch(spark, "upsert")
    body = documents.json_text("conv_id", "turn", "role", "text")
    landed = stream_table(spark, d, "conversations").select(body.alias("body"), *_FILE)
    flows.land_bodies(landed, root, lambda b: documents.field(documents.parse(b), "conv_id"))

    def flatten(batch):
        doc = F.col("__doc")
        rows = documents.with_parsed(batch, "body", "__doc").select(
            documents.field(doc, "conv_id", "bigint").alias("conv_id"),
            documents.field(doc, "turn", "bigint").alias("turn"),
            documents.field(doc, "role").alias("role"),
            documents.field(doc, "text").alias("text"),
        )
        return {"silver": rows}

    runs.each_batch(runs.stream_log(spark, f"{root}/bronze", BRONZE), flatten, root, f"{root}/_checkpoints/silver")
    schema = T.StructType.fromDDL("conv_id bigint, turn bigint, role string, text string")
    log = runs.read_log(spark, f"{root}/silver", schema)
    return runs.latest(log, "conv_id", ["turn"]).drop(runs.BATCH)


def stream_enrich(spark, d):
    """Booking documents through bronze, silver and gold, joined to the spend table on the way."""
    root = scratch(spark, "bookings")
    landed = stream_table(spark, d, "events").select(booking_body().alias("body"), *_FILE)
    flows.run_bookings(spark, landed, root, spend(spark, d), AS_OF, channels=CHANNEL_OF)
    log = runs.read_log(spark, f"{root}/gold", flows.BOOKING_GOLD_LOG)
    return runs.latest(log, "invitee_id").select(*BOOKING_GOLD)


def _fill_inbox(spark, d, path):
    """Booking documents of all events as lines of an even number of files, which is returned: four, more for a large table."""
    rows = table(spark, d, "events")
    files = max(4, 2 * -(-rows.count() // (2 * INBOX_LINES)))
    # rows are dealt out before they become documents, which are several times as wide
    rows.repartition(files).select(booking_body().alias("body")).write.text(path)
    return files


def stream_files(spark, d):
    """Booking documents as lines of landed files, streamed file by file, archived, and current by keyed state."""
    root = scratch(spark, "files")
    files = _fill_inbox(spark, d, f"{root}/inbox")
    landed = landing.stream_bodies(spark, f"{root}/inbox", whole_files=False, files_per_batch=files // 2, archive=f"{root}/archive")
    flows.run_bookings(spark, landed, f"{root}/flow", spend(spark, d), AS_OF, channels=CHANNEL_OF)
    return flows.follow(spark, f"{root}/flow", "bookings").select(*BOOKING_GOLD)


def stream_bookings_warehouse(spark, d):
    """Every booking twice, first with its own documents and then again, to the table that takes each once."""
    root = scratch(spark, "bookings")
    landed = stream_table(spark, d, "events").select(booking_body().alias("body"), *_FILE)
    twice = landed.withColumn("file_path", F.explode(F.array(F.lit("1"), F.lit("2"))))
    flows.run_bookings(spark, twice, root, spend(spark, d), AS_OF, channels=CHANNEL_OF)
    rows = runs.read_log(spark, f"{root}/warehouse/marketing", flows.BOOKING_MARKETING)
    return rows.drop("inserted_at", runs.BATCH)


def _leads(spark, d):
    root = scratch(spark, "leads")
    landed = stream_table(spark, d, "documents").select(lead_body().alias("body"), *_FILE)
    flows.run_leads(spark, landed, root, owners(spark, d))
    return root


def stream_warehouse(spark, d):
    """Lead documents through every layer to the insert-if-absent table."""
    rows = runs.read_log(spark, f"{_leads(spark, d)}/warehouse", flows.LEAD_WAREHOUSE)
    return rows.select(
        *LEAD_GOLD[:-1], F.col(LEAD_GOLD[-1]).cast("timestamp_ntz").alias(LEAD_GOLD[-1])
    )


def stream_outbox(spark, d):
    """Messages of the leads that reached gold."""
    schema = T.StructType.fromDDL("lead_id string, text string, message string")
    return runs.read_log(spark, f"{_leads(spark, d)}/outbox", schema).drop(runs.BATCH)


def stream_current(spark, d):
    """Turns of a conversation in several micro-batches, every third one delivered again later, by keyed state."""
    root = scratch(spark, "current")
    rows = table(spark, d, "conversations").select("conv_id", "turn", "role", "text")
    rows.repartition(4).write.parquet(f"{root}/landed")
    rows.where("turn % 3 = 0").repartition(2).write.mode("append").parquet(f"{root}/landed")
    for files in (1, 2):  # stopped after some batches, then on to the end
        landed = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", files).parquet(f"{root}/landed")
        keyed.follow(landed, "conv_id", f"{root}/changes", f"{root}/_checkpoints/current", ["turn"])
    return keyed.current(spark, f"{root}/_checkpoints/current", rows.schema, "conv_id")


def load_indexed(spark, d):
    """Line items as deliveries of their order, one micro-batch for each line number, into a table that takes an order once.

    Each batch opens only the folders that may hold one of its orders; the last two are replayed.
    """
    root = scratch(spark, "indexed")
    rows = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")

    def insert(new, target):
        return insert_if_absent(new, target, "l_orderkey")

    for n in [*range(1, 8), 6, 7]:
        runs.insert_batch(rows.where(F.col("l_linenumber") == n), n, insert, root, rows.schema, "l_orderkey")
    rest = rows.where(~F.col("l_linenumber").between(1, 7) | F.col("l_linenumber").isNull())
    runs.insert_batch(rest, 8, insert, root, rows.schema, "l_orderkey")
    return runs.read_log(spark, root, rows.schema).drop(runs.BATCH)


QUERIES = {
    "stream_current": (
        stream_current,
        """SELECT conv_id, turn, role, text FROM conversations
        QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC, text DESC, role DESC) = 1""",
    ),
    "load_indexed": (
        load_indexed,
        """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM lineitem
        QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey) = 1""",
    ),
    "stream_upsert": (
        stream_upsert,
        """SELECT * FROM conversations
        QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC) = 1""",
    ),
    "stream_enrich": (
        stream_enrich,
        f"""WITH {BOOKINGS_SQL}, {SPEND_SQL}
        SELECT b.* EXCLUDE (ts), s.spend
        FROM bookings b LEFT JOIN daily_spend s ON b.channel = s.channel AND s.date = '2024-01-14'""",
    ),
    "stream_files": (
        stream_files,
        f"""WITH {BOOKINGS_SQL}, {SPEND_SQL}
        SELECT b.* EXCLUDE (ts), s.spend
        FROM bookings b LEFT JOIN daily_spend s ON b.channel = s.channel AND s.date = '2024-01-14'""",
    ),
    "stream_bookings_warehouse": (
        stream_bookings_warehouse,
        f"""WITH {BOOKINGS_SQL}, {SPEND_SQL}
        SELECT b.* EXCLUDE (campaign, ts), s.spend
        FROM bookings b LEFT JOIN daily_spend s ON b.channel = s.channel AND s.date = '2024-01-14'""",
    ),
    "stream_warehouse": (
        stream_warehouse,
        f"""WITH {GOLD_SQL}
        SELECT * EXCLUDE (toxic) REPLACE (CAST(date_created AS TIMESTAMP) AS date_created) FROM gold""",
    ),
    "stream_outbox": (
        stream_outbox,
        f"""WITH {GOLD_SQL}, texts AS (SELECT lead_id, 'New Lead: ' || display_name || ' | ' || lead_email
          || ' | Owner: ' || lead_owner || ' | Funnel: ' || funnel || ' | Status: None' AS text FROM gold)
        SELECT lead_id, text, '{{"text":"' || text || '"}}' AS message FROM texts""",
    ),
}
