"""Booking and lead flows over landing folders.

Folders under ``root``: ``bronze`` (bodies whole), then logs per layer: ``silver``, ``gold``,
``quarantine``, and for leads ``rejected`` (no id), ``outbox`` (messages to post) and
``warehouse`` (insert if absent).
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.operators.required import REASONS, split_required
from millrace.plans import bookings, leads
from millrace.schemas import BOOKING_GOLD, BOOKING_SILVER, BRONZE, CHANNELS, LEAD_GOLD
from millrace.sources import landing
from millrace.streaming import keyed, runs

_ARRIVED = [f for f in BRONZE if f.name in ("file_path", "file_time", "ingest_ts")]


def _strings(names: list[str]) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names] + _ARRIVED)


BOOKING_LOG = _strings(BOOKING_SILVER)
BOOKING_GOLD_LOG = T.StructType([*BOOKING_LOG.fields, T.StructField("spend", T.DoubleType())])
LEAD_LOG = _strings(["doc_id", "body"])
LEAD_GOLD_LOG = _strings([*LEAD_GOLD, "doc_id"])
LEAD_WAREHOUSE = T.StructType(
    [T.StructField(n, T.StringType()) for n in LEAD_GOLD[:-1]]
    + [T.StructField(LEAD_GOLD[-1], T.TimestampType())]
)


def _warehouse(names: list[str]) -> T.StructType:
    kinds = {"spend": T.DoubleType(), "inserted_at": T.TimestampType()}
    return T.StructType([T.StructField(n, kinds.get(n, T.StringType())) for n in [*names, "inserted_at"]])


BOOKING_EVENTS = _warehouse([n for n in BOOKING_SILVER if n != "campaign"])
BOOKING_MARKETING = _warehouse([n for n in BOOKING_GOLD if n != "campaign"])


def land_bodies(landed: DataFrame, root: str, doc_id: Callable[[Column], Column]) -> None:
    """Landing stream to bronze; returns when all that has arrived is written."""
    rows = landing.bronze_rows(landed, doc_id(landed["body"]))
    runs.land(rows, f"{root}/bronze", f"{root}/_checkpoints/bronze")


def run_bookings(
    spark: SparkSession,
    landed: DataFrame,
    root: str,
    spend: DataFrame,
    as_of: date | str | None,
    channels: Mapping[str, str] = CHANNELS,
    **options,
) -> None:
    """Webhook bodies to bronze, silver, gold, quarantine and two warehouse tables, for all that has arrived.

    The warehouse tables ``events`` and ``marketing`` take each booking once, as it first arrived.
    """
    land_bodies(landed, root, landing.invitee_id_of)

    def to_silver(batch: DataFrame) -> runs.Parts:
        split = bookings.booking_silver(batch.drop("doc_id"), channels)
        # only the quarantine shows bodies; those of valid rows need not be kept while the parts are written
        slim = split.judged.withColumn("body", F.when(F.col(REASONS).isNotNull(), F.col("body")))
        return runs.Parts(split.held(slim), lambda s: {"silver": s.valid, "quarantine": s.quarantine})

    def to_gold(batch: DataFrame) -> dict[str, DataFrame]:
        return {"gold": bookings.booking_gold(batch, spend, as_of, **options)}

    bronze = runs.stream_log(spark, f"{root}/bronze", BRONZE)
    runs.each_batch(bronze, to_silver, root, f"{root}/_checkpoints/silver")
    silver = runs.stream_log(spark, f"{root}/silver", BOOKING_LOG)
    runs.each_batch(silver, to_gold, root, f"{root}/_checkpoints/gold")
    gold = runs.stream_log(spark, f"{root}/gold", BOOKING_GOLD_LOG)
    started = []
    for name, schema in (("events", BOOKING_EVENTS), ("marketing", BOOKING_MARKETING)):

        def insert(new: DataFrame, target: DataFrame, names: list[str] = schema.names) -> DataFrame:
            return bookings.load_bookings(new, target).select(*names)

        table, progress = f"{root}/warehouse/{name}", f"{root}/_checkpoints/{name}"
        started.append(runs.start_absent_indexed(gold, insert, table, schema, progress, "invitee_id"))
    # the tables do not depend on each other: while one query ends a step, the other has tasks to run
    runs.await_all(started)


def run_leads(spark: SparkSession, landed: DataFrame, root: str, owners: DataFrame) -> None:
    """Webhook bodies to bronze, silver, gold, outbox, quarantine and warehouse."""
    land_bodies(landed, root, landing.lead_id_of)

    def to_silver(batch: DataFrame) -> runs.Parts:
        split = split_required(batch, {"event.lead_id": batch["doc_id"].isNotNull()})
        return runs.Parts(split, lambda s: {"silver": leads.lead_silver(s.valid, owners), "rejected": s.quarantine})

    def to_gold(batch: DataFrame) -> runs.Parts:
        return runs.Parts(leads.lead_gold(batch), lambda s: {"gold": s.valid, "quarantine": s.quarantine})

    def to_outbox(batch: DataFrame) -> dict[str, DataFrame]:
        return {"outbox": leads.lead_outbox(batch)}

    bronze = runs.stream_log(spark, f"{root}/bronze", BRONZE)
    runs.each_batch(bronze, to_silver, root, f"{root}/_checkpoints/silver")
    silver = runs.stream_log(spark, f"{root}/silver", LEAD_LOG)
    runs.each_batch(silver, to_gold, root, f"{root}/_checkpoints/gold")
    gold = runs.stream_log(spark, f"{root}/gold", LEAD_GOLD_LOG)
    runs.each_batch(gold, to_outbox, root, f"{root}/_checkpoints/outbox")
    table, progress = f"{root}/warehouse", f"{root}/_checkpoints/warehouse"
    runs.append_absent_indexed(gold, leads.load_leads, table, LEAD_WAREHOUSE, progress, "lead_id")


def follow(spark: SparkSession, root: str, of: str) -> DataFrame:
    """The current gold row of each booking or lead, by keyed state that goes on from the last call.

    ``of`` is ``bookings`` or ``leads``. A call costs what has arrived since, and the reading of the current rows; rows that
    changed are in ``root/changes``, batch by batch.
    """
    key, schema = {"bookings": ("invitee_id", BOOKING_GOLD_LOG), "leads": ("lead_id", LEAD_GOLD_LOG)}[of]
    checkpoint = f"{root}/_checkpoints/current"
    gold = runs.stream_log(spark, f"{root}/gold", schema)
    keyed.follow(gold, key, f"{root}/changes", checkpoint)
    return spark.createDataFrame([], schema) if gold is None else keyed.current(spark, checkpoint, schema, key)
