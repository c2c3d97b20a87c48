"""Delivery of messages with claims: a restart neither loses a message nor sends one anew.

Three logs under ``root``: ``pending`` (messages by micro-batch, as the flows write them), ``claims`` and ``sent`` (one folder for each
run of the sender). A run first claims what is pending and not sent, one message for each key, and writes the claim; then it posts
the claimed messages, and acknowledges by writing ``sent``. A run that was stopped in between is taken up again with the very
same claim: no later run can claim its messages, and the receiver can tell a repeated post by the key and the run's number. Every
folder is replaced as a whole, so each step may be repeated.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.operators.dedup import first_per_key
from millrace.operators.joins import narrowed
from millrace.sources import tables
from millrace.streaming import runs

RUN = "run"


class Claim(NamedTuple):
    run: int
    messages: DataFrame


def _log(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return tables.optional_table(spark, path, T.StructType([*schema.fields, T.StructField(RUN, T.IntegerType())]))


def _last(log: DataFrame) -> int:
    return log.agg(F.max(RUN)).first()[0] or 0


def claim(spark: SparkSession, root: str, schema: T.StructType, key: str) -> Claim | None:
    """The messages that the sender is to post now; None if there are none.

    An open claim, one without an acknowledgement, comes back as it was written. Of several messages with a key the first to arrive is
    sent; a message without a key is not.
    """
    claims, sent = (_log(spark, f"{root}/{name}", schema) for name in ("claims", "sent"))
    last = _last(claims)
    if last > _last(sent):
        return Claim(last, claims.where(F.col(RUN) == last).drop(RUN))
    pending = runs.read_log(spark, f"{root}/pending", schema).where(F.col(key).isNotNull())
    order = [runs.BATCH, *sorted(n for n in schema.names if n != key)]
    fresh = first_per_key(pending, [key], order).select(*schema.names)
    done = narrowed(sent.select(key), fresh, key)
    # written before it is looked at: what was claimed must not be worked out a second time
    path = f"{root}/claims/{RUN}={last + 1}"
    tables.write_table(fresh.join(done.distinct(), key, "left_anti").select(*schema.names), path)
    new = spark.read.schema(schema).parquet(path)
    return None if new.isEmpty() else Claim(last + 1, new)


def acknowledge(spark: SparkSession, root: str, claimed: Claim) -> None:
    """All messages of the claim were posted."""
    tables.write_table(claimed.messages, f"{root}/sent/{RUN}={claimed.run}")


def delivered(spark: SparkSession, root: str, schema: T.StructType) -> DataFrame:
    """Messages that were sent, with the run that sent each."""
    return _log(spark, f"{root}/sent", schema)
