"""Operator inputs derived from the test tables, and the same inputs as SQL common tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import wraps

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from millrace.functions import documents
from millrace.plans.bookings import booking_mart
from millrace.session import apply_settings, shared_root
from millrace.streaming.runs import BATCH_BYTES

# All bookings of the test tables start in this month.
AS_OF = "2024-01-15"

CHANNEL_OF = {
    "click": "facebook_paid_ads",
    "view": "youtube_paid_ads",
    "signup": "tiktok_paid_ads",
}


def prepared(query: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    """Put the session settings the results rely on before the query is built."""

    @wraps(query)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return query(apply_settings(spark), sf_dir)

    return run


_schemas: dict[str, StructType] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A test table; its schema is inferred once, which saves a job per query."""
    path = f"{sf_dir}/{name}.parquet"
    if path not in _schemas:
        _schemas[path] = spark.read.parquet(path).schema
    return spark.read.schema(_schemas[path]).parquet(path)


def stream_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A test table as a file stream, with the file columns of a landing stream."""
    rows = table(spark, sf_dir, name)
    # the bracket makes it a pattern: a pattern may match one file as well as a folder
    reader = spark.readStream.schema(rows.schema).option("maxBytesPerTrigger", BATCH_BYTES)
    files = reader.parquet(f"{sf_dir}/{name}.parque[t]")
    # a file of one row group would be one task, and so would all that is made of it
    return files.select("*", "_metadata.file_path", F.col("_metadata.file_modification_time").alias("file_time")).hint("rebalance")


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder under the shared root."""
    return f"{shared_root(spark)}/millrace/{name}-{uuid.uuid4().hex}"


def text_of(c: str) -> Column:
    return F.col(c).cast("string")


def marketing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Enriched bookings out of ``events``."""
    k = documents.field(documents.parse(F.col("props")), "k", "bigint")
    return table(spark, sf_dir, "events").select(
        text_of("event_id").alias("invitee_id"),
        text_of("event_id").alias("booking_id"),
        F.col("event_type").alias("status"),
        F.col("ts").alias("start_time"),
        documents.lookup(F.col("event_type"), CHANNEL_OF).alias("channel"),
        F.concat(F.lit("emp_"), (F.col("user_id") % 10).cast("string")).alias("employee_name"),
        F.when(k % 7 != 0, F.col("value")).alias("spend"),
    )


def mart(spark: SparkSession, sf_dir: str) -> DataFrame:
    return booking_mart(marketing(spark, sf_dir))


CHANNEL_SQL = """CASE event_type WHEN 'click' THEN 'facebook_paid_ads'
    WHEN 'view' THEN 'youtube_paid_ads' WHEN 'signup' THEN 'tiktok_paid_ads' END"""

MART_SQL = f"""mart AS (
  SELECT CAST(event_id AS VARCHAR) AS invitee_id, CAST(event_id AS VARCHAR) AS booking_id,
    event_type AS status, ts AS start_time, {CHANNEL_SQL} AS channel,
    'emp_' || CAST(user_id % 10 AS VARCHAR) AS employee_name,
    CASE WHEN CAST(props->>'$.k' AS BIGINT) % 7 <> 0 THEN value END AS spend,
    CAST(ts AS DATE) AS booking_date, CAST(hour(ts) AS INTEGER) AS hour,
    dayname(ts) AS day_of_week, CAST(week(ts) AS INTEGER) AS week
  FROM events)"""

# the month of the reports, with missing spend as 0
MONTH_SQL = f"""{MART_SQL}, month AS (
  SELECT * REPLACE (coalesce(spend, 0) AS spend) FROM mart
  WHERE booking_date >= DATE '2024-01-01' AND booking_date < DATE '2024-02-01')"""


def visitors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers and suppliers; suppliers have no orders, so they are visitors without events."""
    people = table(spark, sf_dir, "customer").select(
        F.concat(F.lit("c"), text_of("c_custkey")).alias("visitor_key"),
        F.col("c_name").alias("created_at"),
        F.lit(None).cast("string").alias("last_active_at"),
        F.col("c_nationkey").cast("bigint").alias("load_count"),
        F.col("c_custkey").alias("play_count"),
    )
    firms = table(spark, sf_dir, "supplier").select(
        F.concat(F.lit("s"), text_of("s_suppkey")).alias("visitor_key"),
        F.col("s_name").alias("created_at"),
        F.lit(None).cast("string").alias("last_active_at"),
        F.col("s_nationkey").cast("bigint").alias("load_count"),
        F.col("s_suppkey").alias("play_count"),
    )
    return people.unionByName(firms)


def video_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as video views."""
    return table(spark, sf_dir, "orders").select(
        F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("received_at"),
        text_of("o_orderkey").alias("event_key"),
        F.concat(F.lit("10.0.0."), (F.col("o_custkey") % 250).cast("string")).alias("ip"),
        F.col("o_orderstatus").alias("country"),
        F.lit(None).cast("string").alias("region"),
        F.lit(None).cast("string").alias("city"),
        (F.col("o_orderkey") % 101 / 100).alias("percent_viewed"),
        F.concat(F.lit("c"), text_of("o_custkey")).alias("visitor_key"),
        F.col("o_orderpriority").alias("media_id"),
        F.lower("o_orderpriority").alias("media_name"),
    )


def media_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Finished orders per priority and day as daily media figures."""
    return (
        table(spark, sf_dir, "orders")
        .where(F.col("o_orderstatus") == "F")
        .groupBy(
            F.col("o_orderpriority").alias("media_id"),
            F.date_format("o_orderdate", "yyyy-MM-dd").alias("date"),
        )
        .agg(
            F.count(F.lit(1)).alias("load_count"),
            F.count(F.lit(1)).alias("play_count"),
            F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("double").alias("hours_watched"),
        )
    )


VIDEO_SQL = """visitors AS (
  SELECT 'c' || CAST(c_custkey AS VARCHAR) AS visitor_key, c_name AS created_at,
    CAST(NULL AS VARCHAR) AS last_active_at,
    CAST(c_nationkey AS BIGINT) AS load_count, c_custkey AS play_count FROM customer
  UNION ALL
  SELECT 's' || CAST(s_suppkey AS VARCHAR), s_name, NULL, CAST(s_nationkey AS BIGINT), s_suppkey
  FROM supplier),
video_events AS (
  SELECT strftime(o_orderdate, '%Y-%m-%dT%H:%M:%SZ') AS received_at,
    CAST(o_orderkey AS VARCHAR) AS event_key,
    '10.0.0.' || CAST(o_custkey % 250 AS VARCHAR) AS ip, o_orderstatus AS country,
    CAST(NULL AS VARCHAR) AS region, CAST(NULL AS VARCHAR) AS city,
    CAST(o_orderkey % 101 AS DOUBLE) / 100 AS percent_viewed,
    'c' || CAST(o_custkey AS VARCHAR) AS visitor_key, o_orderpriority AS media_id,
    lower(o_orderpriority) AS media_name, CAST(o_orderdate AS DATE) AS event_date FROM orders),
media_stats AS (
  SELECT o_orderpriority AS media_id, strftime(o_orderdate, '%Y-%m-%d') AS date,
    count(*) AS load_count, count(*) AS play_count,
    CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS hours_watched
  FROM orders WHERE o_orderstatus = 'F' GROUP BY ALL)"""


def spend(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as spend rows: many per channel and day, in the order of their id."""
    return table(spark, sf_dir, "events").select(
        F.date_format("ts", "yyyy-MM-dd").alias("date"),
        documents.lookup(F.col("event_type"), CHANNEL_OF).alias("channel"),
        F.col("value").alias("spend"),
        F.col("event_id").alias("pos"),
    )


SPEND_SQL = f"""spend_rows AS (
  SELECT strftime(ts, '%Y-%m-%d') AS date, {CHANNEL_SQL} AS channel, value AS spend, event_id AS pos
  FROM events),
daily_spend AS (
  SELECT date, channel, spend FROM spend_rows
  QUALIFY row_number() OVER (PARTITION BY channel, date ORDER BY pos) = 1)"""


def booking_body() -> Column:
    """A booking document built from the columns of ``events``; ``error`` rows lack a host."""
    stamp = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
    host = F.array(
        F.struct(
            F.concat(F.lit("emp"), (F.col("user_id") % 10).cast("string"), F.lit("@example.org")).alias("user_email"),
            F.concat(F.lit("emp_"), (F.col("user_id") % 10).cast("string")).alias("user_name"),
        )
    )
    meeting = F.struct(
        F.concat(F.lit("https://host/events/"), text_of("event_id")).alias("uri"),
        stamp.alias("start_time"),
        stamp.alias("end_time"),
        F.concat(F.lit("call "), F.col("event_type")).alias("name"),
        F.concat(F.lit("https://host/types/"), F.col("event_type")).alias("event_type"),
        F.when(F.col("event_type") != "error", host).otherwise(F.slice(host, 1, 0)).alias("event_memberships"),
    )
    payload = F.struct(
        F.concat(F.lit("https://host/invitees/"), text_of("event_id")).alias("uri"),
        F.concat(F.lit("user"), text_of("user_id"), F.lit("@example.org")).alias("email"),
        F.concat(F.lit("User "), text_of("user_id")).alias("name"),
        F.lit("active").alias("status"),
        stamp.alias("created_at"),
        F.when(F.col("event_type") == "click", F.create_map(F.lit("utm_campaign"), F.col("props")))
        .otherwise(F.create_map().cast("map<string,string>")).alias("tracking"),
        meeting.alias("scheduled_event"),
    )
    return F.to_json(F.struct(payload.alias("payload")))


BOOKINGS_SQL = f"""bookings AS (
  SELECT CAST(event_id AS VARCHAR) AS invitee_id,
    'user' || CAST(user_id AS VARCHAR) || '@example.org' AS email,
    'User ' || CAST(user_id AS VARCHAR) AS name, 'active' AS status,
    strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ') AS booking_created_at,
    CAST(event_id AS VARCHAR) AS booking_id,
    strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ') AS start_time,
    strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ') AS end_time,
    'call ' || event_type AS event_name, event_type AS event_type_id, {CHANNEL_SQL} AS channel,
    'emp' || CAST(user_id % 10 AS VARCHAR) || '@example.org' AS employee_email,
    'emp_' || CAST(user_id % 10 AS VARCHAR) AS employee_name,
    CASE WHEN event_type = 'click' THEN props END AS campaign, ts
  FROM events WHERE event_type <> 'error')"""


def lead_body() -> Column:
    """A lead document built from the columns of ``documents``, text and all.

    It repeats two keys of the owner document: one with a value, one with a null.
    """
    return documents.json_text(
        F.struct(text_of("doc_id").alias("lead_id")).alias("event"),
        text_of("doc_id").alias("lead_id"),
        F.col("source").alias("display_name"),
        F.concat(F.lit("lead"), text_of("doc_id"), F.lit("@example.org")).alias("lead_email"),
        F.col("lang").alias("funnel"),
        F.lit(None).cast("string").alias("status_label"),
        F.date_format(
            F.timestamp_seconds(F.lit(1700000000) + F.col("n_chars")), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
        ).alias("created"),
        F.col("text"),
    )


def lead_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select(
        text_of("doc_id").alias("doc_id"), lead_body().alias("body")
    )


def owners(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Owner documents out of ``labels``."""
    return table(spark, sf_dir, "labels").select(
        text_of("doc_id").alias("lead_id"),
        documents.json_text(
            F.concat(F.lit("owner"), text_of("quality")).alias("lead_owner"),
            F.lit("owner").alias("display_name"),
            F.lit("open").alias("status_label"),
            F.lit("2024-01-02T03:04:05.678901+00:00").alias("date_created"),
            F.col("toxic"),
        ).alias("owner"),
    )
