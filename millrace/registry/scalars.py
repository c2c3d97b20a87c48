"""Column functions over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.functions import dates, documents, numbers, text
from millrace.registry.views import table, text_of


def json_extract(spark, d):
    doc = documents.with_parsed(table(spark, d, "events"), "props", "doc")
    return doc.select("event_id", documents.field(F.col("doc"), "k", "bigint").alias("k"))


def json_text(spark, d):
    rows = table(spark, d, "labels").select(
        "doc_id",
        documents.json_text(
            F.col("quality"), F.when(F.col("toxic") == 0, F.col("toxic")).alias("safe")
        ).alias("body"),
    )
    return rows


def last_segment(spark, d):
    return table(spark, d, "pages").select("page_id", text.last_segment(F.col("url")).alias("segment"))


def trim_timestamp(spark, d):
    """The event time as ISO-8601 text with fraction and offset, cut to seconds."""
    stamp = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'")
    return table(spark, d, "events").select("event_id", text.trim_timestamp(stamp).alias("trimmed"))


def lead_message(spark, d):
    rows = table(spark, d, "customer").select(
        "c_custkey",
        text.lead_message(
            F.col("c_name"), F.lit("a@b.c"), F.col("c_mktsegment"), F.lit(None), F.col("c_nationkey")
        ).alias("text"),
    )
    return rows


def money_text(spark, d):
    return table(spark, d, "orders").select(
        "o_orderkey",
        text.money_text(F.col("o_totalprice"), 2).alias("cents"),
        text.money_text(F.col("o_totalprice"), 0).alias("whole"),
    )


def url_unquote(spark, d):
    """Page addresses with their separators escaped, decoded again."""
    escaped = F.replace(F.replace(F.col("url"), F.lit("/"), F.lit("%2F")), F.lit(":"), F.lit("%3a"))
    return table(spark, d, "pages").select(
        "page_id", text.unquote_plus(F.concat(escaped, F.lit("+100%+%zz"))).alias("url")
    )


def object_key(spark, d):
    return table(spark, d, "documents").select(
        text.object_key("gold/lead_", F.col("doc_id")).alias("object_key")
    )


def number_text(spark, d):
    """Numbers that arrive as text, some missing."""
    amount = F.when(F.col("o_orderstatus") != "P", text_of("o_totalprice"))
    return table(spark, d, "orders").select("o_orderkey", documents.number(amount).alias("amount"))


def ratio(spark, d):
    """Price per unit, null where the whole is zero."""
    return table(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        numbers.ratio(F.col("l_quantity"), F.col("l_discount")).alias("ratio"),
    )


def calendar(spark, d):
    """Calendar columns of ISO-8601 text, over years with every kind of turn."""
    stamp = F.date_format("l_shipdate", "yyyy-MM-dd'T'HH:mm:ss'Z'")
    moments = table(spark, d, "lineitem").select(dates.to_timestamp(stamp).alias("moment")).distinct()
    day = F.to_date("moment")
    return moments.select(
        day.alias("day"),
        *[c.alias(n) for n, c in dates.calendar_columns(F.col("moment")).items() if n != "booking_date"],
        dates.week_start(day).alias("week_start"),
        dates.day_text(F.date_sub(day, 1)).alias("day_before"),
    )


def event_day(spark, d):
    """Leading day of text: half of it no date at all."""
    stamp = F.when(F.col("o_orderstatus") == "F", F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss"))
    return table(spark, d, "orders").select(
        "o_orderkey", dates.to_day(F.coalesce(stamp, F.col("o_orderpriority"))).alias("day")
    )


def first_element(spark, d):
    """First number of each vector, null for an empty one."""
    rows = table(spark, d, "embeddings")
    kept = F.when(F.col("label") > 0, F.col("embedding")).otherwise(F.slice("embedding", 1, 0))
    return rows.select("vec_id", documents.first_element(kept).cast("double").alias("head"))


QUERIES = {
    "json_extract": (json_extract, "SELECT event_id, CAST(props->>'$.k' AS BIGINT) AS k FROM events"),
    "json_text": (
        json_text,
        """SELECT doc_id, '{"quality":' || quality || ',"safe":'
          || CASE WHEN toxic = 0 THEN '0' ELSE 'null' END || '}' AS body FROM labels""",
    ),
    "last_segment": (last_segment, "SELECT page_id, regexp_extract(url, '[^/]*$') AS segment FROM pages"),
    "trim_timestamp": (
        trim_timestamp, "SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS trimmed FROM events"
    ),
    "lead_message": (
        lead_message,
        """SELECT c_custkey, 'New Lead: ' || c_name || ' | a@b.c | Owner: ' || c_mktsegment
          || ' | Funnel: None | Status: ' || c_nationkey AS text FROM customer""",
    ),
    "money_text": (
        money_text,
        """SELECT o_orderkey, '$' || format('{:,.2f}', o_totalprice) AS cents,
          '$' || format('{:,.0f}', o_totalprice) AS whole FROM orders""",
    ),
    "url_unquote": (url_unquote, "SELECT page_id, url || ' 100% %zz' AS url FROM pages"),
    "object_key": (object_key, "SELECT 'gold/lead_' || doc_id || '.json' AS object_key FROM documents"),
    "number_text": (
        number_text,
        "SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN o_totalprice END AS amount FROM orders",
    ),
    "ratio": (
        ratio,
        """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
          CASE WHEN l_discount <> 0 THEN l_quantity / l_discount END AS ratio FROM lineitem""",
    ),
    "calendar": (
        calendar,
        """SELECT DISTINCT CAST(l_shipdate AS DATE) AS day, CAST(hour(l_shipdate) AS INTEGER) AS hour,
          dayname(l_shipdate) AS day_of_week, CAST(week(l_shipdate) AS INTEGER) AS week,
          CAST(date_trunc('week', l_shipdate) AS DATE) AS week_start,
          strftime(CAST(l_shipdate AS DATE) - 1, '%Y-%m-%d') AS day_before FROM lineitem""",
    ),
    "event_day": (
        event_day,
        """SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN CAST(o_orderdate AS DATE) END AS day
        FROM orders""",
    ),
    "first_element": (
        first_element,
        "SELECT vec_id, CAST(CASE WHEN label > 0 THEN embedding[1] END AS DOUBLE) AS head FROM embeddings",
    ),
}
