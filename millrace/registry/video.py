"""Video feeds, layers and gold."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.operators.dedup import first_per_key
from millrace.operators.filters import of_media, since_yesterday
from millrace.operators.filters import recent_visitors as keep_recent
from millrace.plans import video as v
from millrace.registry.views import VIDEO_SQL, media_stats, scratch, table, text_of, video_events, visitors
from millrace.schemas import VIDEO_EVENTS, VISITORS
from millrace.sources import landing, tables

DAY = "1998-06-15"
WITH_NULLS = {"ignoreNullFields": "false"}


def video_gold(spark, d):
    return v.video_gold(visitors(spark, d), video_events(spark, d), media_stats(spark, d))


def visitors_events_left(spark, d):
    joined = v.visitors_with_events(
        visitors(spark, d).drop("last_active_at"), v.with_event_day(video_events(spark, d))
    )
    return joined.select("visitor_key", "load_count", "event_key", "media_id", "event_date")


def events_stats_left(spark, d):
    joined = v.events_with_stats(v.with_event_day(video_events(spark, d)), media_stats(spark, d))
    return joined.select("event_key", "media_id", "event_date", "date", "hours_watched")


def dedup_by_key(spark, d):
    keys = ["l_orderkey", "l_linenumber"]
    return first_per_key(table(spark, d, "lineitem"), keys)


def _page(rows, *columns):
    """A page that holds each row twice, as overlapping fetches do."""
    one = F.struct(*columns)
    return rows.select(F.to_json(F.array(one, one), WITH_NULLS).alias("body"))


def _event_pages(spark, d):
    return _page(video_events(spark, d), *VIDEO_EVENTS.names)


def union_pages(spark, d):
    """All landed event pages as rows, duplicates still in."""
    return landing.feed_rows(_event_pages(spark, d), VIDEO_EVENTS)


def pages_split(spark, d):
    """Event pages and web pages landed together; the web pages are set aside."""
    web = table(spark, d, "pages").select(F.col("html").alias("body"))
    split = landing.split_pages(_event_pages(spark, d).unionByName(web))
    events = landing.feed_rows(split.valid, VIDEO_EVENTS).select("event_key", F.lit(None).cast("string").alias("bad"))
    return events.unionByName(
        split.quarantine.select(F.lit(None).cast("string").alias("event_key"), F.md5("body").alias("bad"))
    )


def pages_until_short(spark, d):
    """Pages of 200 order numbers each per media; a fetch stops at the first with fewer than 36 events."""
    rows = video_events(spark, d).withColumn("page", F.floor(F.col("event_key").cast("bigint") / 200))
    whole = F.to_json(F.struct(*VIDEO_EVENTS.names), WITH_NULLS)
    listed = F.concat(F.lit("["), F.array_join(F.collect_list(whole), ","), F.lit("]"))
    pages = rows.groupBy(F.col("media_id").alias("media"), "page").agg(listed.alias("body"))
    return landing.feed_rows(landing.until_short_page(pages, "media", "page", 36), VIDEO_EVENTS).drop("media", "page")


def event_feed(spark, d):
    """Pages to clean rows since the day before, for two media."""
    rows = v.bronze_events(_event_pages(spark, d), DAY, ["1-URGENT", "5-LOW"])
    return first_per_key(rows, ["event_key"])


def stats_feed(spark, d):
    rows = media_stats(spark, d)
    one = F.struct("date", "load_count", "play_count", F.col("hours_watched").cast("string").alias("hours_watched"))
    pages = rows.select("media_id", F.to_json(F.array(one), WITH_NULLS).alias("body"))
    return v.bronze_stats(pages, DAY)


def visitor_feed(spark, d):
    """Orders as visitors who came on the order's day."""
    rows = table(spark, d, "orders").select(
        text_of("o_orderkey").alias("visitor_key"),
        F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("created_at"),
        F.lit(None).cast("string").alias("last_active_at"),
        F.col("o_custkey").alias("load_count"),
        F.col("o_orderkey").alias("play_count"),
    )
    pages = _page(rows, *VISITORS.names)
    return first_per_key(v.bronze_visitors(pages, DAY), ["visitor_key"])


def recent_visitors(spark, d):
    rows = table(spark, d, "orders").select(
        "o_orderkey", F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("created_at")
    )
    return keep_recent(rows, DAY)


def recent_events(spark, d):
    """The day bound on a timestamp column, where it reaches the scan."""
    return since_yesterday(table(spark, d, "orders"), "o_orderdate", DAY).select("o_orderkey", "o_orderdate")


def of_media_list(spark, d):
    rows = video_events(spark, d).select("event_key", "media_id")
    return of_media(rows, ["1-URGENT", "5-LOW"])


def of_media_table(spark, d):
    """Media named by a table: the priorities of finished orders."""
    wanted = table(spark, d, "orders").where("o_orderstatus = 'F'").select(F.col("o_orderpriority").alias("media_id"))
    return of_media(video_events(spark, d).select("event_key", "media_id"), wanted)


def silver_layers(spark, d):
    """Bronze with every event twice, to silver, by layer files; rows per table and media."""
    root = scratch(spark, "video")
    events = video_events(spark, d)
    v.write_bronze(events.unionByName(events), f"{root}/bronze", "events", DAY)
    v.write_bronze(media_stats(spark, d), f"{root}/bronze", "media_stats", DAY)
    v.write_silver(spark, f"{root}/bronze", f"{root}/silver", DAY)
    silver = v.read_silver(spark, f"{root}/silver", DAY)
    counts = [
        silver[name].groupBy("media_id").agg(F.count(F.lit(1)).alias("n")).withColumn("layer", F.lit(name))
        for name in ("events", "media_stats")
    ]
    return counts[0].unionByName(counts[1]).unionByName(
        silver["visitors"].select(
            F.lit(None).cast("string").alias("media_id"), F.lit(0).cast("bigint").alias("n"),
            F.lit("visitors").alias("layer"),
        )
    )


def video_gold_layers(spark, d):
    """The whole chain by layer files: bronze, silver, gold."""
    root = scratch(spark, "video")
    for name, rows in (
        ("visitors", visitors(spark, d)), ("events", video_events(spark, d)), ("media_stats", media_stats(spark, d)),
    ):
        v.write_bronze(rows, f"{root}/bronze", name, DAY)
    v.write_silver(spark, f"{root}/bronze", f"{root}/silver", DAY)
    v.write_gold(spark, f"{root}/silver", f"{root}/gold", DAY)
    return spark.read.parquet(f"{root}/gold/engagement").drop(tables.DAY)


def gold_days(spark, d):
    """Gold of three days, the second without events; what each of the three tables holds for each day."""
    root = scratch(spark, "video")
    days = ["1998-06-14", "1998-06-15", "1998-06-16"]
    for n, day in enumerate(days):
        feeds = {"visitors": visitors(spark, d), "events": video_events(spark, d), "media_stats": media_stats(spark, d)}
        if n == 1:
            feeds["events"] = feeds["events"].where("false")
        for name, rows in feeds.items():
            v.write_bronze(rows, f"{root}/bronze", name, day)
        v.write_silver(spark, f"{root}/bronze", f"{root}/silver", day)
        v.write_gold(spark, f"{root}/silver", f"{root}/gold", day)
    # a second run of the first day, with one media left
    fewer = video_events(spark, d).where("media_id = '5-LOW'")
    v.write_bronze(fewer, f"{root}/bronze", "events", days[0])
    v.write_silver(spark, f"{root}/bronze", f"{root}/silver", days[0])
    v.write_gold(spark, f"{root}/silver", f"{root}/gold", days[0])
    counts = [
        spark.read.parquet(f"{root}/gold/{name}").groupBy(F.col(tables.DAY).cast("string").alias("day"))
        .agg(F.count(F.lit(1)).alias("n")).withColumn("layer", F.lit(name))
        for name in ("engagement", "visitors", "media_stats")
    ]
    return counts[0].unionByName(counts[1]).unionByName(counts[2])


def feed_quarantine(spark, d):
    """Orders as elements of event pages, some without a key, some with a bad number, and numbers between them."""
    one = F.struct(*VIDEO_EVENTS.names)
    whole = F.to_json(one, WITH_NULLS)
    bare = F.to_json(F.struct("event_key"))
    wrong = F.to_json(F.struct(*[F.lit("much").alias(c) if c == "percent_viewed" else F.col(c) for c in VIDEO_EVENTS.names]), WITH_NULLS)
    key = F.col("event_key").cast("bigint") % 4
    element = F.when(key == 0, bare).when(key == 1, wrong).when(key == 2, F.col("event_key")).otherwise(whole)
    pages = video_events(spark, d).select(F.concat(F.lit("["), element, F.lit("]")).alias("body"))
    split = landing.split_feed(pages, VIDEO_EVENTS)
    good = split.valid.select("event_key", F.lit(0).alias("broken"))
    bad = split.quarantine.select(F.coalesce(F.get_json_object("element", "$.event_key"), "element").alias("event_key"), F.size("reasons").alias("broken"))
    return good.unionByName(bad)


def video_history(spark, d):
    """Line items as events seen again on later ingest days; the last sighting stands."""
    rows = table(spark, d, "lineitem").select(
        F.col("l_orderkey").alias("event_key"),
        F.to_date("l_shipdate").alias(tables.DAY),
        "l_linenumber", "l_partkey", "l_suppkey",
    )
    return v.across_days(rows, ["event_key"])


GOLD_SQL = f"""WITH {VIDEO_SQL}
SELECT v.visitor_key, v.created_at, v.load_count, v.play_count, e.event_key, e.ip, e.country, e.region,
  e.city, e.percent_viewed, e.media_id, e.media_name, s.date, s.hours_watched, e.event_date
FROM visitors v LEFT JOIN video_events e ON v.visitor_key = e.visitor_key
LEFT JOIN media_stats s ON e.media_id = s.media_id AND e.event_date = CAST(s.date AS DATE)"""

_EVENT_COLUMNS = ", ".join(VIDEO_EVENTS.names)

QUERIES = {
    "video_gold": (video_gold, GOLD_SQL),
    "visitors_events_left": (
        visitors_events_left,
        f"""WITH {VIDEO_SQL} SELECT v.visitor_key, v.load_count, e.event_key, e.media_id, e.event_date
        FROM visitors v LEFT JOIN video_events e ON v.visitor_key = e.visitor_key""",
    ),
    "events_stats_left": (
        events_stats_left,
        f"""WITH {VIDEO_SQL} SELECT e.event_key, e.media_id, e.event_date, s.date, s.hours_watched
        FROM video_events e LEFT JOIN media_stats s
        ON e.media_id = s.media_id AND e.event_date = CAST(s.date AS DATE)""",
    ),
    "dedup_by_key": (
        dedup_by_key,
        """SELECT * FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber
          ORDER BY l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax,
            l_returnflag, l_linestatus, l_shipdate) = 1""",
    ),
    "union_pages": (
        union_pages,
        f"""WITH {VIDEO_SQL} SELECT {_EVENT_COLUMNS} FROM video_events
        UNION ALL SELECT {_EVENT_COLUMNS} FROM video_events""",
    ),
    "pages_split": (
        pages_split,
        """SELECT CAST(o_orderkey AS VARCHAR) AS event_key, CAST(NULL AS VARCHAR) AS bad FROM orders
        UNION ALL SELECT CAST(o_orderkey AS VARCHAR), NULL FROM orders
        UNION ALL SELECT NULL, md5(html) FROM pages""",
    ),
    "pages_until_short": (
        pages_until_short,
        f"""WITH {VIDEO_SQL}, sizes AS (
          SELECT media_id, CAST(event_key AS BIGINT) // 200 AS page, count(*) AS n FROM video_events GROUP BY ALL),
        ends AS (SELECT media_id, coalesce(min(page) FILTER (WHERE n < 36), max(page)) AS last FROM sizes GROUP BY media_id)
        SELECT {_EVENT_COLUMNS} FROM video_events JOIN ends USING (media_id) WHERE CAST(event_key AS BIGINT) // 200 <= last""",
    ),
    "event_feed": (
        event_feed,
        f"""WITH {VIDEO_SQL} SELECT {_EVENT_COLUMNS} FROM video_events
        WHERE event_date >= DATE '1998-06-14' AND media_id IN ('1-URGENT', '5-LOW')""",
    ),
    "stats_feed": (stats_feed, f"WITH {VIDEO_SQL} SELECT * FROM media_stats WHERE date >= '1998-06-14'"),
    "visitor_feed": (
        visitor_feed,
        """SELECT CAST(o_orderkey AS VARCHAR) AS visitor_key,
          strftime(o_orderdate, '%Y-%m-%dT%H:%M:%SZ') AS created_at,
          CAST(NULL AS VARCHAR) AS last_active_at, o_custkey AS load_count, o_orderkey AS play_count
        FROM orders WHERE o_orderdate >= DATE '1998-06-14'""",
    ),
    "recent_visitors": (
        recent_visitors,
        """SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%dT%H:%M:%SZ') AS created_at FROM orders
        WHERE o_orderdate >= DATE '1998-06-14'""",
    ),
    "recent_events": (
        recent_events,
        "SELECT o_orderkey, o_orderdate FROM orders WHERE o_orderdate >= DATE '1998-06-14'",
    ),
    "of_media_list": (
        of_media_list,
        """SELECT CAST(o_orderkey AS VARCHAR) AS event_key, o_orderpriority AS media_id FROM orders
        WHERE o_orderpriority IN ('1-URGENT', '5-LOW')""",
    ),
    "of_media_table": (
        of_media_table,
        """SELECT CAST(o_orderkey AS VARCHAR) AS event_key, o_orderpriority AS media_id FROM orders
        WHERE o_orderpriority IN (SELECT o_orderpriority FROM orders WHERE o_orderstatus = 'F')""",
    ),
    "silver_layers": (
        silver_layers,
        f"""WITH {VIDEO_SQL}
        SELECT media_id, count(*) AS n, 'events' AS layer FROM video_events GROUP BY media_id
        UNION ALL SELECT media_id, count(*), 'media_stats' FROM media_stats GROUP BY media_id""",
    ),
    "video_gold_layers": (video_gold_layers, GOLD_SQL),
    "gold_days": (
        gold_days,
        f"""WITH {VIDEO_SQL}, joined AS (
          SELECT e.media_id, e.visitor_key AS viewed, v.visitor_key FROM visitors v
          LEFT JOIN video_events e ON v.visitor_key = e.visitor_key),
        low AS (SELECT v.visitor_key FROM visitors v
          LEFT JOIN (SELECT * FROM video_events WHERE media_id = '5-LOW') e ON v.visitor_key = e.visitor_key)
        SELECT '1998-06-14' AS day, count(*) AS n, 'engagement' AS layer FROM low
        UNION ALL SELECT '1998-06-16', count(*), 'engagement' FROM joined
        UNION ALL SELECT '1998-06-15', count(*), 'visitors' FROM visitors
        UNION ALL SELECT '1998-06-15', count(*), 'media_stats' FROM media_stats""",
    ),
    "feed_quarantine": (
        feed_quarantine,
        """SELECT CAST(o_orderkey AS VARCHAR) AS event_key,
          CAST(CASE o_orderkey % 4 WHEN 0 THEN 9 WHEN 1 THEN 1 WHEN 2 THEN 11 ELSE 0 END AS INTEGER) AS broken FROM orders""",
    ),
    "video_history": (
        video_history,
        """SELECT l_orderkey AS event_key, CAST(l_shipdate AS DATE) AS ingest_date, l_linenumber,
          l_partkey, l_suppkey FROM lineitem
        QUALIFY row_number() OVER (PARTITION BY l_orderkey
          ORDER BY CAST(l_shipdate AS DATE) DESC, l_linenumber DESC, l_partkey DESC, l_suppkey DESC) = 1""",
    ),
}
