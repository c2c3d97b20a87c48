"""Reports on the bookings mart."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.operators.filters import fill_spend, month_slice
from millrace.plans import bookings
from millrace.plans import reports as r
from millrace.registry.views import AS_OF, MART_SQL, MONTH_SQL, mart, marketing, scratch, table
from millrace.sources import tables


def _month(spark, d):
    return month_slice(mart(spark, d), AS_OF)


def booking_mart(spark, d):
    return mart(spark, d)


def marketing_scan(spark, d):
    marketing(spark, d).createOrReplaceTempView("marketing")
    return bookings.booking_mart(tables.marketing_table(spark)).groupBy("status").agg(
        F.count(F.lit(1)).alias("n"), F.max("start_time").alias("latest")
    )


def mart_roundtrip(spark, d):
    path = scratch(spark, "mart")
    tables.write_mart(mart(spark, d), path)
    return tables.load_mart(spark, path)


def mart_types(spark, d):
    """Columns of the saved mart and their types."""
    return spark.createDataFrame(mart_roundtrip(spark, d).dtypes, "name string, kind string")


def mart_rows(spark, d):
    """The mart refreshed from the catalog table; rows and days saved."""
    marketing(spark, d).createOrReplaceTempView("marketing")
    path = scratch(spark, "mart")
    bookings.refresh_mart(spark, path)
    saved = tables.load_mart(spark, path)
    return saved.groupBy("booking_date").agg(F.count(F.lit(1)).alias("rows"))


def _refreshes(spark, d):
    """Refreshes of one mart: without sign-ups of even days, with them, again, and without the first day."""
    rows, path = marketing(spark, d), scratch(spark, "mart")
    early = F.day("start_time") % 2 == 0
    first = F.to_date("start_time") == F.to_date(F.lit(rows.agg(F.min("start_time")).first()[0]))
    for version in (rows.where(~(early & (F.col("status") == "signup"))), rows, rows, rows.where(~first)):
        version.createOrReplaceTempView("marketing")
        yield path, bookings.refresh_by_day(spark, path)


def mart_refresh(spark, d):
    """What four refreshes wrote: days, days that are gone, rows of the mart after each."""
    done = [(n, len(r.written), len(r.gone), r.rows) for n, (_, r) in enumerate(_refreshes(spark, d), 1)]
    return spark.createDataFrame(done, "refresh int, written bigint, gone bigint, rows bigint")


def mart_refreshed(spark, d):
    """The mart after the four refreshes."""
    path = [path for path, _ in _refreshes(spark, d)][-1]
    return tables.load_mart(spark, path)


def orders_month(spark, d):
    """The month filter where most rows fall outside."""
    orders = table(spark, d, "orders").select(
        F.col("o_orderkey").alias("invitee_id"),
        F.to_date("o_orderdate").alias("booking_date"),
        F.col("o_totalprice").alias("spend"),
    )
    return month_slice(orders, "1998-06-15")


def spend_fill(spark, d):
    return fill_spend(marketing(spark, d)).select("invitee_id", "spend")


def daily_bookings(spark, d):
    return r.daily_bookings(_month(spark, d)).orderBy("booking_date", "channel")


def _costs(spark, d):
    return r.cost_per_booking(_month(spark, d))


def cost_per_booking(spark, d):
    return _costs(spark, d).orderBy("channel")


def cost_per_booking_sorted(spark, d):
    return r.sorted_by(_costs(spark, d), "total_spend", ascending=False)


def cost_per_booking_once(spark, d):
    return r.cost_per_booking_once(_month(spark, d))


def _rounded(df, *names):
    return df.withColumns({n: F.round(n, 6) for n in names})


def booking_kpis(spark, d):
    return _rounded(r.booking_kpis(_costs(spark, d)), "average_cpb", "weighted_cpb")


def cumulative_bookings(spark, d):
    daily = r.daily_bookings(_month(spark, d))
    return r.cumulative_bookings(daily).orderBy("booking_date", "channel")


def _volume(spark, d):
    return r.hour_weekday(_month(spark, d))


def hour_weekday(spark, d):
    return _volume(spark, d).orderBy("hour", "day_of_week")


def heatmap(spark, d):
    return r.heatmap(_volume(spark, d)).orderBy("hour")


def bookings_by_hour(spark, d):
    return r.bookings_by_hour(_volume(spark, d)).orderBy("hour")


def bookings_by_weekday(spark, d):
    return r.bookings_by_weekday(_volume(spark, d)).orderBy("day_of_week")


def meeting_load(spark, d):
    return r.meeting_load(_month(spark, d)).orderBy("employee_name")


def meeting_load_distinct(spark, d):
    """A meeting of several invitees: the bookings of one user on one day."""
    shared = _month(spark, d).withColumn(
        "booking_id", F.concat("employee_name", F.lit("-"), F.col("booking_date").cast("string"))
    )
    return r.meeting_load_distinct(shared)


def meeting_load_cube(spark, d):
    """The same from the bitmaps of each employee and week."""
    shared = _month(spark, d).withColumn(
        "booking_id", F.concat("employee_name", F.lit("-"), F.col("booking_date").cast("string"))
    )
    return r.meeting_load_of_cube(r.meeting_cube(shared))


def meeting_kpis(spark, d):
    return r.meeting_kpis(r.meeting_load(_month(spark, d)))


def weekly_trend(spark, d):
    return r.weekly_trend(_month(spark, d)).orderBy("employee_name", "week")


def weekly_trend_by_start(spark, d):
    return r.weekly_trend_by_start(_month(spark, d))


def booking_cube(spark, d):
    cube = r.booking_cube(_month(spark, d))
    return cube.withColumn("spend", F.col("spend").cast("double"))


def dashboard(spark, d):
    """Every figure of the dashboard's reports that has a channel, hour or employee, in one table."""
    reports = r.dashboard(mart(spark, d), AS_OF)

    def rows(name, key, value):
        return reports[name].select(
            F.lit(name).alias("report"), key.cast("string").alias("key"), value.cast("double").alias("figure")
        )

    return (
        rows("cost_per_booking", F.col("channel"), F.col("total_spend"))
        .unionByName(rows("bookings_by_hour", F.col("hour"), F.col("booking_count")))
        .unionByName(rows("meeting_load", F.col("employee_name"), F.col("meeting_count")))
        .unionByName(rows("booking_kpis", F.lit("all"), F.col("total_bookings")))
        .unionByName(rows("meeting_kpis", F.lit("all"), F.col("max_meetings")))
    )


DISTINCT_SQL = f"""WITH {MONTH_SQL}
SELECT employee_name, count(DISTINCT booking_date) AS meeting_count, count(DISTINCT week) AS week_count,
  count(DISTINCT booking_date) / CAST(count(DISTINCT week) AS DOUBLE) AS avg_meeting_per_week
FROM month GROUP BY employee_name"""

DAILY_SQL = f"""WITH {MONTH_SQL}, daily AS (
  SELECT booking_date, channel, count(invitee_id) AS bookings FROM month
  WHERE channel IS NOT NULL GROUP BY ALL)"""

COSTS_SQL = f"""WITH {MONTH_SQL}, costs AS (
  SELECT channel, CAST(sum(CAST(spend AS DECIMAL(18,2))) AS DOUBLE) AS total_spend,
    count(invitee_id) AS booked_calls FROM month WHERE channel IS NOT NULL GROUP BY channel),
cpb AS (SELECT *, total_spend / booked_calls AS "Average_CPB" FROM costs)"""

VOLUME_SQL = f"""WITH {MONTH_SQL}, volume AS (
  SELECT hour, day_of_week, count(invitee_id) AS booking_count FROM month GROUP BY ALL)"""

LOAD_SQL = f"""WITH {MONTH_SQL}, load AS (
  SELECT employee_name, count(booking_id) AS meeting_count, count(DISTINCT week) AS week_count,
    count(booking_id) / CAST(count(DISTINCT week) AS DOUBLE) AS avg_meeting_per_week
  FROM month WHERE employee_name IS NOT NULL GROUP BY employee_name)"""

_DAYS = ["Friday", "Monday", "Saturday", "Sunday", "Thursday", "Tuesday", "Wednesday"]

QUERIES = {
    "booking_mart": (booking_mart, f"WITH {MART_SQL} SELECT * FROM mart"),
    "marketing_scan": (
        marketing_scan,
        f"WITH {MART_SQL} SELECT status, count(*) AS n, max(start_time) AS latest FROM mart GROUP BY status",
    ),
    "mart_types": (
        mart_types,
        f"""WITH {MART_SQL}, kinds AS (
          SELECT column_name AS name, column_type AS kind FROM (DESCRIBE SELECT * FROM mart))
        SELECT name, CASE kind WHEN 'VARCHAR' THEN 'string' WHEN 'TIMESTAMP' THEN 'timestamp_ntz'
          WHEN 'INTEGER' THEN 'int' ELSE lower(kind) END AS kind FROM kinds""",
    ),
    "mart_roundtrip": (mart_roundtrip, f"WITH {MART_SQL} SELECT * FROM mart"),
    "mart_rows": (
        mart_rows, "SELECT CAST(ts AS DATE) AS booking_date, count(*) AS rows FROM events GROUP BY ALL"
    ),
    "mart_refresh": (
        mart_refresh,
        """WITH days AS (
          SELECT CAST(ts AS DATE) AS day, count(*) AS n, count(*) FILTER (WHERE event_type = 'signup' AND day(ts) % 2 = 0) AS late
          FROM events GROUP BY ALL)
        SELECT 1 AS refresh, count(*) FILTER (WHERE n > late) AS written, CAST(0 AS BIGINT) AS gone, CAST(sum(n - late) AS BIGINT) AS rows FROM days
        UNION ALL SELECT 2, count(*) FILTER (WHERE late > 0), 0, CAST(sum(n) AS BIGINT) FROM days
        UNION ALL SELECT 3, 0, 0, CAST(sum(n) AS BIGINT) FROM days
        UNION ALL SELECT 4, 0, 1, CAST(sum(n) AS BIGINT) - CAST(arg_min(n, day) AS BIGINT) FROM days""",
    ),
    "mart_refreshed": (
        mart_refreshed, f"WITH {MART_SQL} SELECT * FROM mart WHERE booking_date > (SELECT min(booking_date) FROM mart)"
    ),
    "month_slice": (
        orders_month,
        """SELECT o_orderkey AS invitee_id, CAST(o_orderdate AS DATE) AS booking_date, o_totalprice AS spend
        FROM orders WHERE year(o_orderdate) = 1998 AND month(o_orderdate) = 6""",
    ),
    "spend_fill": (
        spend_fill, f"WITH {MART_SQL} SELECT invitee_id, coalesce(spend, 0) AS spend FROM mart"
    ),
    "daily_bookings": (daily_bookings, f"{DAILY_SQL} SELECT * FROM daily"),
    "cost_per_booking": (cost_per_booking, f"{COSTS_SQL} SELECT * FROM cpb"),
    "cost_per_booking_sorted": (
        cost_per_booking_sorted, f"{COSTS_SQL} SELECT * FROM cpb ORDER BY total_spend DESC"
    ),
    "cost_per_booking_once": (
        cost_per_booking_once,
        f"""WITH {MONTH_SQL}, once AS (
          SELECT channel, booking_date, max(spend) AS spend, count(invitee_id) AS calls
          FROM month WHERE channel IS NOT NULL GROUP BY ALL),
        costs AS (SELECT channel, CAST(sum(CAST(spend AS DECIMAL(18,2))) AS DOUBLE) AS total_spend,
          CAST(sum(calls) AS BIGINT) AS booked_calls FROM once GROUP BY channel)
        SELECT *, total_spend / booked_calls AS "Average_CPB" FROM costs""",
    ),
    "booking_kpis": (
        booking_kpis,
        f"""{COSTS_SQL}, k AS (
          SELECT CAST(sum(booked_calls) AS BIGINT) AS total_bookings,
            CAST(sum(CAST(total_spend AS DECIMAL(18,2))) AS DOUBLE) AS total_spend,
            avg("Average_CPB") AS average_cpb FROM cpb)
        SELECT total_bookings, total_spend, round(average_cpb, 6) AS average_cpb,
          round(total_spend / total_bookings, 6) AS weighted_cpb,
          CAST(total_bookings AS VARCHAR) AS total_bookings_text,
          '$' || format('{{:,.0f}}', total_spend) AS total_spend_text,
          '$' || format('{{:,.2f}}', average_cpb) AS average_cpb_text FROM k""",
    ),
    "cumulative_bookings": (
        cumulative_bookings,
        f"""{DAILY_SQL} SELECT *, CAST(sum(bookings) OVER (PARTITION BY channel ORDER BY booking_date
          ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS cumulative_bookings FROM daily""",
    ),
    "hour_weekday": (hour_weekday, f"{VOLUME_SQL} SELECT * FROM volume"),
    "heatmap": (
        heatmap,
        f"{VOLUME_SQL} SELECT hour, "
        + ", ".join(
            f"CAST(sum(booking_count) FILTER (day_of_week = '{day}') AS BIGINT) AS \"{day}\"" for day in _DAYS
        )
        + " FROM volume GROUP BY hour",
    ),
    "bookings_by_hour": (
        bookings_by_hour,
        f"""{VOLUME_SQL} SELECT hour, CAST(sum(booking_count) AS BIGINT) AS booking_count
        FROM volume GROUP BY hour""",
    ),
    "bookings_by_weekday": (
        bookings_by_weekday,
        f"""{VOLUME_SQL}, days AS (
          SELECT day_of_week, CAST(sum(booking_count) AS BIGINT) AS booking_count
          FROM volume GROUP BY day_of_week)
        SELECT *, booking_count / CAST((SELECT sum(booking_count) FROM days) AS DOUBLE) AS share FROM days""",
    ),
    "meeting_load": (meeting_load, f"{LOAD_SQL} SELECT * FROM load"),
    "meeting_load_distinct": (meeting_load_distinct, DISTINCT_SQL),
    "meeting_load_cube": (meeting_load_cube, DISTINCT_SQL),
    "meeting_kpis": (
        meeting_kpis,
        f"""{LOAD_SQL} SELECT CAST(sum(meeting_count) AS BIGINT) AS total_meetings,
        min(meeting_count) AS min_meetings, max(meeting_count) AS max_meetings FROM load""",
    ),
    "weekly_trend": (
        weekly_trend,
        f"""WITH {MONTH_SQL} SELECT employee_name, week, count(booking_id) AS meeting_count
        FROM month WHERE employee_name IS NOT NULL GROUP BY ALL""",
    ),
    "weekly_trend_by_start": (
        weekly_trend_by_start,
        f"""WITH {MONTH_SQL} SELECT employee_name, week,
          CAST(date_trunc('week', booking_date) AS DATE) AS week_start, count(booking_id) AS meeting_count
        FROM month WHERE employee_name IS NOT NULL GROUP BY ALL""",
    ),
    "booking_cube": (
        booking_cube,
        f"""WITH {MONTH_SQL}
        SELECT booking_date, hour, day_of_week, week, channel, employee_name,
          count(invitee_id) AS bookings, count(booking_id) AS meetings,
          CAST(sum(CAST(spend AS DECIMAL(18,2))) AS DOUBLE) AS spend
        FROM month GROUP BY ALL""",
    ),
    "dashboard": (
        dashboard,
        f"""WITH {MONTH_SQL}, load AS (
          SELECT employee_name, count(*) AS n FROM month GROUP BY ALL)
        SELECT 'cost_per_booking' AS report, channel AS key,
          CAST(sum(CAST(spend AS DECIMAL(18,2))) AS DOUBLE) AS figure
        FROM month WHERE channel IS NOT NULL GROUP BY channel
        UNION ALL SELECT 'bookings_by_hour', CAST(hour AS VARCHAR), CAST(count(*) AS DOUBLE)
        FROM month GROUP BY hour
        UNION ALL SELECT 'meeting_load', employee_name, CAST(n AS DOUBLE) FROM load
        UNION ALL SELECT 'booking_kpis', 'all', CAST(count(channel) AS DOUBLE) FROM month
        UNION ALL SELECT 'meeting_kpis', 'all', CAST(max(n) AS DOUBLE) FROM load""",
    ),
}
