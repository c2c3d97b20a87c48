"""Jobs by name: ``spark-submit`` this file or ``python -m millrace <job> …``."""

from __future__ import annotations

import argparse
from collections.abc import Sequence
from datetime import date, timedelta

from pyspark.sql import SparkSession

from millrace.plans import bookings, reports, video
from millrace.session import build_session
from millrace.sources import landing, tables
from millrace.streaming import flows, runs

REPORTS = [
    "daily_bookings", "cost_per_booking", "booking_kpis", "cumulative_bookings", "heatmap",
    "bookings_by_hour", "bookings_by_weekday", "meeting_load", "meeting_kpis", "weekly_trend",
]


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="millrace")
    jobs = top.add_subparsers(dest="job", required=True)

    def job(name: str, *folders: str, day: bool = True) -> argparse.ArgumentParser:
        sub = jobs.add_parser(name)
        for folder in folders:
            sub.add_argument(f"--{folder}", required=True)
        if day:
            sub.add_argument("--day", required=True, help="processing day, yyyy-MM-dd")
        return sub

    job("video-bronze", "landed", "bronze").add_argument("--media", nargs="*")
    job("video-silver", "bronze", "silver")
    job("video-gold", "silver", "gold")
    archived = "folder for the files that have been read"
    booked = job("bookings", "landed", "root", "spend")
    booked.add_argument("--archive", help=archived)
    booked.add_argument("--broken-spend", help="folder for spend files that cannot be read; without it they stop the job")
    job("leads", "landed", "root", "owners", day=False).add_argument("--archive", help=archived)
    job("compact", "root", "out", day=False).add_argument("--previous", help="result of the last run, to go on from")
    marketing = job("marketing", "root", day=False)
    marketing.add_argument("--table", default="marketing")
    marketing.add_argument("--compacted", help="result of the compact job, read in place of the log")
    marketing.add_argument("--keyed", action="store_true", help="current rows by keyed state, which goes on from the last run")
    job("refresh", "mart", day=False).add_argument("--table", default="marketing")
    job("report", "mart", "out").add_argument("--name", choices=REPORTS, required=True)
    return top


def run(spark: SparkSession, arguments: Sequence[str] | None = None) -> object:
    """Run one job and return what it reports: tables written, rows saved, or nothing."""
    a = parser().parse_args(arguments)
    if a.job == "video-bronze":
        return video.ingest(spark, a.landed, a.bronze, a.day, a.media)
    if a.job == "video-silver":
        return video.write_silver(spark, a.bronze, a.silver, a.day)
    if a.job == "video-gold":
        return video.write_gold(spark, a.silver, a.gold, a.day)
    if a.job == "bookings":
        before = date.fromisoformat(a.day) - timedelta(days=1)
        spend = landing.read_spend(spark, a.spend, str(before), a.broken_spend)
        inbox = landing.stream_bodies(spark, a.landed, archive=a.archive)
        return flows.run_bookings(spark, inbox, a.root, spend, a.day)
    if a.job == "leads":
        owners = landing.read_owners(spark, a.owners)
        return flows.run_leads(spark, landing.stream_bodies(spark, a.landed, archive=a.archive), a.root, owners)
    if a.job == "compact":
        log = runs.read_log(spark, f"{a.root}/gold", flows.BOOKING_GOLD_LOG)
        previous = spark.read.parquet(a.previous) if a.previous else None
        return runs.compact(log, "invitee_id", a.out, previous=previous)
    if a.job == "marketing":
        log = runs.read_log(spark, f"{a.root}/gold", flows.BOOKING_GOLD_LOG)
        if a.keyed:
            current = flows.follow(spark, a.root, "bookings")
        else:
            current = spark.read.parquet(a.compacted) if a.compacted else runs.latest(log, "invitee_id")
        current = current.drop(runs.BATCH)
        return current.write.mode("overwrite").format("parquet").saveAsTable(a.table)
    if a.job == "refresh":
        return bookings.refresh_mart(spark, a.mart, a.table)
    month = reports.dashboard(tables.load_mart(spark, a.mart), a.day)
    tables.write_table(month[a.name], a.out)
    month["cube"].unpersist()
    return None


if __name__ == "__main__":
    print(run(build_session()))
