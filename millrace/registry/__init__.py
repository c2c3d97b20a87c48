"""Runnable queries over the test tables, each with the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from millrace.registry import bookings, leads, reports, scalars, streams, video
from millrace.registry.views import prepared

Query = Callable[[SparkSession, str], DataFrame]

_GROUPS = (reports, video, bookings, leads, scalars, streams)


def queries() -> dict[str, Query]:
    return {name: prepared(fn) for group in _GROUPS for name, (fn, _) in group.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for group in _GROUPS for name, (_, sql) in group.QUERIES.items() if sql}
