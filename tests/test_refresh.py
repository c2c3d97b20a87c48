"""The mart refreshed by what changed."""

from __future__ import annotations

import glob
import os
from datetime import date

import pytest
from pyspark.sql import functions as F

from millrace.sources import tables

ROWS = "k string, v double, day date"
A, B, C = date(2024, 1, 1), date(2024, 1, 2), None


def files(path):
    """Data files and when they were written."""
    return {f: os.stat(f).st_mtime_ns for f in glob.glob(f"{path}/day=*/*.parquet")}


def content(spark, path):
    return sorted(map(repr, tables.load_mart(spark, path).select("k", "v", "day").collect()))


def test_only_changed_days_are_written(spark, frame, folder):
    path = folder("mart")
    rows = [("a", 1.0, A), ("b", None, A), ("a", 1.0, B), ("c", 2.0, C)]

    def refresh(rows):
        done = tables.refresh_days(frame(rows, ROWS), path, "day")
        assert content(spark, path) == sorted(map(repr, frame(rows, ROWS).collect())) and done.rows == len(rows)
        return done

    assert refresh(rows).written == sorted([A, B, C], key=str)
    before = files(path)
    assert refresh(rows[::-1]) == (4, [], []) and files(path) == before
    changed = refresh([("a", 1.0, A), ("b", 5.0, A), *rows[2:]])
    assert changed.written == [A] and changed.gone == []
    after = files(path)
    assert {f for f in before if after.get(f) != before[f]} == {f for f in before if "2024-01-01" in f}
    # the null day changes, a day goes, a day comes
    moved = refresh([("b", 5.0, A), ("a", 1.0, A), ("c", 3.0, C), ("n", 0.0, date(2024, 1, 9))])
    assert moved.written == [date(2024, 1, 9), None] and moved.gone == [B]
    assert sorted(refresh([("b", 5.0, A), ("a", 1.0, A)]).gone, key=str) == [date(2024, 1, 9), None]
    assert refresh([]).rows == 0 and refresh(rows).rows == 4


def test_a_value_that_moves_to_another_column_is_a_change(spark, frame, folder):
    path, kind = folder("mart"), "p string, q string, day date"
    tables.refresh_days(frame([("x", None, A)], kind), path, "day")
    assert tables.refresh_days(frame([(None, "x", A)], kind), path, "day").written == [A]
    assert tables.refresh_days(frame([(None, "x", A), (None, "x", A)], kind), path, "day").written == [A]
    assert tables.refresh_days(frame([(None, "x", A)] * 4, kind), path, "day").written == [A]


def test_other_columns_write_all_anew(spark, frame, folder):
    path = folder("mart")
    tables.refresh_days(frame([("a", 1.0, A), ("b", 2.0, B)], ROWS), path, "day")
    wider = frame([("a", 1.0, 7, A), ("b", 2.0, 8, B)], "k string, v double, w int, day date")
    assert tables.refresh_days(wider, path, "day").written == [A, B]
    assert tables.load_mart(spark, path).where("w = 8").count() == 1


def test_a_stopped_refresh_is_made_up_for(spark, frame, folder, monkeypatch):
    path = folder("mart")
    tables.refresh_days(frame([("a", 1.0, A), ("b", 2.0, B)], ROWS), path, "day")
    old, new = frame([("a", 1.0, A), ("b", 2.0, B)], ROWS), frame([("a", 9.0, A), ("b", 2.0, B)], ROWS)
    write = tables.write_layer

    def stop(*arguments, **options):
        write(*arguments, **options)
        raise KeyboardInterrupt

    monkeypatch.setattr(tables, "write_layer", stop)
    with pytest.raises(KeyboardInterrupt):
        tables.refresh_days(new, path, "day")
    monkeypatch.undo()
    # the source went back to what it was: the day was written in between and has to be written again
    assert tables.refresh_days(old, path, "day").written == [A]
    assert content(spark, path) == sorted(map(repr, old.collect()))


def test_rows_are_counted_in_the_write(spark, frame, folder):
    shaky = spark.range(1_000).select(F.lit(A).alias("day"), F.rand().alias("v")).where(F.rand() < 0.5)
    counted = tables.digests(shaky, "day")
    assert counted.columns == ["day", "rows", "total", "mixed"]
    stable = spark.range(1_000).select((F.col("id") % 7).alias("v"), F.date_add(F.lit(A), (F.col("id") % 5).cast("int")).alias("day"))
    done = tables.refresh_days(stable, folder("mart"), "day")
    assert done.rows == 1_000 and len(done.written) == 5
