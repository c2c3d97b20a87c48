"""Dedup, skew-aware joins, insert-if-absent, against brute force on small rows."""

from __future__ import annotations

from collections import Counter

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from millrace.operators import joins
from millrace.operators.dedup import dedup_by, first_per_key, latest_per_key
from millrace.operators.filters import month_slice, of_media, recent_visitors
from millrace.operators.required import split_required

key = st.one_of(st.none(), st.integers(0, 4))
some = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))


def bag(df):
    return Counter(tuple(r) for r in df.collect())


def left_join(left, right):
    out = Counter()
    for k, a in left:
        hits = [b for j, b in right if k is not None and j == k]
        for b in hits or [None]:
            out[(k, a, b)] += 1
    return out


@given(rows=st.lists(st.tuples(key, st.integers(0, 3), st.integers(0, 3)), min_size=1, max_size=30))
@some
def test_first_per_key(frame, rows):
    got = first_per_key(frame(rows, "k int, a int, b int"), ["k"]).collect()
    best = {}
    for row in rows:
        best[row[0]] = min(best.get(row[0], row), row)
    assert Counter(tuple(r) for r in got) == Counter(best.values())


@given(rows=st.lists(st.tuples(key, st.integers(0, 50)), min_size=1, max_size=30))
@some
def test_latest_per_key(frame, rows):
    got = latest_per_key(frame(rows, "k int, at int"), ["k"], ["at"])
    want = {}
    for k, at in rows:
        want[k] = max(want.get(k, at), at)
    assert bag(got) == Counter(want.items())


def test_dedup_is_a_transform_and_repeats(frame):
    rows = frame([(1, "b"), (1, "a"), (2, None)], "k int, v string")
    first = rows.repartition(3).transform(dedup_by(["k"])).collect()
    assert sorted(first) == sorted(rows.transform(dedup_by(["k"])).collect()) == [(1, "a"), (2, None)]


HOT = [(1, i) for i in range(40)] + [(2, i) for i in range(3)] + [(None, i) for i in range(25)]


def test_skew_left_join_matches_brute_force(frame):
    left = [(1, 10), (2, 20), (3, 30), (None, 40), (1, 11)]
    got = joins.skew_left_join(
        frame(left, "k int, a int"), frame(HOT, "k int, b int"), ["k"]
    )
    assert got.columns == ["k", "a", "b"]
    assert bag(got) == left_join(left, HOT)


@given(
    left=st.lists(st.tuples(key, st.integers(0, 3)), min_size=1, max_size=10),
    right=st.lists(st.tuples(key, st.integers(0, 99)), min_size=1, max_size=40),
)
@some
def test_skew_left_join_on_any_rows(frame, left, right):
    got = joins.skew_left_join(
        frame(left, "k int, a int"), frame(right, "k int, b int"), ["k"]
    )
    assert bag(got) == left_join(left, right)


@pytest.mark.parametrize("broadcast_rows", [100, 0, 2])
def test_lookup_join_takes_every_route(frame, broadcast_rows):
    dimension = [(1, 100), (2, 200), (2, 201), (9, 900), (None, 0)]
    got = joins.lookup_join(
        frame(HOT, "k int, a int"), frame(dimension, "k int, b int"), ["k"],
        broadcast_rows=broadcast_rows,
    )
    assert bag(got) == left_join(HOT, dimension)


@pytest.mark.parametrize("broadcast_rows", [100, 0])
def test_keep_matching(frame, broadcast_rows):
    wanted = frame([(1,), (1,), (None,), (7,)], "k int")
    got = joins.keep_matching(
        frame(HOT, "k int, a int"), wanted, "k", broadcast_rows=broadcast_rows
    )
    assert bag(got) == Counter(r for r in HOT if r[0] == 1)


@pytest.mark.parametrize("broadcast_rows", [0, 100])
def test_docs_for_keys_is_exact_for_any_size(frame, broadcast_rows):
    docs = frame([(1, "a"), (2, "b"), (2, "b2"), (3, "c")], "k int, v string")
    wanted = frame([(2,), (2,), (9,), (None,)], "k int")
    got = joins.docs_for_keys(wanted, docs, "k", broadcast_rows=broadcast_rows)
    assert bag(got) == Counter([(2, "b"), (2, "b2")])


def test_identical_copies_of_a_hot_key_all_survive(frame):
    right = frame([(1, 5)] * 30, "k int, b int")
    assert joins.skew_left_join(frame([(1, 0)], "k int, a int"), right, ["k"]).count() == 30


def test_is_small_counts_nested_values(frame):
    rows = frame([(["x" * 100] * 10, {"k": "y" * 100})], "a array<string>, m map<string, string>")
    assert joins.is_small(rows, 10, 5_000) and not joins.is_small(rows, 10, 1_000)


def test_is_small_counts_rows_and_bytes(frame):
    rows = frame([("x" * 100,)] * 10, "t string")
    assert joins.is_small(rows, 10, 10_000)
    assert not joins.is_small(rows, 9)
    assert not joins.is_small(rows, 10, 500)
    assert not joins.is_small(rows, 0)


@pytest.mark.parametrize("broadcast_rows", [0, 100])
def test_insert_if_absent(frame, broadcast_rows):
    new = frame([(1, "a"), (1, "b"), (2, "c"), (3, "d"), (None, "e")], "k int, v string")
    target = frame([(2,), (2,), (None,), (8,)], "k int")
    got = joins.insert_if_absent(new, target, "k", broadcast_rows=broadcast_rows)
    assert bag(got) == Counter([(1, "a"), (3, "d"), (None, "e")])


def test_split_required_treats_null_as_broken(frame):
    rows = frame([(1, "x"), (None, "y"), (3, None)], "a int, b string")
    split = split_required(rows, {"a": F.col("a") > 0, "b": F.col("b").isNotNull()})
    assert bag(split.valid) == Counter([(1, "x")])
    assert {r.b: r.reasons for r in split.quarantine.collect()} == {"y": ["a"], None: ["b"]}


def test_recent_visitors(frame):
    rows = frame(
        [("2024-02-28T23:59:59Z",), ("2024-02-29T00:00:00Z",), ("2024-03-05",), (None,)], "created_at string"
    )
    assert recent_visitors(rows, "2024-03-01").count() == 2


def test_of_media(frame):
    rows = frame([("a", "1"), ("b", "2"), (None, "3")], "media_id string, event_key string")
    assert of_media(rows, ["a", "z"]).count() == 1
    assert of_media(rows, frame([("b",), ("b",)], "media_id string")).count() == 1


def test_month_slice_bounds_and_status(frame):
    rows = frame(
        [("2023-12-31", "active", 1.0), ("2024-01-01", "active", None), ("2024-01-31", "canceled", 2.0),
         ("2024-02-01", "active", 3.0), (None, "active", 4.0), ("2023-01-15", "active", 5.0)],
        "d string, status string, spend double",
    ).withColumn("booking_date", F.col("d").cast("date"))
    assert sorted(r.spend for r in month_slice(rows, "2024-01-15").collect()) == [0.0, 2.0]
    assert [r.spend for r in month_slice(rows, "2024-01-15", status="canceled").collect()] == [2.0]
