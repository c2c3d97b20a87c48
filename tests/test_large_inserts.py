"""What keeps a large insert cheap: no count of its keys for an empty table, one shuffle of its rows, an index that shuffles keys."""

from __future__ import annotations

import glob

import pytest
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.operators import joins, key_index
from millrace.operators.joins import insert_if_absent
from millrace.streaming import runs

KEYED = "invitee_id string, v int"


@pytest.fixture
def frames(spark):
    """The class of this session's frames, to watch its methods."""
    return type(spark.range(0))


def plan_of(rows: DataFrame, capsys) -> str:
    rows.explain("extended")
    return capsys.readouterr().out


def test_keys_are_not_counted_for_an_empty_target(frame, monkeypatch):
    counted = []
    monkeypatch.setattr(joins, "is_small", lambda *a, **b: counted.append(a) or True)
    new = frame([("a", 1), ("a", 2), (None, 3), (None, 4)], KEYED)
    got = insert_if_absent(new, frame([], KEYED), "invitee_id")
    assert sorted(map(repr, got.collect())) == sorted(map(repr, frame([("a", 1), (None, 3)], KEYED).collect()))
    assert not counted


def test_inserted_rows_are_shuffled_once(spark, frame, frames, folder, monkeypatch):
    hints = []
    hint = frames.hint
    monkeypatch.setattr(frames, "hint", lambda rows, name, *a: hints.append(name) or hint(rows, name, *a))
    root, schema = folder("table"), frame([], KEYED).schema
    for n in range(2):
        rows = frame([(f"k{i}", i) for i in range(n * 50, n * 50 + 100)], KEYED).repartition(40)
        runs.insert_batch(rows, n, lambda new, target: insert_if_absent(new, target, "invitee_id"), root, schema, "invitee_id")
    table = runs.read_log(spark, root, schema)
    assert table.count() == table.select("invitee_id").distinct().count() == 150
    assert "rebalance" not in hints and len(glob.glob(f"{root}/batch_id=0/part-*")) == 1


def test_index_shuffles_keys_not_bitmaps(frame, capsys, monkeypatch):
    monkeypatch.setattr(key_index, "KEYS_PER_BITMAP", 8)
    keys = [f"k{n}" for n in range(100)]
    rows = frame([(k,) for k in [*keys, *keys[:20], None]], "invitee_id string").repartition(5)
    built = key_index.build(rows, "invitee_id")
    plan = plan_of(built, capsys).split("== Physical Plan ==")[1]
    exchanges = [line for line in plan.splitlines() if "Exchange" in line]
    assert sum("hashpartitioning(bucket" in line for line in exchanges) == 1
    assert plan.index("bitmap_construct_agg") < plan.index("hashpartitioning(bucket")  # above it: the shuffle comes first
    bitmaps = {r.bucket: r for r in built.collect()}
    assert len(bitmaps) == built.count() and {r.size for r in bitmaps.values()} == {16}
    index = built.withColumn("batch_id", F.lit(3))
    assert key_index.may_hold(index, "batch_id", frame([("k7",)], "invitee_id string"), "invitee_id") == [3]
    size = F.lit(16)
    held = frame([(k,) for k in keys], "key string").select(key_index._bucket(F.col("key"), size).alias("bucket"), F.explode(F.array(*key_index._bits(F.col("key")))).alias("bit"))
    want = held.groupBy("bucket").agg(F.bitmap_construct_agg("bit").alias("bitmap")).collect()
    assert {r.bucket: bytes(r.bitmap) for r in want} == {b: bytes(r.bitmap) for b, r in bitmaps.items()}
