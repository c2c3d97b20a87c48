"""Keyed state against ranking the log, and the index of keys against scanning the table."""

from __future__ import annotations

import glob
import random

import pytest
from pyspark.sql import functions as F

from millrace.operators import key_index
from millrace.operators.joins import insert_if_absent
from millrace.schemas import BRONZE
from millrace.sources import landing
from millrace.streaming import flows, keyed, runs
from samples import booking, put

LOG = "k string, t int, v string"


def deliveries(seed: int, n: int) -> list[tuple]:
    draw = random.Random(seed)
    return [(draw.choice(["hot", None, *"abcdefgh"]), draw.choice([None, *range(20)]), draw.choice([None, "x", "y", "é"])) for _ in range(n)]


def land(frame, path, rows):
    frame(rows, LOG).coalesce(1).write.mode("append").parquet(path)


def test_keyed_state_equals_latest(spark, frame, folder):
    landed, out, progress = folder("landed"), folder("changes"), folder("checkpoint")
    schema = frame([], LOG).schema
    seen = []
    for seed in range(4):
        rows = deliveries(seed, 50) + seen[:10]  # some come again, later
        seen += rows
        land(frame, landed, rows)
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(landed)
        keyed.follow(stream, "k", out, progress, ["t"])
        got = keyed.current(spark, progress, schema, "k")
        want = runs.latest(frame(seen, LOG), "k", ["t", "v"])
        assert got.columns == ["k", "t", "v"] and sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))
    wanted = keyed.lookup(spark, progress, schema, "k", frame([("a",), ("a",), ("none",), (None,)], "k string")).collect()
    assert [r.k for r in wanted] == ["a"]


def test_a_batch_costs_its_own_keys_and_a_replay_changes_nothing(spark, frame, folder):
    landed, out, progress = folder("landed"), folder("changes"), folder("checkpoint")
    schema = frame([], LOG).schema

    def follow():
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(landed)
        keyed.follow(stream, "k", out, progress, ["t"])
        return sorted(map(repr, keyed.current(spark, progress, schema, "k").collect()))

    land(frame, landed, [(f"k{n}", 5, "first") for n in range(2_000)])
    before = follow()
    assert follow() == before  # nothing new: no batch, no change
    assert len(glob.glob(f"{out}/batch_id=*")) == 1
    land(frame, landed, [("k1", 4, "late"), ("k2", 6, "newer"), ("new", 1, "x"), ("k2", 6, "newer")])
    after = follow()
    changed = spark.read.parquet(f"{out}/batch_id=1").collect()
    assert {r.k: r.v for r in changed} == {"k1": "first", "k2": "newer", "new": "x"} and len(changed) == 3
    assert len(after) == 2_001 and len(set(after) ^ set(before)) == 3
    # the batch is handled again: its commit is lost, as by a driver that stops behind the write
    for commit in glob.glob(f"{progress}/commits/1") + glob.glob(f"{progress}/commits/.1.crc"):
        import os

        os.remove(commit)
    assert follow() == after and spark.read.parquet(out).count() == 2_003


def test_state_store_settings_are_put_back(spark, frame, folder):
    land(frame, folder("landed"), [("a", 1, "x")])
    stream = spark.readStream.schema(LOG).parquet(folder("landed"))
    before = {name: spark.conf.get(name, None) for name in keyed.STATE_STORE}
    keyed.follow(stream, "k", folder("changes"), folder("checkpoint"), ["t"])
    assert {name: spark.conf.get(name, None) for name in keyed.STATE_STORE} == before
    keyed.follow(None, "k", folder("changes"), folder("checkpoint"))
    with pytest.raises(ValueError):
        keyed.follow(stream.withColumn("m", F.create_map("k", "v")), "k", folder("changes"), folder("other"))


def test_current_bookings_by_state(spark, frame, folder):
    inbox, root = folder("inbox"), folder("out")
    spend = frame([], "pos int, date string, channel string, spend double")
    for round_ in range(3):
        for n in range(4):
            put(inbox, f"{round_}-{n}.json", booking(f"i{(n + round_) % 6}", status=f"s{round_}"))
        flows.run_bookings(spark, landing.stream_bodies(spark, inbox, files_per_batch=2), root, spend, "2024-01-15")
        got = flows.follow(spark, root, "bookings")
        want = runs.latest(runs.read_log(spark, f"{root}/gold", flows.BOOKING_GOLD_LOG), "invitee_id").drop(runs.BATCH)
        assert sorted(map(repr, got.select(*want.columns).collect())) == sorted(map(repr, want.collect()))
    assert BRONZE.names  # the landed bodies stay whole
    assert flows.follow(spark, folder("nothing"), "leads").collect() == []


@pytest.mark.parametrize(("kind", "make"), [("bigint", lambda n: n * 7919), ("string", lambda n: f"key-{n}"), ("date", None)])
def test_index_misses_no_key(spark, kind, make):
    def keys(low, high):
        rows = spark.range(low, high)
        if kind == "date":
            return rows.select(F.date_add(F.lit("1990-01-01").cast("date"), F.col("id").cast("int")).alias("k"))
        return rows.select((F.col("id") * 7919).alias("k") if kind == "bigint" else F.concat(F.lit("key-"), F.col("id").cast("string")).alias("k"))

    # folders of different size, with interleaved ranges of keys
    sizes = [1, 100, 5_000, 9_000]
    index, low = None, 0
    for folder, n in enumerate(sizes):
        one = key_index.build(keys(low, low + n), "k").withColumn("folder", F.lit(folder))
        index, low = one if index is None else index.unionByName(one), low + n
    index = index.cache()
    low = 0
    for folder, n in enumerate(sizes):
        assert folder in key_index.may_hold(index, "folder", keys(low, low + n), "k")
        assert folder in key_index.may_hold(index, "folder", keys(low + n - 1, low + n), "k")
        low += n
    assert key_index.may_hold(index, "folder", keys(0, 0), "k") == []
    foreign = [key_index.may_hold(index, "folder", keys(low + n, low + n + 1), "k") for n in range(1_000, 1_010)]
    assert sum(map(len, foreign)) <= 2
    index.unpersist()


def test_false_reports_are_few(spark):
    """Keys between those that a folder holds: out of 20,000 few meet all bits."""
    index = key_index.build(spark.range(0, 40_000, 2).withColumnRenamed("id", "k"), "k").withColumn("folder", F.lit(1)).cache()
    size = index.first()["size"]
    odd = spark.range(1, 40_000, 2).select(F.col("id").alias("key"))
    probes = odd.withColumn("bucket", key_index._bucket(F.col("key"), F.lit(size)))
    hit = F.lit(True)
    for bit in key_index._bits(F.col("key")):
        hit = hit & key_index._is_set(F.col("bitmap"), bit)
    assert size == 16 and index.join(probes, "bucket").where(hit).count() < 200
    index.unpersist()


def test_indexed_table_equals_insert_if_absent(spark, frame, folder):
    root, schema = folder("table"), frame([], "k string, v int").schema
    draw = random.Random(8)
    batches = [[(draw.choice([None, f"{b}-{draw.randrange(40)}", f"{draw.randrange(6)}-{draw.randrange(40)}"]), n) for n in range(60)] for b in range(6)]
    insert = lambda new, target: insert_if_absent(new, target, "k")
    kept = frame([], "k string, v int").collect()
    for b, rows in enumerate(batches):
        if b == 2:  # a folder that was written without an index
            runs.write_batch(insert(frame(rows, "k string, v int"), runs.read_log(spark, root, schema)), root, b)
        else:
            runs.insert_batch(frame(rows, "k string, v int"), b, insert, root, schema, "k")
        kept += insert(frame(rows, "k string, v int"), frame(kept, "k string, v int")).collect()
        got = runs.read_log(spark, root, schema).drop(runs.BATCH).collect()
        assert sorted(map(repr, got)) == sorted(map(repr, kept))
    runs.insert_batch(frame(batches[-1], "k string, v int"), 5, insert, root, schema, "k")
    assert runs.read_log(spark, root, schema).count() == len(kept)


def test_folders_opened(spark, frame, folder):
    root, schema = folder("table"), frame([], "k string, v int").schema
    insert = lambda new, target: insert_if_absent(new, target, "k")
    for b in range(8):
        runs.insert_batch(frame([(f"{b}-{n}", n) for n in range(50)], "k string, v int"), b, insert, root, schema, "k", report=True)
    runs.insert_batch(frame([("3-7", 99), ("new", 1)], "k string, v int"), 8, insert, root, schema, "k", report=True)
    runs.insert_batch(frame([], "k string, v int"), 9, insert, root, schema, "k", report=True)
    runs.insert_batch(frame([("new", 2)], "k string, v int"), 10, insert, root, schema, "k", report=True)
    probes = {r.batch_id: (r.folders, r.opened) for r in spark.read.parquet(f"{root}/{runs.PROBES}").collect()}
    assert {b: f for b, (f, _) in probes.items()} == {b: b for b in range(11)}
    assert probes[8][1] <= 2 and probes[9][1] == 0 and 1 <= probes[10][1] <= 2
    assert runs.read_log(spark, root, schema).count() == 401
