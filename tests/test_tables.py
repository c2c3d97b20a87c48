"""Session settings, shared folder, layer tables, exports."""

from __future__ import annotations

import json
import os

import pytest

from millrace import session
from millrace.sources import tables


def test_settings_are_on_the_session(spark):
    for key, value in session.SETTINGS.items():
        assert spark.conf.get(key) == value
    assert session.apply_settings(spark) is spark


@pytest.mark.parametrize("size, partitions", [(0, 200), (10**9, 200), (10**12, 7451), (10**15, 7_450_581)])
def test_shuffle_partitions_grow_with_the_input(size, partitions):
    assert session.shuffle_partitions(size) == partitions


class Conf:
    def __init__(self, root, master):
        self.root = root
        self.conf = self
        self.sparkContext = type("Context", (), {"master": master})

    def get(self, key, default):
        return self.root or default


def test_shared_root_is_what_the_session_names():
    assert session.shared_root(Conf("hdfs://x/y/", "yarn")) == "hdfs://x/y"
    local = session.shared_root(Conf(None, "local[2]"))
    assert os.path.isdir(local) and session.shared_root(Conf(None, "local[2]")) == local
    with pytest.raises(ValueError):
        session.shared_root(Conf(None, "yarn"))


def test_write_layer_replaces_only_its_partitions(spark, frame, folder):
    path = folder("t")
    for day, rows in (("2024-01-01", [(1,), (2,)]), ("2024-01-02", [(3,)]), ("2024-01-01", [(4,)])):
        tables.write_layer(tables.with_day(frame(rows, "k int"), day), path)
    assert sorted(r.k for r in spark.read.parquet(path).collect()) == [3, 4]


def test_balanced_write_gives_few_files(spark, folder):
    path = folder("t")
    rows = spark.range(1000).selectExpr("id", "id % 3 as g").repartition(8)
    tables.write_layer(rows, path, by=["g"], balance_by=["g"])
    files = [f for f in spark.read.parquet(path).inputFiles()]
    assert len(files) == 3 and spark.read.parquet(path).count() == 1000


def test_json_export_keeps_nulls(spark, frame, folder):
    path = folder("out")
    tables.write_json(frame([("a", None)], "k string, v int"), path)
    (line,) = spark.read.text(path).collect()
    assert json.loads(line.value) == {"k": "a", "v": None}


def test_has_rows(frame):
    assert not tables.has_rows(frame([], "k int")) and tables.has_rows(frame([(1,)], "k int"))
