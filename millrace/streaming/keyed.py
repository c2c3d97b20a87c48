"""Current rows in keyed state: the last arrival of each business id, kept up to date batch by batch.

A log that is read through ``runs.latest`` is ranked as a whole at each read. Here the row that stands lives in the
state store, under its key: a micro-batch looks up and replaces the keys it brings, whatever the log has grown to, and
reading the current rows is a scan of the state. The state is the largest row of a key, in the order of arrival, a built-in
aggregate: a map task sends at most one row per key, so a hot key costs a row per task. A late older delivery changes nothing.

The state store is RocksDB with a change log, so that a batch writes what it changed and memory is bounded. State and
progress lie in the checkpoint, under the shared folder; a batch that is replayed starts from the state before it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.operators.dedup import orderable
from millrace.schemas import ARRIVAL
from millrace.streaming import runs

_ROW = "__row"

# The number of state partitions is that of the first batch's shuffle and stays for the life of the checkpoint.
STATE_STORE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
}


def _in_order(rows: DataFrame, key: str, order_by: list[str] | None) -> list[str]:
    """All columns but the key, those that say which row is later first; the others settle ties."""
    order = order_by or [c for c in (*ARRIVAL, "body") if c in rows.columns]
    names = [*order, *sorted(c for c in orderable(rows, besides=[key]) if c not in order)]
    if len(names) + 1 != len(rows.columns):
        raise ValueError(f"columns without an order cannot be kept: {set(rows.columns) - {key, *names}}")
    return names


def follow(
    stream: DataFrame | None, key: str, root: str, checkpoint: str, order_by: list[str] | None = None
) -> None:
    """Bring the state up to all that has arrived.

    What a batch changed is written as ``root/batch_id=<n>``, one row for each key it brought, as it stands after the
    batch: a log for whoever goes on from there. A replayed batch replaces its folder.
    """
    if stream is None:
        return
    spark = stream.sparkSession
    before = {name: spark.conf.get(name, None) for name in STATE_STORE}
    for name, value in STATE_STORE.items():
        spark.conf.set(name, value)
    try:
        names = _in_order(stream, key, order_by)
        largest = stream.groupBy(key).agg(F.max(F.struct(*names)).alias(_ROW)).select(key, f"{_ROW}.*")
        (
            largest.select(*stream.columns)
            .writeStream.outputMode("update")
            .foreachBatch(lambda rows, batch_id: runs.write_batch(rows, root, batch_id))
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start()
            .awaitTermination()
        )
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def current(spark: SparkSession, checkpoint: str, schema: T.StructType, key: str) -> DataFrame:
    """The rows that stand, read from the state; ``schema`` names the columns of the stream."""
    state = spark.read.format("statestore").load(checkpoint)
    largest = state.schema["value"].dataType.names[0]
    rows = state.select(F.col(f"key.{key}").alias(key), F.col(f"value.{largest}").alias(_ROW)).select(key, f"{_ROW}.*")
    return rows.select(*schema.names)


def lookup(spark: SparkSession, checkpoint: str, schema: T.StructType, key: str, wanted: DataFrame) -> DataFrame:
    """The rows that stand for the wanted keys."""
    return current(spark, checkpoint, schema, key).join(wanted.select(key).distinct(), key, "left_semi")
