"""File streams between layers.

A layer's log is a parquet table with one folder per micro-batch, replaced as a whole: a batch
that is replayed after a failure leaves the same rows. The checkpoint is the acknowledgement.
Tables keyed by a business id are read through ``latest``: last arrival wins.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Mapping
from contextlib import nullcontext
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from millrace.operators import key_index
from millrace.operators.dedup import latest_per_key
from millrace.operators.required import Split
from millrace.schemas import ARRIVAL
from millrace.sources import tables

BATCH = "batch_id"
# Most that one micro-batch reads of a log.
BATCH_BYTES = 2**40


def write_batch(df: DataFrame, root: str, batch_id: int) -> None:
    """Replace one micro-batch of a log, in few files however many small ones came in."""
    df.hint("rebalance").write.mode("overwrite").parquet(f"{root}/{BATCH}={batch_id}")


def read_log(spark: SparkSession, root: str, schema: T.StructType) -> DataFrame:
    """All batches of a log; empty when nothing has arrived yet."""
    return tables.optional_table(
        spark, root, T.StructType([*schema.fields, T.StructField(BATCH, T.IntegerType())])
    )


def stream_log(
    spark: SparkSession, root: str, schema: T.StructType, bytes_per_batch: int = BATCH_BYTES
) -> DataFrame | None:
    """A log as a stream: what one layer writes starts the next. None before the first write."""
    reader = spark.readStream.schema(schema).option("maxBytesPerTrigger", bytes_per_batch)
    return tables.if_present(lambda: reader.parquet(root).select(*schema.names))


def latest(log: DataFrame, key: str, order_by: list[str] | None = None) -> DataFrame:
    """Current row of each key of a log: an upsert at read time."""
    order = order_by or [c for c in (*ARRIVAL, BATCH, "body") if c in log.columns]
    return latest_per_key(log, [key], order)


def compact(
    log: DataFrame,
    key: str,
    path: str,
    order_by: list[str] | None = None,
    previous: DataFrame | None = None,
) -> None:
    """Write the current rows of a log to a new folder, never into one being read.

    With ``previous``, an earlier result, only batches after its last one are read from the log.
    """
    if previous is not None:
        done = previous.agg(F.max(BATCH)).first()[0]
        newer = log if done is None else log.where(F.col(BATCH) > done)
        log = previous.unionByName(newer)
    tables.write_table(latest(log, key, order_by), path)


def land(stream: DataFrame, path: str, checkpoint: str) -> None:
    """Append all that has arrived to bronze with the exactly-once file sink."""
    (
        stream.writeStream.format("parquet")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start(path)
        .awaitTermination()
    )


def _start(stream: DataFrame, handle: Callable[[DataFrame, int], None], checkpoint: str) -> StreamingQuery:
    return stream.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def _run(stream: DataFrame, handle: Callable[[DataFrame, int], None], checkpoint: str) -> None:
    _start(stream, handle, checkpoint).awaitTermination()


def await_all(queries: Iterable[StreamingQuery | None]) -> None:
    """Wait for queries that run side by side; when one fails the others are stopped."""
    running = [q for q in queries if q is not None]
    try:
        for query in running:
            query.awaitTermination()
    finally:
        for query in running:
            query.stop()


class Parts(NamedTuple):
    """Results that are cuts of the same judged rows."""

    split: Split
    results: Callable[[Split], Mapping[str, DataFrame]]


def each_batch(
    stream: DataFrame | None, step: Callable[[DataFrame], Mapping[str, DataFrame] | Parts], root: str, checkpoint: str
) -> None:
    """Run ``step`` on every micro-batch and replace that batch in the log of each result.

    Every row of a batch is handled. A step with several results gives ``Parts``: the batch is read, parsed and judged once, and
    kept on disk, as it may be far larger than memory, while its results are written. Returns when all that has arrived is done.
    """
    if stream is None:
        return

    def handle(batch: DataFrame, batch_id: int) -> None:
        made = step(batch)
        with made.split.on_disk() if isinstance(made, Parts) else nullcontext() as split:
            for name, rows in (made.results(split) if split else made).items():
                write_batch(rows, f"{root}/{name}", batch_id)

    _run(stream, handle, checkpoint)


def append_absent(
    stream: DataFrame | None,
    insert: Callable[[DataFrame, DataFrame], DataFrame],
    root: str,
    schema: T.StructType,
    checkpoint: str,
) -> None:
    """Append only rows whose key the table lacks.

    ``insert(batch, target)`` picks them. The target is the table without the current batch, so
    a replayed batch inserts the same rows again.
    """
    if stream is None:
        return

    def handle(batch: DataFrame, batch_id: int) -> None:
        target = read_log(batch.sparkSession, root, schema)
        write_batch(insert(batch, target.where(target[BATCH] != batch_id)), root, batch_id)

    _run(stream, handle, checkpoint)


# Beside the batch folders of an indexed table; readers of the table pass folders with such names over.
KEYS, PROBES = "_keys", "_probes"


def _folders(rows: DataFrame) -> set[int]:
    """Batch numbers of a log, from the names of its files."""
    return {int(m[1]) for f in rows.inputFiles() if (m := re.search(rf"/{BATCH}=(\d+)/", f))}


def insert_batch(
    batch: DataFrame,
    batch_id: int,
    insert: Callable[[DataFrame, DataFrame], DataFrame],
    root: str,
    schema: T.StructType,
    key: str,
    report: bool = False,
) -> None:
    """One micro-batch of ``append_absent`` on a table with an index of its keys.

    ``insert(batch, target)`` gets as target only the batch folders that may hold a key of the batch, by ``key_index``; a folder
    without an index is among them. The folder that is written gets its index, and with ``report`` ``_probes`` gets how many
    folders there were and how many were opened. A replayed batch replaces all of it.
    """
    spark = batch.sparkSession
    target = read_log(spark, root, schema)
    kind = schema[key].dataType
    index_schema = T.StructType([*key_index.schema(kind).fields, T.StructField(BATCH, T.IntegerType())])
    index = tables.optional_table(spark, f"{root}/{KEYS}", index_schema)
    others = _folders(target) - {batch_id}
    indexed = _folders(index) & others
    found = key_index.may_hold(index.where(index[BATCH] != batch_id), BATCH, batch, key) if indexed else []
    opened = sorted((others - indexed) | (others & set(found)))
    # the rows come out of a shuffle by key, whose small partitions are merged: a second one would make the files no fewer
    rows = insert(batch, target.where(target[BATCH].isin(opened)))
    rows.write.mode("overwrite").parquet(f"{root}/{BATCH}={batch_id}")
    written = spark.read.schema(schema).parquet(f"{root}/{BATCH}={batch_id}")
    key_index.build(written, key).write.mode("overwrite").parquet(f"{root}/{KEYS}/{BATCH}={batch_id}")
    if not report:
        return
    probe = spark.range(1).select(F.lit(len(others)).cast("bigint").alias("folders"), F.lit(len(opened)).cast("bigint").alias("opened"))
    probe.coalesce(1).write.mode("overwrite").parquet(f"{root}/{PROBES}/{BATCH}={batch_id}")


def start_absent_indexed(
    stream: DataFrame | None,
    insert: Callable[[DataFrame, DataFrame], DataFrame],
    root: str,
    schema: T.StructType,
    checkpoint: str,
    key: str,
) -> StreamingQuery | None:
    """``append_absent`` that opens only the folders of the table that may hold keys of the batch; started, not waited for."""
    if stream is None:
        return None
    return _start(stream, lambda batch, batch_id: insert_batch(batch, batch_id, insert, root, schema, key), checkpoint)


def append_absent_indexed(
    stream: DataFrame | None,
    insert: Callable[[DataFrame, DataFrame], DataFrame],
    root: str,
    schema: T.StructType,
    checkpoint: str,
    key: str,
) -> None:
    """``start_absent_indexed``; returns when all that has arrived is done."""
    await_all([start_absent_indexed(stream, insert, root, schema, checkpoint, key)])
