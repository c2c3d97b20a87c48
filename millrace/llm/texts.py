"""Helpers that the document operators share: rows in, Arrow batches through a task, rows out."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterable, Iterator
from pathlib import Path

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import SparkContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from millrace.session import shared_root

# Rows handed to a function at once hold about so many bytes of text; a longer text comes alone.
PART_BYTES = 4 * 1024 * 1024
# Bytes of rows that Spark hands to Python at once; it holds such a batch on both sides.
BATCH_BYTES = "8m"


def documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id`` and ``text`` alone; whatever other columns there are cannot clash."""
    return docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))


def parts(batches: Iterable[pa.RecordBatch], text: int | None = 1, part_bytes: int = PART_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut batches so that a part holds about ``part_bytes`` of text."""
    for batch in batches:
        if text is None or not batch.num_rows:
            if batch.num_rows:
                yield batch
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_pylist()
        start, held = 0, 0
        for i, size in enumerate(sizes):
            if i > start and held + size > part_bytes:
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += size
        yield batch.slice(start)


def share_code(context: SparkContext) -> None:
    """Send the package to the executors once, for a driver that found it on a path of its own."""
    if getattr(context, "_millrace_shared", False):
        return
    root = Path(__file__).resolve().parents[1]
    archive = Path(tempfile.mkdtemp(prefix="millrace-code-")) / "millrace.zip"
    with zipfile.ZipFile(archive, "w") as made:
        for file in sorted(root.rglob("*.py")):
            made.write(file, file.relative_to(root.parent))
    context.addPyFile(str(archive))  # Spark serves it; executors do not read the driver's folder
    context._millrace_shared = True


def map_parts(docs: DataFrame, function: Callable, schema: str | StructType, text: int | None = 1, part_bytes: int = PART_BYTES) -> DataFrame:
    """Rows of ``schema``, made in each task by ``function()(*columns) -> columns`` from parts of the rows.

    Columns come as Arrow arrays and go as Arrow arrays, numpy arrays or lists; ``text`` is the column whose size counts.
    """
    share_code(docs.sparkSession.sparkContext)
    docs.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
    made_as = to_arrow_schema(StructType.fromDDL(schema) if isinstance(schema, str) else schema)

    def run(batches):
        step = function()
        for part in parts(batches, text, part_bytes):
            made = step(*part.columns)
            if made is not None:
                arrays = [c if isinstance(c, pa.Array) else pa.array(c, type=f.type) for c, f in zip(made, made_as, strict=True)]
                yield pa.RecordBatch.from_arrays(arrays, schema=made_as)
        # a worker that waits for its next task gives back what this one held
        step = part = made = arrays = None  # noqa: F841
        pa.default_memory_pool().release_unused()

    return docs.mapInArrow(run, schema)


def checkpointed(rows: DataFrame) -> DataFrame:
    """Rows written once to the shared folder of the session (``spark.checkpoint.dir``), their lineage cut."""
    context = rows.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_root(rows.sparkSession))
    return rows.checkpoint()


class Cache:
    """A dict of bounded size: when the young half is full it becomes the old half."""

    def __init__(self, make: Callable, most: int = 200_000):
        self.make, self.most, self.young, self.old = make, most, {}, {}

    def get(self, key):
        found = self.young.get(key)
        if found is None:
            found = self.old.get(key)
            if found is None:
                found = self.make(key)
            if len(self.young) >= self.most:
                self.old, self.young = self.young, {}
            self.young[key] = found
        return found


def with_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, StructType]:
    """doc_id, text and ``row``, the whole row, for steps that hand rows on; and the schema of ``row`` alone."""
    rows = documents_and(docs, id_col, text_col, F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    return rows, StructType([rows.schema["row"]])


def documents_and(docs: DataFrame, id_col: str, text_col: str, more: Column) -> DataFrame:
    return docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"), more)


def written(rows: DataFrame, name: str) -> DataFrame:
    """Rows written once as Parquet under the shared folder of the session, and read again."""
    path = f"{shared_root(rows.sparkSession)}/millrace-llm/{name}-{uuid.uuid4().hex}"
    rows.write.option("compression", "zstd").parquet(path)
    return rows.sparkSession.read.parquet(path)


def join_counted(rows: DataFrame, counted: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Join rows with a table that was grouped by the same keys; a hot key is split as the join runs.

    Adaptive execution splits a join only if both sides come straight out of a shuffle, and a grouped table
    that is dealt by its keys already would not be shuffled again, nor would what groups by them after the join. So the first key,
    a bigint, is joined under a value of its own (one to one), and comes back as it was.
    """
    key = keys[0]
    other = F.col(key).bitwiseXOR(F.lit(0x5851F42D4C957F2D))
    return rows.withColumn(key, other).join(counted.withColumn(key, other), keys, how).withColumn(key, other)


def crc_of_id() -> Column:
    """crc32 of doc_id as text; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
