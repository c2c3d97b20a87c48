"""Session settings that the results and the plans rely on."""

from __future__ import annotations

import tempfile
from functools import cache

from pyspark.sql import DataFrame, SparkSession

# All of these may be set on a running session; cluster sizing is left to spark-submit.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # of a key that a document repeats the last value counts
    "spark.sql.variant.allowDuplicateKeys": "true",
}


# Shuffle data that one task should handle; adaptive execution merges smaller partitions.
SHUFFLE_BYTES = 128 * 1024 * 1024


def shuffle_partitions(input_bytes: int, at_least: int = 200) -> int:
    """Shuffle partitions for a job that reads about ``input_bytes``.

    Adaptive execution can only merge partitions, so a large job has to start with many.
    """
    return max(at_least, -(-input_bytes // SHUFFLE_BYTES))


def build_session(
    app_name: str = "millrace", master: str | None = None, input_bytes: int | None = None, **conf: str
) -> SparkSession:
    """New or running session with ``SETTINGS``; ``conf`` keys may use ``__`` for dots.

    ``input_bytes``, what the job is going to read, sizes its shuffles.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = dict(SETTINGS)
    if input_bytes is not None:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions(input_bytes))
    settings |= {key.replace("__", "."): value for key, value in conf.items()}
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def apply_settings(spark: SparkSession) -> SparkSession:
    """Put ``SETTINGS`` on a session that somebody else built."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def shared_root(spark: SparkSession) -> str:
    """Folder that every executor can reach, for intermediate tables and stream checkpoints.

    It is the session's ``spark.checkpoint.dir``. Only a local session may do without: it
    gets a new temporary folder.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return _local_root()


def checkpointed(rows: DataFrame) -> DataFrame:
    """Rows written once to the shared folder, their lineage cut."""
    context = rows.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_root(rows.sparkSession))
    return rows.checkpoint()


@cache
def _local_root() -> str:
    return tempfile.mkdtemp(prefix="millrace-")
