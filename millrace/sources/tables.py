"""Layer tables on parquet: pruned reads, balanced and repeatable writes."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import date
from typing import NamedTuple

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

DAY = "ingest_date"


def write_layer(
    df: DataFrame,
    path: str,
    by: Sequence[str] = (DAY,),
    balance_by: Sequence[str] = (),
    replace_all: bool = False,
) -> None:
    """Overwrite only the partitions that ``df`` holds, or the whole table.

    ``balance_by`` names the partition columns of many values in ``df``. The rows of one value
    are then brought into few files, and adaptive execution cuts a value that is too large for
    one task. Rows of a single day need no such shuffle.
    """
    if balance_by:
        df = df.hint("rebalance", *balance_by)
    (
        df.write.mode("overwrite")
        .option("partitionOverwriteMode", "static" if replace_all else "dynamic")
        .partitionBy(*by)
        .parquet(path)
    )


def write_table(df: DataFrame, path: str) -> None:
    """Replace a whole table; each table has a folder of its own, none inside another."""
    df.write.mode("overwrite").parquet(path)


def write_day(df: DataFrame, path: str, day: date | str, by: Sequence[str] = ()) -> None:
    """Replace one day of a layer table as a whole, by nothing if ``df`` has no rows.

    ``by`` names partition columns below the day; a value of many rows is spread over tasks and files.
    """
    if by:
        df = df.hint("rebalance", *by)
    writer = df.write.mode("overwrite").option("partitionOverwriteMode", "static")
    (writer.partitionBy(*by) if by else writer).parquet(f"{path}/{DAY}={day}")


def with_day(df: DataFrame, day: date | str) -> DataFrame:
    return df.withColumn(DAY, F.lit(str(day)).cast("date"))


def if_present(read: Callable[[], DataFrame]) -> DataFrame | None:
    """What ``read`` gives, or None when its path does not exist; other failures are raised."""
    try:
        return read()
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def optional_table(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The table at ``path``, or an empty one of that schema when the path does not exist."""
    table = if_present(lambda: spark.read.schema(schema).parquet(path))
    return spark.createDataFrame([], schema) if table is None else table


def read_day(spark: SparkSession, path: str, day: date | str, schema: T.StructType) -> DataFrame:
    """One ingest day of a layer table; only that partition is scanned."""
    full = T.StructType([*schema.fields, T.StructField(DAY, T.DateType())])
    table = optional_table(spark, path, full)
    return table.where(F.col(DAY) == F.lit(str(day)).cast("date")).select(*schema.names)


def has_rows(df: DataFrame) -> bool:
    """Whether there is anything to write; stops at the first row."""
    return not df.isEmpty()


def write_json(df: DataFrame, path: str) -> None:
    """One JSON object per row, nulls written out, for readers outside Spark."""
    df.write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def marketing_table(spark: SparkSession, name: str = "marketing") -> DataFrame:
    """The catalog table of enriched bookings, all columns."""
    return spark.table(name)


def write_mart(mart: DataFrame, path: str) -> None:
    """Replace the bookings mart, by day of the booking: a month's reports read that month."""
    day = ["booking_date"]
    write_layer(mart, path, by=day, balance_by=day, replace_all=True)


def digests(df: DataFrame, by: str) -> DataFrame:
    """``by``, ``rows`` and two sums over the hashes of its rows, in whatever order they come: equal rows, equal digest."""
    # a hash passes nulls over, so which columns are null is hashed with them
    columns = [F.col(f"`{c}`") for c in df.columns]
    whole = [*columns, *[c.isNull() for c in columns]]
    return df.groupBy(by).agg(
        F.count(F.lit(1)).alias("rows"),
        F.sum(F.xxhash64(F.lit(1), *whole).cast("decimal(20,0)")).cast("string").alias("total"),
        F.bit_xor(F.xxhash64(F.lit(2), *whole)).alias("mixed"),
    )


class Refresh(NamedTuple):
    """What a refresh did: rows of the table now, days that were written, days that are gone."""

    rows: int
    written: list
    gone: list


# Beside the day folders; readers of the table pass a folder with such a name over.
_DAYS = "_days"


def refresh_days(df: DataFrame, path: str, by: str) -> Refresh:
    """Bring the table at ``path``, with a folder for each day of ``by``, up to ``df``: only days that differ are written.

    The digest of every day is kept with the table and compared with that of ``df``, a row for each day; so ``df`` is read once,
    and once more for the days that changed. Before a day is written its digest goes, and it is put back with the new one at the
    end: a refresh that was stopped is made up for by the next. Rows are counted in the write; if there are not as many as in
    the digests, ``df`` changed meanwhile, and an error says so.
    """
    spark = df.sparkSession
    types = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in df.schema)
    now = {r[by]: r for r in digests(df, by).withColumn("types", F.lit(types)).collect()}
    kept = if_present(lambda: spark.read.parquet(f"{path}/{_DAYS}"))
    before = {} if kept is None else {r[by]: r for r in kept.collect()}
    schema = T.StructType([df.schema[by], *T.StructType.fromDDL("rows bigint, total string, mixed bigint, types string").fields])

    def keep(rows: list) -> None:
        write_table(spark.createDataFrame([tuple(r[n] for n in schema.names) for r in rows], schema).coalesce(1), f"{path}/{_DAYS}")

    fields = ("rows", "total", "mixed", "types")
    same = {day for day, r in now.items() if day in before and all(r[f] == before[day][f] for f in fields)}
    changed, gone = [d for d in now if d not in same], [d for d in before if d not in now]
    if not changed and not gone and kept is not None:
        return Refresh(sum(r["rows"] for r in now.values()), [], [])
    anew = kept is None or any(r["types"] != types for r in before.values())
    if not anew:
        keep([before[day] for day in same])
    if changed or anew:
        known = [d for d in changed if d is not None]
        of_days = F.col(by).isin(known) | (F.col(by).isNull() if None in changed else F.lit(False))
        seen = Observation()
        rows = (df if anew else df.where(of_days)).observe(seen, F.count(F.lit(1)).alias("rows"))
        write_layer(rows, path, by=[by], balance_by=[by], replace_all=anew)
        if seen.get["rows"] != sum(now[d]["rows"] for d in (now if anew else changed)):
            raise RuntimeError("the source changed while the table was refreshed; refresh it again")
    nothing = spark.createDataFrame([], T.StructType([f for f in df.schema if f.name != by]))
    for day in [] if anew else gone:
        write_table(nothing, f"{path}/{by}={'__HIVE_DEFAULT_PARTITION__' if day is None else day}")
    keep(list(now.values()))
    return Refresh(sum(r["rows"] for r in now.values()), sorted(now if anew else changed, key=str), gone)


def load_mart(spark: SparkSession, path: str) -> DataFrame:
    """The mart as written; ``booking_date`` comes back as a date from the folder names."""
    return spark.read.parquet(path)
