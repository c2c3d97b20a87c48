"""Landing files: webhook bodies, feed pages, spend files, owner documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions import documents, text
from millrace.operators.joins import lookup_join
from millrace.operators.required import REASONS, Split, split_required
from millrace.schemas import SPEND
from millrace.sources import tables


def _with_file(lines: DataFrame) -> DataFrame:
    return lines.select(
        F.col("value").alias("body"),
        "_metadata.file_path",
        F.col("_metadata.file_modification_time").alias("file_time"),
    )


def bodies(spark: SparkSession, path: str, whole_files: bool = True) -> DataFrame:
    """Bodies of a landing folder: one per file, or one per line."""
    return _with_file(spark.read.text(path, wholetext=whole_files))


def stream_bodies(
    spark: SparkSession,
    path: str,
    whole_files: bool = True,
    files_per_batch: int = 100_000,
    archive: str | None = None,
) -> DataFrame:
    """The same as a stream of newly arrived files.

    With ``archive``, a folder outside ``path``, Spark moves finished files there, so that the
    landing folder does not grow and each listing stays short.
    """
    reader = spark.readStream.option("maxFilesPerTrigger", files_per_batch)
    if archive:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive)
    return _with_file(reader.text(path, wholetext=whole_files))


def bronze_rows(landed: DataFrame, doc_id: Column) -> DataFrame:
    """Bodies whole, with their business id and arrival; works on batch and stream.

    The arrival time is a constant of the micro-batch, so a replay writes the same rows.
    """
    return landed.select(
        doc_id.alias("doc_id"), "body", "file_path", "file_time", F.current_timestamp().alias("ingest_ts")
    )


def lead_id_of(body: Column) -> Column:
    return documents.field(documents.parse(body), "event.lead_id")


def invitee_id_of(body: Column) -> Column:
    return text.last_segment(documents.field(documents.parse(body), "payload.uri"))


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """Page files of a feed as ``body``, with the columns that its folders name."""
    return spark.read.text(path, wholetext=True).withColumnRenamed("value", "body")


_ELEMENT, _DOC, _VALUES, _BAD, _PLACE = "element", "__doc", "__values", "__bad_page", "__place"


def split_pages(pages: DataFrame, page: str = "body") -> Split:
    """Pages that are JSON arrays, and the others. The size of a page does not matter."""
    array = F.from_json(F.col(page), "array<string>").isNotNull()
    return split_required(pages, {"array": array})


def until_short_page(pages: DataFrame, by: str, number: str, page_rows: int, page: str = "body") -> DataFrame:
    """Pages of each ``by`` up to the first that has fewer than ``page_rows`` elements: a fetch stops there, what lies behind is stale.

    A page that is no array counts as short, and pages of one number as one fetch: all of them stay. The first short page of each ``by``
    is an aggregate of the sizes; page texts are not shuffled for it if there are few of them.
    """
    rows = F.coalesce(F.size(F.from_json(F.col(page), "array<string>")), F.lit(-1))
    short = pages.where(rows < page_rows).groupBy(by).agg(F.min(number).alias(_PLACE))
    ended = lookup_join(pages, short, [by])
    return ended.where(F.col(_PLACE).isNull() | (F.col(number) <= F.col(_PLACE))).select(*pages.columns)


def _whole_number(value: Column) -> Column:
    """Number text to bigint where it has no fraction: ``12`` and ``12.0``, also as text."""
    exact = value.try_cast("decimal(38,9)")
    return F.when(exact == F.floor(exact), exact.try_cast("bigint"))


def _typed(value: Column, kind: T.DataType) -> Column:
    return _whole_number(value) if isinstance(kind, T.LongType) else value.try_cast(kind)


def split_feed(pages: DataFrame, row_schema: T.StructType, page: str = "body") -> Split:
    """Elements of the JSON arrays in ``page``: rows of ``row_schema``, and elements that break a rule with the reasons.

    An element has to be an object with every field of the schema, null values allowed, and numbers where numbers are
    asked for; a feed may send them as text. Columns beside ``page`` are carried along. A page that is no array has no elements
    (see ``split_pages``).
    """
    rest = [c for c in pages.columns if c != page and c not in row_schema.names]
    elements = pages.select(*rest, F.explode(F.from_json(F.col(page), "array<string>")).alias(_ELEMENT))
    return _judged_elements(elements, row_schema, rest)


def split_landed(pages: DataFrame, row_schema: T.StructType, page: str = "body") -> Split:
    """``split_pages`` and ``split_feed`` in one pass: valid rows, and what is broken with the reasons.

    A broken element has ``element``, a page that is no array has its text in column ``page`` instead, and the reason ``array``.
    """
    array = F.from_json(F.col(page), "array<string>")
    rest = [c for c in pages.columns if c != page and c not in row_schema.names]
    opened = pages.select(*rest, F.when(array.isNull(), F.col(page)).alias(page), array.isNull().alias(_BAD), F.posexplode_outer(array).alias(_PLACE, _ELEMENT))
    # an array without elements leaves neither a place nor a bad page
    elements = opened.where(F.col(_BAD) | F.col(_PLACE).isNotNull()).drop(_PLACE)
    split = _judged_elements(elements, row_schema, [*rest, page, _BAD])
    judged = split.judged.withColumn(REASONS, F.when(F.col(_BAD), F.array(F.lit("array"))).otherwise(F.col(REASONS)))
    return split.held(judged).then(lambda rows: rows.drop(page, _BAD), lambda rows: rows.drop(_BAD))


def _judged_elements(elements: DataFrame, row_schema: T.StructType, rest: list[str]) -> Split:
    parsed = documents.with_once(elements, _DOC, documents.top_level(documents.parse(F.col(_ELEMENT))))
    doc = F.col(_DOC)
    texts = {f.name: documents.as_text(doc[f.name]) for f in row_schema}
    values = F.struct(*[_typed(texts[f.name], f.dataType).alias(f.name) for f in row_schema])
    valued = documents.with_once(parsed, _VALUES, F.when(doc.isNotNull(), values))
    rules: dict[str, Column] = {"object": doc.isNotNull()}
    for f in row_schema:
        rules[f.name] = F.map_contains_key(doc, f.name)
        if not isinstance(f.dataType, T.StringType):
            rules[f"{f.name} is a number"] = F.col(f"{_VALUES}.{f.name}").isNotNull() | texts[f.name].isNull()
    judged = split_required(valued, rules).judged.drop(_DOC)
    return Split(judged, lambda rows: rows.select(*rest, f"{_VALUES}.*"), lambda rows: rows.select(*rest, _ELEMENT, REASONS))


def feed_rows(pages: DataFrame, row_schema: T.StructType, page: str = "body") -> DataFrame:
    """The valid rows of ``split_feed``."""
    return split_feed(pages, row_schema, page).valid


def media_feed_rows(
    pages: DataFrame, row_schema: T.StructType, media_id: Column, page: str = "body"
) -> DataFrame:
    """``feed_rows`` for a feed whose elements do not name their media."""
    inner = T.StructType([f for f in row_schema if f.name != "media_id"])
    rows = feed_rows(pages.withColumn("media_id", media_id), inner, page)
    return rows.select(*row_schema.names)


def _array_of(row_schema: T.StructType, body: Column) -> Column:
    """JSON array of objects, every field as text; a body that is none raises."""
    as_text = T.StructType([T.StructField(f.name, T.StringType()) for f in row_schema])
    return F.from_json(body, T.ArrayType(as_text), {"mode": "FAILFAST"})


def spend_rows(files: DataFrame, body: str = "body") -> DataFrame:
    """Spend rows of JSON array files, with file and position to keep the array order."""
    kept = [c for c in ("file_path",) if c in files.columns]
    rows = files.select(*kept, F.posexplode(_array_of(SPEND, F.col(body))).alias("pos", "r"))
    return rows.select(
        *kept, "pos", *[F.col(f"r.{f.name}").cast(f.dataType).alias(f.name) for f in SPEND]
    )


def split_spend(files: DataFrame, body: str = "body") -> Split:
    """Spend files that are JSON arrays of objects with sound numbers, as rows, and the others whole with the reasons."""
    elements = F.from_json(F.col(body), "array<string>")
    objects = F.from_json(F.col(body), T.ArrayType(T.StructType([T.StructField(f.name, T.StringType()) for f in SPEND])))
    held = documents.with_once(files, _VALUES, F.struct(elements.alias("elements"), objects.alias("objects")))
    rows = F.col(f"{_VALUES}.objects")
    sound = F.forall(rows, lambda r: r.isNotNull() & (r["spend"].isNull() | r["spend"].try_cast("double").isNotNull()))
    rules = {"array": F.col(f"{_VALUES}.elements").isNotNull(), "objects": F.size(rows) == F.size(f"{_VALUES}.elements"), "numbers": sound}
    kept = [c for c in ("file_path",) if c in files.columns]

    def valid(whole: DataFrame) -> DataFrame:
        each = whole.select(*kept, F.posexplode(f"{_VALUES}.objects").alias("pos", "r"))
        return each.select(*kept, "pos", *[F.col(f"r.{f.name}").cast(f.dataType).alias(f.name) for f in SPEND])

    return split_required(held, rules).then(valid, lambda broken: broken.drop(_VALUES))


def read_spend(spark: SparkSession, root: str, day: str | None = None, broken: str | None = None) -> DataFrame:
    """Spend rows of the files under ``root``; with ``day`` only that day's file. No file or folder: no rows.

    A file that cannot be read stops the job; with ``broken``, a folder, it is set aside there with the reasons instead.
    """
    reader = spark.read
    if day is not None:
        # Fixed value: name of a day's spend file.
        reader = reader.option("pathGlobFilter", f"spend_data_{day}.json")
    files = tables.if_present(lambda: _with_file(reader.text(root, wholetext=True)))
    files = _no_files(spark) if files is None else files
    if broken is None:
        return spend_rows(files)
    split = split_spend(files)
    tables.write_table(split.quarantine, broken)
    return split.valid


def spend_of_named_day(spend: DataFrame) -> DataFrame:
    """Spend rows that bear the day their file is named after."""
    return spend.where(F.endswith("file_path", F.concat(F.lit("spend_data_"), "date", F.lit(".json"))))


def _no_files(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], "body string, file_path string, file_time timestamp")


def read_owners(spark: SparkSession, root: str) -> DataFrame:
    """Owner documents, one file per lead named after its id: ``lead_id, owner``. No folder: no rows."""

    def named() -> DataFrame:
        # the metadata column holds the name in URL form
        name = F.regexp_replace(F.col("_metadata.file_name"), r"\.json$", "")
        return spark.read.text(root, wholetext=True).select(text.unquote(name).alias("lead_id"), F.col("value").alias("owner"))

    found = tables.if_present(named)
    return spark.createDataFrame([], "lead_id string, owner string") if found is None else found
