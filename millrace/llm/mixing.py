"""Operator 11: sources mixed to target weights, by entropy balancing.

1. A document's size is its number of words. Sizes are counted once; how many documents of each size a source has is all that
   the steps up to 4 read.
2. Targets: sources in the order of their code points weigh 5, 2, 1 over and over and share 150 % of all words. What exceeds
   twice a source's words is shared anew among the others, until no target is above.
3. Rates: of all rates with a source's words at its target and none above two, those with the least entropy relative to one copy of each
   document. They are exponentially tilted: min(2, exp(z * size)), with a multiplier z for each source. Newton
   steps on the logarithm of the constraints find all multipliers at once, a grouped sum over the table of sizes for each step; a step that leaves its
   bracket is replaced by the middle. Sums are of whole numbers, so that a rerun takes the same path.
4. Copies: per source from the largest size to the smallest, the copies of a size are its rate's, rounded, with the words
   that rounding left over so far. So a source misses its target by about half of its smallest document.
5. Of the documents of one source and size those with the least hashes take the odd copies. A source and size with very many documents is
   numbered in buckets.

A null text has no words; a null source is a source of its own, the last one. Rows that share an id are mixed each for itself, also those without one. Very long
texts are counted like others. Without documents there are no rows; if all sizes are zero, all targets are. Other columns are left aside.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from millrace.llm.texts import share_code, written

WORDS = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)
PERCENT = 150
MOST_COPIES = 2
# Rates are whole numbers of this part, so that sums do not depend on their order.
UNIT = 1 << 40
# A source's words may differ from its target by this share before they are rounded to copies.
PRECISION = 1e-7
MOST_ROUNDS = 200
# Documents of one source and size that are numbered together; at most MOST_SPLIT sources and sizes are split, which bounds what is broadcast.
BUCKET_ROWS, MOST_SPLIT = 50_000, 100_000


def sized(docs: DataFrame) -> DataFrame:
    """doc_id, key (of the source: empty for null), size of every row."""
    return docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.coalesce(F.concat(F.lit("="), F.col("source").cast("string")), F.lit("")).alias("key"),
        F.coalesce(F.regexp_count(F.col("text").cast("string"), F.lit(WORDS)), F.lit(0)).cast("bigint").alias("size"),
    )


def weighed(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """key, source_size, weight: sources in the order of their code points, null last.

    Places come from ranges of sources that are counted apart, so that no task sorts them all.
    """
    order = [(F.col("key") == "").asc(), F.col("key").asc()]
    sources = sizes.groupBy("key").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"))
    ranged = written(sources.repartitionByRange(*order).withColumn("range", F.spark_partition_id()), "mix-sources")
    before = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    firsts = ranged.groupBy("range").agg(F.count(F.lit(1)).alias("n")).select("range", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    inside = Window.partitionBy("range").orderBy(*order)
    placed = ranged.withColumn("place", F.row_number().over(inside) - 1).join(firsts, "range").withColumn("place", F.col("place") + F.col("first"))
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("place") % len(weights) + 1).cast("int"))
    return placed.select("key", "source_size", weight.cast("bigint").alias("weight"))


def with_targets(sources: DataFrame, percent: int = PERCENT, most: int = MOST_COPIES) -> DataFrame:
    """Sources with ``target``: shares by weight of ``percent`` of all words, none above ``most`` times the source's own."""
    total = sources.agg(F.sum("source_size")).first()[0] or 0
    level = 0.0
    while True:
        # each round caps the sources that the level of the last one fills; it rises until none is left to cap
        cap = F.col("source_size") * most
        full = F.col("weight") * F.lit(level) >= cap
        capped, weight = sources.agg(F.sum(F.when(full, cap).otherwise(0)), F.sum(F.when(full, 0).otherwise(F.col("weight")))).first()
        rest = percent * total - 100 * (capped or 0)
        raised = rest / (100 * weight) if weight else level
        if raised <= level:
            return sources.withColumn("target", F.least(F.col("weight") * F.lit(level), cap.cast("double")))
        level = raised


def _rate(most: int) -> Column:
    """Rate in units: the exponential tilt, cut at the most copies."""
    return F.round(F.exp(F.least(F.col("z") * F.col("size"), F.lit(math.log(most)))) * UNIT).cast("bigint")


def _summed(sizes: DataFrame, state: DataFrame, most: int) -> DataFrame:
    """``state`` with the words that its rates take, and by how much they change with z."""
    rate, words = F.col("rate").cast("decimal(13,0)"), (F.col("n") * F.col("size")).cast("decimal(19,0)")
    tilted = F.when(F.col("rate") < most * UNIT, words * F.col("size").cast("decimal(10,0)") * rate)
    kept = [F.min(c).alias(c) for c in ("source_size", "target", "z", "low", "high")]
    in_units = lambda x: F.coalesce(F.sum(x).cast("double") / UNIT, F.lit(0.0))
    rated = sizes.join(state, "key").withColumn("rate", _rate(most))
    return rated.groupBy("key").agg(*kept, in_units(words * rate).alias("words"), in_units(tilted).alias("slope"))


def with_multipliers(sizes: DataFrame, sources: DataFrame, most: int = MOST_COPIES) -> DataFrame:
    """Sources with the multiplier ``z`` of their rates and ``words``, what the rates take."""
    highest = math.log(most)
    target, words, z, low, high = map(F.col, ("target", "words", "z", "low", "high"))
    short = target < F.col("source_size")
    # at the lower end of the bracket rates take too little or just enough, at the upper end too much or just enough
    begun = sources.select(
        "key", "source_size", "target",
        F.when(target >= F.col("source_size") * most, highest).otherwise(0.0).alias("z"),
        F.when(short & (target > 0), F.log(target / F.nullif("source_size", F.lit(0)))).otherwise(0.0).alias("low"),
        F.when(short, 0.0).otherwise(highest).alias("high"),
    )
    state = written(begun, "mix-state")
    for _ in range(MOST_ROUNDS):
        summed = written(_summed(sizes, state, most), "mix-state")
        off = (target > 0) & (F.abs(words - target) > PRECISION * target)
        # a bracket without a number inside ends the search as well: the unit of rates is reached
        still = off & ((high - low) > 1e-15 * F.greatest(F.abs(low), F.abs(high)))
        if not summed.where(still).limit(1).count():
            return summed.select("key", "source_size", "target", "z", "words")
        little = words < target
        step = F.log(target / F.nullif("words", F.lit(0.0))) * words / F.nullif("slope", F.lit(0.0))
        narrowed = summed.where(still).select(
            "key", "source_size", "target", (z + step).alias("z"), F.when(little, z).otherwise(low).alias("low"), F.when(little, high).otherwise(z).alias("high")
        )
        moved = narrowed.withColumn("z", F.when((z > low) & (z < high), z).otherwise((low + high) / 2))
        state = moved.unionByName(summed.where(~still).select(*moved.columns))
    raise RuntimeError(f"the multipliers are not at rest after {MOST_ROUNDS} rounds")


def copies_by_size(sizes: DataFrame, state: DataFrame, most: int = MOST_COPIES) -> DataFrame:
    """key, size, n, source_size, target, copies: how many copies all documents of a source and size have together.

    The sizes of a source lie in one task, one after the other: their number grows at most with the root of its words.
    """
    share_code(sizes.sparkSession.sparkContext)
    columns = ("key", "size", "n", "source_size", "target")
    schema = "key string, size bigint, n bigint, source_size bigint, target double, copies bigint"
    made_as = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, left = None, 0.0
        for batch in batches:
            held = {name: batch.column(name).to_pylist() for name in (*columns, "rate", "words")}
            copies = []
            for key, size, n, rate, words, target in zip(*(held[c] for c in ("key", "size", "n", "rate", "words", "target")), strict=True):
                if key != current:
                    current, left = key, target - words
                if not size:
                    copies.append(n)
                    continue
                wanted = n * (rate / UNIT) * size + left
                copies.append(min(max(math.floor(wanted / size + 0.5), 0), most * n))
                left = wanted - copies[-1] * size
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in columns), pa.array(copies, pa.int64())], schema=made_as)

    rated = sizes.join(state, "key").select(*columns, _rate(most).alias("rate"), "words")
    return rated.repartition("key").sortWithinPartitions("key", F.desc("size")).mapInArrow(run, schema)


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, percent: int = PERCENT, most: int = MOST_COPIES) -> DataFrame:
    """doc_id, size, source_size, target, taken, copies of every row."""
    rows = written(sized(docs), "mix-docs")
    sizes = written(rows.groupBy("key", "size").agg(F.count(F.lit(1)).alias("n")), "mix-sizes")
    sources = written(with_targets(written(weighed(sizes, weights), "mix-weights"), percent, most), "mix-targets")
    quotas = written(copies_by_size(sizes, with_multipliers(sizes, sources, most), most), "mix-copies")
    # a source and size of very many rows is dealt into buckets, and its odd copies go to them in turn
    bucket_rows = max(BUCKET_ROWS, -(-(sizes.agg(F.sum("n")).first()[0] or 0) // MOST_SPLIT))
    buckets = F.ceil(F.col("n") / bucket_rows).cast("int")
    large = F.broadcast(sizes.where(F.col("n") > bucket_rows).select("key", "size", buckets.alias("buckets")))
    hashed = F.xxhash64("doc_id", F.lit(11))
    dealt = rows.withColumn("hash", hashed).join(large, ["key", "size"], "left").withColumn("bucket", F.pmod("hash", F.coalesce("buckets", F.lit(1))))
    filled = dealt.where("buckets is not null").groupBy("key", "size", "bucket").agg(F.count(F.lit(1)).alias("own"))
    ahead = Window.partitionBy("key", "size").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    firsts = filled.select("key", "size", "bucket", F.coalesce(F.sum("own").over(ahead), F.lit(0)).alias("first"))
    split = quotas.withColumn("bucket", F.explode(F.sequence(F.lit(0).cast("bigint"), F.ceil(F.col("n") / bucket_rows) - 1)))
    offered = split.join(firsts, ["key", "size", "bucket"], "left")
    inside = Window.partitionBy("key", "size", "bucket").orderBy("hash", "doc_id")
    numbered = dealt.select("doc_id", "key", "size", "bucket", (F.row_number().over(inside) - 1).alias("place"))
    number = F.col("place") + F.coalesce("first", F.lit(0))
    extra = (number < F.col("copies") - F.expr("copies div n") * F.col("n")).cast("bigint")
    return numbered.join(offered, ["key", "size", "bucket"]).select(
        "doc_id", "size", "source_size", "target",
        ((F.expr("copies div n") + extra) * F.col("size")).alias("taken"), (F.expr("copies div n") + extra).cast("int").alias("copies"),
    )
