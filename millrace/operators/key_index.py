"""Which folders of a table may hold a key: a Bloom filter and the range of the key for each folder.

A filter is a set of bitmaps of fixed size. A key's bits all lie in one of them, so a key meets one row of a folder's filter. The number of
bitmaps is a power of two, by the number of keys: filters of equal size are probed by one join, whichever folder they
belong to. A folder that is not reported holds none of the keys; of a folder that does not hold a key, few are reported.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.operators import joins

# Bits of a bitmap are fixed by the built-in bitmap functions. With 16 bits and 7 hashes a key about one in 2,000 foreign keys is reported.
BITMAP_BITS = 32_768
KEYS_PER_BITMAP = BITMAP_BITS // 16
HASHES = 7


def schema(kind: T.DataType) -> T.StructType:
    fields = [("size", T.LongType()), ("bucket", T.LongType()), ("bitmap", T.BinaryType()), ("least", kind), ("greatest", kind)]
    return T.StructType([T.StructField(name, of) for name, of in fields])


def _bits(key: Column) -> list[Column]:
    """Places of a key's bits in its bitmap."""
    first, step = F.xxhash64(key, F.lit(1)), F.xxhash64(key, F.lit(2))
    # remainders first: the sum of two hashes may not fit a bigint
    at = [F.pmod(first, F.lit(BITMAP_BITS)), F.pmod(step, F.lit(BITMAP_BITS // 2)) * 2 + 1]
    return [F.pmod(at[0] + at[1] * n, F.lit(BITMAP_BITS)) for n in range(HASHES)]


def _bucket(key: Column, size: Column) -> Column:
    return F.pmod(F.xxhash64(key), size)


def build(rows: DataFrame, key: str) -> DataFrame:
    """``size, bucket, bitmap, least, greatest`` of the keys of one folder; null keys are left out."""
    keys = rows.select(F.col(key).alias("key")).where("key is not null")
    size, least = 1, keys.count()
    while size * KEYS_PER_BITMAP < least:
        size *= 2
    # keys are shuffled, not bitmaps: a task has few keys of each bucket, but its bitmap would be whole. One bitmap for each hash, then their union
    placed = keys.select(_bucket(F.col("key"), F.lit(size)).alias("bucket"), "key").repartition("bucket")
    each = placed.groupBy("bucket").agg(
        F.array(*[F.bitmap_construct_agg(bit) for bit in _bits(F.col("key"))]).alias("each"), F.min("key").alias("least"), F.max("key").alias("greatest")
    )
    opened = each.select("bucket", F.explode("each").alias("bitmap"), "least", "greatest")
    filled = opened.groupBy("bucket").agg(F.bitmap_or_agg("bitmap").alias("bitmap"), F.min("least").alias("least"), F.max("greatest").alias("greatest"))
    return filled.select(F.lit(size).cast("bigint").alias("size"), "bucket", "bitmap", "least", "greatest")


def _is_set(bitmap: Column, bit: Column) -> Column:
    byte = F.conv(F.hex(F.substring(bitmap, F.floor(bit / 8) + 1, F.lit(1))), 16, 10).cast("int")
    return F.getbit(byte, (bit % 8).cast("int")) == 1


def may_hold(index: DataFrame, folder: str, keys: DataFrame, key: str) -> list:
    """Folders that may hold one of the keys; ``index`` has the rows of ``build`` for every folder, named by column ``folder``.

    The keys' own range prunes the index first. The answer has a value for each folder at most.
    """
    wanted = keys.select(F.col(key).alias("key")).where("key is not null")
    least, greatest, n, size = wanted.agg(F.min("key"), F.max("key"), F.count(F.lit(1)), F.sum(F.octet_length(F.col("key").cast("string")))).first()
    if least is None:
        return []
    kind = index.schema["least"].dataType
    near = index.where((F.col("least") <= F.lit(greatest).cast(kind)) & (F.col("greatest") >= F.lit(least).cast(kind)))
    sizes = [r["size"] for r in near.select("size").distinct().collect()]  # powers of two
    if not sizes:
        return []
    probes = wanted.distinct().select("key", F.explode(F.array(*[F.lit(s).cast("bigint") for s in sizes])).alias("size"))
    probes = probes.withColumn("bucket", _bucket(F.col("key"), F.col("size")))
    if n * len(sizes) <= joins.BROADCAST_ROWS and size * len(sizes) <= joins.BROADCAST_BYTES:
        probes = F.broadcast(probes)
    hit = F.col("key").between(F.col("least"), F.col("greatest"))
    for bit in _bits(F.col("key")):
        hit = hit & _is_set(F.col("bitmap"), bit)
    return sorted(r[0] for r in near.join(probes, ["size", "bucket"]).where(hit).select(folder).distinct().collect())
