"""Left joins that hold under skew, and lookups that broadcast only what is small.

Adaptive execution splits a hot key in an inner join, and on the left of a left or anti join, but not on the right of
a left join, because that would give false unmatched rows. So a left join whose right side may be hot is
written as an inner join and an anti join side by side. Rows whose key is null match nothing and need no shuffle at all.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.operators.dedup import first_per_key

# What may be broadcast: at most this many rows and this many bytes.
BROADCAST_ROWS = 200_000
BROADCAST_BYTES = 32 * 1024 * 1024

_HIT = "__hit"


def _width(field: T.StructField) -> Column:
    """Bytes of a value: of texts and bytes as they are, of nested values as JSON, else of a number."""
    value = F.col(f"`{field.name}`")
    kind = field.dataType
    if isinstance(kind, T.StringType | T.BinaryType):
        return F.coalesce(F.octet_length(value), F.lit(0))
    if isinstance(kind, T.ArrayType | T.MapType | T.StructType | T.VariantType):
        whole = value if isinstance(kind, T.VariantType) else F.struct(value.alias("v"))
        return F.coalesce(F.octet_length(F.to_json(whole)), F.lit(0))
    return F.lit(8)


def is_small(df: DataFrame, rows: int | None = None, size: int | None = None) -> bool:
    """Whether ``df`` may be broadcast, by a distributed count of its rows and bytes.

    ``rows=0`` says no without looking.
    """
    rows = BROADCAST_ROWS if rows is None else rows
    size = BROADCAST_BYTES if size is None else size
    if rows == 0:
        return False
    width = sum((_width(f) for f in df.schema), F.lit(0))
    counted = df.agg(F.count(F.lit(1)).alias("rows"), F.sum(width).alias("bytes")).first()
    return counted["rows"] <= rows and (counted["bytes"] or 0) <= size


def _no_null(keys: Sequence[str]) -> Column:
    known = F.col(keys[0]).isNotNull()
    for key in keys[1:]:
        known = known & F.col(key).isNotNull()
    return known


def _with_nothing(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``left`` with the columns of ``right`` as nulls."""
    nothing = [F.lit(None).cast(f.dataType).alias(f.name) for f in right.schema if f.name not in keys]
    return left.select(*keys, *[c for c in left.columns if c not in keys], *nothing)


def skew_left_join(
    left: DataFrame, right: DataFrame, keys: Sequence[str], present: DataFrame | None = None
) -> DataFrame:
    """Left outer join where one key may hold much of the right side.

    ``present`` has the keys of ``right``, where they are cheaper to come by.
    """
    matched = left.join(right, list(keys))
    known = left.where(_no_null(keys))
    alone = known.join((right if present is None else present).select(*keys).distinct(), list(keys), "left_anti")
    rest = alone.unionByName(left.where(~_no_null(keys)))
    return matched.unionByName(_with_nothing(rest, right, keys))


def lookup_join(
    facts: DataFrame, dimension: DataFrame, keys: Sequence[str], broadcast_rows: int | None = None
) -> DataFrame:
    """Left outer join of facts to a dimension; a miss gives nulls.

    Broadcast when the dimension is counted to be small. Beyond that it is a shuffle join, in which a hot fact key
    is split as it runs; facts without a key stand beside it.
    """
    if is_small(dimension, broadcast_rows):
        return facts.join(F.broadcast(dimension), list(keys), "left")
    found = facts.where(_no_null(keys)).join(dimension, list(keys), "left")
    return found.unionByName(_with_nothing(facts.where(~_no_null(keys)), dimension, keys))


def keep_matching(facts: DataFrame, wanted: DataFrame, key: str, broadcast_rows: int | None = None) -> DataFrame:
    """Facts whose key is wanted."""
    hits = wanted.select(key).distinct()
    hits = F.broadcast(hits) if is_small(hits, broadcast_rows) else hits
    return facts.join(hits, key, "left_semi")


def insert_if_absent(
    new: DataFrame,
    target: DataFrame,
    key: str,
    order_by: Sequence[str] | None = None,
    broadcast_rows: int | None = None,
) -> DataFrame:
    """Rows of ``new``, one per key, whose key the target lacks: what an append may add.

    A small batch is not a reason to shuffle a large target: its keys are broadcast to find the
    ones already present, and only those meet the batch again.
    """
    fresh = first_per_key(new, [key], order_by)
    if target.isEmpty():  # the keys of the batch need not be counted
        return fresh
    present = narrowed(target.select(key), new, key, broadcast_rows)
    # distinct: a key that fills the target must not fill one task of the join
    return fresh.join(present.distinct(), key, "left_anti")


def docs_for_keys(wanted: DataFrame, docs: DataFrame, key: str, broadcast_rows: int | None = None) -> DataFrame:
    """Exactly the documents whose key is wanted, read as a set instead of one by one."""
    return keep_matching(docs, wanted, key, broadcast_rows)


def narrowed(
    rows: DataFrame, batch: DataFrame, key: str, broadcast_rows: int | None = None
) -> DataFrame:
    """``rows`` ahead of a join with ``batch``: at least all that the batch can meet.

    A small batch filters the rows where they are scanned, without a shuffle. For a large one all
    rows are passed on: the join that follows finds the partners anyway.
    """
    keys = batch.select(key)
    if is_small(keys, broadcast_rows):
        return rows.join(F.broadcast(keys.distinct()), key, "left_semi")
    return rows
