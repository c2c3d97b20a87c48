"""One row per key.

Both forms are ``row_number() = 1``. Spark plans that as a window group limit on each side of
the shuffle, so every map task sends at most one row per key: a key that holds a third of the
table costs one row per task, and its partition does not grow with it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

_RANK = "__rank"
_UNORDERED = (T.MapType, T.VariantType)


def orderable(df: DataFrame, besides: Sequence[str] = ()) -> list[str]:
    """Columns of ``df`` that can be compared, in schema order."""
    return [
        f.name for f in df.schema if f.name not in besides and not isinstance(f.dataType, _UNORDERED)
    ]


def _first(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(_RANK, F.row_number().over(window)).where(F.col(_RANK) == 1).drop(_RANK)


def first_per_key(
    df: DataFrame, keys: Sequence[str], order_by: Sequence[str | Column] | None = None
) -> DataFrame:
    """The first row of each key, by ``order_by`` or else by all other columns.

    Null keys form a group of their own, as in ``dropDuplicates``.
    """
    order = order_by or orderable(df, besides=keys) or keys
    return _first(df, keys, [F.col(c) if isinstance(c, str) else c for c in order])


def latest_per_key(df: DataFrame, keys: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """The last row of each key in the given order: last write wins."""
    return _first(df, keys, [F.col(c).desc_nulls_last() for c in order_by])


def dedup_by(keys: Sequence[str], order_by: Sequence[str | Column] | None = None):
    """``first_per_key`` for ``DataFrame.transform``."""
    return lambda df: first_per_key(df, keys, order_by)
