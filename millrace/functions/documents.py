"""JSON documents: parse once to VARIANT, then read typed fields by path.

A VARIANT tells a missing key (SQL NULL) from an explicit JSON null, which the required-field
rules need and a struct schema cannot express.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def parse(body: Column) -> Column:
    """JSON text to VARIANT; null when it is not valid JSON."""
    return F.try_parse_json(body)


def with_once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Add ``value`` as a column that is worked out once per row, however often it is read.

    The optimizer copies a plain projected expression into the filters and lambdas that read it,
    which here would parse a document again for each; it leaves the output of a generator alone.
    """
    return df.select("*", F.explode(F.array(value)).alias(name))


def with_parsed(df: DataFrame, body: str, name: str) -> DataFrame:
    """Add the parsed ``body`` as column ``name``."""
    return with_once(df, name, parse(F.col(body)))


def field(doc: Column, path: str, kind: str = "string") -> Column:
    """Value at ``path``; null when absent, JSON null or not of that kind."""
    return F.try_variant_get(doc, f"$.{path}", kind)


def inside(value: Column, path: str, root: str) -> Column:
    """Place ``path`` of a document whose part ``root`` was read as the struct ``value``; null where an array is too short."""
    for step in path.removeprefix(f"{root}.").split("."):
        name, _, place = step.rstrip("]").partition("[")
        value = F.get(value[name], F.lit(int(place))) if place else value[name]
    return value


def has_key(doc: Column, path: str) -> Column:
    """True when the path exists, even with a JSON null."""
    return F.try_variant_get(doc, f"$.{path}", "variant").isNotNull()


def has_value(doc: Column, path: str) -> Column:
    """True when the path exists and is not a JSON null."""
    found = F.try_variant_get(doc, f"$.{path}", "variant")
    return found.isNotNull() & ~F.is_variant_null(found)


def top_level(doc: Column) -> Column:
    """Object to ``map<string,variant>``; null for anything else."""
    return doc.try_cast("map<string,variant>")


def merge_right_wins(left: Column, right: Column) -> Column:
    """Union of two maps by key; the right value stands on conflict, also when it is null."""
    only_left = F.map_filter(left, lambda key, _: ~F.map_contains_key(right, key))
    return F.map_concat(only_left, right)


def as_text(value: Column) -> Column:
    """Scalar VARIANT as plain text, nested VARIANT as JSON text."""
    return F.coalesce(F.try_variant_get(value, "$", "string"), F.when(
        ~F.is_variant_null(value), F.to_json(value)))


def json_text(*columns: Column | str) -> Column:
    """One JSON object of the columns, nulls written out."""
    return F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})


def first_element(array: Column) -> Column:
    """First array element, null for an empty array."""
    return F.get(array, F.lit(0))


def number(text: Column) -> Column:
    """Double from number text; null stays null and bad text raises."""
    return text.cast("double")


def lookup(key: Column, values: dict[str, str]) -> Column:
    """Constant map lookup, null on a miss; for maps of a handful of entries."""
    pairs = [F.lit(item) for pair in values.items() for item in pair]
    return F.create_map(*pairs)[key]
