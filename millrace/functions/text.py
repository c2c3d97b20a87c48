"""Text columns: ids out of addresses, display text, object keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def last_segment(url: Column) -> Column:
    """What follows the last ``/``; empty when the text ends in one."""
    return F.substring_index(url, "/", -1)


def unquote_plus(text: Column) -> Column:
    """URL-decode with ``+`` as space; a ``%`` that starts no escape stays as it is."""
    return F.url_decode(F.regexp_replace(text, "%(?![0-9A-Fa-f]{2})", "%25"))


def unquote(text: Column) -> Column:
    """URL-decode that leaves ``+`` alone."""
    return unquote_plus(F.replace(text, F.lit("+"), F.lit("%2B")))


def trim_timestamp(text: Column) -> Column:
    """ISO-8601 text to ``yyyy-MM-dd HH:mm:ss`` by text edits alone, as far as it goes."""
    plain = F.replace(F.replace(text, F.lit("+00:00"), F.lit("")), F.lit("T"), F.lit(" "))
    return F.substring(plain, 1, 19)


def lead_message(name: Column, email: Column, owner: Column, funnel: Column, status: Column) -> Column:
    """Notification text of a new lead; a null field reads ``None``."""
    fields = [F.coalesce(c.cast("string"), F.lit("None")) for c in (name, email, owner, funnel, status)]
    # Fixed value: the wording of the message.
    return F.format_string("New Lead: %s | %s | Owner: %s | Funnel: %s | Status: %s", *fields)


def money_text(amount: Column, decimals: int) -> Column:
    """``$12,346`` or ``$12,345.50``."""
    return F.concat(F.lit("$"), F.format_number(amount, decimals))


def object_key(prefix: str, identifier: Column, suffix: str = ".json") -> Column:
    """Storage key of one record, for exports that address records by name."""
    return F.concat(F.lit(prefix), identifier.cast("string"), F.lit(suffix))


def prefix(text: Column, length: int) -> Column:
    return F.left(text, F.lit(length))
