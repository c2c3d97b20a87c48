"""Sales leads: bronze documents -> silver with owner -> gold, message, warehouse rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions import documents, text
from millrace.operators.joins import insert_if_absent, lookup_join, narrowed
from millrace.operators.required import Split, split_required
from millrace.schemas import ARRIVAL, LEAD_GOLD

_FIELDS = "__fields"
_GOLD = "__gold"
_OWNER = "__owner"
_OWNER_FIELDS = "__owner_fields"


def lead_silver(bronze: DataFrame, owners: DataFrame) -> DataFrame:
    """Each lead document merged with its owner document; the lead's own value stands.

    ``bronze`` has ``doc_id`` and ``body``, ``owners`` has ``lead_id`` and ``owner``, both JSON
    text. A lead without owner stays as it is. Owners grow with the leads, so they are not
    broadcast; a small batch of leads first picks its owners out where they are scanned.
    """
    owner = owners.select(F.col("lead_id").alias("doc_id"), F.col("owner").alias(_OWNER))
    owner = narrowed(owner, bronze, "doc_id")
    joined = lookup_join(bronze, owner, ["doc_id"], broadcast_rows=0)
    fields = joined
    for name, text_column in ((_FIELDS, "body"), (_OWNER_FIELDS, _OWNER)):
        fields = documents.with_once(
            fields, name, documents.top_level(documents.parse(F.col(text_column)))
        )
    merged = documents.merge_right_wins(F.col(_OWNER_FIELDS), F.col(_FIELDS))
    body = F.to_json(F.coalesce(merged, F.col(_FIELDS)), {"ignoreNullFields": "false"})
    # a body that is no JSON object stays as it came, for the quarantine
    return fields.withColumn("body", F.coalesce(body, F.col("body"))).drop(_OWNER, _FIELDS, _OWNER_FIELDS)


def lead_gold(silver: DataFrame) -> Split:
    """The 7 gold fields of merged documents, and the documents that lack one.

    Every field has to be present; only the creation time has to have a value, as it is cut.
    """
    kept = [c for c in silver.columns if c not in ("body", *LEAD_GOLD)]
    parsed = documents.with_once(
        silver, _FIELDS, documents.top_level(documents.parse(F.col("body")))
    )
    fields = F.col(_FIELDS)
    texts = F.struct(*[documents.as_text(fields[name]).alias(name) for name in LEAD_GOLD])
    rules: dict[str, Column] = {"body": fields.isNotNull()}
    rules |= {name: F.map_contains_key(fields, name) for name in LEAD_GOLD[:-1]}
    rules[LEAD_GOLD[-1]] = documents.as_text(fields[LEAD_GOLD[-1]]).isNotNull()
    judged = split_required(parsed.withColumn(_GOLD, texts), rules).judged.drop(_FIELDS)

    def valid(rows: DataFrame) -> DataFrame:
        gold = rows.select(f"{_GOLD}.*", *kept)
        return gold.withColumn("date_created", text.trim_timestamp(F.col("date_created")))

    return Split(judged, valid, lambda rows: rows.drop(_GOLD))


def lead_outbox(gold: DataFrame) -> DataFrame:
    """One notification per lead row, as text and as the message body to post."""
    message = text.lead_message(
        *[F.col(c) for c in ("display_name", "lead_email", "lead_owner", "funnel", "status_label")]
    )
    return gold.select("lead_id", message.alias("text")).withColumn(
        "message", documents.json_text("text")
    )


def load_leads(new: DataFrame, target: DataFrame) -> DataFrame:
    """Gold leads that the warehouse table lacks, with the creation time as a timestamp.

    Of several deliveries of a lead the first to arrive is taken, in one batch as in many.
    """
    rows = insert_if_absent(new, target, "lead_id", first_arrival(new, LEAD_GOLD))
    return rows.select(*LEAD_GOLD).withColumn("date_created", F.to_timestamp("date_created"))


def first_arrival(rows: DataFrame, columns: list[str]) -> list[str]:
    """Order of arrival, then of the columns; None of it is in the result."""
    arrived = [c for c in ARRIVAL if c in rows.columns]
    return [*arrived, *sorted(c for c in columns if c in rows.columns)]
