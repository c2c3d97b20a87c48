"""Lead documents, owners, upsert, gold and messages."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.functions import documents
from millrace.operators.dedup import latest_per_key
from millrace.plans import leads as p
from millrace.registry.views import lead_docs, owners, scratch, table
from millrace.streaming import outbox, runs

_DOC = "__doc"


def owner_merge(spark, d):
    """Leads with their owners; where both have a key, the lead's value stands, null too."""
    silver = documents.with_parsed(p.lead_silver(lead_docs(spark, d), owners(spark, d)), "body", _DOC)
    doc = F.col(_DOC)
    return silver.select(
        documents.field(doc, "lead_id").alias("lead_id"),
        documents.field(doc, "event.lead_id").alias("event_lead_id"),
        documents.field(doc, "display_name").alias("display_name"),
        documents.field(doc, "lead_owner").alias("lead_owner"),
        documents.field(doc, "status_label").alias("status_label"),
        documents.has_key(doc, "date_created").alias("has_owner"),
        documents.field(doc, "toxic", "int").alias("toxic"),
        F.md5(documents.field(doc, "text")).alias("text_md5"),
    )


def _gold(spark, d):
    return p.lead_gold(p.lead_silver(lead_docs(spark, d), owners(spark, d)))


def lead_gold(spark, d):
    return _gold(spark, d).valid.drop("doc_id")


def lead_quarantine(spark, d):
    """Leads without owner lack the owner's fields."""
    return _gold(spark, d).quarantine.select("doc_id", F.array_join("reasons", " ").alias("reasons"))


def lead_outbox(spark, d):
    return p.lead_outbox(_gold(spark, d).valid)


def outbox_delivery(spark, d):
    """Messages of the leads in three batches, each with all of the one before; the second sender stops ahead of its acknowledgement."""
    root = scratch(spark, "outbox")
    messages = p.lead_outbox(_gold(spark, d).valid)
    part = F.pmod(F.col("lead_id").cast("bigint"), F.lit(3))
    for n in range(3):
        runs.write_batch(messages.where((part <= n) & (part >= n - 1)), f"{root}/pending", n)
        claimed = outbox.claim(spark, root, messages.schema, "lead_id")
        if claimed and n != 1:
            outbox.acknowledge(spark, root, claimed)
    # the third call has taken up the second claim again; what came meanwhile is claimed now
    while claimed := outbox.claim(spark, root, messages.schema, "lead_id"):
        outbox.acknowledge(spark, root, claimed)
    return outbox.delivered(spark, root, messages.schema).select("lead_id", "text", outbox.RUN)


def load_leads(spark, d):
    """Gold leads into a table that holds the toxic ones."""
    target = table(spark, d, "labels").where("toxic = 1").select(F.col("doc_id").cast("string").alias("lead_id"))
    rows = p.load_leads(_gold(spark, d).valid, target)
    return rows.withColumn("date_created", F.col("date_created").cast("timestamp_ntz"))


def load_first_arrival(spark, d):
    """Turns of a conversation as deliveries of one lead; the first to arrive is inserted."""
    new = table(spark, d, "conversations").select(
        F.col("conv_id").cast("string").alias("lead_id"),
        F.col("role").alias("display_name"),
        F.md5("text").alias("lead_email"),
        F.col("turn").cast("string").alias("lead_owner"),
        F.lit("chat").alias("funnel"),
        F.lit(None).cast("string").alias("status_label"),
        F.lit("2024-01-02 03:04:05").alias("date_created"),
        F.timestamp_seconds(F.col("turn")).alias("ingest_ts"),
    )
    target = table(spark, d, "labels").where("toxic = 1").select(F.col("doc_id").cast("string").alias("lead_id"))
    rows = p.load_leads(new, target)
    return rows.withColumn("date_created", F.col("date_created").cast("timestamp_ntz"))


def upsert_latest(spark, d):
    return latest_per_key(table(spark, d, "conversations"), ["conv_id"], ["turn"])


GOLD_SQL = """gold AS (
  SELECT CAST(doc_id AS VARCHAR) AS lead_id, source AS display_name,
    'lead' || CAST(doc_id AS VARCHAR) || '@example.org' AS lead_email,
    'owner' || CAST(quality AS VARCHAR) AS lead_owner, lang AS funnel,
    CAST(NULL AS VARCHAR) AS status_label, '2024-01-02 03:04:05' AS date_created, toxic
  FROM documents JOIN labels USING (doc_id))"""

_MESSAGE = """'New Lead: ' || display_name || ' | ' || lead_email || ' | Owner: ' || lead_owner
  || ' | Funnel: ' || funnel || ' | Status: None'"""

QUERIES = {
    "owner_merge": (
        owner_merge,
        """SELECT CAST(d.doc_id AS VARCHAR) AS lead_id, CAST(d.doc_id AS VARCHAR) AS event_lead_id,
          d.source AS display_name, 'owner' || CAST(l.quality AS VARCHAR) AS lead_owner,
          CAST(NULL AS VARCHAR) AS status_label, l.doc_id IS NOT NULL AS has_owner, l.toxic,
          md5(d.text) AS text_md5
        FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""",
    ),
    "lead_gold": (lead_gold, f"WITH {GOLD_SQL} SELECT * EXCLUDE (toxic) FROM gold"),
    "lead_quarantine": (
        lead_quarantine,
        """SELECT CAST(doc_id AS VARCHAR) AS doc_id, 'lead_owner date_created' AS reasons FROM documents
        WHERE doc_id NOT IN (SELECT doc_id FROM labels)""",
    ),
    "lead_outbox": (
        lead_outbox,
        f"""WITH {GOLD_SQL}, texts AS (SELECT lead_id, {_MESSAGE} AS text FROM gold)
        SELECT lead_id, text, '{{"text":"' || text || '"}}' AS message FROM texts""",
    ),
    "outbox_delivery": (
        outbox_delivery,
        f"""WITH {GOLD_SQL}
        SELECT lead_id, {_MESSAGE} AS text, CAST(CAST(lead_id AS BIGINT) % 3 + 1 AS INTEGER) AS run FROM gold""",
    ),
    "load_leads": (
        load_leads,
        f"""WITH {GOLD_SQL}
        SELECT * EXCLUDE (toxic) REPLACE (CAST(date_created AS TIMESTAMP) AS date_created)
        FROM gold WHERE toxic <> 1""",
    ),
    "load_first_arrival": (
        load_first_arrival,
        """SELECT CAST(conv_id AS VARCHAR) AS lead_id, role AS display_name, md5(text) AS lead_email,
          CAST(turn AS VARCHAR) AS lead_owner, 'chat' AS funnel, CAST(NULL AS VARCHAR) AS status_label,
          TIMESTAMP '2024-01-02 03:04:05' AS date_created
        FROM conversations WHERE conv_id NOT IN (SELECT doc_id FROM labels WHERE toxic = 1)
        QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY turn, md5(text)) = 1""",
    ),
    "upsert_latest": (
        upsert_latest,
        """SELECT * FROM conversations
        QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC) = 1""",
    ),
}
