"""Lead documents: merge with owner, gold, messages, load."""

from __future__ import annotations

import json

import pytest

from millrace.plans import leads as p
from millrace.schemas import LEAD_GOLD
from millrace.sources import landing
from samples import lead, owner, put


def silver(frame, leads, owners):
    return p.lead_silver(
        frame([(json.loads(x)["lead_id"], x) for x in leads], "doc_id string, body string"),
        frame(owners, "lead_id string, owner string"),
    )


def bodies(df):
    return {r.doc_id: json.loads(r.body) for r in df.collect()}


def test_merge_is_a_union_where_the_lead_wins(frame):
    cases = [
        (lead("L1", funnel="ads", status_label=None, tags=["x", {"y": None}]), owner(extra={"a": 1})),
        (lead("L2"), None),
        (lead("L3", display_name="Mine"), owner()),
    ]
    owners = [(json.loads(b)["lead_id"], o) for b, o in cases if o]
    got = bodies(silver(frame, [b for b, _ in cases], owners))
    for body, other in cases:
        want = (json.loads(other) if other else {}) | json.loads(body)
        assert got[want["lead_id"]] == want


def test_gold_fields_and_trimmed_time(frame):
    gold = p.lead_gold(silver(frame, [lead("L1")], [("L1", owner(status_label=None))])).valid
    assert gold.columns == [*LEAD_GOLD, "doc_id"]
    row = gold.first()
    assert row.date_created == "2026-03-10 01:02:03"
    assert row.status_label is None and row.lead_owner == "Olga"


@pytest.mark.parametrize(
    "body, own, reasons",
    [
        (lead("L1"), None, LEAD_GOLD[1:]),
        (lead("L1"), owner(date_created=None), ["date_created"]),
        (lead("L1", date_created=None), owner(), ["date_created"]),
    ],
)
def test_missing_gold_field_goes_to_quarantine(frame, body, own, reasons):
    both = silver(frame, [body, lead("ok")], [("ok", owner())] + ([("L1", own)] if own else []))
    split = p.lead_gold(both)
    assert [r.lead_id for r in split.valid.collect()] == ["ok"]
    assert [(r.doc_id, r.reasons) for r in split.quarantine.collect()] == [("L1", reasons)]


def test_body_that_is_no_object_reaches_quarantine(frame):
    rows = frame([("x", "[1]"), ("y", "{bad")], "doc_id string, body string")
    merged = p.lead_silver(rows, frame([], "lead_id string, owner string"))
    bad = p.lead_gold(merged).quarantine.collect()
    assert {r.body for r in bad} == {"[1]", "{bad"} and all("body" in r.reasons for r in bad)


def test_outbox(frame):
    gold = p.lead_gold(silver(frame, [lead("L1")], [("L1", owner(funnel=None))])).valid
    row = p.lead_outbox(gold).first()
    assert row.text == (
        "New Lead: Owner's name | l@example.org | Owner: Olga | Funnel: None | Status: new"
    )
    assert json.loads(row.message) == {"text": row.text}


def test_load_is_idempotent(frame):
    gold = p.lead_gold(silver(frame, [lead("L1"), lead("L2")], [("L1", owner()), ("L2", owner())])).valid
    first = p.load_leads(gold, frame([("L2",)], "lead_id string"))
    row = first.collect()
    assert [r.lead_id for r in row] == ["L1"] and row[0].date_created.minute == 2
    assert p.load_leads(gold, first.select("lead_id").union(frame([("L2",)], "i string"))).count() == 0


def test_owner_files_are_named_after_the_lead(spark, folder):
    root = folder("owners")
    put(root, "L1.json", owner())
    for name in ("L+2", "L 3", "L%2B4", "Lé5"):
        put(root, f"{name}.json", owner())
    got = landing.read_owners(spark, root).collect()
    assert {r.lead_id for r in got} == {"L1", "L+2", "L 3", "L%2B4", "Lé5"}
    assert json.loads(got[0].owner)["lead_owner"] == "Olga"
