"""Webhook documents for the tests."""

from __future__ import annotations

import json

FACEBOOK = "d639ecd3-8718-4068-955a-436b10d72c78"


def booking(invitee="inv1", drop=(), **changes):
    """A booking body; ``changes`` go by dotted path, ``drop`` removes paths."""
    doc = {
        "payload": {
            "uri": f"https://host/invitees/{invitee}",
            "email": "ann@example.org",
            "name": "Ann",
            "status": "active",
            "created_at": "2024-01-01T00:00:00.000000Z",
            "tracking": {"utm_campaign": "spring", "utm_source": None},
            "scheduled_event": {
                "uri": f"https://host/events/ev-{invitee}",
                "start_time": "2024-01-10T09:00:00.000000Z",
                "end_time": "2024-01-10T09:30:00.000000Z",
                "name": "Intro call",
                "event_type": f"https://host/types/{FACEBOOK}",
                "event_memberships": [
                    {"user_email": "eve@example.org", "user_name": "Eve"},
                    {"user_email": "second@example.org", "user_name": "Second"},
                ],
            },
        }
    }
    for path, value in changes.items():
        _parent(doc, path)[path.split("__")[-1]] = value
    for path in drop:
        del _parent(doc, path)[path.split("__")[-1]]
    return json.dumps(doc)


def _parent(doc, path):
    node = doc["payload"]
    for step in path.split("__")[:-1]:
        node = node[step]
    return node


def lead(lead_id="L1", **fields):
    return json.dumps({"event": {"lead_id": lead_id, "action": "created"}, "lead_id": lead_id, **fields})


def owner(**fields):
    return json.dumps(
        {
            "display_name": "Owner's name", "lead_email": "l@example.org", "lead_owner": "Olga",
            "funnel": "web", "status_label": "new",
            "date_created": "2026-03-10T01:02:03.123456+00:00", **fields,
        }
    )


def put(folder, name, body):
    """Write one landing file."""
    import os

    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w", encoding="utf-8") as out:
        out.write(body)
