"""Repair of conversations against its SQL, and against all edits tried."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from itertools import product

import pytest

from millrace.llm import conversations, registry
from millrace.llm.conversations import Costs, Repair
from oracle import connect, differences

GOOD = re.compile("(s?(ua)+)?")
SCHEMA = "conv_id bigint, turn bigint, role string, text string"


def cheapest(rows: list[tuple[str, bool, bool]], costs: Costs) -> tuple[int, str]:
    """Cost and audit by trying every edit of every row, with up to two turns inserted before, between and behind."""
    found = []
    for edits in product(*[["D"] if faulty else ["D", "K", "Ru", "Ra"] for _, faulty, _ in rows]):
        kept = [(e, r) for e, r in zip(edits, rows, strict=True)]
        for inserted in product(["", "u", "a", "ua", "au"], repeat=len(rows) + 1):
            roles, audit, cost = inserted[0], "I" * len(inserted[0]), costs.insert * len("".join(inserted))
            for (edit, (initial, _, truncated)), more in zip(kept, inserted[1:], strict=True):
                roles += "" if edit == "D" else initial if edit == "K" else edit[1]
                cost += {"D": costs.delete, "K": 0, "R": costs.rerole}[edit[0]] + costs.truncated * (truncated and edit != "D")
                roles, audit = roles + more, audit + edit[0] + "I" * len(more)
            if GOOD.fullmatch(roles):
                found.append((cost, audit))
    return min(found)


def searched(rows: list[tuple[str, bool, bool]], costs: Costs) -> tuple[int, str]:
    edits: list[str] = []
    repair = Repair(lambda edit, state: edits.append(edit), costs)
    for row in rows:
        repair.row(*row)
    cost = repair.end()
    return cost, "".join(edits)


@pytest.mark.parametrize("costs", [Costs(), Costs(insert=1), Costs(rerole=2, delete=3, insert=2, truncated=1), Costs(rerole=3, delete=7, insert=3, truncated=0)])
def test_cheapest_edits(costs):
    draw = random.Random(4)
    for _ in range(60):
        rows = [(draw.choice("suuaax"), draw.random() < 0.15, draw.random() < 0.3) for _ in range(draw.randrange(4))]
        assert searched(rows, costs) == cheapest(rows, costs), rows


def by_whole_strings(rows: list[tuple[str, bool, bool]], costs: Costs) -> tuple[int, str]:
    """The same programme with whole audits kept in each state."""
    ways = {"": (0, "")}

    def inserted(ways):
        for _ in range(2):
            for state, (cost, audit) in list(ways.items()):
                to = "a" if state == "u" else "u"
                ways[to] = min(ways.get(to, (10**9, "")), (cost + costs.insert, audit + "I"))
        return ways

    ways = inserted(ways)
    for initial, faulty, truncated in rows:
        after: dict = {}
        for state, (cost, audit) in ways.items():
            options = [(state, costs.delete, "D")]
            if not faulty:
                to = "a" if state == "u" else "u"
                options.append((to, costs.truncated * truncated + (0 if initial == to else costs.rerole), "K" if initial == to else "R"))
                if state == "" and initial == "s":
                    options.append(("s", costs.truncated * truncated, "K"))
            for to, more, edit in options:
                after[to] = min(after.get(to, (10**9, "")), (cost + more, audit + edit))
        ways = inserted(after)
    return min(ways[s] for s in ("", "a") if s in ways)


def test_long_conversations_settle_early():
    draw = random.Random(9)
    for noise in (0.0, 0.05, 0.5):
        rows = [("ua"[k % 2] if draw.random() >= noise else draw.choice("sua"), draw.random() < noise / 5, draw.random() < noise / 3) for k in range(4_000)]
        edits, open_edits = [], []
        repair = Repair(lambda edit, state, edits=edits: edits.append(edit))
        for k, row in enumerate(rows):
            repair.row(*row)
            open_edits.append(k + 1 - len(edits))
        cost = repair.end()
        assert (cost, "".join(edits)) == by_whole_strings(rows, Costs())
        assert max(open_edits) < 200


def test_references_are_given_back():
    """After every row the tree holds just what its survivors lead to."""
    draw = random.Random(6)
    repair = Repair(lambda edit, state: None)
    for _ in range(300):
        repair.row(draw.choice("suax"), draw.random() < 0.1, draw.random() < 0.3)
        held = set()
        for _, node in repair.ways.values():
            while node is not None and node not in held:
                held.add(node)
                node = node.parent
        below, todo = set(), [repair.root]
        while todo:
            node = todo.pop()
            below.add(node)
            todo += node.heirs
        assert held | {repair.root} == below
        ends = [node for _, node in repair.ways.values()]
        assert all(node.refs == len(node.heirs) + ends.count(node) for node in below)


@pytest.mark.parametrize("sf", ["0.001", "0.01"])
def test_equals_sql(spark, sf):
    sf_dir = f"/root/testdata/sf{sf}"
    assert differences(connect(sf_dir), registry.QUERIES["op12_conversation_repair"](spark, sf_dir), registry.SQL["op12_conversation_repair"]) == []


def test_equals_sql_on_odd_rows(spark, tmp_path):
    import duckdb

    draw = random.Random(3)
    rows = []
    for conv in [None, *range(150)]:
        for turn in range(draw.randrange(12)):
            role = draw.choice(["user", "assistant", "system", "tool", "", None, "sun"])
            rows.append((conv, None if draw.random() < 0.05 else turn + 3 * (draw.random() < 0.1), role, draw.choice(["a.", "b!", "c", " \t\n", "", None, "d?\x0b ", "é…", "Ünd?"]), draw.random()))
    rows += [(999, 1, "user", "x" * 200_000 + ".", 0.5), (999, None, "assistant", None, 0.5), (1000, None, None, None, 0.5)]
    # rows that share a turn are told apart by role and text
    rows += rows[:20]
    frame = spark.createDataFrame(rows, SCHEMA + ", cost double")
    frame.coalesce(1).write.parquet(str(tmp_path / "c"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM read_parquet('{tmp_path}/c/*.parquet')")
    assert differences(con, conversations.repair_report(conversations.damaged(frame)), registry.SQL["op12_conversation_repair"]) == []


def test_repaired_turns(frame):
    rows = [(1, 0, "system", "S."), (1, 1, "assistant", "one."), (1, 2, "assistant", "two."), (1, 3, "assistant", "two."), (1, 4, "user", "cut"), (2, 0, "user", " ")]
    table = frame(rows, SCHEMA)
    got = [tuple(r) for r in conversations.repaired(table).orderBy("conv_id", "place").collect()]
    assert got == [
        (1, 0, "K", 0, "system", "S."), (1, 1, "R", 1, "user", "one."), (1, 2, "K", 2, "assistant", "two."),
        (1, 3, "D", 3, "assistant", "two."), (1, 4, "D", 4, "user", "cut"), (2, 0, "D", 0, "user", " "),
    ]
    report = {r.conv_id: r for r in conversations.repair_report(table).collect()}
    assert report[1].repaired_sha256 == hashlib.sha256(b"system:S.\nuser:one.\nassistant:two.").hexdigest()
    assert tuple(report[1])[1:8] == (0, 0, 1, 1, 3, 5, "KRKDD") and report[2].audit == "D"
    assert conversations.repair_report(table.limit(0)).collect() == [] and conversations.repaired(table.limit(0)).collect() == []


def test_damage(frame):
    rows = [(c, t, "assistant", "a. b! c?") for c in range(12) for t in range(12)]
    got = conversations.damaged(frame(rows, SCHEMA)).collect()
    want = []
    for c, t, role, text in rows:
        kind = zlib.crc32(f"{c}:{t}".encode()) % 20
        row = (c, t, "user" if kind == 4 else role, {1: "", 2: "a b c"}.get(kind, text), kind != 0)
        want += [row] * (2 if kind == 3 else 1)
    assert sorted(map(tuple, got)) == sorted(want) and {zlib.crc32(f"{c}:{t}".encode()) % 20 for c, t, *_ in rows} >= set(range(5))


def test_one_shuffle(frame):
    plan = conversations.repair_report(frame([(1, 0, "user", "x")], SCHEMA))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1
