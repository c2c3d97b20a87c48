"""Operator 12: conversations repaired at least cost, by a Viterbi search that emits edits once its survivors agree.

A conversation's roles, by their initials, are to be ``(s?(ua)+)?``: one system turn at most, then user and assistant in turn.
Edits keep a row, give it the role user or assistant, delete it, or insert an empty turn. Where a search stands is one of
four states (nothing written, after system, after user, after assistant); each keeps its cheapest way so far, of equal ones the
one whose edits' initials are least. The ways are paths in a tree of backpointers with reference counts. As
soon as all of them lead through one node, the edits up to it are settled: they are handed on, and the rows they speak of are let go.
A tie is decided over the whole unsettled parts of both ways. A state that cannot win any more, whatever follows, is
dropped, so that it does not keep the others from agreeing.

Rows come sorted by conversation and turn through a task, and no conversation is held whole: memory follows the stretch that is not
settled yet. A conversation is read by one task, however long it is, for its edits and the hash of its repaired text follow one another.

Null roles and texts are one space each; a null turn comes first; rows without a conversation id are one conversation.
Rows of one turn are taken by role, then text; a row that repeats is a duplicate. A long text is read whole. Without rows there is no result.
Other columns are left aside.
"""

from __future__ import annotations

import hashlib
from collections import deque
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from millrace.llm.texts import share_code

SPACE = " \t\n\x0b\x0c\r"
NOTHING, SYSTEM, USER, ASSISTANT = range(4)
WRITTEN = {USER: "user", ASSISTANT: "assistant"}
# Pairs of initials that may stand side by side in a conversation as it comes.
LEGAL = {"su", "ua", "au"}

TURNS = "conv_id bigint, place bigint, edit string, turn bigint, role string, text string"
REPORT = (
    "conv_id bigint, gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, audit string, "
    "repaired_sha256 string"
)
# Rows and characters of results that are handed on together.
ROWS_AT_ONCE, CHARACTERS_AT_ONCE = 5_000, 4 * 1024 * 1024


@dataclass(frozen=True)
class Costs:
    rerole: int = 1
    delete: int = 2
    insert: int = 5
    truncated: int = 5

    def margins(self) -> dict[tuple[int, int], int]:
        """(a, b): the most that it costs to follow, from state a, whatever can still be done from state b."""
        system, pair = self.delete, 2 * self.insert
        return {
            (NOTHING, SYSTEM): 0, (NOTHING, USER): self.insert, (NOTHING, ASSISTANT): 0,
            (SYSTEM, NOTHING): max(system, pair), (SYSTEM, USER): self.insert, (SYSTEM, ASSISTANT): pair,
            (USER, NOTHING): self.insert + system, (USER, SYSTEM): self.insert, (USER, ASSISTANT): self.insert,
            (ASSISTANT, NOTHING): system, (ASSISTANT, SYSTEM): 0, (ASSISTANT, USER): self.insert,
        }


class Node:
    """An edit and the state after it; ``refs`` counts the nodes and survivors that lead here."""

    __slots__ = ("parent", "edit", "state", "depth", "refs", "heirs")

    def __init__(self, parent: Node | None, edit: str, state: int):
        self.parent, self.edit, self.state = parent, edit, state
        self.depth, self.refs, self.heirs = (parent.depth + 1 if parent else 0), 0, []
        if parent:
            parent.refs += 1
            parent.heirs.append(self)


def release(node: Node) -> None:
    """One reference less; what nothing leads to any more goes."""
    node.refs -= 1
    while node.refs == 0 and node.parent is not None:
        parent = node.parent
        parent.heirs.remove(node)
        parent.refs -= 1
        node.parent, node = None, parent


def less(a: Node, last_a: str, b: Node, last_b: str) -> bool:
    """Whether the edits on the way to a, then ``last_a``, are less than those to b, then ``last_b``."""
    left, right = [last_a], [last_b]
    while a is not b:
        if a.depth >= b.depth:
            left.append(a.edit)
            a = a.parent
        else:
            right.append(b.edit)
            b = b.parent
    return left[::-1] < right[::-1]


class Repair:
    """The search over one conversation; ``settled(edit, state)`` gets the edits in order, as soon as they are certain."""

    def __init__(self, settled: Callable[[str, int], None], costs: Costs = Costs()):
        self.settled, self.costs, self.margins = settled, costs, costs.margins()
        self.root = Node(None, "", NOTHING)
        self.root.refs += 1
        self.ways: dict[int, tuple[int, Node]] = {NOTHING: (0, self.root)}
        self._insert()

    def _offer(self, ways: dict[int, tuple[int, Node, str]], state: int, cost: int, node: Node, edit: str) -> None:
        known = ways.get(state)
        if known is None or cost < known[0] or (cost == known[0] and less(node, edit, known[1], known[2])):
            ways[state] = (cost, node, edit)

    def _insert(self) -> None:
        """Let inserted turns lead from state to state; no way takes more than two of them between rows."""
        for _ in range(2):
            for state in list(self.ways):
                cost, node = self.ways[state]
                to = ASSISTANT if state == USER else USER
                known = self.ways.get(to)
                cost += self.costs.insert
                if known is None or cost < known[0] or (cost == known[0] and less(node, "I", known[1].parent, known[1].edit)):
                    made = Node(node, "I", to)
                    made.refs += 1
                    if known:
                        release(known[1])
                    self.ways[to] = (cost, made)

    def row(self, initial: str, faulty: bool, truncated: bool) -> None:
        """The next row: ``faulty`` ones have to go."""
        costs = self.costs
        ways: dict[int, tuple[int, Node, str]] = {}
        for state, (cost, node) in self.ways.items():
            self._offer(ways, state, cost + costs.delete, node, "D")
            if faulty:
                continue
            stays = cost + costs.truncated * truncated
            if state == NOTHING and initial == "s":
                self._offer(ways, SYSTEM, stays, node, "K")
            to = ASSISTANT if state == USER else USER
            if initial == WRITTEN[to][0]:
                self._offer(ways, to, stays, node, "K")
            else:
                self._offer(ways, to, stays + costs.rerole, node, "R")
        before = self.ways
        self.ways = {}
        for state, (cost, node, edit) in ways.items():
            made = Node(node, edit, state)
            made.refs += 1
            self.ways[state] = (cost, made)
        for _, node in before.values():
            release(node)
        self._insert()
        self._drop()
        self._settle()

    def _drop(self) -> None:
        for state, (cost, node) in list(self.ways.items()):
            if any(other != state and own + self.margins[other, state] < cost for other, (own, _) in self.ways.items()):
                del self.ways[state]
                release(node)

    def _settle(self) -> None:
        while self.root.refs == 1 and self.root.heirs:
            heir = self.root.heirs[0]
            self.root.heirs, heir.parent = [], None
            self.root = heir
            self.settled(heir.edit, heir.state)

    def end(self) -> int:
        """Settle what is left; the cost of all edits."""
        best: dict[int, tuple[int, Node, str]] = {}
        for state in (NOTHING, ASSISTANT):
            if state in self.ways:
                cost, node = self.ways[state]
                self._offer(best, NOTHING, cost, node, "")
        cost, node, _ = best[NOTHING]
        rest = []
        while node is not self.root:
            rest.append(node)
            node = node.parent
        for made in reversed(rest):
            self.settled(made.edit, made.state)
        return cost


class Conversation:
    """Counts, edits and repaired turns of one conversation, row by row.

    ``turn(edit, turn, role, text)`` gets every edit: the row as it is after it, or, deleted, as it was.
    """

    def __init__(self, turn: Callable[[str, int | None, str, str], None], costs: Costs):
        self.turn, self.repair = turn, Repair(self._settled, costs)
        self.rows: deque = deque()
        self.blank = self.duplicate = self.truncated = self.illegal = self.turns = 0
        self.initial = self.first_turn = self.last_turn = None

    def _settled(self, edit: str, state: int) -> None:
        turn, role, text = (None, "", "") if edit == "I" else self.rows.popleft()
        self.turn(edit, turn, WRITTEN[state] if edit in "RI" else role, text)

    def row(self, turn: int | None, role: str, text: str, repeated: bool) -> None:
        if turn is not None and turn != self.last_turn:
            self.first_turn = turn if self.first_turn is None else self.first_turn
            self.last_turn, self.turns = turn, self.turns + 1
        initial, said = role[:1], text.rstrip(SPACE)
        if self.initial is not None and self.initial + initial not in LEGAL:
            self.illegal += 1
        self.initial = initial
        blank, cut = not said, said[-1:] not in (".", "!", "?")
        self.blank += blank
        self.duplicate += not blank and repeated
        self.truncated += not blank and not repeated and cut
        self.rows.append((turn, role, text))
        self.repair.row(initial, blank or repeated, cut)

    def end(self) -> tuple[int, ...]:
        """gaps, blank, duplicate, truncated, illegal, cost."""
        cost = self.repair.end()
        gaps = 0 if self.first_turn is None else self.last_turn - self.first_turn + 1 - self.turns
        return gaps, self.blank, self.duplicate, self.truncated, self.illegal, cost


def damaged(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text, alive: rows damaged by the remainder of crc32(conv_id:turn) by 20; dropped ones are not alive."""
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    rows = conversations.select(
        F.col("conv_id").cast("bigint").alias("conv_id"), F.col("turn").cast("bigint").alias("turn"),
        space("role").alias("role"), space("text").alias("text"),
        F.pmod(F.crc32(F.concat_ws(":", space("conv_id"), space("turn"))), F.lit(20)).alias("kind"),
    )
    kind = F.col("kind")
    text = F.when(kind == 1, "").when(kind == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    done = rows.select(
        "conv_id", "turn", F.when(kind == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"), (kind != 0).alias("alive"),
        F.explode(F.array_repeat(F.lit(0), F.when(kind == 3, 2).otherwise(1))).alias("copy"),
    )
    return done.drop("copy")


def _in_order(conversations: DataFrame) -> DataFrame:
    """Rows of a conversation together and by turn, dealt by one shuffle; ``repeated``: role and text came before."""
    alive = F.col("alive") if "alive" in conversations.columns else F.lit(True)
    rows = conversations.select(
        F.col("conv_id").cast("bigint").alias("conv_id"), F.col("turn").cast("bigint").alias("turn"),
        *(F.when(alive, F.coalesce(F.col(c).cast("string"), F.lit(" "))).alias(c) for c in ("role", "text")), alive.alias("alive"),
    )
    same = Window.partitionBy("conv_id", "alive", "role", "text").orderBy("turn")
    marked = rows.repartition("conv_id").withColumn("repeated", F.row_number().over(same) > 1)
    return marked.sortWithinPartitions("conv_id", "turn", "role", "text", "repeated")


def _streamed(rows: DataFrame, schema: str, begin: Callable, finish: Callable, costs: Costs) -> DataFrame:
    """Rows of ``schema``: ``begin(conv_id, out)`` gives what takes a conversation's edits, ``finish`` adds what follows its end."""
    share_code(rows.sparkSession.sparkContext)
    made_as = to_arrow_schema(StructType.fromDDL(schema))

    def batch(out: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), made_as, strict=True)], schema=made_as)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        current, conversation, taker = object(), None, None
        size = 0
        for part in batches:
            columns = [part.column(name).to_pylist() for name in ("conv_id", "turn", "role", "text", "alive", "repeated")]
            for conv_id, turn, role, text, alive, repeated in zip(*columns, strict=True):
                if conv_id != current:
                    if conversation is not None:
                        finish(current, taker, conversation.end(), out)
                    current, taker = conv_id, begin(conv_id, out)
                    conversation = Conversation(taker.take, costs)
                if alive:
                    conversation.row(turn, role, text, repeated)
                    size += len(text)
                if len(out) >= ROWS_AT_ONCE or (out and size >= CHARACTERS_AT_ONCE):
                    yield batch(out)
                    out.clear()
                    size = 0
        if conversation is not None:
            finish(current, taker, conversation.end(), out)
        if out:
            yield batch(out)

    return _in_order(rows).select("conv_id", "turn", "role", "text", "alive", "repeated").mapInArrow(run, schema)


class _Turns:
    def __init__(self, conv_id, out):
        self.conv_id, self.out, self.place = conv_id, out, 0

    def take(self, edit, turn, role, text):
        self.out.append((self.conv_id, self.place, edit, turn, role, text))
        self.place += 1


class _Digest:
    def __init__(self, conv_id, out):
        self.edits, self.digest, self.joint = [], hashlib.sha256(), b""

    def take(self, edit, turn, role, text):
        self.edits.append(edit)
        if edit != "D":
            self.digest.update(self.joint + f"{role}:{text}".encode())
            self.joint = b"\n"


def repaired(conversations: DataFrame, costs: Costs = Costs()) -> DataFrame:
    """conv_id, place, edit (K, R, D, I), turn, role, text: every edit in order; rows other than D are the repaired conversation."""
    return _streamed(conversations, TURNS, _Turns, lambda *_: None, costs)


def repair_report(conversations: DataFrame, costs: Costs = Costs()) -> DataFrame:
    """A row for each conversation: gaps, faults, cost, audit and the hash of the repaired text."""

    def finish(conv_id, taker, counts, out):
        out.append((conv_id, *counts, "".join(taker.edits), taker.digest.hexdigest()))

    return _streamed(conversations, REPORT, _Digest, finish, costs)
