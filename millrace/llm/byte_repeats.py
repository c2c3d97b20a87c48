"""Operator 5: byte strings that stand more than once, found in suffix arrays and removed wherever they stand.

The search (see ``recurring``) leaves segments of text whose anchor recurs. Copies of a whole context are repeated as a
whole. The distinct contexts of an anchor are compared shard by shard: laid out in blocks of ``BLOCK`` bytes from the
anchor on, one symbol for each block, they are put into one suffix array by linear grouping. Neighbours in it that
agree in all the full blocks of a window form a cluster, and in a cluster the bytes before and after those blocks decide,
window by window. Equal windows have their anchor at the same place and so the same blocks: none is missed.

Null text counts as empty. Texts shorter than a window keep all. Rows that share an id count as one document given several
times: equal places in them are one occurrence, so a repeated row alone removes nothing. Of rows without an id each text is a
document of its own. Cuts of a very crowded anchor that agree in their blocks are compared by window hashes (see ``compare_crowded``).
Hashes of 64 bits stand for anchors and contexts together (128 bits), and for blocks inside a shard.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm import hashing, recurring
from millrace.llm.components import groups
from millrace.llm.suffixes import suffix_array
from millrace.llm.texts import join_counted, map_parts, written

WINDOW, ANCHOR, BLOCK = 400, 32, 16
# Contexts of one suffix array; each holds at most about twice a window of bytes.
CONTEXTS_AT_ONCE = 4_000


def _nothing() -> tuple[np.ndarray, ...]:
    return np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.uint64), np.zeros(0, np.int64)


def find_segments(texts: list[bytes], window: int = WINDOW, anchor: int = ANCHOR) -> tuple[np.ndarray, ...]:
    """Document number, key, context and packed place of every segment."""
    data, begins = hashing.join_texts(texts)
    lengths = np.array([len(t) for t in texts], dtype=np.int64)
    if not len(texts) or lengths.max() < window:
        return _nothing()
    sums = hashing.byte_sums(data)
    places = np.arange(len(data) - anchor + 1)
    phrases = hashing.stretch_hash(sums, places, places + anchor)
    least = hashing.minima(phrases, window - anchor + 1)
    fits = np.maximum(lengths - window + 1, 0)
    number = np.repeat(np.arange(len(texts)), fits)
    at = np.arange(len(number)) - np.repeat(np.cumsum(fits) - fits, fits) + begins[number]
    held = least[at]
    new = np.append(True, (held[1:] != held[:-1]) | (number[1:] != number[:-1]))
    first = at[new]
    last = at[np.append(np.flatnonzero(new)[1:] - 1, len(at) - 1)]
    context = hashing.stretch_hash(sums, first, last + window)
    doc = number[new]
    return doc, phrases[held[new]], context, recurring.pack(first - begins[doc], last - first + 1, context)


class Bytes:
    """Prefix sums of a text, and the check of a segment against it."""

    def __init__(self, text: bytes, window: int):
        self.text, self.window = text, window
        self.sums = hashing.byte_sums(np.frombuffer(text, dtype=np.uint8))

    def hold(self, start: np.ndarray, windows: np.ndarray, check: np.ndarray) -> np.ndarray:
        """Which segments are this text's own: another row may have the same id."""
        end = start + windows + self.window - 1
        inside = end < len(self.sums)
        context = hashing.stretch_hash(self.sums, np.where(inside, start, 0), np.where(inside, end, 0))
        return inside & ((context >> np.uint64(64 - recurring.CHECK_BITS)).astype(np.int64) == check)


ASKED = "key bigint, slot int, inner bigint, doc bigint, start bigint, origin bigint, context binary"


def asked_contexts(joined: DataFrame, window: int, anchor: int, block: int) -> DataFrame:
    """Contexts that have to be compared, with the place of their anchor, out of rows (doc, text, entries).

    For an anchor in several slots a context is cut at its blocks, so that equal windows meet in one slot: that of the hash of
    their full blocks, ``inner``; a whole context has none.
    """
    full = (window - block) // block

    def begin():
        def step(ids, texts, entries):
            made: list[list] = [[], [], [], [], [], [], []]

            def add(*row) -> None:
                for column, value in zip(made, row, strict=True):
                    column.append(value)

            for row, (doc, text) in enumerate(zip(ids.to_pylist(), texts.to_pylist(), strict=True)):
                start, windows, check, key, slots, _ = recurring.entry_arrays(entries[row].values)
                asked = slots > 0
                if not asked.any():
                    continue
                raw = (text or "").encode()
                own = Bytes(raw, window)
                places = np.arange(len(raw) - anchor + 1)
                phrases = hashing.stretch_hash(own.sums, places, places + anchor).view(np.int64)
                asked &= own.hold(start, windows, check)
                for s, n, k, many in zip(*(x[asked].tolist() for x in (start, windows, key, slots)), strict=True):
                    origin = s + int(np.argmax(phrases[s : s + window - anchor + 1] == k))
                    if many == 1:
                        add(k, 0, None, doc, s, origin, raw[s : s + n + window - 1])
                        continue
                    for q in range(s + (origin - s) % block, s + n + block - 1, block):
                        low, high = max(s, q - block + 1), min(s + n - 1, q)
                        if low <= high:
                            inner = int(hashing.stretch_hash(own.sums, np.array([q]), np.array([q + full * block])).view(np.int64)[0]) ^ (q - origin)
                            add(k, inner % many, inner, doc, low, origin, raw[low : high + window])
            return made

        return step

    return map_parts(joined.select("doc", "text", "entries"), begin, ASKED)


def repeated_windows(keys: list[int], contexts: list[bytes], origins: np.ndarray, window: int, block: int) -> list[tuple[int, int]]:
    """(context number, window number) of the windows that another context of the same key holds too.

    ``origins`` are the places of the anchors, counted from the contexts' begins.
    """
    data, begins = hashing.join_texts(contexts)
    sums = hashing.byte_sums(data)
    lengths = np.array([len(c) for c in contexts], dtype=np.int64)
    full = (window - block) // block
    lead = origins % block
    blocks = np.maximum((lengths - lead) // block, 0)
    owner = np.repeat(np.arange(len(contexts)), blocks)
    number = np.arange(len(owner)) - np.repeat(np.cumsum(blocks) - blocks, blocks)
    at = begins[owner] + lead[owner] + number * block
    # a symbol is a block, its distance from the anchor and its key
    names = hashing.stretch_hash(sums, at, at + block) + hashing.mix((lead[owner] + number * block - origins[owner]).astype(np.uint64))
    names = hashing.mix(names ^ np.array(keys, dtype=np.int64).view(np.uint64)[owner])
    _, ranks = np.unique(names, return_inverse=True)
    # contexts are set apart by a symbol that is less than all others
    place = np.arange(len(owner)) + owner
    symbols = np.zeros(len(owner) + len(contexts), dtype=np.int64)
    symbols[place] = ranks + 1
    order = suffix_array(symbols)
    # suffixes with all full blocks of a window in their context
    whole = np.zeros(len(symbols), dtype=bool)
    whole[place] = blocks[owner] - number >= full
    order = order[whole[order]]
    agree = np.arange(1, len(order))
    for k in range(full):
        if not len(agree):
            break
        agree = agree[symbols[order[agree] + k] == symbols[order[agree - 1] + k]]
    same = np.zeros(len(order) + 1, dtype=bool)
    same[agree] = True
    cluster = np.cumsum(~same[:-1]) if len(order) else np.zeros(0, np.int64)
    shared = same[:-1] | same[1:]
    back = np.full(len(symbols), -1, dtype=np.int64)
    back[place] = np.arange(len(owner))
    members, cluster = back[order[shared]], cluster[shared]
    if not len(members):
        return []
    # windows that begin up to block - 1 bytes before the first full block
    ahead = np.arange(block)
    q = at[members]
    context = owner[members]
    first = (q[:, None] - ahead[None, :]) - begins[context][:, None]
    valid = (first >= 0) & (first + window <= lengths[context][:, None])
    row, h = np.nonzero(valid)
    start, border = q[row] - h, q[row]
    ends = hashing.stretch_hash(sums, start, border) + hashing.mix(hashing.stretch_hash(sums, border + full * block, start + window))
    ends = hashing.mix(ends ^ hashing.mix((cluster[row] * block + h).astype(np.uint64)))
    _, inverse, counts = np.unique(ends, return_inverse=True, return_counts=True)
    twice = counts[inverse] > 1
    return list(zip(context[row[twice]].tolist(), (start[twice] - begins[context[row[twice]]]).tolist(), strict=True))


def runs_of(marked: list[tuple[int, int]]) -> list[tuple[int, int, int]]:
    """(context, first window, number of windows) of windows in a row."""
    made: list[list[int]] = []
    for context, window in sorted(marked):
        if made and made[-1][0] == context and made[-1][1] + made[-1][2] == window:
            made[-1][2] += 1
        else:
            made.append([context, window, 1])
    return [tuple(m) for m in made]


def compare_contexts(asked: DataFrame, window: int, block: int) -> DataFrame:
    """doc, start, windows of the repeated windows, out of ASKED rows that lie together by key and slot."""

    def run(batches):
        for tables in recurring.many_groups(groups(batches, 2), CONTEXTS_AT_ONCE):
            table = pa.concat_tables(tables)
            keys, docs, contexts = (table[c].to_pylist() for c in ("key", "doc", "context"))
            starts, origins = table["start"].to_numpy(), table["origin"].to_numpy()
            runs = runs_of(repeated_windows(keys, contexts, origins - starts, window, block))
            if runs:
                columns = [[docs[c] for c, _, _ in runs], [int(starts[c]) + w for c, w, _ in runs], [n for _, _, n in runs]]
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["doc", "start", "windows"])

    return asked.repartition("key", "slot").sortWithinPartitions("key", "slot").mapInArrow(run, "doc bigint, start bigint, windows bigint")


def compare_crowded(cut: DataFrame, window: int, block: int) -> DataFrame:
    """doc, start, windows of the repeated windows, out of ASKED rows cut at blocks.

    Cuts with the same full blocks are counted first. One that stands alone has no equal. Many together, as at the edge of a passage that
    stands in many surroundings, would fill a task: of those each window is told by a hash of 128 bits, and equal ones are summed up before they
    are dealt out. The others are compared slot by slot.
    """
    sizes = cut.groupBy("key", "inner").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    met = join_counted(cut, sizes, ["key", "inner"])
    few = met.where(F.col("n") <= recurring.SLOT_ROWS).select(*cut.columns)
    many = met.where(F.col("n") > recurring.SLOT_ROWS).select("key", "doc", "start", "context")

    def begin():
        def step(keys, docs, starts, contexts):
            made: list[list] = [[], [], [], [], []]
            for key, doc, start, context in zip(*(c.to_pylist() for c in (keys, docs, starts, contexts)), strict=True):
                data = np.frombuffer(context, dtype=np.uint8)
                at = np.arange(len(data) - window + 1)
                first, second = (hashing.stretch_hash(hashing.byte_sums(data, kind), at, at + window).view(np.int64) for kind in (0, 1))
                made[0] += [key] * len(at)
                made[1] += [doc] * len(at)
                made[2] += (at + start).tolist()
                made[3] += first.tolist()
                made[4] += second.tolist()
            return made

        return step

    windows = map_parts(many, begin, "key bigint, doc bigint, start bigint, one bigint, two bigint", text=3)
    # rows of one id are one document: the same place twice is one occurrence
    places = F.struct("doc", "start")
    again = windows.groupBy("key", "one", "two").agg(F.min(places).alias("low"), F.max(places).alias("high")).where("low < high")
    found = join_counted(windows, again.select("key", "one", "two"), ["key", "one", "two"]).select("doc", "start", F.lit(1).cast("bigint").alias("windows"))
    return compare_contexts(few, window, block).unionByName(found)


def repeated_bytes(docs: DataFrame, window: int = WINDOW, anchor: int = ANCHOR, block: int = BLOCK) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept bytes and removed spans of every document."""
    texts, least = recurring.keyed(docs)
    segments = recurring.recurring_segments(texts, lambda texts: find_segments(texts, window, anchor), lambda _first, copies: copies > 1, "bytes")
    asked = written(asked_contexts(texts.join(segments.where(F.exists("entries", lambda e: e["slots"] > 0)), "doc"), window, anchor, block), "asked")
    found = compare_contexts(asked.where("inner is null"), window, block)
    cut = asked.where("inner is not null")
    if not cut.isEmpty():
        found = found.unionByName(compare_crowded(cut, window, block))
    marked = found.groupBy("doc").agg(F.collect_list(F.struct("start", "windows")).alias("marked"))
    joined = texts.join(segments, "doc", "left").join(marked, "doc", "left")

    def begin():
        def step(ids, texts, entries, marks):
            made: list[list] = [[], [], [], [], [], []]
            for row, (doc, text) in enumerate(zip(ids.to_pylist(), texts.to_pylist(), strict=True)):
                raw = (text or "").encode()
                spans = np.zeros((0, 2), np.int64)
                kept = raw
                if entries[row].is_valid:
                    start, windows, check, _, _, covered = recurring.entry_arrays(entries[row].values)
                    own = Bytes(raw, window)
                    mine = own.hold(start, windows, check)
                    begins, ends = [start[mine & covered]], [(start + windows + window - 1)[mine & covered]]
                    if marks[row].is_valid:
                        # a marked window belongs to a segment of this text, or to another row of the same id
                        first, n = (marks[row].values.field(c).to_numpy() for c in ("start", "windows"))
                        known = recurring.mark_runs(len(raw) + 1, start[mine], (start + windows)[mine])
                        good = (first + n <= len(known)) & known[np.minimum(first, len(raw))]
                        begins.append(first[good])
                        ends.append((first + n + window - 1)[good])
                    gone = recurring.mark_runs(len(raw), np.concatenate(begins), np.concatenate(ends))
                    edges = np.flatnonzero(np.diff(np.concatenate([[False], gone, [False]]).astype(np.int8)))
                    spans = edges.reshape(-1, 2)
                    kept = np.frombuffer(raw, dtype=np.uint8)[~gone].tobytes()
                values = (
                    None if doc < least else doc, len(raw), len(raw) - len(kept), len(spans), hashlib.sha256(kept).hexdigest(), kept
                )
                for column, value in zip(made, values, strict=True):
                    column.append(value)
            return made

        return step

    schema = "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string, kept binary"
    return map_parts(joined.select("doc", "text", "entries", "marked"), begin, schema)
