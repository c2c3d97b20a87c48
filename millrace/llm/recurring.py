"""What recurs across documents: the search that both duplicate-passage operators begin with.

A window is a fixed number of units (words or bytes). Each window has an anchor: the stretch of ``ANCHOR`` units of least hash in
it, the leftmost of equals. Equal windows have equal anchors at the same place, so only windows whose anchor recurs can
recur. Windows in a row with the same anchor make a segment; a segment's context is all that its windows cover.

1. Anchors of all documents are counted. Those that stand once are done with.
2. The segments that are left are grouped by anchor and context, both as 64-bit hashes. Equal contexts are copies of each
   other, whole; a third of all documents may share one, for the groups are summed up before they are dealt out.
3. If an anchor has several contexts, their windows have to be compared. One segment of each context is asked for; the caller
   does that in shards by anchor. An anchor of very many segments is cut into slots by a hash of the window.

The tables that several later steps need are written to the shared folder once.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.texts import join_counted, map_parts, written

# Segments of one anchor in a slot of its shard.
SLOT_ROWS = 20_000
# Text that is searched at once: arrays of eight bytes for each of its bytes stay near the processor.
PART_BYTES = 512 * 1024

SEGMENTS = "doc bigint, key bigint, context bigint, at bigint"

CHECK_BITS, COUNT_BITS = 16, 12


def pack(start: np.ndarray, windows: np.ndarray, context: np.ndarray) -> np.ndarray:
    """First window, number of windows and some bits of the context, in that order of weight."""
    check = (context >> np.uint64(64 - CHECK_BITS)).astype(np.int64)
    return (start.astype(np.int64) << (CHECK_BITS + COUNT_BITS)) | (windows.astype(np.int64) << CHECK_BITS) | check


def unpack(at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return at >> (CHECK_BITS + COUNT_BITS), (at >> CHECK_BITS) & ((1 << COUNT_BITS) - 1), at & ((1 << CHECK_BITS) - 1)


def keyed(docs: DataFrame) -> tuple[DataFrame, int]:
    """doc, text; and the least id there is. ``doc`` is what tables of this module are joined by.

    A row without an id gets a number below all ids, made from its text: so each such text is a document of its own, and any
    number of them is dealt out like others.
    """
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc"), F.col("text").cast("string").alias("text"))
    ids = rows.agg(F.min("doc"), F.count(F.when(F.col("doc").isNull(), 1))).first()
    least = 0 if ids[0] is None else ids[0]
    if not ids[1]:
        # no row is left out; joins by doc ask for this themselves, some of them, and only like scans share a shuffle
        return rows.where("doc is not null"), least
    room = least + (1 << 63)
    if room < 1 << 32:
        raise ValueError("rows without an id need room below the least id")
    number = F.lit(least - 1) - F.pmod(F.xxhash64("text"), F.lit((1 << (room.bit_length() - 1)) - 1))
    return rows.withColumn("doc", F.coalesce("doc", number)), least


def segments(texts: DataFrame, find: Callable) -> DataFrame:
    """SEGMENTS of all texts (see ``keyed``); ``find(texts)`` gives document number, key, context and at as arrays."""

    def begin():
        def step(ids, texts):
            number, key, context, at = find([(t or "").encode() for t in texts.to_pylist()])
            return ids.to_numpy()[number], key.view(np.int64), context.view(np.int64), at

        return step

    return map_parts(texts, begin, SEGMENTS, part_bytes=PART_BYTES)


def recurring_segments(texts: DataFrame, find: Callable, covered: Callable, name: str) -> DataFrame:
    """doc and entries (at, key, slots, covered) of every document with a recurring segment.

    ``covered(first, copies)`` says whether a segment is wholly repeated, given whether it is the first of its context and
    how often the context stands. ``slots`` is over 0 where the context has to be compared with others of its anchor.
    """
    found = segments(texts, find)
    # keys alone are counted: both uses of the counts then share one shuffle, and the texts are searched for it once
    anchors = found.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    again = join_counted(found, anchors, ["key"])
    contexts = again.groupBy("key", "context").agg(F.count(F.lit(1)).alias("copies"), F.min(F.struct("doc", "at")).alias("least"))
    both = join_counted(again, contexts, ["key", "context"])
    first = F.struct("doc", "at") == F.col("least")
    # a context that stands less often than its anchor has others beside it
    slots = F.when(F.col("copies") < F.col("n"), F.ceil(F.col("n") / SLOT_ROWS)).otherwise(0).cast("int")
    judged = both.select(
        "doc", "at", "key", F.when(first, slots).otherwise(0).alias("slots"), covered(first, F.col("copies")).alias("covered")
    ).where("covered or slots > 0")
    entry = F.struct("at", F.when(F.col("slots") > 0, F.col("key")).otherwise(0).alias("key"), "slots", "covered")
    return written(judged.groupBy("doc").agg(F.collect_list(entry).alias("entries")), name)


def entry_arrays(entries: pa.StructArray) -> tuple[np.ndarray, ...]:
    """start, windows, check, key, slots, covered of one document's entries."""
    at, key, slots, covered = (entries.field(n).to_numpy(zero_copy_only=False) for n in ("at", "key", "slots", "covered"))
    return (*unpack(at), key, slots, covered)


def many_groups(tables: Iterator[pa.Table], most_rows: int) -> Iterator[list[pa.Table]]:
    """Whole groups put together until they have about ``most_rows`` rows."""
    held, rows = [], 0
    for table in tables:
        if held and rows + table.num_rows > most_rows:
            yield held
            held, rows = [], 0
        held.append(table)
        rows += table.num_rows
    if held:
        yield held


def mark_runs(n: int, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Mask of n places covered by ranges."""
    steps = np.zeros(n + 1, dtype=np.int64)
    np.add.at(steps, starts, 1)
    np.add.at(steps, ends, -1)
    return np.cumsum(steps[:-1]) > 0
