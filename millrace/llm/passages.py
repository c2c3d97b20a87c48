"""Operator 2: repeated passages of words, removed but for their first occurrence.

The search (see ``recurring``) leaves segments of text whose anchor phrase recurs. Of the distinct contexts of an anchor, shard by
shard, all windows are compiled into an Aho-Corasick automaton over word numbers; streaming the contexts
through it locates every occurrence of every phrase, a phrase of several occurrences is a confirmed recurring passage, and
all but its first occurrence are marked. Copies of a whole context are marked with it. The windows of a crowded anchor, one of
more than ``recurring.SLOT_ROWS`` segments, are grouped by their words instead. Then each document drops the
words that a marked window covers.

Copies of a whole context are told by hashes of 64 bits for the anchor and for the context, and are not streamed again.

Null text has no words. Documents of fewer words than a window keep all. Order is by id, then by place; rows without an
id stand first, in the order of a hash of their text, each text a document of its own. Rows that share an id count as one document given several times: equal places in them are one
occurrence, so a repeated row takes nothing from the other.
"""

from __future__ import annotations

import hashlib

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm import hashing, recurring
from millrace.llm.components import groups
from millrace.llm.texts import join_counted, map_parts

WINDOW, ANCHOR = 20, 6
# Contexts of one automaton; each holds at most about twice a window of words.
CONTEXTS_AT_ONCE = 3_000


def find_segments(texts: list[bytes], window: int = WINDOW, anchor: int = ANCHOR) -> tuple[np.ndarray, ...]:
    """Document number, key, context and packed place of every segment."""
    data, begins = hashing.join_texts(texts)
    starts, ends = hashing.find_words(data)
    words = hashing.stretch_hash(hashing.byte_sums(data), starts, ends)
    first_word = np.searchsorted(starts, begins)
    n = len(words) - window + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.uint64), np.zeros(0, np.int64)
    number = np.repeat(np.arange(len(texts)), np.diff(first_word))
    sums = hashing.prefix_sums(words)
    places = np.arange(len(words) - anchor + 1)
    phrases = hashing.stretch_hash(sums, places, places + anchor)
    least = hashing.minima(phrases, window - anchor + 1)
    at = np.flatnonzero(number[:n] == number[window - 1 :])
    if not len(at):
        return np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.uint64), np.zeros(0, np.int64)
    held = least[at]
    new = np.append(True, (held[1:] != held[:-1]) | (number[at[1:]] != number[at[:-1]]))
    first = at[new]
    last = at[np.append(np.flatnonzero(new)[1:] - 1, len(at) - 1)]
    context = hashing.stretch_hash(sums, first, last + window)
    doc = number[first]
    return doc, phrases[held[new]], context, recurring.pack(first - first_word[doc], last - first + 1, context)


class Words:
    """Words of a text and the check of a segment against them."""

    def __init__(self, text: bytes, window: int):
        self.words, self.window = text.split(), window
        data, begins = hashing.join_texts([text])
        starts, ends = hashing.find_words(data)
        self.sums = hashing.prefix_sums(hashing.stretch_hash(hashing.byte_sums(data), starts, ends))

    def hold(self, start: np.ndarray, windows: np.ndarray, check: np.ndarray) -> np.ndarray:
        """Which segments are this text's own: another row may have the same id."""
        end = start + windows + self.window - 1
        inside = end < len(self.sums)
        context = hashing.stretch_hash(self.sums, np.where(inside, start, 0), np.where(inside, end, 0))
        return inside & ((context >> np.uint64(64 - recurring.CHECK_BITS)).astype(np.int64) == check)


ASKED = "key bigint, doc bigint, start bigint, words string"


def asked_contexts(joined: DataFrame, window: int, crowded: bool) -> DataFrame:
    """ASKED rows of what has to be compared, out of rows (doc, text, entries).

    Those of anchors in one slot are whole contexts; those of anchors in several (``crowded``) are single windows.
    """

    def begin():
        def step(ids, texts, entries):
            made: list[list] = [[], [], [], []]
            for row, (doc, text) in enumerate(zip(ids.to_pylist(), texts.to_pylist(), strict=True)):
                start, windows, check, key, slots, _ = recurring.entry_arrays(entries[row].values)
                asked = slots > 1 if crowded else slots == 1
                if not asked.any():
                    continue
                own = Words((text or "").encode(), window)
                for s, n, k in zip(*(x[asked & own.hold(start, windows, check)].tolist() for x in (start, windows, key)), strict=True):
                    for first, last in [(i, i + window) for i in range(s, s + n)] if crowded else [(s, s + n + window - 1)]:
                        for column, value in zip(made, (k, doc, first, b" ".join(own.words[first:last]).decode()), strict=True):
                            column.append(value)
            return made

        return step

    wanted = joined.where(F.exists("entries", lambda e: e["slots"] > 1 if crowded else e["slots"] == 1))
    return map_parts(wanted.select("doc", "text", "entries"), begin, ASKED)


def _symbol(number: int) -> str:
    return chr(number + 1 if number < 0xD7FF else number + 0x801)


def later_windows(contexts: list[tuple[int, int, list[str]]], window: int) -> list[tuple[int, int]]:
    """(context number, window number) of all windows that also start earlier.

    Contexts are (doc, start, words). The automaton holds every window once; the contexts are streamed through it.
    """
    numbers: dict[str, int] = {}
    texts = ["".join([_symbol(numbers.setdefault(w, len(numbers))) for w in words]) for _, _, words in contexts]
    phrases = ahocorasick.Automaton()
    for text in texts:
        for i in range(len(text) - window + 1):
            phrase = text[i : i + window]
            if phrase not in phrases:
                phrases.add_word(phrase, len(phrases))
    if not len(phrases):
        return []
    phrases.make_automaton()
    least: list[tuple[int, int] | None] = [None] * (len(phrases) + 1)
    hits = []
    for number, (text, context) in enumerate(zip(texts, contexts, strict=True)):
        doc, start, _ = context
        for end, phrase in phrases.iter(text):
            place = (doc, start + end - window + 1)
            hits.append((number, end - window + 1, phrase, place))
            if least[phrase] is None or place < least[phrase]:
                least[phrase] = place
    return [(number, i) for number, i, phrase, place in hits if place != least[phrase]]


def compare_contexts(asked: DataFrame, window: int) -> DataFrame:
    """doc, start of the windows to be marked, out of ASKED rows, whole contexts."""

    def run(batches):
        for tables in recurring.many_groups(groups(batches, 1), CONTEXTS_AT_ONCE):
            table = pa.concat_tables(tables)
            rows = zip(*(table[c].to_pylist() for c in ("doc", "start", "words")), strict=True)
            contexts = [(doc, start, words.split(" ")) for doc, start, words in rows]
            marked = sorted({(contexts[c][0], contexts[c][1] + i) for c, i in later_windows(contexts, window)})
            if marked:
                yield pa.RecordBatch.from_arrays([pa.array([m[0] for m in marked], pa.int64()), pa.array([m[1] for m in marked], pa.int64())], names=["doc", "start"])

    return asked.repartition("key").sortWithinPartitions("key").mapInArrow(run, "doc bigint, start bigint")


def compare_windows(asked: DataFrame) -> DataFrame:
    """doc, start of the windows to be marked, out of ASKED rows, single windows.

    Equal windows are summed up before they are dealt out, so any number of contexts may share one.
    """
    least = asked.groupBy("key", "words").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("doc", "start")).alias("least")).where("n > 1")
    return join_counted(asked, least, ["key", "words"]).where(F.struct("doc", "start") != F.col("least")).select("doc", "start")


def repeated_passages(docs: DataFrame, window: int = WINDOW, anchor: int = ANCHOR) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256, kept text of every document."""
    texts, least = recurring.keyed(docs)
    segments = recurring.recurring_segments(texts, lambda texts: find_segments(texts, window, anchor), lambda first, copies: ~first, "passages")
    asked = texts.join(segments.where(F.exists("entries", lambda e: e["slots"] > 0)), "doc")
    compared = compare_contexts(asked_contexts(asked, window, False), window).unionByName(compare_windows(asked_contexts(asked, window, True)))
    marked = compared.groupBy("doc").agg(F.collect_set("start").alias("marked"))
    joined = texts.join(segments, "doc", "left").join(marked, "doc", "left")

    def begin():
        def step(ids, texts, entries, starts):
            made: list[list] = [[], [], [], [], []]
            for row, (doc, text) in enumerate(zip(ids.to_pylist(), texts.to_pylist(), strict=True)):
                raw = (text or "").encode()
                words, kept = raw.split(), None
                if entries[row].is_valid:
                    start, windows, check, _, _, covered = recurring.entry_arrays(entries[row].values)
                    own = Words(raw, window)
                    mine = own.hold(start, windows, check)
                    drop = mine & covered
                    singles = np.zeros(0, np.int64)
                    if starts[row].is_valid:
                        # a marked window belongs to a segment of this text, or to another row of the same id
                        singles = starts[row].values.to_numpy()
                        ahead = np.zeros(len(words) + 1, dtype=bool)
                        for s, n in zip(start[mine].tolist(), windows[mine].tolist(), strict=True):
                            ahead[s : s + n] = True
                        singles = singles[(singles < len(ahead))]
                        singles = singles[ahead[singles]]
                    gone = recurring.mark_runs(
                        len(words), np.concatenate([start[drop], singles]), np.concatenate([(start + windows + window - 1)[drop], singles + window])
                    )
                    kept = [w for w, g in zip(words, gone.tolist(), strict=True) if not g]
                kept = words if kept is None else kept
                joined_words = b" ".join(kept)
                for column, value in zip(
                    made,
                    (None if doc < least else doc, len(words), len(words) - len(kept), hashlib.sha256(joined_words).hexdigest(), joined_words.decode()),
                    strict=True,
                ):
                    column.append(value)
            return made

        return step

    rows = joined.select("doc", "text", "entries", "marked")
    return map_parts(rows, begin, "doc_id bigint, n_words bigint, n_removed bigint, kept_sha256 string, kept string")
