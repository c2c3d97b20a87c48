"""Operator 6: benchmark passages in documents, found by one Aho-Corasick automaton over normalised items.

Texts are normalised byte for byte: ASCII letters in lower case, every other ASCII character but digits a blank. So
an offset in the normalised text is the same offset in the original, and word boundaries of a hit lead straight back.
The automaton holds every window of ``window`` words of the items (a shorter item whole), with a blank on both sides;
a text is scanned once.

The automaton is broadcast, so its size is bounded: the windows of a benchmark of more than ``part_bytes`` of text are dealt
into parts by a hash of window and item, so neither a large item nor a window of many items makes a large part. Part after part is
sent out, scanned for and taken back; the hits of all parts are put together. A Python worker builds the automaton of a part once.

Null text has no words; a null item or an item without words has no windows. A null item id is written as the
empty text. Repeated rows give repeated results. Without items nothing is hit, without documents there are no rows. A very long text is scanned whole.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable, Iterator
from itertools import chain

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.texts import documents, map_parts, with_rows, written

WINDOW = 10
# About ten trie nodes of 40 bytes for each byte of item text.
PART_BYTES = 1024 * 1024

_ASCII = "".join(chr(c).lower() if chr(c).isalnum() else " " for c in range(128)).encode()
NORMAL = _ASCII + bytes(range(128, 256))

SCANNED = (
    "doc_id bigint, text_key string, n_words bigint, hit_spans array<struct<first: bigint, last: bigint, start: bigint, end: bigint>>, "
    "items array<string>"
)


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(NORMAL).split()


def windows_of(words: list[bytes], window: int) -> list[str]:
    """Padded windows as text of one character per byte, as the automaton takes them."""
    if not words:
        return []
    size = min(window, len(words))
    return [(b" " + b" ".join(words[i : i + size]) + b" ").decode("latin-1") for i in range(len(words) - size + 1)]


Window = tuple[str, int, str]  # padded window, words in it, item


def windows_of_item(item: str, text: str | None, window: int) -> list[Window]:
    words = words_of(text)
    return [(found, min(window, len(words)), item) for found in windows_of(words, window)]


def automaton(windows: list[Window]) -> ahocorasick.Automaton | None:
    """From padded windows to (words in it, items that hold it); None without windows."""
    holders: dict[str, tuple[int, list[str]]] = {}
    for found, size, item in windows:
        holders.setdefault(found, (size, []))[1].append(item)
    made = ahocorasick.Automaton()
    for found, (size, names) in holders.items():
        made.add_word(found, (size, tuple(dict.fromkeys(names))))
    made.make_automaton()
    return made if len(made) else None


_held: dict[str, ahocorasick.Automaton | None] = {}


def held_automaton(name: str, windows: Callable[[], list[Window]]) -> ahocorasick.Automaton | None:
    """The automaton of a part, kept by the worker for its next task; that of another part goes."""
    if name not in _held:
        _held.clear()
        _held[name] = automaton(windows())
    return _held[name]


def scan(normal: bytes, made: ahocorasick.Automaton | None) -> tuple[int, list[tuple[int, int]], set[str]]:
    """Words of a normalised text, merged runs of hit words (first, last), items."""
    words = normal.split()
    if not words or made is None:
        return len(words), [], set()
    joined = b" " + b" ".join(words) + b" "
    hits = list(made.iter(joined.decode("latin-1")))
    if not hits:
        return len(words), [], set()
    blanks = np.flatnonzero(np.frombuffer(joined, dtype=np.uint8) == 32)
    lasts = np.searchsorted(blanks, [end for end, _ in hits]) - 1
    items: set[str] = set()
    runs: list[list[int]] = []
    ranges = sorted((int(last) - size + 1, int(last)) for last, (_, (size, _)) in zip(lasts, hits, strict=True))
    for _, (_, names) in hits:
        items.update(names)
    for first, last in ranges:
        if runs and first <= runs[-1][1] + 1:
            runs[-1][1] = max(runs[-1][1], last)
        else:
            runs.append([first, last])
    return len(words), [(a, b) for a, b in runs], items


def character_spans(text: str, normal: bytes, runs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Code point offsets (end exclusive) of runs of words."""
    inside = np.frombuffer(b" " + normal + b" ", dtype=np.uint8) != 32
    starts = np.flatnonzero(inside[1:] & ~inside[:-1])
    ends = np.flatnonzero(inside[:-1] & ~inside[1:])
    raw = text.encode()
    at = np.concatenate([[0], np.cumsum((np.frombuffer(raw, dtype=np.uint8) & 0xC0) != 0x80)])
    return [(int(at[starts[a]]), int(at[ends[b]])) for a, b in runs]


class Part:
    """Windows of one automaton, on their way to the tasks."""

    def __init__(self, spark: SparkSession, windows: list[Window]):
        self.shared, self.name = spark.sparkContext.broadcast(windows), uuid.uuid4().hex

    def begin(self) -> Callable[[], ahocorasick.Automaton | None]:
        shared, name = self.shared, self.name
        return lambda: held_automaton(name, lambda: shared.value)


def _scanned(docs: DataFrame, part: Part, keyed: bool) -> DataFrame:
    automaton_here = part.begin()

    def start():
        made = automaton_here()

        def step(ids, texts):
            keys, counts, spans, names = [], [], [], []
            for text in texts.to_pylist():
                raw = (text or "").encode()
                normal = raw.translate(NORMAL)
                n_words, runs, found = scan(normal, made)
                keys.append(hashlib.sha256(raw).hexdigest() if keyed else None)
                counts.append(n_words)
                where = character_spans(text, normal, runs) if runs else []
                spans.append([dict(first=a, last=b, start=s, end=e) for (a, b), (s, e) in zip(runs, where, strict=True)])
                names.append(sorted(found))
            return ids, keys, counts, spans, names

        return step

    return map_parts(docs, start, SCANNED)


def _items(benchmark: DataFrame, item_col: str = "item_id") -> DataFrame:
    item = F.coalesce(F.col(item_col).cast("string"), F.lit("")).alias("item")
    return benchmark.select(item, F.col("text").cast("string").alias("text")).where("text is not null")


def _parts(items: DataFrame, window: int, part_bytes: int) -> Iterator[list[Window]]:
    """Windows of all items in parts of a bounded size, each brought to the driver when it is asked for."""
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    if size <= part_bytes:
        yield [found for r in items.collect() for found in windows_of_item(r.item, r.text, window)]
        return

    def begin():
        def step(names, texts):
            found = [w for item, text in zip(names.to_pylist(), texts.to_pylist(), strict=True) for w in windows_of_item(item, text, window)]
            return [[w[k] for w in found] for k in range(3)]

        return step

    windows = written(map_parts(items, begin, "found string, size int, item string").distinct(), "benchmark")
    # a window is about ``window`` times as much text as its share of the item
    held = windows.agg(F.sum(F.octet_length("found") + F.octet_length("item"))).first()[0] or 0
    pieces = -(-held // (part_bytes * window))
    dealt = windows.withColumn("part", F.pmod(F.xxhash64("found", "item"), F.lit(pieces)))
    for part in range(pieces):
        yield [(r.found, r.size, r.item) for r in dealt.where(F.col("part") == part).collect()]


def benchmark_hits(
    docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, part_bytes: int = PART_BYTES, item_col: str = "item_id"
) -> DataFrame:
    """Per document: n_words, hit_spans (word numbers and code point offsets of hit runs), items (sorted texts of ids)."""
    spark, texts = docs.sparkSession, documents(docs)
    parts = _parts(_items(benchmark, item_col), window, part_bytes)
    first, second = next(parts, []), next(parts, None)
    if second is None:
        return _scanned(texts, Part(spark, first), keyed=False).drop("text_key")
    found, n = None, 0
    for windows in chain((first, second), parts):
        part = Part(spark, windows)
        # written before the next part is sent out: one part at a time is in memory
        one = written(_scanned(texts, part, keyed=True), "benchmark-hits")
        part.shared.unpersist()
        found, n = one if found is None else found.unionByName(one), n + 1
    together = found.groupBy("doc_id", "text_key", "n_words").agg(
        F.array_distinct(F.flatten(F.collect_list("hit_spans"))).alias("hit_spans"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
        (F.count(F.lit(1)) / n).cast("int").alias("copies"),
    )
    each = together.withColumn("copy", F.explode(F.sequence(F.lit(1), "copies")))
    return each.select("doc_id", "n_words", "hit_spans", "items")


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, part_bytes: int = PART_BYTES) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated and the hit spans."""
    found = benchmark_hits(docs, benchmark, window, part_bytes)
    n_hit = F.size(F.array_distinct(F.flatten(F.transform("hit_spans", lambda s: F.sequence(s["first"], s["last"])))))
    return found.select(
        "doc_id",
        "n_words",
        n_hit.cast("bigint").alias("n_hit"),
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
        (F.size("hit_spans") > 0).alias("contaminated"),
        "hit_spans",
    )


def without_benchmark(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, part_bytes: int = PART_BYTES) -> DataFrame:
    """The rows of ``docs`` that hold no window of the benchmark."""
    kept, before = docs, None
    for windows in _parts(_items(benchmark), window, part_bytes):
        if before is not None:  # what the part before has left is written, and that part taken back
            kept = written(kept, "benchmark-kept")
            before.shared.unpersist()
        before = Part(docs.sparkSession, windows)
        rows, passed = with_rows(kept)
        automaton_here = before.begin()

        def begin(automaton_here=automaton_here):
            made = automaton_here()

            def step(_ids, texts, more):
                clean = [not scan((t or "").encode().translate(NORMAL), made)[2] for t in texts.to_pylist()]
                return (more.filter(pa.array(clean)),)

            return step

        kept = map_parts(rows, begin, passed).select("row.*")
    return kept
