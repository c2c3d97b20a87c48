"""Operator 10: near copies of documents, by bottom-k sketches from one hash function.

1. A document's set holds the hashes of its distinct word shingles; its sketch is the ``SKETCHED`` least of them. Documents with equal sets
   are one from here on.
2. Inverted lists are kept for pairs of the ``INDEXED`` least values: sets whose similarity is 0.85 share at least two of eight with a
   chance of 0.99999, and a value that many unrelated documents share makes no list of its own. Lists of the same documents are one.
3. In a list, overlaps of the sketches, then the similarity that the union's sketch tells, link documents that may be near copies
   (five deviations below the bound). Only as many links are given as join what belongs together. The components of
   these links are the candidate groups; documents that merely share a list are not in one.
4. In a group the full sets decide. A document that is linked to another one of the largest class so far need not ask again; every other
   document of the group asks all others, so no class is missed.

A list or group too large for a task is dealt into parts, and each pair of parts is a task. In a large list the documents close to its
least one are linked to that, and from then on only meet the others.

Null text, and text without words, has an empty set and is linked with nothing. A text of fewer words than a shingle
has one shingle, the whole sequence. A row without an id is linked with nothing and has no component. Rows that
share an id are one document with several sets: what is linked to one of them is in the document's class. Ties: the least id stands for its group.
Texts are read whole; a part holds sets of a bounded total size, or one longer text. Without documents there are no rows. Other columns are left aside.
"""

from __future__ import annotations

import hashlib
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm import hashing
from millrace.llm.components import UnionFind, connected_components, groups
from millrace.llm.texts import checkpointed, documents, join_counted, map_parts

SHINGLE, PERCENT = 3, 85
INDEXED, SKETCHED = 8, 64
# Documents of a list or group that go into one part, and shingles of a part's full sets.
BLOCK = 2_000
BLOCK_SHINGLES = 5_000_000

LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))


def shingle_sets(texts: list[str | None], size: int = SHINGLE) -> list[np.ndarray]:
    """Sorted distinct hashes of the word shingles of each text."""
    data, begins = hashing.join_texts([(t or "").encode().translate(LOWER) for t in texts])
    starts, ends = hashing.find_words(data)
    words = hashing.stretch_hash(hashing.byte_sums(data), starts, ends)
    bounds = np.searchsorted(starts, begins)
    n = max(0, len(words) - size + 1)
    made = np.full(n, size, dtype=np.uint64)
    for k in range(size):
        made = hashing.mix(made * np.uint64(0xD6E8FEB86659FD93) + words[k : k + n])
    found = []
    for first, last in zip(bounds[:-1], bounds[1:], strict=True):
        if last - first >= size:
            found.append(np.unique(made[first : last - size + 1]))
        elif last > first:
            whole = np.full(1, last - first, dtype=np.uint64)
            for k in range(first, last):
                whole = hashing.mix(whole * np.uint64(0xD6E8FEB86659FD93) + words[k : k + 1])
            found.append(whole)
        else:
            found.append(np.zeros(0, dtype=np.uint64))
    return found


def set_key(values: np.ndarray) -> bytes:
    return hashlib.blake2b(values.tobytes(), digest_size=16).digest()


_PAIRS = np.array(list(combinations(range(INDEXED), 2)))


def sketch_keys(values: np.ndarray) -> np.ndarray:
    """One key for each pair of retained values."""
    pairs = _PAIRS[_PAIRS[:, 1] < len(values)]
    return hashing.signed(hashing.mix(values[pairs[:, 0]] * np.uint64(0xD6E8FEB86659FD93) + values[pairs[:, 1]]))


def sketches(docs: DataFrame, size: int = SHINGLE) -> DataFrame:
    """doc_id, n_shingles, set_key, keys, sketch of every row."""

    def begin():
        def step(ids, texts):
            sets = shingle_sets(texts.to_pylist(), size)
            keys = [sketch_keys(s[:INDEXED]) for s in sets]
            return ids, [len(s) for s in sets], [set_key(s) for s in sets], keys, [s[:SKETCHED].tobytes() for s in sets]

        return step

    return map_parts(documents(docs), begin, "doc_id bigint, n_shingles bigint, set_key binary, keys array<bigint>, sketch binary")


def union_sketches(a: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Similarity of set ``a`` to each of ``rows`` as the least values of their union tell it.

    Sketches are rows of SKETCHED values in order, with NO_VALUE behind a shorter one.
    """
    both = np.sort(np.concatenate([np.broadcast_to(a, rows.shape), rows], axis=1), axis=1)
    real = both != NO_VALUE
    again = np.zeros(both.shape, dtype=bool)
    again[:, 1:] = (both[:, 1:] == both[:, :-1]) & real[:, 1:]
    rank = np.cumsum(real & ~again, axis=1)
    inside = rank <= SKETCHED
    return (again & inside).sum(axis=1) / np.minimum(rank[:, -1], SKETCHED)


NO_VALUE = np.uint64((1 << 64) - 1)
# Values of a group's sets up to which one index of them all is kept.
INDEXED_VALUES = 10_000_000


class Index:
    """Inverted lists: from values to the numbers of the sets that hold them."""

    def __init__(self, sets: list[np.ndarray]):
        self.n = len(sets)
        values = np.concatenate(sets)
        owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
        order = np.argsort(values, kind="stable")
        self.values, self.owner = values[order], owner[order]

    def overlaps(self, values: np.ndarray) -> np.ndarray:
        """How many of the values each set holds."""
        lows, highs = np.searchsorted(self.values, values), np.searchsorted(self.values, values, side="right")
        spans = highs - lows
        at = np.repeat(lows - np.append(0, np.cumsum(spans)[:-1]), spans) + np.arange(spans.sum())
        return np.bincount(self.owner[at], minlength=self.n)


class Sketches:
    """Sets of a list by their sketches; finds links that join all that may be near copies."""

    def __init__(self, sizes: list[int], sketched: list[np.ndarray], percent: int = PERCENT):
        self.percent = percent
        self.sizes = np.array(sizes)
        self.sketched = sketched
        self.sketches = np.full((len(sketched), SKETCHED), NO_VALUE, dtype=np.uint64)
        for row, own in zip(self.sketches, sketched, strict=True):
            row[: len(own)] = own
        self.index = Index(sketched)
        self.least_share = percent / 100 - 5 * (percent / 100 * (1 - percent / 100) / SKETCHED) ** 0.5

    def partners(self, i: int) -> np.ndarray:
        """All sets that may be linked to set i."""
        sizes = self.sizes
        overlaps = self.index.overlaps(self.sketched[i])
        fits = (100 * np.minimum(sizes, sizes[i]) >= self.percent * np.maximum(sizes, sizes[i])) & (overlaps > 0)
        fits &= overlaps >= np.minimum(np.minimum(sizes, sizes[i]), SKETCHED) * (self.least_share - 0.1)
        fits[i] = False
        found = np.flatnonzero(fits)
        return found[union_sketches(self.sketches[i], self.sketches[found]) >= self.least_share] if len(found) else found

    def links(self) -> list[tuple[int, int]]:
        """Links that join exactly the classes."""
        n = len(self.sizes)
        union, made, asked, seen = UnionFind(n), [], [False] * n, [False] * n

        def ask(i: int) -> None:
            asked[i] = seen[i] = True
            for j in self.partners(i).tolist():
                seen[j] = True
                if union.union(i, j):
                    made.append((i, j))

        for i in range(n):
            if not seen[i]:
                ask(i)
        roots = [union.find(i) for i in range(n)]
        largest = max(set(roots), key=roots.count) if n < 50 else int(np.bincount(roots).argmax())
        for i in range(n):
            if not asked[i] and union.find(i) != union.find(largest):
                ask(i)
        return made


class Group(Sketches):
    """Full sets of a candidate group; finds all classes of linked sets."""

    def __init__(self, sets: list[np.ndarray], percent: int = PERCENT):
        super().__init__([len(s) for s in sets], [s[:SKETCHED] for s in sets], percent)
        self.sets = sets
        self.whole = Index(sets) if self.sizes.sum() <= INDEXED_VALUES else None

    def partners(self, i: int) -> np.ndarray:
        """All sets linked to set i."""
        found, mine = super().partners(i), self.sets[i]
        if self.whole is not None and len(found) > 40:
            shared = self.whole.overlaps(mine)[found]
        else:
            shared = np.array([len(np.intersect1d(mine, self.sets[j], assume_unique=True)) for j in found.tolist()], dtype=np.int64)
        return found[100 * shared >= self.percent * (self.sizes[i] + self.sizes[found] - shared)]


def links_of_lists(members: DataFrame, percent: int = PERCENT) -> DataFrame:
    """Links u, v out of rows (key, first, second, id, n, sketch), which lie together by their first three columns."""

    def run(batches):
        for group in groups(batches, 3):
            ids, sizes = group.column("id").to_pylist(), group.column("n").to_pylist()
            if len(ids) > 1:
                found = Sketches(sizes, [np.frombuffer(s, dtype=np.uint64) for s in group.column("sketch").to_pylist()], percent).links()
                if found:
                    yield pa.RecordBatch.from_arrays([pa.array([ids[x[k]] for x in found], pa.int64()) for k in (0, 1)], names=["u", "v"])

    return members.mapInArrow(run, "u bigint, v bigint")


def links_of_groups(members: DataFrame, size: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """Links u, v out of rows (candidate, first, second, id, set_key, text), which lie together by their first three columns."""

    def run(batches):
        for group in groups(batches, 3):
            texts, keys, ids = group.column("text").to_pylist(), group.column("set_key").to_pylist(), group.column("id").to_pylist()
            kept: dict[tuple[int, bytes], np.ndarray] = {}
            for start in range(0, len(texts), 200):
                sets = shingle_sets(texts[start : start + 200], size)
                for doc, key, own in zip(ids[start : start + 200], keys[start : start + 200], sets, strict=True):
                    if set_key(own) == key:  # another row may have the same id and another text
                        kept[doc, key] = own
            names = sorted(kept)
            if len(names) > 1:
                found = Group([kept[n] for n in names], percent).links()
                if found:
                    yield pa.RecordBatch.from_arrays([pa.array([names[a][0] for a, _ in found], pa.int64()), pa.array([names[b][0] for _, b in found], pa.int64())], names=["u", "v"])

    return members.mapInArrow(run, "u bigint, v bigint")


def tasks(rest: Column, main: Column, own: Column, is_main: Column) -> Column:
    """Pairs (first, second) of parts that a row goes to, of ``rest`` parts and ``main`` parts behind them; ``own`` is its part.

    Every two rows meet in a task, but for two rows of main parts. One part alone is a task by itself.
    """
    numbers = lambda n: F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))
    pair = lambda a, b: F.struct(a.cast("int").alias("first"), b.cast("int").alias("second"))
    to_rest = F.transform(F.filter(numbers(rest), lambda q: q != own), lambda q: pair(F.least(own, q), F.greatest(own, q)))
    to_main = F.transform(numbers(main), lambda q: pair(own, rest + q))
    alone = F.when((rest == 1) & (main == 0), F.array(pair(own, own))).otherwise(F.slice(F.array(pair(own, own)), 1, 0))
    return F.when(is_main, F.transform(numbers(rest), lambda q: pair(q, rest + own))).otherwise(F.concat(to_rest, to_main, alone))


def _close_to_least(entries: DataFrame, distinct: DataFrame, percent: int) -> DataFrame:
    """Entries of large lists with ``main``: whether the sketch says that a document may be a near copy of the list's least."""
    hubs = distinct.select(F.col("id").alias("least"), F.col("n").alias("least_n"), F.col("sketch").alias("least_sketch"))
    rows = entries.join(hubs, "least").select("least_n", "least_sketch", "n", "sketch", "key", "m", "least", "id")

    def begin():
        def step(hub_n, hub_sketch, n, sketch, key, m, least, ids):
            main = []
            for hub_size, hub, size, own, a, b in zip(*(c.to_pylist() for c in (hub_n, hub_sketch, n, sketch, least, ids)), strict=True):
                both = Sketches([hub_size, size], [np.frombuffer(x, dtype=np.uint64) for x in (hub, own)], percent)
                main.append(a == b or bool(len(both.partners(0))))
            return key, m, least, ids, n, sketch, main

        return step

    return map_parts(rows, begin, "key bigint, m bigint, least bigint, id bigint, n bigint, sketch binary, main boolean", text=None)


def candidate_groups(distinct: DataFrame, percent: int = PERCENT, block: int = BLOCK) -> DataFrame:
    """id, component of the documents that may have a near copy."""
    listed = distinct.select("id", "n", F.explode("keys").alias("key"))
    lists = listed.groupBy("key").agg(
        F.count(F.lit(1)).alias("m"), F.min("id").alias("least"), F.min("n").alias("shortest"), F.max("n").alias("longest"),
        F.bit_xor(F.xxhash64("id")).alias("one"), F.bit_xor(F.xxhash64("id", F.lit(1))).alias("other"),
    )
    # two documents of different size are no pair; of lists that hold the same documents one is enough
    some = lists.where((F.col("m") > 2) | ((F.col("m") == 2) & (100 * F.col("shortest") >= percent * F.col("longest"))))
    kept = some.groupBy("m", "least", "one", "other").agg(F.min("key").alias("key")).select("key", "m", "least")
    entries = checkpointed(join_counted(listed.select("id", "key"), kept, ["key"]))
    members = entries.join(distinct.select("id", "n", "sketch"), "id")
    no = F.lit(0)
    small = members.where(F.col("m") <= block).select("key", no.alias("first"), no.alias("second"), "id", "n", "sketch")
    links = links_of_lists(small.repartition("key").sortWithinPartitions("key"), percent)
    large = members.where(F.col("m") > block)
    if not large.limit(1).isEmpty():
        large = checkpointed(_close_to_least(large, distinct, percent))
        links = links.unionByName(large.where("main and id <> least").select(F.col("id").alias("u"), F.col("least").alias("v")))
        parts = lambda rows: F.ceil(F.count(F.when(rows, 1)) / block).cast("int")
        counted = large.groupBy("key").agg(parts(~F.col("main")).alias("rest_parts"), parts(F.col("main")).alias("main_parts"))
        own = F.pmod(F.xxhash64("id"), F.greatest(F.lit(1), F.when(F.col("main"), F.col("main_parts")).otherwise(F.col("rest_parts")))).cast("int")
        met = join_counted(large, counted, ["key"]).withColumn("own", own)
        met = met.select("key", F.explode(tasks(F.col("rest_parts"), F.col("main_parts"), F.col("own"), F.col("main"))).alias("task"), "id", "n", "sketch")
        met = met.select("key", "task.first", "task.second", "id", "n", "sketch").repartition("key", "first", "second")
        links = links.unionByName(links_of_lists(met.sortWithinPartitions("key", "first", "second"), percent))
    return connected_components(checkpointed(links.distinct()))


def near_copies(docs: DataFrame, size: int = SHINGLE, percent: int = PERCENT, block: int = BLOCK) -> DataFrame:
    """doc_id, n_shingles, component_id, kept of every row."""
    rows = checkpointed(sketches(docs, size))
    usable = rows.where("doc_id is not null and n_shingles > 0")
    # equal sets are one: the least id stands for all
    distinct = usable.groupBy("set_key").agg(F.min("doc_id").alias("id"), F.min("n_shingles").alias("n"), F.min("keys").alias("keys"), F.min("sketch").alias("sketch"))
    distinct = checkpointed(distinct)
    candidates = checkpointed(candidate_groups(distinct, percent, block))
    # parts of large groups; each pair of parts is one task, a small group has one part alone
    sized = candidates.join(distinct.select("id", "n", "set_key"), "id")
    parts = F.ceil(F.greatest(F.count(F.lit(1)) / block, F.sum("n") / BLOCK_SHINGLES)).cast("int")
    counted = sized.groupBy("component").agg(parts.alias("parts"))
    placed = sized.join(counted, "component").withColumn("own", F.pmod(F.xxhash64("id"), F.col("parts")).cast("int"))
    texts = documents(docs).where("doc_id is not null").select(F.col("doc_id").alias("id"), "text")
    met = tasks(F.col("parts"), F.lit(0), F.col("own"), F.lit(False))
    delivered = placed.join(texts, "id").withColumn("task", F.explode(met)).select(
        F.col("component").alias("candidate"), "task.first", "task.second", "id", "set_key", "text"
    )
    dealt = delivered.repartition("candidate", "first", "second").sortWithinPartitions("candidate", "first", "second")
    linked = checkpointed(links_of_groups(dealt, size, percent))
    classes = connected_components(linked)
    by_set = distinct.select("set_key", "id").join(classes, "id", "left").select("set_key", F.coalesce("component", "id").alias("component"))
    found = rows.select("doc_id", "n_shingles", "set_key").join(by_set, "set_key", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce(F.when(F.col("n_shingles") > 0, F.col("component")), F.col("doc_id")))
    return found.select(
        "doc_id", "n_shingles", component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept")
    )


def one_of_each(docs: DataFrame, size: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """The rows of ``docs`` that stand for their group of near copies; of rows that share an id one stays.

    Rows without an id stay, for they are linked with nothing.
    """
    kept = near_copies(docs, size, percent).where("kept and doc_id is not null").select("doc_id").distinct()
    alone = Window.partitionBy("doc_id").orderBy(F.length("text"), "text")
    place = "_".join(["place", *docs.columns])  # no column of docs has this name
    stay = docs.join(kept, "doc_id", "left_semi").withColumn(place, F.row_number().over(alone)).where(F.col(f"`{place}`") == 1)
    return stay.select(*docs.columns).unionByName(docs.where("doc_id is null"))
