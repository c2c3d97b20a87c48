"""Operator 13: ranked lexical search, by branch and bound in FP-trees of documents.

1. Terms of the items, in blocks of items whose text has a bounded size; a block's terms are its vocabulary.
2. One pass over the documents restricts each to a vector: the vocabulary's terms in it and their counts, and the number of
   all its terms. It is written once. N, L and the document frequencies are sums over that table.
3. A task takes its vectors some hundred thousand entries at a time and orders each vector by document frequency, the rarest term
   first. Sorted, vectors that begin alike lie side by side: they share a path of the tree, and a node is a
   range of them. A node's largest counts and least m bound every score below it.
4. Depth first: at a node the items whose bound stays below their tenth score so far are given up; a node that no
   item is left for is cut off, a small one is worked out. The tenth scores go on from tree to tree of a task.
5. Each task hands on ten rows an item at most; these are ranked.

Null text has no term. Rows that share an item id are one item with the terms of all; items without terms have no result. Equal scores go by ascending
doc_id, those without an id last; rows that share an id are documents of their own. A very long text is counted a slice at a time.
Without documents or items there are no rows. Other columns are left aside.
"""

from __future__ import annotations

import heapq
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from millrace.llm.decontamination import NORMAL
from millrace.llm.texts import documents, map_parts, share_code, written

TOP = 10
# Item text that one block's vocabulary is made of, on average; a larger item is a block's bound.
BLOCK_BYTES = 2 * 1024 * 1024
# Entries of vectors that one tree is built of (a single longer vector makes a tree of its own).
TREE_ENTRIES = 600_000
# Nodes of so many vectors are worked out and not split.
LEAF = 32
SLICE = 1 << 20

VECTORS = "doc_id bigint, n bigint, terms array<int>, counts array<bigint>"
FOUND = "item int, item_id bigint, doc_id bigint, score bigint"


def slices(text: str | None) -> Iterator[list[bytes]]:
    """Terms of a text, in lists of bounded size."""
    data = (text or "").encode().translate(NORMAL)
    start = 0
    while start < len(data):
        end = data.find(b" ", start + SLICE)
        end = len(data) if end < 0 else end
        yield data[start:end].split()
        start = end


def item_terms(benchmark: DataFrame, item_col: str = "item_id") -> DataFrame:
    """doc_id (the item's), term: the distinct terms of every item."""

    def begin():
        def step(ids, texts):
            owners, terms = [], []
            for item, text in zip(ids.to_pylist(), texts.to_pylist(), strict=True):
                own = {t for part in slices(text) for t in part}
                owners += [item] * len(own)
                terms += [t.decode() for t in own]
            return owners, terms

        return step

    return map_parts(documents(benchmark, item_col), begin, "doc_id bigint, term string").distinct()


def vectors(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """doc_id, n, and the numbers and counts of the vocabulary's terms, for every row that has a term at all."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def begin():
        number = shared.value.get

        def step(ids, texts):
            rows: list[list] = [[], [], [], []]
            for doc_id, text in zip(ids.to_pylist(), texts.to_pylist(), strict=True):
                n, held = 0, Counter()
                for part in slices(text):
                    n += len(part)
                    held.update(map(number, part))
                held.pop(None, None)
                if n:
                    for column, value in zip(rows, (doc_id, n, list(held), list(held.values())), strict=True):
                        column.append(value)
            return rows

        return step

    return map_parts(documents(docs), begin, VECTORS)


class Best:
    """The best documents of every item so far."""

    def __init__(self, items: int, top: int):
        self.top = top
        self.heaps: list[list] = [[] for _ in range(items)]
        self.least = np.ones(items, dtype=np.int64)  # what a score has to reach

    def offer(self, item: int, score: int, doc_id: int | None) -> None:
        heap, entry = self.heaps[item], (score, float("-inf") if doc_id is None else -doc_id, doc_id)
        if len(heap) < self.top:
            heapq.heappush(heap, entry)
        elif entry[:2] > heap[0][:2]:
            heapq.heapreplace(heap, entry)
        if len(heap) == self.top:
            self.least[item] = heap[0][0]


class Weights:
    """Weights of terms, in order of document frequency, and the items that hold each."""

    def __init__(self, weights: np.ndarray, frequencies: np.ndarray, terms: np.ndarray, items: np.ndarray, n_items: int):
        self.n_items, self.weights = n_items, weights
        self.rank = np.empty(len(weights), dtype=np.int64)
        self.rank[np.lexsort((np.arange(len(weights)), frequencies))] = np.arange(len(weights))
        order = np.argsort(terms, kind="stable")
        self.holders = items[order]
        self.first = np.searchsorted(terms[order], np.arange(len(weights) + 1))

    def parts(self, terms: np.ndarray, counts: np.ndarray, m: np.ndarray) -> np.ndarray:
        return self.weights[terms] * ((1_000_000_000 * counts) // (1_000 * counts + 8 * m))

    def spread(self, terms: np.ndarray, values: np.ndarray, rows: np.ndarray, n_rows: int) -> np.ndarray:
        """Sums of values by row and item, each value given to all items that hold its term."""
        lows = self.first[terms]
        spans = self.first[terms + 1] - lows
        ends = np.cumsum(spans)
        at = np.repeat(lows - ends + spans, spans) + np.arange(ends[-1] if len(ends) else 0)
        made = np.zeros(n_rows * self.n_items, dtype=np.int64)
        np.add.at(made, np.repeat(rows * self.n_items, spans) + self.holders[at], np.repeat(values, spans))
        return made.reshape(n_rows, self.n_items)


class Tree:
    """FP-tree of vectors: sorted by their terms, so that a node is a range of them."""

    def __init__(self, known: Weights, ids: list, m: np.ndarray, first: np.ndarray, terms: np.ndarray, counts: np.ndarray):
        owner = np.repeat(np.arange(len(ids)), np.diff(first))
        inside = np.lexsort((known.rank[terms], owner))
        terms, counts = terms[inside], counts[inside]
        keys = known.rank[terms].astype(">u4").tobytes()
        paths = [keys[4 * a : 4 * b] for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True)]
        order = sorted(range(len(ids)), key=paths.__getitem__)
        self.known = known
        self.ids = [ids[i] for i in order]
        self.m = m[order]
        sizes = np.diff(first)[order]
        self.first = np.concatenate([[0], np.cumsum(sizes)])
        take = np.repeat(first[:-1][order] - self.first[:-1], sizes) + np.arange(self.first[-1])
        self.terms, self.counts = terms[take], counts[take]
        # how many terms a vector's path shares with the one before
        self.shared = np.zeros(len(ids) + 1, dtype=np.int64)
        for k in range(1, len(order)):
            a, b = self.terms[self.first[k - 1] : self.first[k]], self.terms[self.first[k] : self.first[k + 1]]
            both = min(len(a), len(b))
            differ = np.flatnonzero(a[:both] != b[:both])
            self.shared[k] = differ[0] if len(differ) else both

    def children(self, low: int, high: int) -> list[tuple[int, int]]:
        """Ranges below a node; neighbours that are small together make one range."""
        shared = self.shared[low + 1 : high]
        cuts = [low, *(np.flatnonzero(shared == shared.min()) + low + 1).tolist(), high]
        made: list[tuple[int, int]] = []
        for a, b in zip(cuts, cuts[1:], strict=False):
            if made and b - made[-1][0] <= LEAF:
                made[-1] = (made[-1][0], b)
            else:
                made.append((a, b))
        return made

    def bounds(self, low: int, high: int) -> np.ndarray:
        """What no score below a node exceeds, for every item: by the largest counts and the least m in it."""
        a, b = self.first[low], self.first[high]
        terms, place = np.unique(self.terms[a:b], return_inverse=True)
        most = np.zeros(len(terms), dtype=np.int64)
        np.maximum.at(most, place, self.counts[a:b])
        parts = self.known.parts(terms, most, self.m[low:high].min())
        return self.known.spread(terms, parts, np.zeros(len(terms), dtype=np.int64), 1)[0]

    def scores(self, low: int, high: int) -> np.ndarray:
        """Scores of the vectors in a range, a row each."""
        a, b = self.first[low], self.first[high]
        rows = np.repeat(np.arange(high - low), np.diff(self.first[low : high + 1]))
        parts = self.known.parts(self.terms[a:b], self.counts[a:b], self.m[low:high][rows])
        return self.known.spread(self.terms[a:b], parts, rows, high - low)

    def search(self, best: Best) -> int:
        """Offer every document that may be among the best of an item; returns how many were worked out."""
        worked_out = 0
        nodes = [(0, len(self.ids), np.arange(self.known.n_items), 2 * len(self.ids))] if self.ids else []
        while nodes:
            low, high, left, above = nodes.pop()
            # a node that is not much smaller than the last one bounded would tell nothing new
            if 2 * (high - low) <= above:
                left = left[self.bounds(low, high)[left] >= best.least[left]]
                above = high - low
                if not len(left):
                    continue
            if high - low > LEAF:
                below = self.children(low, high)
                nodes += [(a, b, left, above) for a, b in reversed(below)]
                continue
            worked_out += high - low
            found = self.scores(low, high)[:, left]
            for row, column in np.argwhere(found >= best.least[left]).tolist():
                item = int(left[column])
                if found[row, column] >= best.least[item]:
                    best.offer(item, int(found[row, column]), self.ids[low + row])
        return worked_out


def trees(batches: Iterator[pa.RecordBatch], known: Weights, n_docs: int, n_terms: int) -> Iterator[Tree]:
    """Trees of vectors that hold about TREE_ENTRIES entries together."""

    def tree(rows: pa.Table) -> Tree:
        columns = [rows.column(i).combine_chunks() for i in range(4)]
        m = np.array([10 + 90 * n * n_docs // n_terms for n in columns[1].to_pylist()], dtype=np.int64)
        first = np.concatenate([[0], np.cumsum(columns[2].value_lengths().to_numpy(zero_copy_only=False))]).astype(np.int64)
        flat = [c.flatten().to_numpy(zero_copy_only=False).astype(np.int64) for c in columns[2:]]
        return Tree(known, columns[0].to_pylist(), m, first, *flat)

    held, entries = [], 0
    for batch in batches:
        sizes = np.cumsum(batch.column(2).value_lengths().to_numpy(zero_copy_only=False))
        start = 0
        while start < batch.num_rows:
            used = sizes[start - 1] if start else 0
            end = max(start + 1, int(np.searchsorted(sizes, used + TREE_ENTRIES - entries, side="right")))
            held.append(batch.slice(start, end - start))
            entries += int(sizes[end - 1] - used)
            if end < batch.num_rows or entries >= TREE_ENTRIES:
                yield tree(pa.Table.from_batches(held))
                held, entries = [], 0
            start = end
    if held:
        yield tree(pa.Table.from_batches(held))


def _search_block(docs: DataFrame, pairs: DataFrame, top: int) -> DataFrame:
    """item_id, rank, doc_id, score for the items of one block."""
    spark = docs.sparkSession
    rows = pairs.collect()  # the terms of one block
    items = sorted({r.doc_id for r in rows}, key=lambda i: (i is None, i))
    terms = sorted({r.term for r in rows})
    item_number, term_number = ({x: k for k, x in enumerate(y)} for y in (items, terms))
    found = written(vectors(docs, {t.encode(): k for t, k in term_number.items()}), "vectors")
    n_docs, n_terms = found.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    df = found.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    weight = F.floor(1000 * F.log((2.0 * n_docs + 2) / (2 * F.col("df") + 1)))
    frequencies, weights = np.zeros((2, len(terms)), dtype=np.int64)
    for r in df.select("term", "df", weight.alias("w")).collect():  # a row for each term of the block
        frequencies[r.term], weights[r.term] = r.df, r.w
    held = np.array([(term_number[r.term], item_number[r.doc_id]) for r in rows], dtype=np.int64).reshape(-1, 2)
    shared = spark.sparkContext.broadcast((items, Weights(weights, frequencies, held[:, 0], held[:, 1], len(items))))
    made_as = to_arrow_schema(StructType.fromDDL(FOUND))

    def run(batches):
        names, known = shared.value
        best = Best(known.n_items, top)
        for one in trees(batches, known, n_docs, n_terms):
            one.search(best)
        entries = [(item, names[item], e[2], e[0]) for item, heap in enumerate(best.heaps) for e in heap]
        if entries:
            columns = zip(zip(*entries, strict=True), made_as, strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(values, f.type) for values, f in columns], schema=made_as)

    # vectors without a term of the block score nothing
    best = found.where(F.size("terms") > 0).mapInArrow(run, FOUND)
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    ranked = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return ranked.select("item_id", "rank", "doc_id", "score")


def ranked_search(docs: DataFrame, benchmark: DataFrame, top: int = TOP, block_bytes: int = BLOCK_BYTES, item_col: str = "item_id") -> DataFrame:
    """item_id, rank, doc_id, score: the ``top`` best documents of every item, searched block by block."""
    share_code(docs.sparkSession.sparkContext)
    pairs = written(item_terms(benchmark, item_col), "item-terms")
    size = pairs.agg(F.sum(F.octet_length("term"))).first()[0] or 0
    blocks = max(1, -(-size // block_bytes))
    block = F.pmod(F.xxhash64(F.coalesce(F.col("doc_id"), F.lit(-1))), F.lit(blocks))
    found = [_search_block(docs, pairs.where(block == k), top) for k in range(blocks)]
    together = found[0]
    for one in found[1:]:
        together = together.unionByName(one)
    return together
