"""Operator 4: documents packed into as few token sequences as possible, by bin completion.

1. Tokens. A document's ids are those of its words, one after the other: the vocabulary drops white space, so the
   ids of a word do not depend on what stands around it. Longer documents are cut into pieces of the full length.
2. Plan. Only lengths matter, and there are at most ``capacity`` of them. So the driver gets the number of pieces
   of each length (at most 4096 rows, whatever the corpus) and plans with whole groups of equal sequences. Bin completion
   fills the sequence around the largest piece left: fillings that another one dominates are not tried, a
   branch whose waste exceeds what the incumbent allows is cut. The incumbent is the best-fit packing; when
   it meets the lower bound nothing is left to search.
3. Placing. Pieces of one length are numbered with two small counts (per bucket of ids, then in the bucket), so a
   length that a third of all pieces share is still dealt over many tasks; the number picks sequence and offset.

Null text counts as empty: one piece, the closing id alone. Repeated rows are packed each on its own; a null id
is kept. Without documents there is no sequence.
"""

from __future__ import annotations

import re
import zlib
from bisect import bisect_left
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import cache
from itertools import islice

import numpy as np
import public_tokenizers
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from millrace.llm.texts import checkpointed, documents, map_parts

CAPACITY = 4096
CLOSING = 1
TOKENIZER = "word_bpe_49k.json"
# Of each half of the cache; it stays with the worker.
WORDS_KEPT = 100_000
# Nodes of the search beyond the best-fit packing (at each it looks for one more length of a filling); a bound of effort,
# not of data: every piece is in the packing that is found.
SEARCH_NODES = 400_000
AHEAD = 200
# Pieces of one length and bucket that are numbered together.
BUCKET_ROWS = 50_000

# Characters from here on, and one before, are given to the tokenizer whole; below them lower case and letter classes are settled.
SETTLED = 0x250
BEYOND = re.compile("[\u0130\u0250-\U0010ffff]")


def _members(of_class: str) -> str:
    return "".join(re.escape(c) for c in map(chr, range(SETTLED)) if regex.match(of_class, c))


# The tokenizer's own cut of texts, with its classes written out, which is quicker.
_LETTERS, _NUMBERS, _BLANKS = map(_members, (r"\p{L}", r"\p{N}", r"\s"))
PRETOKEN = re.compile(f"[{_LETTERS}]+|'s|'t|'re|'ve|'m|'ll|'d|[{_NUMBERS}]|[^{_BLANKS}{_LETTERS}{_NUMBERS}]+")
ENCODED_AT_ONCE = 20_000


class WordIds:
    """Ids of texts as little-endian 32-bit bytes, pretoken by pretoken from a bounded cache."""

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        vocabulary = self.tokenizer.get_vocab()
        self.closes = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
        self.closes[[i for t, i in vocabulary.items() if t.endswith("</w>")]] = True
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def encode(self, texts: list[str]) -> list[bytes]:
        encodings = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, dtype="<u4").tobytes() for e in encodings]

    def settled(self, text: str) -> bool:
        """Whether our cut is the tokenizer's; other texts are given to it whole."""
        return not BEYOND.search(text) and not any(s in text for s in self.special)

    def encode_pretokens(self, pretokens: list[str]) -> list[bytes]:
        """Blanks keep pretokens apart, and the last id of each closes a word."""
        made = []
        for start in range(0, len(pretokens), ENCODED_AT_ONCE):
            ids = np.frombuffer(self.encode([" ".join(pretokens[start : start + ENCODED_AT_ONCE])])[0], dtype="<u4")
            ends = (np.flatnonzero(self.closes[ids]) + 1) * 4
            data = ids.tobytes()
            made += [data[a:b] for a, b in zip([0, *ends.tolist()], ends.tolist(), strict=False)]
        return made

    def texts(self, texts: list[str]) -> list[bytes]:
        settled = [self.settled(t) for t in texts]
        split = [PRETOKEN.findall(t.lower()) if own else [] for t, own in zip(texts, settled, strict=True)]
        missing = list(set().union(*split) - self.young.keys())
        if len(self.young) + len(missing) > WORDS_KEPT:
            self.old, self.young = self.young, {}
            missing = list(set().union(*split))
        young, old = self.young, self.old
        unknown = []
        for w in missing:
            known = old.get(w)
            if known is None:
                unknown.append(w)
            else:
                young[w] = known
        young.update(zip(unknown, self.encode_pretokens(unknown), strict=True))
        return [
            b"".join([young[w] for w in words]) if own else self.encode([text])[0]
            for text, words, own in zip(texts, split, settled, strict=True)
        ]


@cache
def word_ids(path: str) -> WordIds:
    """One for all tasks of a Python worker: loading a vocabulary for each task costs time, and memory that comes back late."""
    return WordIds(path)


def pieces(docs: DataFrame, capacity: int = CAPACITY, closing: int = CLOSING, tokenizer: str = TOKENIZER) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 of every piece."""
    path = public_tokenizers.path(tokenizer)

    def begin():
        known = word_ids(path)
        end = np.array([closing], dtype="<u4").tobytes()

        def step(ids, texts):
            rows: list[list] = [[], [], [], [], []]
            for doc_id, data in zip(ids.to_pylist(), known.texts([t or "" for t in texts.to_pylist()]), strict=True):
                data += end
                for k, at in enumerate(range(0, len(data), 4 * capacity)):
                    part = data[at : at + 4 * capacity]
                    for column, value in zip(rows, (doc_id, k, at // 4, len(part) // 4, zlib.crc32(part)), strict=True):
                        column.append(value)
            return rows

        return step

    return map_parts(documents(docs), begin, "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint")


@dataclass(frozen=True)
class Filling:
    """``times`` sequences that each hold ``parts``: (length, how many), lengths descending."""

    parts: tuple[tuple[int, int], ...]
    times: int


def best_fit(counts: dict[int, int], capacity: int) -> list[Filling]:
    """Best-fit decreasing with groups of equal sequences: each step uses up a length or a group."""
    rooms: list[int] = []  # distinct free spaces, ascending
    groups: dict[int, list[tuple[tuple, int]]] = {}

    def add(room: int, parts: tuple, times: int) -> None:
        if room not in groups:
            groups[room] = []
            rooms.insert(bisect_left(rooms, room), room)
        groups[room].append((parts, times))

    for length in sorted(counts, reverse=True):
        left = counts[length]
        while left:
            at = bisect_left(rooms, length)
            if at == len(rooms):
                each = min(capacity // length, left)
                add(capacity - each * length, ((length, each),), left // each)
                left -= each * (left // each)
                continue
            room = rooms[at]
            parts, times = groups[room].pop()
            if not groups[room]:
                del groups[room], rooms[at]
            each = min(room // length, max(1, left // times))
            used = min(times, left // each)
            if used < times:
                add(room, parts, times - used)
            add(room - each * length, (*parts, (length, each)), used)
            left -= each * used
    return [Filling(parts, times) for room in groups for parts, times in groups[room]]


def lower_bound(counts: dict[int, int], capacity: int) -> int:
    """Sequences that any packing needs: by total length, and by pieces too long to share (Martello and Toth)."""
    lengths = np.array(sorted(counts), dtype=np.int64)
    numbers = np.array([counts[int(x)] for x in lengths], dtype=np.int64)
    best = -(-int((lengths * numbers).sum()) // capacity)
    for low in [0, *[int(x) for x in lengths if x <= capacity // 2]]:
        alone = lengths > capacity - low
        large = (lengths > capacity // 2) & ~alone
        small = (lengths >= low) & (lengths <= capacity // 2)
        room = int((numbers[large] * (capacity - lengths[large])).sum())
        rest = int((numbers[small] * lengths[small]).sum()) - room
        best = max(best, int(numbers[alone].sum() + numbers[large].sum()) + max(0, -(-rest // capacity)))
    return best


class Left:
    """Pieces left, by length; lengths of which there are some are bits of a number.

    ``sums`` are the spaces that lengths can fill, as bits, the largest space first. They are made anew when a length comes back that they
    do not know, and now and then; in between they may hold sums of lengths that are used up, which only costs nodes.
    """

    SUMS_HOLD = 64

    def __init__(self, counts: dict[int, int], capacity: int):
        self.counts, self.capacity = counts, capacity
        self.lengths = sum(1 << k for k, n in counts.items() if n)
        self.summed, self.taken, self.sums = 0, 0, 0

    def refresh(self) -> None:
        if not self.lengths & ~self.summed and self.taken < self.SUMS_HOLD:
            return
        whole, sums, lengths = (2 << self.capacity) - 1, 1, self.lengths
        while lengths:
            length = (lengths & -lengths).bit_length() - 1
            lengths &= lengths - 1
            if sums >> length & 1:  # then all its multiples are there
                continue
            shift = length
            while shift <= self.capacity:
                sums |= sums << shift & whole
                shift *= 2
        self.summed, self.taken = self.lengths, 0
        self.sums = int(f"{sums:0{self.capacity + 1}b}"[::-1], 2)

    def fills(self, space: int) -> bool:
        """Whether lengths can fill a space to the end (used up ones among them)."""
        return bool(self.sums >> (self.capacity - space) & 1)

    def openings(self, space: int) -> int:
        """Lengths that leave a space that can be filled."""
        return self.sums >> (self.capacity - space) & self.lengths

    def largest(self, most: int) -> int:
        """The largest length up to ``most``; -1 if there is none."""
        return (self.lengths & ((2 << most) - 1)).bit_length() - 1

    def take(self, parts: tuple[tuple[int, int], ...], times: int) -> None:
        self.taken += 1
        for length, each in parts:
            self.counts[length] -= each * times
            if not self.counts[length]:
                self.lengths ^= 1 << length

    def give(self, parts: tuple[tuple[int, int], ...], times: int) -> None:
        for length, each in parts:
            if not self.counts[length]:
                self.lengths ^= 1 << length
            self.counts[length] += each * times


class Effort:
    """Nodes that a search may still visit."""

    def __init__(self, nodes: int):
        self.nodes = nodes


def dominated(left: Left, parts: list[tuple[int, int]], space: int) -> bool:
    """Whether another filling takes the place of this one: some of its pieces go together into one larger piece that is left.

    ``space`` is what the filling leaves free. Sums of its pieces are bits of two numbers, those of two pieces and more apart: a piece as
    large as the sum of several is better, a piece as large as one is the same.
    """
    one, several, spare = 1, 0, left.lengths
    for length, each in parts:
        if left.counts[length] == each:
            spare ^= 1 << length
        for _ in range(each):
            several |= (several | one & ~1) << length
            one |= 1 << length
    reached, shifted = (one | several) << 1 if space else 0, 1
    while shifted < space:
        more = min(shifted, space - shifted)
        reached |= reached << more
        shifted += more
    return bool((reached | several) & spare)


def fullest(left: Left, room: int, effort: Effort, most_free: int | None = None) -> Iterator[tuple[int, tuple[tuple[int, int], ...]]]:
    """Undominated fillings of ``room`` from the pieces left: (space left free, parts), until the effort is spent.

    The fullest come first, of equally full ones those of the largest pieces. Every undominated filling that leaves at most
    ``most_free`` free comes once.
    """
    parts: list[tuple[int, int]] = []

    def fill(space: int, most: int, free: int) -> Iterator[tuple[int, tuple[tuple[int, int], ...]]]:
        """Ways to fill ``space`` to the end with lengths up to ``most``."""
        effort.nodes -= 1
        if not space:
            if not dominated(left, parts, free):
                yield free, tuple(parts)
            return
        lengths = left.openings(space) & ((2 << most) - 1)
        while lengths and effort.nodes > 0:
            length = lengths.bit_length() - 1
            lengths ^= 1 << length
            for each in range(min(left.counts[length], space // length), 0, -1):
                if left.fills(space - each * length):
                    parts.append((length, each))
                    yield from fill(space - each * length, length - 1, free)
                    parts.pop()

    for free in range(min(room, room if most_free is None else most_free) + 1):
        if left.fills(room - free):
            yield from fill(room - free, room, free)
        if effort.nodes <= 0:
            return


def largest(left: Left, room: int, effort: Effort, most_free: int | None = None) -> Iterator[tuple[int, tuple[tuple[int, int], ...]]]:
    """The same fillings in another order: always the largest piece that fits, then whatever differs from that, the smallest pieces
    first. Of those that the first ``AHEAD`` nodes find the fullest comes first."""
    parts: list[tuple[int, int]] = []
    until = effort.nodes - AHEAD

    def fill(space: int, most: int) -> Iterator[tuple[int, tuple[tuple[int, int], ...]] | None]:
        effort.nodes -= 1
        if effort.nodes == until:
            yield None
        length = left.largest(min(space, most))
        if length < 0:
            if (most_free is None or space <= most_free) and not dominated(left, parts, space):
                yield space, tuple(parts)
            return
        for each in range(min(left.counts[length], space // length), -1, -1):
            if effort.nodes <= 0:
                return
            if each:
                parts.append((length, each))
            yield from fill(space - each * length, length - 1)
            if each:
                parts.pop()

    ways, first = fill(room, room), []
    for filling in ways:
        if filling is None:
            break
        first.append(filling)
        if not filling[0]:
            break
    yield from sorted(first, key=lambda f: f[0])
    yield from filter(None, ways)


def bin_completion(counts: dict[int, int], capacity: int = CAPACITY, nodes: int = SEARCH_NODES) -> list[Filling]:
    """Fillings that hold every piece: the best-fit packing, or a better one found by bin completion.

    Which filling a node tries first decides what a search of bounded effort finds, so both orders get a share of it.
    """
    counts = {int(k): int(n) for k, n in counts.items() if n}
    if not counts:
        return []
    best, bound = best_fit(counts, capacity), lower_bound(counts, capacity)
    for fillings, share in ((largest, nodes // 2), (fullest, nodes - nodes // 2)):
        if sequences(best) > bound:
            best = _search(counts, capacity, best, bound, fillings, Effort(share))
    return best


def sequences(plan: list[Filling]) -> int:
    return sum(f.times for f in plan)


def _search(counts: dict[int, int], capacity: int, best: list[Filling], bound: int, fillings: Callable, effort: Effort) -> list[Filling]:
    """Depth first over groups of equal sequences, from the incumbent ``best`` on.

    A node is the table of pieces left, one for the whole search: a branch takes its pieces out and gives them back. What is
    kept of a node is its filling and how many of its fillings were tried; the next one is made again when the search comes back.
    """
    fewest = sequences(best)
    total = sum(k * n for k, n in counts.items())
    counts = dict(counts)
    left = Left(counts, capacity)
    path: list[tuple[Filling, int, int]] = []  # filling, space lost, fillings tried at its node
    used, waste, tried = 0, 0, 0
    while fewest > bound and effort.nodes > 0:
        top = left.largest(capacity)
        if top < 0:
            best, fewest = [f for f, _, _ in path], used
        elif not tried and len(path) % 64 == 0:  # best fit for what is left may already do
            finish = best_fit({k: n for k, n in counts.items() if n}, capacity)
            if used + sequences(finish) < fewest:
                best, fewest = [*(f for f, _, _ in path), *finish], used + sequences(finish)
        spare = (fewest - 1) * capacity - total - waste  # a packing that is better wastes no more than this
        chosen = None
        if top > 0 and spare >= 0:
            left.take(((top, 1),), 1)
            left.refresh()
            for lost, parts in islice(fillings(left, capacity - top, effort, spare), tried, None):
                tried += 1
                each = sum(n for k, n in parts if k == top) + 1
                joined = ((top, each), *(p for p in parts if p[0] != top))
                times = min((counts[k] + (k == top)) // n for k, n in joined)
                if lost * times <= spare:
                    chosen = Filling(joined, times), lost * times, tried
                    break
            left.give(((top, 1),), 1)
        if chosen:
            path.append(chosen)
            left.take(chosen[0].parts, chosen[0].times)
            used, waste, tried = used + chosen[0].times, waste + chosen[1], 0
        elif path:
            filling, lost, tried = path.pop()
            left.give(filling.parts, filling.times)
            used, waste = used - filling.times, waste - lost
        else:
            break
    return best


@dataclass(frozen=True)
class Places:
    """For each length, runs of piece numbers and where they go; arrays sorted by ``first``."""

    first: np.ndarray
    sequence: np.ndarray
    times: np.ndarray
    offset: np.ndarray


def places(plan: list[Filling]) -> dict[int, Places]:
    """Piece number r of a length falls into the run that begins at ``first``: sequence + (r - first) % times."""
    runs: dict[int, list[tuple[int, int, int, int]]] = {}
    begun: dict[int, int] = {}
    sequence = 0
    for filling in plan:
        offset = 0
        for length, each in filling.parts:
            first = begun.get(length, 0)
            runs.setdefault(length, []).append((first, sequence, filling.times, offset))
            begun[length] = first + each * filling.times
            offset += each * length
        sequence += filling.times
    return {k: Places(*np.array(rows, dtype=np.int64).T) for k, rows in runs.items()}


def pack(docs: DataFrame, capacity: int = CAPACITY, closing: int = CLOSING, tokenizer: str = TOKENIZER) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset of every piece of every document."""
    spark = docs.sparkSession
    # written once: tokenising again for the second use would cost as much as the first
    cut = checkpointed(pieces(docs, capacity, closing, tokenizer))
    by_length = cut.groupBy("length").count()
    counts = {r["length"]: r["count"] for r in by_length.collect()}
    where = spark.sparkContext.broadcast(places(bin_completion(counts, capacity)))
    buckets = -(-sum(counts.values()) // BUCKET_ROWS)
    dealt = cut.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(buckets)).cast("int"))
    before = Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    firsts = dealt.groupBy("length", "bucket").count().select(
        "length", "bucket", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("before")
    )
    inside = Window.partitionBy("length", "bucket").orderBy("doc_id", "piece")
    numbered = dealt.withColumn("place", F.row_number().over(inside) - 1).join(firsts, ["length", "bucket"])
    columns = numbered.select("doc_id", "piece", "start", "length", "ids_crc32", (F.col("place") + F.col("before")).alias("number"))

    def begin():
        known = where.value

        def step(ids, piece, start, length, crc, number):
            lengths, numbers = length.to_numpy(), number.to_numpy()
            sequence, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
            order = np.argsort(lengths, kind="stable")
            for group in np.split(order, np.flatnonzero(np.diff(lengths[order])) + 1):
                size = int(lengths[group[0]])
                own = known[size]
                run = np.searchsorted(own.first, numbers[group], side="right") - 1
                beyond = numbers[group] - own.first[run]
                sequence[group] = own.sequence[run] + beyond % own.times[run]
                offset[group] = own.offset[run] + beyond // own.times[run] * size
            return ids, piece, start, length, crc, sequence, offset

        return step

    schema = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, sequence_id bigint, offset bigint"
    return map_parts(columns, begin, schema, text=None)
