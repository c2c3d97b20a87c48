"""Token counts at every prefix, and packing, against the tokenizer library and by round trip."""

from __future__ import annotations

import random
import zlib
from collections import Counter
from itertools import product

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from millrace.llm import packing, token_counts

PIECES = st.sampled_from([" ", "  ", "\n", "\t", "'", "re", "'re", "'ll", "a", "é", "日", "!", "1", "<|endoftext|>", "the", "ing", "....", "\x1c", "İ", "Σ", "ß", "́"])
TEXTS = st.lists(PIECES, max_size=12).map("".join)


@pytest.fixture(scope="module")
def counter():
    return token_counts.PrefixCounts(public_tokenizers.path(token_counts.TOKENIZER))


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(public_tokenizers.path(token_counts.TOKENIZER))


@given(text=TEXTS)
@settings(max_examples=300, deadline=None)
def test_every_prefix(counter, library, text):
    steps, total = counter.text(text)
    assert len(steps) == len(text.encode())
    for i in range(len(text) + 1):
        want = len(library.encode(text[:i], add_special_tokens=False).ids)
        assert token_counts.count_at(steps, len(text[:i].encode())) == want
    assert total == len(library.encode(text, add_special_tokens=False).ids)


def test_every_white_space_and_control_character(counter, library):
    """Each of them between, before and behind others, at every prefix."""
    odd = [chr(c) for c in [*range(33), *range(127, 161), 0x1680, *range(0x2000, 0x2010), 0x2028, 0x2029, 0x202F, 0x205F, 0x2060, 0x3000, 0xFEFF]]
    for a in odd:
        for form in ("{a}", "\n\n{a}", "  {a}x", "{a}{a}{a} y", "x{a} {a}\x1c\x1dz", " {a}'re{a}", "\x1c\x1f{a} 1", "日{a} {a}本"):
            text = form.format(a=a)
            steps, total = counter.text(text)
            counts = [token_counts.count_at(steps, len(text[:i].encode())) for i in range(len(text) + 1)]
            assert counts == [len(library.encode(text[:i], add_special_tokens=False).ids) for i in range(len(text) + 1)], repr(text)


def test_random_prefixes(counter, library):
    draw = random.Random(20)
    letters = " \n\t\r\x0b\x1c\x1d\x1e\x1f\x85\xa0a1'é!日\u2003\u200b"
    for _ in range(6_000):
        text = "".join(draw.choices(letters, k=draw.randrange(1, 9)))
        steps, total = counter.text(text)
        assert total == len(library.encode(text, add_special_tokens=False).ids), repr(text)
        i = draw.randrange(len(text))
        assert token_counts.count_at(steps, len(text[:i].encode())) == len(library.encode(text[:i], add_special_tokens=False).ids), repr(text)


def test_budget(counter):
    steps, total = counter.text("The quick brown fox jumps over it.")
    at = token_counts.bytes_within(steps, 3)
    assert token_counts.count_at(steps, at) <= 3 < token_counts.count_at(steps, at + 1)
    assert token_counts.bytes_within(steps, total) == len(steps) and token_counts.bytes_within(steps, 0) == 0


def test_counts_of_the_smallest_table(spark, library):
    from millrace.llm import registry

    texts = {r.doc_id: r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    for r in registry.QUERIES["op1_token_counts"](spark, "/root/testdata/sf0.001").collect():
        n = len(library.encode(texts[r.doc_id], add_special_tokens=False).ids)
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len(texts[r.doc_id].encode()), n, n > 1024)


@given(text=TEXTS)
@settings(max_examples=300, deadline=None)
def test_word_ids(text):
    path = public_tokenizers.path(packing.TOKENIZER)
    if not hasattr(test_word_ids, "known"):
        test_word_ids.known = packing.WordIds(path)
    ids = test_word_ids.known.tokenizer.encode(text, add_special_tokens=False).ids
    assert np.frombuffer(test_word_ids.known.texts([text])[0], dtype="<u4").tolist() == ids


def test_packing_round_trip(spark):
    from millrace.llm import registry

    tokenizer = Tokenizer.from_file(public_tokenizers.path(packing.TOKENIZER))
    texts = {r.doc_id: r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    rows = registry.QUERIES["op4_best_fit_packing"](spark, "/root/testdata/sf0.001").collect()
    by_doc: dict[int, list] = {}
    by_sequence: dict[int, list] = {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_sequence.setdefault(r.sequence_id, []).append(r)
    assert set(by_doc) == set(texts)
    for doc_id, pieces in by_doc.items():
        ids = [*tokenizer.encode(texts[doc_id], add_special_tokens=False).ids, 1]
        for k, r in enumerate(sorted(pieces, key=lambda r: r.piece)):
            own = ids[4096 * k : 4096 * (k + 1)]
            assert (r.piece, r.start, r.length) == (k, 4096 * k, len(own))
            assert r.ids_crc32 == zlib.crc32(np.array(own, dtype="<u4").tobytes())
        assert sum(r.length for r in pieces) == len(ids)
    for pieces in by_sequence.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 4096
    assert len(by_sequence) == packing.lower_bound(Counter(r.length for r in rows), 4096)


@pytest.mark.parametrize("seed", range(6))
def test_bin_completion_holds_every_piece(seed):
    draw = random.Random(seed)
    lengths = [draw.choice([draw.randint(1, 100), draw.randint(30, 60), 50]) for _ in range(draw.randint(0, 300))]
    counts = Counter(lengths)
    plan = packing.bin_completion(counts, 100, nodes=300)
    held: Counter = Counter()
    for filling in plan:
        assert sum(k * n for k, n in filling.parts) <= 100
        for k, n in filling.parts:
            held[k] += n * filling.times
    assert held == counts
    used = sum(f.times for f in plan)
    assert packing.lower_bound(counts, 100) if counts else used == 0
    assert used <= sum(f.times for f in packing.best_fit(counts, 100))


def test_bin_completion_beats_best_fit():
    # best fit decreasing takes three sequences for what two hold
    counts = Counter([44, 24, 24, 22, 21, 17, 8, 8, 6, 6, 10, 10])
    assert packing.lower_bound(counts, 100) == 2
    assert sum(f.times for f in packing.bin_completion(counts, 100)) == 2


def undominated(counts: dict[int, int], room: int) -> set[tuple]:
    """All fillings, without those whose pieces another one holds, put together into larger ones."""
    lengths = sorted(counts, reverse=True)
    fillings = [
        tuple(zip(lengths, numbers, strict=True))
        for numbers in product(*[range(counts[k] + 1) for k in lengths])
        if sum(k * n for k, n in zip(lengths, numbers, strict=True)) <= room
    ]
    pieces = {f: [k for k, n in f for _ in range(n)] for f in fillings}

    def holds(bins: list[int], small: list[int]) -> bool:
        if not small:
            return True
        return any(holds([*bins[:i], b - small[0], *bins[i + 1 :]], small[1:]) for i, b in enumerate(bins) if b >= small[0])

    return {
        tuple((k, n) for k, n in f if n)
        for f in fillings
        if not any(g != f and holds(pieces[g], pieces[f]) for g in fillings)
    }


@pytest.mark.parametrize("order", [packing.largest, packing.fullest])
def test_completions_are_all_undominated_fillings(order):
    draw = random.Random(12)
    cases = [({6: 1, 5: 1, 4: 1, 3: 1}, 10), ({3: 1}, 4), ({2: 3}, 1), ({1: 4}, 3)]
    cases += [({draw.randrange(1, 13): draw.randrange(1, 3) for _ in range(draw.randrange(1, 6))}, draw.randrange(1, 19)) for _ in range(60)]
    for counts, room in cases:
        left = packing.Left(dict(counts), 20)
        left.refresh()
        found = [(space, tuple(sorted(parts, reverse=True))) for space, parts in order(left, room, packing.Effort(10**6))]
        assert len(found) == len(set(found)) and {parts for _, parts in found} == undominated(counts, room), (counts, room)
        assert all(space == room - sum(k * n for k, n in parts) for space, parts in found)
    left = packing.Left({6: 1, 5: 1, 4: 1, 3: 1}, 20)
    left.refresh()
    assert list(order(left, 10, packing.Effort(100))) == [(0, ((6, 1), (4, 1)))]


def fewest(pieces: tuple[int, ...], capacity: int) -> int:
    """Sequences of the best packing, by trying all."""
    best = len(pieces)

    def place(at: int, rooms: list[int]) -> None:
        nonlocal best
        if len(rooms) >= best:
            return
        if at == len(pieces):
            best = len(rooms)
            return
        for i, room in enumerate(rooms):
            if pieces[at] <= room and room not in rooms[:i]:
                place(at + 1, [*rooms[:i], room - pieces[at], *rooms[i + 1 :]])
        place(at + 1, [*rooms, capacity - pieces[at]])

    place(0, [])
    return best


def held(plan: list[packing.Filling], capacity: int) -> Counter:
    made: Counter = Counter()
    for filling in plan:
        assert sum(k * n for k, n in filling.parts) <= capacity
        for length, each in filling.parts:
            made[length] += each * filling.times
    return made


def test_bin_completion_finds_the_best_packing():
    draw = random.Random(13)
    better = 0
    for _ in range(150):
        pieces = tuple(sorted((draw.randrange(12, 60) for _ in range(draw.randrange(1, 11))), reverse=True))
        plan = packing.bin_completion(Counter(pieces), 100)
        assert held(plan, 100) == Counter(pieces) and packing.sequences(plan) == fewest(pieces, 100)
        better += packing.sequences(plan) < packing.sequences(packing.best_fit(Counter(pieces), 100))
    assert better


def test_bin_completion_in_bounded_memory():
    import tracemalloc

    draw = random.Random(14)
    counts = Counter(min(4096, int(draw.lognormvariate(6.8, 0.5)) + 200) for _ in range(75_000))
    counts.update(range(1, 4097))
    tracemalloc.start()
    plan = packing.bin_completion(counts, 4096, nodes=60_000)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert held(plan, 4096) == counts and peak < 100e6
    assert packing.sequences(plan) <= packing.sequences(packing.best_fit(counts, 4096))
