"""Ranked search against its SQL and against plain Python."""

from __future__ import annotations

import math
import random
import re

import pytest

from llm_samples import ASCII_LOWER, ODD, ODD_SCHEMA, some_texts
from millrace.llm import lexical, registry
from oracle import connect, differences

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def terms_of(text: str | None) -> list[str]:
    return TERM.findall((text or "").translate(ASCII_LOWER))


def plain(docs: list[tuple], items: list[tuple], top: int = 10) -> set[tuple]:
    held = [(doc_id, terms_of(text)) for doc_id, text in docs if terms_of(text)]
    n_docs, n_terms = len(held), sum(len(t) for _, t in held)
    wanted: dict = {}
    for item, text in items:
        wanted.setdefault(item, set()).update(terms_of(text))
    made = set()
    for item, terms in wanted.items():
        found = []
        for doc_id, own in held:
            m, score = 100 - 90 + 90 * len(own) * n_docs // n_terms, 0
            for term in terms:
                if tf := own.count(term):
                    df = sum(term in other for _, other in held)
                    score += math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1))) * (10**9 * tf // (1000 * tf + 8 * m))
            if score > 0:
                found.append((score, doc_id))
        found.sort(key=lambda x: (-x[0], x[1] is None, x[1] or 0))
        made |= {(item, k, doc_id, score) for k, (score, doc_id) in enumerate(found[:top], 1)}
    return made


@pytest.mark.parametrize("sf", ["0.001", "0.01"])
def test_equals_sql(spark, sf):
    sf_dir = f"/root/testdata/sf{sf}"
    assert differences(connect(sf_dir), registry.QUERIES["op13_ranked_search"](spark, sf_dir), registry.SQL["op13_ranked_search"]) == []


@pytest.mark.parametrize(("leaf", "entries", "block_bytes"), [(32, 600_000, 1 << 21), (2, 50, 8), (1, 400, 1 << 21)])
def test_equals_plain_python(frame, monkeypatch, leaf, entries, block_bytes):
    monkeypatch.setattr(lexical, "LEAF", leaf)
    monkeypatch.setattr(lexical, "TREE_ENTRIES", entries)
    texts = some_texts(5, 150, "abcdefghijklmnopqrstuvw", 25)
    texts += [texts[3]] * 12 + ["A-b a; C", "É é_x", None, "", "--", "b"]
    docs = list(enumerate(texts))
    random.Random(2).shuffle(docs)
    items = [(1, "a b c"), (2, "q"), (3, None), (4, "!"), (5, texts[3]), (6, "not there"), (7, "é É x"), (None, "w v u t"), (1, "d a")]
    got = lexical.ranked_search(frame(docs, "doc_id bigint, text string"), frame(items, "item_id bigint, text string"), block_bytes=block_bytes)
    assert got.dtypes == [("item_id", "bigint"), ("rank", "int"), ("doc_id", "bigint"), ("score", "bigint")]
    rows = [tuple(r) for r in got.collect()]
    assert len(rows) == len(set(rows)) and set(rows) == plain(docs, items)


def test_odd_rows(frame):
    odd = frame(ODD, ODD_SCHEMA)
    items = [(1, "words in it and a lang", 2.0, None), (2, "same row", None, "x"), (3, None, None, None)]
    benchmark = frame(items, "item_id bigint, text string, score double, doc_id string")
    got = lexical.ranked_search(odd, benchmark)
    want = plain([r[:2] for r in ODD], [r[:2] for r in items])
    assert {tuple(r) for r in got.collect()} == want and any(r[2] is None for r in want)
    assert lexical.ranked_search(odd.limit(0), benchmark).collect() == []
    assert lexical.ranked_search(odd, benchmark.limit(0)).collect() == []


def test_a_slice_never_cuts_a_term(monkeypatch):
    monkeypatch.setattr(lexical, "SLICE", 3)
    text = "ab cdefgh, i\tjk-é ÉÀ" * 3
    assert [t.decode() for part in lexical.slices(text) for t in part] == terms_of(text)


def test_branches_are_cut():
    """Copies of a passage set the tenth score; what shares no rare term with it is not worked out."""
    import numpy as np

    n = 2_000
    vectors = [[0, 1, 2]] * 20 + [[3 + k % 50] for k in range(n - 20)]
    terms = np.array([t for v in vectors for t in v])
    frequencies = np.bincount(terms, minlength=53)
    known = lexical.Weights(np.full(53, 10), frequencies, np.array([0, 1, 2, 3]), np.zeros(4, dtype=np.int64), 1)
    first = np.concatenate([[0], np.cumsum([len(v) for v in vectors])])
    tree = lexical.Tree(known, list(range(n)), np.full(n, 100), first, terms, np.ones(len(terms), dtype=np.int64))
    best = lexical.Best(1, 10)
    assert tree.search(best) < n / 4
    assert sorted(e[2] for e in best.heaps[0]) == list(range(10))
