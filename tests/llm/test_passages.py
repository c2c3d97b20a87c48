"""Repeated passages of words and bytes against plain Python, with small windows so that much repeats."""

from __future__ import annotations

import hashlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from llm_samples import later_words_removed, repeated_bytes_removed, some_texts
from millrace.llm import byte_repeats, hashing, passages, recurring
from millrace.llm.suffixes import suffix_array


@pytest.mark.parametrize("slot_rows", [20_000, 2])
@pytest.mark.parametrize("seed", [1, 2])
def test_later_passages_go(frame, monkeypatch, slot_rows, seed):
    monkeypatch.setattr(recurring, "SLOT_ROWS", slot_rows)
    docs = list(enumerate([*some_texts(seed, 60), None, "", "a  b\t\nc"]))
    got = passages.repeated_passages(frame(docs, "doc_id bigint, text string"), window=5, anchor=2).collect()
    want = later_words_removed(docs, 5)
    assert {r.doc_id: (r.n_words, r.n_removed, r.kept) for r in got} == want
    assert all(r.kept_sha256 == hashlib.sha256(r.kept.encode()).hexdigest() for r in got)


@pytest.mark.parametrize("slot_rows", [20_000, 2])
@pytest.mark.parametrize("seed", [3, 4])
def test_repeated_bytes_go(frame, monkeypatch, slot_rows, seed):
    monkeypatch.setattr(recurring, "SLOT_ROWS", slot_rows)
    docs = list(enumerate([*some_texts(seed, 50, "aé b", 90), None, "", "short", "ab" * 60]))
    got = byte_repeats.repeated_bytes(frame(docs, "doc_id bigint, text string"), window=40, anchor=8, block=4).collect()
    want = repeated_bytes_removed(docs, 40)
    assert {r.doc_id: (r.n_removed, r.n_spans, bytes(r.kept)) for r in got} == want


@pytest.mark.parametrize("name, query", [("passages", "op2_repeated_passages"), ("bytes", "op5_byte_repeats")])
def test_whole_query_on_the_smallest_table(spark, name, query):
    from millrace.llm import registry

    docs = [(r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    got = {r.doc_id: r for r in registry.QUERIES[query](spark, "/root/testdata/sf0.001").collect()}
    if name == "passages":
        want = {i: (n, gone, hashlib.sha256(kept.encode()).hexdigest()) for i, (n, gone, kept) in later_words_removed(docs, 20).items()}
        assert {i: (r.n_words, r.n_removed, r.kept_sha256) for i, r in got.items()} == want
    else:
        want = {i: (gone, spans, hashlib.sha256(kept).hexdigest()) for i, (gone, spans, kept) in repeated_bytes_removed(docs, 400).items()}
        assert {i: (r.n_removed, r.n_spans, r.kept_sha256) for i, r in got.items()} == want


@given(st.lists(st.integers(1, 3), max_size=40))
@settings(max_examples=300, deadline=None)
def test_suffix_array(symbols):
    assert suffix_array(np.array(symbols, dtype=np.int64)).tolist() == sorted(range(len(symbols)), key=lambda i: symbols[i:])


@given(st.lists(st.integers(0, 5), min_size=1, max_size=40), st.integers(1, 12))
@settings(max_examples=200, deadline=None)
def test_minima_are_leftmost(values, width):
    row = np.array(values, dtype=np.uint64)
    want = [i + values[i : i + width].index(min(values[i : i + width])) for i in range(len(values) - width + 1)]
    assert hashing.minima(row, width).tolist() == want


def test_equal_stretches_have_equal_hashes():
    data = np.frombuffer(b"one two one two", dtype=np.uint8)
    sums = hashing.byte_sums(data)
    hashes = hashing.stretch_hash(sums, np.array([0, 8, 4, 0]), np.array([3, 11, 7, 4]))
    assert hashes[0] == hashes[1] and len(set(hashes.tolist())) == 3
