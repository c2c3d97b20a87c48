"""Nulls, empty and long texts, repeated rows, clashing columns and empty tables, through every operator."""

from __future__ import annotations

import hashlib

import pytest
from pyspark.sql import functions as F

from llm_samples import ODD, ODD_SCHEMA
from millrace.llm import (
    byte_repeats, decontamination, embeddings, languages, near_copies, packing, passages, secrets, token_counts, toxicity,
)

BENCHMARK = [(1, "words in it"), (2, None), (None, "of another kind altogether"), (3, "..."), (4, "lang word lang word lang word lang word lang word lang")]
LABELS = [(4, 1, 0), (7, 0, 1), (7, 0, None), (None, 1, 1), (9, 1, 1), (10, None, 0)]


@pytest.fixture
def odd(frame):
    return frame(ODD, ODD_SCHEMA)


@pytest.fixture
def benchmark(frame):
    return frame(BENCHMARK, "item_id bigint, text string")


@pytest.fixture
def labels(frame):
    return frame(LABELS, "doc_id bigint, quality int, toxic int")


OPERATORS = {
    "token_counts": lambda d, b, l: token_counts.token_counts(d),
    "passages": lambda d, b, l: passages.repeated_passages(d),
    "languages": lambda d, b, l: languages.identify(d),
    "packing": lambda d, b, l: packing.pack(d).where("piece = 0"),
    "byte_repeats": lambda d, b, l: byte_repeats.repeated_bytes(d),
    "decontamination": lambda d, b, l: decontamination.contamination(d, b),
    "toxicity": lambda d, b, l: toxicity.toxicity(d, l),
    "secrets": lambda d, b, l: secrets.secret_report(d),
    "near_copies": lambda d, b, l: near_copies.near_copies(d),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_every_row_gets_a_result(odd, benchmark, labels, name):
    rows = OPERATORS[name](odd, benchmark, labels).collect()
    key = lambda x: (x is None, x)
    assert sorted((r.doc_id for r in rows), key=key) == sorted((r[0] for r in ODD), key=key)


@pytest.mark.parametrize("name", OPERATORS)
def test_empty_tables(odd, benchmark, labels, name):
    assert OPERATORS[name](odd.limit(0), benchmark.limit(0), labels.limit(0)).collect() == []


def by_id(df):
    return {r.doc_id: r for r in df.collect()}


def test_what_odd_rows_get(odd, benchmark, labels):
    empty = hashlib.sha256(b"").hexdigest()
    counts = by_id(token_counts.token_counts(odd))
    assert (counts[1].n_bytes, counts[1].n_tokens) == (counts[2].n_bytes, counts[2].n_tokens) == (0, 0)
    assert counts[9].over_limit and not counts[4].over_limit
    kept = by_id(passages.repeated_passages(odd))
    assert (kept[1].n_words, kept[3].kept_sha256) == (0, empty)
    # of a phrase that repeats all through a text the first window stays, and a repeated row takes nothing
    assert kept[9].n_removed == 8_000 - 2 and kept[5].n_removed == 0
    bytes_ = by_id(byte_repeats.repeated_bytes(odd))
    assert (bytes_[1].n_bytes, bytes_[8].n_removed, bytes_[5].n_removed) == (0, 20_000, 0)
    found = by_id(languages.identify(odd))
    assert all((found[i].lang_pred, found[i].score) == ("und", 0.0) for i in (1, 2, 3, 7))
    clean = by_id(decontamination.contamination(odd, benchmark))
    assert clean[None].items_sha256 == hashlib.sha256(b"1").hexdigest() and clean[9].n_hit == 8_000
    assert clean[1].n_words == 0 and not clean[4].contaminated
    score = by_id(toxicity.toxicity(odd, labels))
    assert all(0 <= r.score <= 1 for r in score.values())
    near = by_id(near_copies.near_copies(odd))
    assert (near[None].component_id, near[None].kept, near[1].component_id, near[2].kept) == (None, True, 1, True)
    pieces = packing.pack(odd).where("doc_id = 1").first()
    assert (pieces.length, pieces.piece, pieces.start) == (1, 0, 0)


def test_odd_vectors(frame):
    inf, nan = float("inf"), float("nan")
    rows = [
        (1, [1.0, 0.0], 1), (2, [2.0, 0.0], 1), (3, [1.0, 0.0], 2), (4, [1.0, 0.0], None), (5, None, 1), (6, [], 1),
        (7, [0.0, 0.0], 1), (8, [None, 1.0], 1), (9, [inf, 1.0], 1), (10, [nan, 1.0], 1), (11, [1.0, 0.0, 0.0], 1),
        (12, [1.0, 0.0], 1), (None, [1.0, 0.0], 1), (13, [-1.0, 0.0], 1), (14, [1e-300, 0.0], 1),
    ]
    got = {r.vec_id: r for r in embeddings.embedding_links(frame(rows, "vec_id bigint, embedding array<double>, label int")).collect()}
    assert len(got) == len(rows)
    assert {i: (r.n_links, r.component_id) for i, r in got.items() if r.n_links} == {i: (3, 1) for i in (1, 2, 12, 14)}
    assert all(got[i].component_id == i and got[i].kept for i in got if i not in (None, 2, 12, 14))
    none = frame([], "vec_id bigint, embedding array<float>, label int")
    assert embeddings.embedding_links(none).collect() == []


def test_filters_hand_all_columns_on(odd, benchmark):
    for kept in (languages.in_known_language(odd), near_copies.one_of_each(odd), decontamination.without_benchmark(odd, benchmark), secrets.redacted(odd)):
        assert kept.columns == odd.columns and kept.dtypes == odd.dtypes
    assert near_copies.one_of_each(odd).where("doc_id = 5").count() == 1
    assert secrets.redacted(odd).select(F.count("text")).first()[0] == len(ODD) - 1
