"""Near copies, embeddings and components against all pairs compared; the pipeline stage by stage."""

from __future__ import annotations

import random

import numpy as np
import pytest

import corpus_pipeline
from llm_samples import classes, shingles, some_texts
from millrace.llm import embeddings, near_copies, registry
from millrace.llm.components import connected_components

SMALL = "/root/testdata/sf0.001"


@pytest.mark.parametrize("block", [2_000, 3])
def test_near_copies(frame, block):
    draw = random.Random(7)
    base = [" ".join(draw.choice("abcdefghij") + str(draw.randrange(30)) for _ in range(60)) for _ in range(6)]
    texts = []
    for text in base:
        for _ in range(8):
            own = text.split(" ")
            for _ in range(draw.randrange(4)):
                own[draw.randrange(len(own))] = "edit"
            texts.append(" ".join(own))
    docs = list(enumerate([*texts, *some_texts(8, 40, "ab", 12), None, "", "A", "a", "A b", "a B"]))
    got = near_copies.near_copies(frame(docs, "doc_id bigint, text string"), block=block).collect()
    want = classes(docs)
    assert {r.doc_id: r.component_id for r in got} == want
    assert all(r.kept == (r.doc_id == r.component_id) and r.n_shingles == len(shingles(docs[r.doc_id][1])) for r in got)


def test_near_copies_of_the_smallest_table(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    got = registry.QUERIES["op10_near_copies"](spark, SMALL).collect()
    assert {r.doc_id: r.component_id for r in got} == classes(docs)


@pytest.mark.parametrize("block", [1_500, 4])
def test_embeddings(frame, block):
    draw = np.random.default_rng(3)
    rows = []
    for centre in draw.normal(size=(12, 32)):
        for k in range(draw.integers(1, 12)):
            rows.append((len(rows), (centre + (k > 2) * draw.normal(size=32) * draw.choice([0.02, 0.1, 0.15])).astype(np.float32).tolist(), int(draw.integers(2))))
    got = {r.vec_id: r for r in embeddings.embedding_links(frame(rows, "vec_id bigint, embedding array<float>, label int"), block=block).collect()}
    x = np.array([r[1] for r in rows])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    labels = np.array([r[2] for r in rows])
    near = (x @ x.T >= embeddings.COSINE) & (labels[:, None] == labels[None, :])
    np.fill_diagonal(near, False)
    found = np.array([got[i].n_links for i in range(len(rows))])
    assert (found <= near.sum(axis=1)).all() and found.sum() >= 0.97 * near.sum()
    assert all(got[i].kept == (got[i].component_id == i) for i in got)


def test_rotation_is_one():
    rows = np.random.default_rng(1).normal(size=(200, 16))
    _, projection = embeddings.learn_rotation(rows)
    assert np.allclose(projection.T @ projection, np.eye(16), atol=1e-8)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_components(frame, seed):
    draw = random.Random(seed)
    edges = [(draw.randrange(80), draw.randrange(80)) for _ in range(60)] + [(k, k + 1) for k in range(100, 140)] + [(200, 200), (None, 1)]
    parent = {n: n for e in edges if e[0] is not None for n in e}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a is not None:
            x, y = find(a), find(b)
            parent[max(x, y)] = min(x, y)
    got = {r.id: r.component for r in connected_components(frame(edges, "u bigint, v bigint")).collect()}
    assert got == {n: find(n) for n in parent}


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["language", "near_copies", "benchmark", "secrets", "packing"]
    held = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = {r.doc_id: r for r in docs.collect()}
        kept = stage(spark, docs, SMALL)
        docs = spark.createDataFrame(kept.collect(), kept.schema)
        after = {r.doc_id: r for r in docs.collect()}
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"] and set(after) <= set(before)
        held[name] = (before, after)
    before, after = held["language"]
    assert len(after) >= 0.99 * len(before) and all(after[i] == before[i] for i in after)
    before, after = held["near_copies"]
    # the stage has bounds of its own, five words and 0.8: those of op10's query bind that query alone
    assert set(after) == set(classes([(i, r.text) for i, r in before.items()], percent=80, size=5).values())
    before, after = held["secrets"]
    assert set(before) == set(after) and all(r.n_chars == len(r.text) for r in after.values() if r.text != before[r.doc_id].text)
    assert not any("AKIA" in r.text for r in after.values())
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, SMALL).collect()
    assert {r.doc_id for r in pieces} == set(after)


def test_pipeline_near_copies_on_both_sides_of_the_bound(spark, frame):
    """Pairs that differ by a block or by scattered words, with similarities from 0.74 to 0.86 on five words."""
    draw = random.Random(21)
    word = lambda: "".join(draw.choices("abcdefghijklmnopqrstuvwxyz", k=7))
    docs, shares = [], []
    for k in range(24):
        base = [word() for _ in range(300)]
        if k % 2:
            other = base + [word() for _ in range(50 + 2 * k)]
        else:
            other = [word() if n and n % (34 + k) == 0 else w for n, w in enumerate(base)]
        docs += [(2 * k, " ".join(base), "en", "s", 0), (2 * k + 1, " ".join(other), "en", "s", 0)]
        a, b = shingles(docs[-2][1], 5), shingles(docs[-1][1], 5)
        shares.append(len(a & b) / len(a | b))
    assert min(shares) < 0.78 < 0.8 < 0.82 < max(shares)
    rows = frame(docs, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    kept = {r.doc_id for r in dict(corpus_pipeline.STAGES)["near_copies"](spark, rows, SMALL).collect()}
    assert kept == {2 * k for k in range(24)} | {2 * k + 1 for k in range(24) if shares[k] < 0.8}
