"""A passage in many different surroundings: what shares an anchor and a window does not come to one task."""

from __future__ import annotations

from pyspark.sql import functions as F

import pytest

from llm_samples import later_words_removed, repeated_bytes_removed
from millrace.llm import byte_repeats, passages, recurring


def test_contexts_of_one_window_are_not_gathered(frame, monkeypatch):
    monkeypatch.setattr(recurring, "SLOT_ROWS", 10)
    passage = " ".join(f"p{k}" for k in range(12))
    docs = [(i, " ".join([f"a{i}x{k}" for k in range(9)] + [passage] + [f"b{i}x{k}" for k in range(9)])) for i in range(60)]
    seen, compare = [], passages.compare_contexts

    def watched(asked, window):
        dealt = [c for c in ("key", "slot") if c in asked.columns]
        seen.append(asked.groupBy(*dealt).count().agg(F.coalesce(F.max("count"), F.lit(0))).collect()[0][0])
        return compare(asked, window)

    monkeypatch.setattr(passages, "compare_contexts", watched)
    got = passages.repeated_passages(frame(docs, "doc_id bigint, text string"), window=5, anchor=2).collect()
    want = later_words_removed(docs, 5)
    assert {r.doc_id: (r.n_words, r.n_removed, r.kept) for r in got} == want
    assert want[1][1] == 12 and seen[0] <= 10


def test_byte_contexts_of_one_window_are_not_gathered(frame, monkeypatch):
    """A passage in many surroundings: at its edges cuts differ, but agree in all full blocks."""
    monkeypatch.setattr(recurring, "SLOT_ROWS", 10)
    passage = "".join(f"p{k}." for k in range(20))
    docs = [(i, f"a{i}x" * 9 + passage + f"b{i}x" * 9) for i in range(60)]
    docs += [(100 + i, f"c{i % 2}y" * 9 + passage[: 41 + i % 7] + f"d{i}y" * 9) for i in range(20)]
    seen, compare = [], byte_repeats.compare_contexts

    def watched(asked, window, block):
        seen.append(asked.groupBy("key", "inner").count().agg(F.coalesce(F.max("count"), F.lit(0))).collect()[0][0])
        return compare(asked, window, block)

    monkeypatch.setattr(byte_repeats, "compare_contexts", watched)
    got = byte_repeats.repeated_bytes(frame(docs, "doc_id bigint, text string"), window=40, anchor=8, block=4).collect()
    assert {r.doc_id: (r.n_removed, r.n_spans, bytes(r.kept)) for r in got} == repeated_bytes_removed(docs, 40)
    assert len(seen) == 2 and max(seen) <= 10


@pytest.mark.parametrize("low", [0, -(1 << 62)])
def test_rows_without_an_id_are_documents_of_their_own(frame, low):
    """Each text without an id stands before all ids and is compared like others; the same text again is the same document."""
    same = " ".join(f"w{k}" for k in range(12))
    texts = [f"n{i} " * 3 + same + f" m{i}" * 3 for i in range(30)]
    docs = [(None, t) for t in texts] + [(None, texts[0])] + [(low + 5, "x " + same), (low, same + " y")]
    rows = frame(docs, "doc_id bigint, text string")
    words = passages.repeated_passages(rows, window=5, anchor=2).collect()
    by_text = sorted((r.doc_id is None, r.n_removed) for r in words)
    # the passage stays in one of the texts without an id, in both rows where that is the repeated one
    kept = [r for r in words if r.n_removed == 0]
    assert len(words) == len(docs) and all(r.doc_id is None for r in kept) and len(kept) in (1, 2) and len({r.kept for r in kept}) == 1
    assert by_text[0][0] is False and {n for none, n in by_text if not none} == {12}
    gone = byte_repeats.repeated_bytes(rows, window=30, anchor=8, block=4).collect()
    assert len(gone) == len(docs) and all(r.n_removed >= len(same) for r in gone)


def test_many_rows_without_an_id_take_time_in_proportion(spark):
    """Rows without an id are not gathered: 20,000 of them with one passage in common."""
    same = " ".join(f"w{k}" for k in range(25))
    rows = spark.range(20_000).select(F.lit(None).cast("bigint").alias("doc_id"), F.concat(F.lit(same + " z"), F.col("id").cast("string")).alias("text"))
    got = passages.repeated_passages(rows.repartition(8)).groupBy("n_removed").count().collect()
    assert {r.n_removed: r["count"] for r in got} == {0: 1, 25: 19_999}
