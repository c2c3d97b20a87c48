"""How often the duplicate-passage operators go through the texts: once to count anchors, once for what recurs, one shuffle."""

from __future__ import annotations

import re

import pytest

from llm_samples import some_texts
from millrace.llm import byte_repeats, passages, recurring


@pytest.fixture
def shuffled(spark):
    """Joins of small tables are shuffled, as those of large ones are."""
    name = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(name)
    spark.conf.set(name, "-1")
    yield
    spark.conf.set(name, before)


@pytest.mark.parametrize("kind", ["words", "bytes"])
def test_texts_are_searched_twice(spark, frame, shuffled, kind):
    searched = spark.sparkContext.accumulator(0)

    def find(texts):
        searched.add(len(texts))
        return passages.find_segments(texts, 5, 2) if kind == "words" else byte_repeats.find_segments(texts, 40, 8)

    docs = frame(list(enumerate(some_texts(1, 60))), "doc_id bigint, text string")
    texts, _ = recurring.keyed(docs)
    assert recurring.recurring_segments(texts, find, lambda first, copies: copies > 1, "test").count() > 0
    assert searched.value == 2 * 60


def test_texts_are_shuffled_once(frame, folder, spark, shuffled, capsys):
    frame(list(enumerate(some_texts(1, 60))), "doc_id bigint, text string").write.parquet(folder("docs"))
    rows = passages.repeated_passages(spark.read.parquet(folder("docs")), window=5, anchor=2)
    assert rows.count() == 60
    rows.collect()
    rows.explain("formatted")
    tree, details = capsys.readouterr().out.split("== Initial Plan ==")
    made = [re.search(rf"^\({n}\) Exchange\nInput \[\d+\]: \[(.*)\]", details, re.M)[1] for n in re.findall(r"- Exchange \((\d+)\)", tree)]
    assert len([columns for columns in made if re.search(r"\btext#", columns)]) == 1 and "ReusedExchange" in tree
