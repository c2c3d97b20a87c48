"""Values in a credential context of any length, and the least cost of repeats against all segmentations of that kind."""

from __future__ import annotations

import math
import random
import string

import public_tokenizers
import pytest

from millrace.llm import secrets

RANKS = secrets.word_ranks(public_tokenizers.path(secrets.DICTIONARY))
LONG = "".join(random.Random(5).choices(string.ascii_letters + string.digits + "+/", k=1_600))


@pytest.mark.parametrize(
    "before, value, after",
    [
        ('{"private_key": "', "-----BEGIN PRIVATE KEY-----\\n" + LONG + "\\n-----END PRIVATE KEY-----\\n", '", "id": 1}'),
        ("pwd = '", LONG[:300], "'"),
        ("credential:" + " " * 20, LONG[:30], ""),
        ("pwd" + "\t" * 12 + "= ", LONG[:30], ""),
        ("Authorization:" + " " * 12 + "Bearer" + " " * 12, LONG[:40], ""),
        ("redis://:", LONG[:20].replace("/", "x"), "@host"),
        ("db://user:", LONG[:400].replace("/", "x"), "@host"),
        ("db://" + "u" * 300 + ":", LONG[:20].replace("/", "x"), "@host"),
    ],
)
def test_no_value_is_too_long(before, value, after):
    text = before + value + after
    spans = [(a, b) for a, kind, b, _ in secrets.find_spans(text, RANKS, secrets.LEAST_COST) if kind == 3]
    assert (len(before), len(before) + len(value)) in spans
    assert secrets.redact(text, spans) == before + "[secret]" + after


@pytest.mark.parametrize("unit", ["z", "q7", "k#2", "v%9x"])
def test_repeats_count_all_times(unit):
    for times in (3, 64, 65, 500):
        cost, pieces = secrets.guess_pieces(unit * times, {})
        assert cost <= sum(map(secrets.brute_force, unit)) + math.log10(times) + 1e-9
    assert pieces == [("repeat", 0, len(unit) * times)]


def all_repeats(low: str) -> float:
    """Least cost out of brute force by single characters and repeats of any length and place."""
    best = [0.0] + [math.inf] * len(low)
    for end in range(1, len(low) + 1):
        for start in range(end):
            join = secrets.PIECE if start else 0
            costs = [best[start] + join + secrets.brute_force(low[start])] if end - start == 1 else []
            for unit in range(1, secrets.LONGEST_UNIT + 1):
                times = (end - start) // unit
                if times >= 2 and times * unit == end - start >= 3 and low[start : start + unit] * times == low[start:end]:
                    costs.append(best[start] + join + sum(map(secrets.brute_force, low[start : start + unit])) + math.log10(times))
            best[end] = min([best[end], *costs])
    return best[-1]


def test_repeats_begin_where_it_is_cheapest():
    draw = random.Random(9)
    for _ in range(300):
        value = "".join(draw.choice(["%", "&", "%&", "&&&", "%%%%", "&%&%&%"]) for _ in range(draw.randrange(1, 12)))
        assert secrets.guess_pieces(value, {})[0] <= all_repeats(value) + 1e-9
    # the repeat has to leave a letter to the word before it
    cost, pieces = secrets.guess_pieces("passworddddddd", {"password": 1})
    assert pieces == [("word", 0, 8), ("repeat", 8, 14)]
    assert math.isclose(cost, math.log10(2) + secrets.PIECE + math.log10(26) + math.log10(6))
