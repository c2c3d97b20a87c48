"""Look-alikes at the end of a word, beside punctuation that stands for itself."""

from __future__ import annotations

import numpy as np
import pytest

from millrace.llm import toxicity


@pytest.fixture(scope="module")
def restorer():
    text = " ".join(["you dumb ass what an asshole and an idiot he is", "a bitch and a moral one", "that is great and so much fun for all of us at home", "wow it is good"] * 20)
    codes = [toxicity.SYMBOL.get(c, 0) for c in "  " + text + " "]
    trigrams = np.zeros(toxicity.SYMBOLS**3)
    for a, b, c in zip(codes, codes[1:], codes[2:], strict=False):
        trigrams[(a * toxicity.SYMBOLS + b) * toxicity.SYMBOLS + c] += 1
    return toxicity.Restorer(trigrams)


@pytest.mark.parametrize(
    "text, word",
    [("a$$", "ass"), ("dum8", "dumb"), ("asshol3", "asshole"), ("a$$hol3", "asshole"), ("idio7", "idiot"), ("1d1o7!", "idiot"), ("mora|", "moral"), ("a$$!", "ass"), ("b!tch!!!!", "bitch")],
)
def test_signs_at_the_end_are_letters(restorer, text, word):
    for sentence in (f"what a {text} he is", f"what a {text}", f"{text}, you"):
        assert toxicity.words_of([sentence], restorer)[1] == [[word]]


@pytest.mark.parametrize("text", ["wow! that is so great!", "so much fun!!!! for all!!", "home! good*? us|", "it is great+ and good*"])
def test_punctuation_stays(restorer, text):
    assert toxicity.words_of([text], restorer)[1] == [[]]


def test_a_stretch_is_judged_by_itself(restorer):
    alone = toxicity.words_of(["you dum8"], restorer)[1][0]
    beside = toxicity.words_of(["you dum8 b!tch and great! so"], restorer)[1][0]
    assert alone == ["dumb"] and beside == ["dumb", "bitch"]
