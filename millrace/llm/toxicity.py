"""Operator 7: toxicity of texts, after a noisy-channel decoding of disguised words.

Channel: a writer may replace a letter by a look-alike sign, write letters with blanks or signs between them, or repeat a
letter. A stretch that may be disguised becomes a lattice of letters (each sign with its possible letters, each run of a
letter cut short or not, a word border or none between spaced letters); the Viterbi path under a character trigram
model is the restored text. The model counts the trigrams of all documents.

Score: words of the text, as written and as restored, give evidence by the word and by how it begins (so that inflected
forms count), weights being log odds learned from labelled rows whose crc32 modulo 5 is not 0; a logistic curve over
the two heaviest pieces of evidence, fitted on labelled rows that the weights have not seen, makes a probability of it.
At most about ``training_docs`` toxic and twice as many other labelled rows are used, chosen by a hash of the id.

Null and empty texts, and texts without evidence, get the score of no evidence. Without labels of both kinds every score
is 0. Labels that are null are not used; a document with several labels counts as toxic if one says so. Repeated rows
give repeated results; a null id counts as the empty text for crc32.
"""

from __future__ import annotations

import math
import re
from collections import Counter

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.texts import Cache, crc_of_id, documents, map_parts

TRAINING_DOCS = 6_000
LEAST_TOXIC = 3  # toxic training rows that evidence has to stand in
PRIOR = 3.0  # rows of the other kind that every piece of evidence is taken to have stood in
BEGINNINGS = (4, 5, 6)

# Signs and the letters that they are written for.
LOOKALIKE = {
    "0": "o", "1": "il", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "€": "e", "£": "l", "*": "aeiou",
}

BORDER, OTHER, SYMBOLS = 0, 59, 60
ALPHABET = "abcdefghijklmnopqrstuvwxyz" + "".join(chr(c) for c in range(0xDF, 0x100) if c != 0xF7)
SYMBOL = {c: i for i, c in enumerate(ALPHABET, 1)}
_CODES = np.zeros(0x10000, dtype=np.int64)
for _c in range(0x10000):
    _CODES[_c] = SYMBOL.get(chr(_c), OTHER if chr(_c).isalpha() else BORDER)

WORD = re.compile(r"[^\W\d_]+")
_SIGNS = "".join(LOOKALIKE)
_SIGN = re.escape(_SIGNS)
# letters and look-alikes side by side, at least one of each
STRETCH = re.compile(rf"[^\W\d_]+(?:[{_SIGN}]+[^\W\d_]*)+|[{_SIGN}]+[^\W\d_]+(?:[{_SIGN}]+[^\W\d_]*)*")
REPEATED = re.compile(r"[^\W\d_]*([^\W\d_])\1\1[^\W\d_]*")
SPACED = re.compile(rf"(?<![^\W_])(?:[^\W\d_]|[{_SIGN}])(?:[ .\-_][^\W\d_{_SIGN}]|[ .\-_][{_SIGN}]){{2,}}(?![^\W_])")
STAY = math.log(0.9)
CHANGE = math.log(0.1)
# Chance that a word as written has this sign right behind it, in its own meaning.
BEHIND = {c: math.log(0.02 if c == "!" else 0.005 if c in "*+|" else 0.001) for c in LOOKALIKE}


def trigram_counts(docs: DataFrame) -> DataFrame:
    """Trigram number and count over all texts; the alphabet bounds the result."""

    def begin():
        def step(texts):
            joined = " ".join(t.lower() for t in texts.to_pylist() if t)
            codes = np.frombuffer(f"  {joined} ".encode("utf-16-le", "surrogatepass"), dtype="<u2")
            s = _CODES[codes]
            s = s[np.append(True, (s[1:] != BORDER) | (s[:-1] != BORDER))] if len(s) else s  # one border between words
            s = np.concatenate([[BORDER], s])
            counts = np.bincount((s[:-2] * SYMBOLS + s[1:-1]) * SYMBOLS + s[2:], minlength=1) if len(s) > 2 else np.zeros(1, np.int64)
            found = np.flatnonzero(counts)
            return found, counts[found]

        return step

    counted = map_parts(docs.select(F.col("text").cast("string").alias("text")), begin, "trigram bigint, n bigint", text=0)
    return counted.groupBy("trigram").agg(F.sum("n").alias("n"))


class Restorer:
    """Viterbi decoding of disguised stretches under a trigram model."""

    def __init__(self, trigrams: np.ndarray):
        counts = trigrams.reshape(SYMBOLS, SYMBOLS, SYMBOLS).astype(float)
        pairs = counts.sum(axis=2, keepdims=True)
        singles = counts.sum(axis=(0, 1)) + 1
        ones = singles / singles.sum()
        twos = (counts.sum(axis=0) + 5 * ones) / (counts.sum(axis=(0, 2))[:, None] + 5)
        self.log = np.log((counts + 5 * twos[None]) / (pairs + 5))
        self.restored = Cache(self._restore, 50_000)

    def decode(self, options: list[list[tuple[str, float]]]) -> str:
        """Best path; each place offers (letters, log chance), where no letters and a blank are allowed too."""
        log, symbol = self.log, SYMBOL
        states: dict[tuple[int, int], tuple[float, tuple]] = {(BORDER, BORDER): (0.0, ())}
        for offered in options:
            after: dict[tuple[int, int], tuple[float, tuple]] = {}
            for (a, b), (score, path) in states.items():
                for text, chance in offered:
                    total, x, y = score + chance, a, b
                    for c in text:
                        z = BORDER if c == " " else symbol.get(c, OTHER)
                        if z == y == BORDER:  # one border between words
                            continue
                        total, x, y = total + log[x, y, z], y, z
                    if (x, y) not in after or after[x, y][0] < total:
                        after[x, y] = (total, (path, text))
            states = after
        best = max(states.items(), key=lambda s: s[1][0] + (0.0 if s[0][1] == BORDER else log[s[0][0], s[0][1], BORDER]))[1][1]
        made = []
        while best:
            best, text = best
            made.append(text)
        return "".join(reversed(made))

    def options(self, stretch: str) -> list[list[tuple[str, float]]]:
        """The lattice of a stretch in lower case. Blanks between letters stand for themselves or for nothing.

        Signs at the end of a word stand for letters or for themselves, as a border.
        """
        spaced = SPACED.fullmatch(stretch) is not None
        letters = [c for c in stretch if not (spaced and c in " .-_")]
        made: list[list[tuple[str, float]]] = []
        behind = len(letters) if spaced else len(stretch.rstrip(_SIGNS))
        i = 0
        while i < len(letters):
            c, run = letters[i], 1
            while i + run < len(letters) and letters[i + run] == c:
                run += 1
            read = [(x, CHANGE) for x in LOOKALIKE.get(c, "")] or [(c, 0.0)]
            plain = [(" ", BEHIND[c])] if i >= behind else []
            if run >= 3:
                made.append(plain + [(x * n, chance + (STAY if n == 1 else CHANGE)) for x, chance in read for n in (1, 2)])
                i += run
            else:
                made.append(plain + read)
                i += 1
            if spaced and i < len(letters):
                made.append([("", STAY), (" ", CHANGE)])
        return made

    def _restore(self, stretch: str) -> str:
        return self.decode(self.options(stretch))

    def restore(self, low: str, mixed: bool = True, repeated: bool = True, spaced: bool = True) -> list[str]:
        """Restored words of the disguised stretches of a text in lower case; the flags say what it may hold."""
        words = []
        if mixed:
            for m in STRETCH.finditer(low):
                found = WORD.findall(self.restored.get(m.group()))
                if found != WORD.findall(m.group()):  # else it is no disguise
                    words += found
        found = []
        if repeated:
            found += [m.group() for m in REPEATED.finditer(low)]
        if spaced:
            found += [m.group() for m in SPACED.finditer(low)]
        return words + [w for stretch in found for w in WORD.findall(self.restored.get(stretch))]


LETTER, SIGN, GAP = 1, 2, 4
_KINDS = np.zeros(0x10000, dtype=np.uint8)
for _c in range(0x10000):
    # halves of characters beyond count as letters, so that nothing is overlooked
    _KINDS[_c] = SIGN if chr(_c) in LOOKALIKE else LETTER if chr(_c).isalpha() or 0xD800 <= _c < 0xE000 else GAP if chr(_c) in " .-_" else 0


def disguises(lows: list[str]) -> list[tuple[bool, bool, bool]]:
    """For each text whether it may hold look-alikes, repeated letters, spaced letters; all texts are looked at at once."""
    packed = [t.encode("utf-16-le", "surrogatepass") for t in lows]
    begins = np.cumsum([0, *(len(p) // 2 + 8 for p in packed)])
    codes = np.frombuffer((b"\n\x00" * 8).join([*packed, b""]) + b"\n\x00" * 8, dtype="<u2")
    kind = _KINDS[codes]
    letter, sign, gap = kind == LETTER, kind == SIGN, kind == GAP
    mixed = (sign[:-1] & letter[1:]) | (letter[:-1] & sign[1:])
    repeated = letter[:-2] & (codes[:-2] == codes[1:-1]) & (codes[1:-1] == codes[2:])
    single = letter | sign
    spaced = single[:-4] & gap[1:-3] & single[2:-2] & gap[3:-1] & single[4:]
    flags = []
    for found in (mixed, repeated, spaced):
        here = np.zeros(len(lows), dtype=bool)
        here[np.searchsorted(begins, np.flatnonzero(found), side="right").clip(1, len(lows)) - 1] = True
        flags.append(here.tolist())
    return list(zip(*flags, strict=True))


def evidence_of(word: str) -> list[str]:
    """The word itself and its beginnings."""
    return [f"={word}", *(f"{word[:n]}~" for n in BEGINNINGS if len(word) >= n)]


def words_of(texts: list[str | None], restorer: Restorer) -> tuple[list[list[str]], list[list[str]]]:
    """Words as written and words as restored of each text."""
    lows = [(t or "").lower() for t in texts]
    flags = disguises(lows)
    return [WORD.findall(low) for low in lows], [restorer.restore(low, *f) if any(f) else [] for low, f in zip(lows, flags, strict=True)]


def labelled(docs: DataFrame, labels: DataFrame, training_docs: int) -> DataFrame:
    """doc_id, text, toxic, half of a bounded sample of the rows that may be learned from."""
    known = labels.where("toxic is not null and doc_id is not null").groupBy("doc_id").agg(F.max((F.col("toxic") == 1).cast("int")).alias("toxic"))
    usable = known.select(F.col("doc_id").cast("bigint").alias("doc_id"), "toxic").where(crc_of_id() % 5 != 0)
    sizes = {r.toxic: r["count"] for r in usable.groupBy("toxic").count().collect()}
    if len(sizes) < 2:
        return None
    part = lambda wanted, n: min(1.0, wanted / n) * 1_000_000
    limit = F.when(F.col("toxic") == 1, part(training_docs, sizes[1])).otherwise(part(2 * training_docs, sizes[0]))
    drawn = usable.where(F.pmod(F.xxhash64(F.lit("drawn"), "doc_id"), F.lit(1_000_000)) < limit)
    # the sample is bounded by its parameter, so it may be broadcast
    return documents(docs).join(F.broadcast(drawn), "doc_id").withColumn("half", F.pmod(F.xxhash64(F.lit("half"), "doc_id"), F.lit(2)).cast("int"))


class Evidence:
    """Weights of words; all evidence of a word begins as the word does, so most words are passed over by that."""

    def __init__(self, weights: dict[str, float]):
        self.weights = weights
        self.heads = {e[1:5] if e[0] == "=" else e[:4] for e in weights}

    def two_heaviest(self, words: list[list[str]]) -> list[tuple[float, float]]:
        """The two largest weights among the distinct words of each text."""
        heads, get = self.heads, self.weights.get
        heavy = {}
        for word in set().union(*words):
            if word[:4] in heads:
                weight = max(get(e, 0.0) for e in evidence_of(word))
                if weight > 0:
                    heavy[word] = weight
        known, made = set(heavy), []
        for own in words:
            found = sorted((heavy[w] for w in known.intersection(own)), reverse=True)[:2]
            made.append((found[0] if found else 0.0, found[1] if len(found) > 1 else 0.0))
        return made


def fit(docs: DataFrame, labels: DataFrame, training_docs: int = TRAINING_DOCS) -> tuple[np.ndarray, dict[str, float], list[float]]:
    """Trigram counts, weights of evidence, and the logistic curve (constant, first, second)."""
    trigrams = np.zeros(SYMBOLS**3)
    for row in trigram_counts(docs).collect():  # at most SYMBOLS ** 3 rows
        trigrams[row.trigram] = row.n
    spark = docs.sparkSession
    sample = labelled(docs, labels, training_docs)
    if sample is None:
        return trigrams, {}, [-1e9, 0.0, 0.0]
    model = spark.sparkContext.broadcast(trigrams)
    rows = sample.select("doc_id", "text", "toxic", "half")

    def begin():
        restorer = Restorer(model.value)

        def step(_ids, texts, toxic, half):
            counts: dict[int, Counter] = {0: Counter(), 1: Counter()}
            written, restored = words_of(texts.to_pylist(), restorer)
            for a, b, t, h in zip(written, restored, toxic.to_pylist(), half.to_pylist(), strict=True):
                if h == 0:
                    counts[t].update({e for w in {*a, *b} for e in evidence_of(w)} | {"#"})
            names = list(counts[0].keys() | counts[1].keys())
            return names, [counts[1][e] for e in names], [counts[0][e] for e in names]

        return step

    counted = map_parts(rows, begin, "evidence string, toxic bigint, other bigint").groupBy("evidence").agg(
        F.sum("toxic").alias("toxic"), F.sum("other").alias("other")
    )
    kept = counted.where((F.col("toxic") >= LEAST_TOXIC) & ((F.col("toxic") > F.col("other")) | (F.col("evidence") == "#"))).collect()
    totals = next(((r.toxic, r.other) for r in kept if r.evidence == "#"), (1, 1))
    weights = {}
    for r in kept:
        share = (totals[0] + 1) / (totals[1] + 1)  # evidence that means nothing is divided like this
        odds = math.log((r.toxic + PRIOR * share) / (r.other + PRIOR) / share)
        if r.evidence != "#" and odds > 1:
            weights[r.evidence] = odds
    shared = spark.sparkContext.broadcast(weights)

    def begin_held():
        restorer, evidence = Restorer(model.value), Evidence(shared.value)

        def step(_ids, texts, toxic, half):
            written, restored = words_of(texts.to_pylist(), restorer)
            heaviest = evidence.two_heaviest([a + b for a, b in zip(written, restored, strict=True)])
            made = [(t, *pair) for pair, t, h in zip(heaviest, toxic.to_pylist(), half.to_pylist(), strict=True) if h == 1]
            return [list(c) for c in zip(*made, strict=True)] if made else [[], [], []]

        return step

    held = map_parts(rows, begin_held, "toxic int, first double, second double").groupBy("toxic", "first", "second").count().orderBy("toxic", "first", "second").collect()
    return trigrams, weights, logistic(np.array([[r.toxic, r.first, r.second, r["count"]] for r in held], dtype=float).reshape(-1, 4))


def logistic(rows: np.ndarray, rounds: int = 50, ridge: float = 0.1) -> list[float]:
    """Constant and slopes of a logistic regression by Newton steps."""
    y, x, n = rows[:, 0], np.column_stack([np.ones(len(rows)), rows[:, 1:3]]), rows[:, 3]
    if not len(rows) or not (n[y == 1].sum() and n[y == 0].sum()):
        return [-3.0, 1.0, 0.0]
    beta = np.zeros(3)
    penalty = ridge * np.diag([0.01, 1.0, 1.0])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        slope = x.T @ (n * (y - p)) - penalty @ beta
        bend = (x * (n * p * (1 - p))[:, None]).T @ x + penalty
        step = np.linalg.solve(bend, slope)
        beta = beta + np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-6:
            break
    return [float(b) for b in beta]


def toxicity_scores(docs: DataFrame, trigrams: np.ndarray, weights: dict[str, float], curve: list[float]) -> DataFrame:
    """doc_id, score and the restored words of disguised stretches."""
    shared = docs.sparkSession.sparkContext.broadcast((trigrams, weights))

    def begin():
        counts, known = shared.value
        restorer, evidence = Restorer(counts), Evidence(known)

        def step(ids, texts):
            written, extra = words_of(texts.to_pylist(), restorer)
            scores = []
            for first, second in evidence.two_heaviest([a + b for a, b in zip(written, extra, strict=True)]):
                z = curve[0] + curve[1] * first + curve[2] * second
                scores.append(1 / (1 + math.exp(-max(-30.0, min(30.0, z)))) if curve[0] > -1e8 else 0.0)
            return ids, scores, [" ".join(words) for words in extra]

        return step

    return map_parts(documents(docs), begin, "doc_id bigint, score double, restored string")


def toxicity(docs: DataFrame, labels: DataFrame, training_docs: int = TRAINING_DOCS) -> DataFrame:
    """doc_id, held_out, score, predicted."""
    scored = toxicity_scores(docs, *fit(docs, labels, training_docs))
    return scored.select("doc_id", (crc_of_id() % 5 == 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
