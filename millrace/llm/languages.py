"""Operator 3: language of a text, by unigram piece models that sum over all segmentations.

The pieces are those of a fixed public vocabulary; each language has its own probability of each piece. A word's likelihood
is the sum over every way to cut it into pieces (forward algorithm), a text's the product over its words
(runs of letters, in lower case, each with the vocabulary's sign of a word start). Letters the vocabulary lacks are spelled
by its byte pieces. The probabilities are fitted by expectation maximisation, whose expected counts come from
forward and backward sums over the words of the training texts.

Training takes at most about ``training_docs`` texts of each language, chosen by a hash of id and text; only texts with a language
and an id whose crc32 modulo 3 is not 1. Everything else covers all texts and whole texts.

Null text, empty text and text without a letter: language ``und``, score 0; so is everything if there is
nothing to learn from. Score is the posterior of the predicted language under equal priors; of equal languages the one
first in the alphabet is predicted. Repeated rows give repeated results; a null id counts as the empty text for crc32.
"""

from __future__ import annotations

import math
import re

import numpy as np
import public_tokenizers
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from millrace.llm.texts import checkpointed, crc_of_id, documents, map_parts, with_rows

VOCABULARY = "piece_bpe_32k.model"
TRAINING_DOCS = 1_000
ROUNDS = 2
SMOOTHING = 0.05
# What a task keeps of words it has met, and the text it splits at once: both bound its memory.
WORDS_KEPT = 200_000
PART_BYTES = 1024 * 1024
# After fitting, pieces of several letters that are expected less often than this in every language have no probability in any: words are
# cut into shorter pieces there.
LEAST_EXPECTED = 0.5
LETTERS = re.compile(r"[^\W\d_]+")
START = "▁"  # the vocabulary's sign of a word start
UNKNOWN = "und"


def letter_pieces(path: str) -> dict[str, int]:
    """Pieces made of letters, with or without the sign of a word start; and of single bytes, as ``<0x..>``."""
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces = {}
    for i in range(model.get_piece_size()):
        piece = model.id_to_piece(i)
        core = piece.removeprefix(START)
        if model.is_byte(i) or ((core.isalpha() and core == core.lower()) or (piece == START)):
            pieces[piece] = i
    return pieces


class Pieces:
    """Forward and backward sums for several languages at once; ``table`` maps a piece to its probabilities."""

    def __init__(self, table: dict[str, tuple[float, ...]], languages: int):
        self.table, self.zero = table, (0.0,) * languages
        self.one = (1.0,) * languages
        self.longest = max((len(p) for p in table if not p.startswith("<0x")), default=1)
        self.spelled: dict[str, tuple[float, ...]] = {}

    def piece(self, text: str) -> tuple[float, ...] | None:
        found = self.table.get(text)
        if found is None and len(text) == 1:
            found = self.spelled.get(text)
            if found is None:
                found = self.one  # at most four bytes, none of them rarer than 1e-12: no underflow
                for byte in text.encode():
                    found = tuple(a * b for a, b in zip(found, self.table.get(f"<0x{byte:02X}>", self.zero), strict=True))
                self.spelled[text] = found
        return found

    def logs(self, word: str, k: int) -> list[float]:
        """Logs of the sums over all segmentations of each prefix, in language k: for words whose sums are too small for numbers."""
        table, longest, piece = self.table, self.longest, self.piece
        sums = [0.0]
        for end in range(1, len(word) + 1):
            terms = []
            for start in range(end - longest if end > longest else 0, end):
                p = table.get(word[start:end]) if start < end - 1 else piece(word[start:end])
                if p is not None and p[k] > 0:
                    terms.append(sums[start] + math.log(p[k]))
            sums.append(log_sum(terms))
        return sums

    def log_likelihoods(self, words: list[str]) -> list[list[float]]:
        """The log of the sum over all segmentations, word by word; sorted words share the sums of their common beginning.

        A word that cannot be made of pieces has -inf.
        """
        table, longest, piece = self.table, self.longest, self.piece
        languages = range(len(self.zero))
        made, before = [], ""
        found_at: list[list] = []
        sums: list[list[float]] = [[1.0] for _ in languages]
        for word in words:
            n, same = len(word), 0
            while same < n and before[same : same + 1] == word[same]:
                same += 1
            del found_at[same:]
            for end in range(same + 1, n + 1):
                found = []
                for start in range(end - longest if end > longest else 0, end - 1):
                    p = table.get(word[start:end])
                    if p is not None:
                        found.append((start, p))
                found.append((end - 1, piece(word[end - 1])))
                found_at.append(found)
            row = []
            for k in languages:
                own = sums[k]
                del own[same + 1 :]
                for found in found_at[len(own) - 1 :]:
                    total = 0.0
                    for start, p in found:
                        total += own[start] * p[k]
                    own.append(total)
                    if total < LEAST_SUM:
                        break
                if own[-1] >= LEAST_SUM:
                    row.append(math.log(own[-1]))
                else:
                    own.pop()  # a longer word must not go on from it
                    row.append(self.logs(word, k)[-1])
            made.append(row)
            before = word
        return made

    def expected(self, word: str) -> dict[str, float]:
        """Expected number of each piece in a word (first language of the table only)."""
        table, longest, piece, n = self.table, self.longest, self.piece, len(word)
        sums = self.logs(word, 0)
        back = [-math.inf] * n + [0.0]
        counts: dict[str, float] = {}
        if sums[n] == -math.inf:
            return counts
        for start in range(n - 1, -1, -1):
            terms = []
            for end in range(start + 1, min(n, start + longest) + 1):
                p = table.get(word[start:end]) if end > start + 1 else piece(word[start:end])
                if p is not None and p[0] > 0 and back[end] > -math.inf:
                    terms.append(math.log(p[0]) + back[end])
                    share = math.exp(sums[start] + terms[-1] - sums[n])
                    if share > 0:
                        text = word[start:end]
                        for name in [text] if text in table else [f"<0x{b:02X}>" for b in text.encode()]:
                            counts[name] = counts.get(name, 0.0) + share
            back[start] = log_sum(terms)
        return counts


# Sums from here on are exact as numbers, whatever their terms; smaller ones are worked out in logarithms.
LEAST_SUM = 1e-250


def log_sum(logs: list[float]) -> float:
    """The log of a sum of numbers given by their logs."""
    top = max(logs, default=-math.inf)
    return top if top == -math.inf else top + math.log(sum(math.exp(x - top) for x in logs))


def words_of(text: str | None) -> list[str]:
    return LETTERS.findall((text or "").lower())


def training_words(docs: DataFrame, training_docs: int) -> DataFrame:
    """lang, word, n of a bounded sample of the texts that may be learned from."""
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"))
    usable = rows.where("lang is not null and text is not null").where(crc_of_id() % 3 != 1)
    sizes = usable.groupBy("lang").count()
    share = F.least(F.lit(1.0), F.lit(training_docs) / F.col("count"))
    drawn = usable.join(F.broadcast(sizes), "lang").where(F.pmod(F.xxhash64("doc_id", "text"), F.lit(1_000_000)) < share * 1_000_000)
    words = drawn.select("lang", F.explode(F.regexp_extract_all(F.lower("text"), F.lit(r"(\p{L}+)"), 1)).alias("word"))
    return words.groupBy("lang", "word").agg(F.count(F.lit(1)).alias("n"))


def fit(docs: DataFrame, vocabulary: str = VOCABULARY, training_docs: int = TRAINING_DOCS, rounds: int = ROUNDS) -> tuple[list[str], dict]:
    """Languages and, for each piece, its probability in each of them."""
    path = public_tokenizers.path(vocabulary)
    words = checkpointed(training_words(docs, training_docs))
    names = sorted(letter_pieces(path))
    table: dict[str, tuple[float, ...]] = {p: (1.0 / len(names),) for p in names}
    languages = [r.lang for r in words.select("lang").distinct().orderBy("lang").collect()]
    if not languages:
        return [], {}
    place = {p: i for i, p in enumerate(names)}
    for _ in range(rounds):
        known = words.sparkSession.sparkContext.broadcast(table)
        first = len(next(iter(table.values()))) == 1

        def begin(known=known, first=first):
            tables = known.value
            own = {lang: Pieces(tables if first else {p: (v[i],) for p, v in tables.items()}, 1) for i, lang in enumerate(languages)}

            def step(langs, texts, numbers):
                counts: dict[tuple[str, str], float] = {}
                for lang, word, n in zip(langs.to_pylist(), texts.to_pylist(), numbers.to_pylist(), strict=True):
                    for piece, share in own[lang].expected(START + word).items():
                        counts[lang, piece] = counts.get((lang, piece), 0.0) + share * n
                return [k[0] for k in counts], [k[1] for k in counts], list(counts.values())

            return step

        partial = map_parts(words, begin, "lang string, piece string, n double")
        # as decimals, so that the sum does not depend on the order of the tasks
        summed = partial.groupBy("lang", "piece").agg(F.sum(F.col("n").cast("decimal(28,6)")).cast("double").alias("n"))
        counts = np.full((len(names), len(languages)), SMOOTHING)
        for row in summed.collect():  # at most one row per language and piece of the vocabulary
            counts[place[row.piece], languages.index(row.lang)] += row.n
        chances = counts / counts.sum(axis=0)
        table = {p: tuple(map(float, chances[i])) for i, p in enumerate(names)}
    often = counts.max(axis=1) >= LEAST_EXPECTED
    return languages, {p: v for p, v in table.items() if often[place[p]] or len(p) == 1 or p.startswith("<0x")}


def language_scores(rows: DataFrame, languages: list[str], table: dict, passed: StructType) -> DataFrame:
    """Rows (doc_id, text, one more column) to that column, lang_pred and score; ``passed`` is the schema of the column."""
    known = rows.sparkSession.sparkContext.broadcast(table)

    def begin():
        model = Pieces(known.value, len(languages)) if languages else None
        place: dict[str, int] = {}
        sums_of = np.zeros((1024, max(1, len(languages))))

        def step(_ids, texts, more):
            nonlocal sums_of
            split = [words_of(t) for t in texts.to_pylist()]
            flat = [w for words in split for w in words]
            if model is None or not flat:
                return more, [UNKNOWN] * len(split), [0.0] * len(split)
            missing = sorted(set(flat) - place.keys())
            if len(place) + len(missing) > WORDS_KEPT:
                place.clear()
                missing = sorted(set(flat))
            if len(place) + len(missing) > len(sums_of):
                sums_of = np.concatenate([sums_of, np.zeros((len(place) + len(missing), len(languages)))])
            if missing:
                sums_of[len(place) : len(place) + len(missing)] = model.log_likelihoods([START + w for w in missing])
                place.update(zip(missing, range(len(place), len(place) + len(missing)), strict=True))
            sizes = np.array([len(words) for words in split])
            at = np.fromiter(map(place.__getitem__, flat), dtype=np.int64, count=len(flat))
            sums = np.zeros((len(split), len(languages)))
            full = np.flatnonzero(sizes)
            sums[full] = np.add.reduceat(sums_of[at], np.cumsum(sizes)[full] - sizes[full], axis=0)
            best = sums.argmax(axis=1)
            top = sums.max(axis=1, keepdims=True)
            # a text that no language can spell says nothing about its language
            score = 1 / np.exp(np.where(np.isinf(top), 0.0, sums - top)).sum(axis=1)
            score[sizes == 0] = 0
            return more, [languages[b] if n else UNKNOWN for b, n in zip(best, sizes, strict=True)], score

        return step

    return map_parts(rows, begin, StructType(passed.fields).add("lang_pred", "string").add("score", "double"), part_bytes=PART_BYTES)


def identify(docs: DataFrame, training_docs: int = TRAINING_DOCS) -> DataFrame:
    """doc_id, held_out, lang_pred, score."""
    languages, table = fit(docs, training_docs=training_docs)
    rows = documents(docs).select("doc_id", "text", F.col("doc_id").alias("id"))
    scored = language_scores(rows, languages, table, rows.select("id").schema).withColumnRenamed("id", "doc_id")
    return scored.select("doc_id", (crc_of_id() % 3 == 1).alias("held_out"), "lang_pred", "score")


def in_known_language(docs: DataFrame, least_score: float = 0.5, training_docs: int = TRAINING_DOCS) -> DataFrame:
    """The rows of ``docs`` whose text has a language that could be learned, by a posterior of ``least_score`` at least."""
    rows, passed = with_rows(docs)
    scored = language_scores(rows, *fit(docs, training_docs=training_docs), passed)
    return scored.where((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= least_score)).select("row.*")
