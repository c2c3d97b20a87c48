"""Operator 9: secrets in texts; values in a credential context are weighed by the guesses they would take.

Three fixed patterns give the base spans. Beyond them, every value that stands in a credential context (after a
credential word and a sign of assignment, in an authorisation header, in a link before the host) is cut into the
pieces that make it cheapest to guess: words of a public vocabulary by rank, dates, repeats, keyboard walks and
brute force. A value whose cheapest segmentation still takes ``10 ** least_cost`` guesses is a span of kind ``guess``.

The pieces: words have at most ``LONGEST_WORD`` letters, the unit of a repeat at most ``LONGEST_UNIT`` characters; a walk of more than 12 keys
begins where it can begin first, and the turns of its first 12 keys count. What is longer is made of several pieces.

Null text counts as empty and has no spans. Very long values are weighed whole. Offsets are code points, end exclusive. Repeated rows give repeated results.
"""

from __future__ import annotations

import json
import math
import re
from functools import lru_cache

import public_tokenizers
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from millrace.llm.texts import documents, map_parts, with_rows

# The base patterns, in the order in which kinds are listed.
ASSIGN = (
    r"([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])"
    r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]{32,}"  # as whole runs of 32 and more: shorter runs are dropped

ASSIGN_RE, ACCESS_RE, HEX_RE = re.compile(ASSIGN), re.compile(ACCESS), re.compile(HEX)

CONTEXT_RE = re.compile(
    r"""(?:pass(?:word|wd|phrase|code)?|pwd|secret|token|credentials?|api[ _-]?key|(?:access|private)[ _-]?key)"""
    r"""["']?[ \t]*+[:=][ \t]*+(?:"([^"\r\n]{8,}+)"|'([^'\r\n]{8,}+)'|([^\s"'<>|,;]{8,}+))""",
    re.IGNORECASE,
)
BEARER_RE = re.compile(r"authorization[ \t]*+:[ \t]*+(?:bearer|basic|token)[ \t]++([A-Za-z0-9+/_.=~-]{8,})", re.IGNORECASE)
LINK_RE = re.compile(r"://[^\s:/@]*+:([^\s/@]{8,}+)@")
CUES = ("pass", "pwd", "secret", "token", "credential", "api", "key", "authorization", "://")

KINDS = ("assign", "access", "hex", "guess")
LEAST_COST = 9.0
DICTIONARY = "word_bpe_49k.json"

ROWS = ("`1234567890-=", "qwertyuiop[]", "asdfghjkl;'", "zxcvbnm,./")
SEQUENCES = ("abcdefghijklmnopqrstuvwxyz", "0123456789")
DATE_RE = re.compile(
    r"(?:(?:19|20)\d\d([-/._]?)(?:0?[1-9]|1[0-2])\1(?:[12]\d|3[01]|0?[1-9])|(?:[12]\d|3[01]|0?[1-9])([-/._]?)(?:0?[1-9]|1[0-2])\2(?:19|20)\d\d|(?:19|20)\d\d)"
)
PIECE = math.log10(2)  # for each further piece: its place and kind are to be guessed too
LONGEST_WORD, LONGEST_UNIT, LONGEST_DATE = 24, 8, 10


@lru_cache(maxsize=1)
def word_ranks(path: str) -> dict[str, int]:
    """Whole words of a vocabulary with their rank; ids follow frequency."""
    with open(path, encoding="utf-8") as file:
        vocabulary = json.load(file)["model"]["vocab"]
    words = sorted((i, t[:-4]) for t, i in vocabulary.items() if t.endswith("</w>") and len(t) > 6 and t[:-4].isascii() and t[:-4].isalpha())
    return {word: rank for rank, (_, word) in enumerate(words, 1)}


@lru_cache(maxsize=1)
def neighbours() -> frozenset[str]:
    """Pairs of keys that lie side by side, on a keyboard or in a sequence, either way."""
    pairs = set()
    for line in (*ROWS, *SEQUENCES):
        pairs.update(a + b for a, b in zip(line, line[1:], strict=False))
    for upper, lower in zip(ROWS, ROWS[1:], strict=False):
        pairs.update(a + b for i, b in enumerate(lower) for a in upper[i + (upper is ROWS[0]) : i + 2 + (upper is ROWS[0])])
    return frozenset(pairs | {p[::-1] for p in pairs})


def brute_force(c: str) -> float:
    return math.log10(10 if c.isdigit() else 26 if c.isalpha() and c.isascii() else 33 if c.isascii() else 1000)


def guess_pieces(value: str, ranks: dict[str, int]) -> tuple[float, list[tuple[str, int, int]]]:
    """Least cost (log10 of guesses) of a value, and its pieces (kind, start, end).

    best[i] is the least cost of the first i characters; each piece that ends at i is tried. Brute force goes on from
    character to character, so a long span of it is one piece.
    """
    n, low, beside = len(value), value.lower(), neighbours()
    best = [0.0] + [math.inf] * n
    back: list[tuple[str, int]] = [("", 0)] * (n + 1)
    dates = {}
    for i in range(n):
        found = DATE_RE.match(value, i, min(n, i + LONGEST_DATE))
        if found:
            dates[i] = (found.end(), math.log10(150 if found.end() - i == 4 else 150 * 365) + (found.end() - i > 8) * math.log10(4))
    walk = 0  # start of the walk that ends here
    # for each unit: start of the stretch with this period, and for each remainder the starts that may give the least cost
    period = [0] * (LONGEST_UNIT + 1)
    starts: list[list[list[int]]] = [[[] for _ in range(unit)] for unit in range(LONGEST_UNIT + 1)]

    def offer(kind: str, start: int, end: int, cost: float) -> None:
        joined = kind == "brute" and start and back[start][0] == "brute"
        total = best[start] + cost + (PIECE if start and not joined else 0)
        if total < best[end]:
            best[end] = total
            back[end] = (kind, back[start][1] if joined else start)

    for end in range(1, n + 1):
        offer("brute", end - 1, end, brute_force(value[end - 1]))
        for start in range(max(0, end - LONGEST_WORD), end - 1):
            rank = ranks.get(low[start:end])
            if rank is not None:
                piece = value[start:end]
                capitals = sum(c.isupper() for c in piece)
                usual = capitals in (0, len(piece)) or piece[0].isupper() and capitals == 1
                offer("word", start, end, math.log10(rank + 1) + (0 if not capitals else math.log10(2) if usual else math.log10(math.comb(len(piece), capitals) * 2)))
        if end > 1 and low[end - 2 : end] not in beside:
            walk = end - 1
        if end - walk >= 3:
            for start in range(walk, end - 2):
                turns = sum(ord(low[k]) - ord(low[k - 1]) != ord(low[k - 1]) - ord(low[k - 2]) for k in range(start + 2, min(end, start + 12)))
                offer("walk", start, end, math.log10(47 * (end - start)) + turns * math.log10(4) / 2)
                if end - start > 12:
                    break
        for unit in range(1, min(LONGEST_UNIT, end - 1) + 1):
            if low[end - 1] != low[end - 1 - unit]:
                period[unit] = end - unit
                starts[unit] = [[] for _ in range(unit)]
                continue
            start = end - max(2, -(-3 // unit)) * unit
            if start < period[unit]:
                continue
            least, kept = math.inf, []
            for s in (*starts[unit][end % unit], start):
                # an earlier start that costs no more now never will: its times grow by the smaller share
                total = best[s] + (PIECE if s else 0) + math.log10((end - s) // unit)
                if total < least:
                    least = total
                    kept.append(s)
            starts[unit][end % unit] = kept
            offer("repeat", kept[-1], end, sum(brute_force(c) for c in low[end - unit : end]) + math.log10((end - kept[-1]) // unit))
        if end < n + 1 and (end - 1) in dates:
            stop, cost = dates[end - 1]
            offer("date", end - 1, stop, cost)
    pieces, end = [], n
    while end:
        kind, start = back[end]
        pieces.append((kind, start, end))
        end = start
    return best[n], pieces[::-1]


def base_spans(text: str, low: str) -> list[tuple[int, int, str]]:
    """(start, kind number, end) of the three fixed patterns."""
    spans = []
    if any(cue in low for cue in ("passw", "secret", "token", "api")):
        spans += [(m.start(), 0, m.end()) for m in ASSIGN_RE.finditer(text) if m.end(2) - m.start(2) >= 8]
    if "AKIA" in text:
        spans += [(m.start(), 1, m.end()) for m in ACCESS_RE.finditer(text) if m.end() - m.start() >= 16]
    spans += [(m.start(), 2, m.end()) for m in HEX_RE.finditer(text)]
    return spans


def context_values(text: str, low: str) -> list[tuple[int, int]]:
    """Spans of values in a credential context."""
    if not any(cue in low for cue in CUES):
        return []
    found = set()
    for m in CONTEXT_RE.finditer(text):
        group = m.lastindex
        found.add((m.start(group), m.end(group)))
    if "authorization" in low:
        found.update((m.start(1), m.end(1)) for m in BEARER_RE.finditer(text))
    if "://" in low:
        found.update((m.start(1), m.end(1)) for m in LINK_RE.finditer(text))
    return sorted(found)


def find_spans(text: str, ranks: dict[str, int], least_cost: float) -> list[tuple[int, int, int, float | None]]:
    """(start, kind number, end, cost) of all spans, by start and then kind."""
    low = text.lower()
    spans = [(start, kind, end, None) for start, kind, end in base_spans(text, low)]
    for start, end in context_values(text, low):
        cost, _ = guess_pieces(text[start:end], ranks)
        if cost >= least_cost:
            spans.append((start, 3, end, cost))
    return sorted(spans, key=lambda s: s[:3])


def secret_spans(docs: DataFrame, dictionary: str = DICTIONARY, least_cost: float = LEAST_COST) -> DataFrame:
    """doc_id, text and ``found``: kind, start, end and, for guessed values, cost of every span."""
    path = public_tokenizers.path(dictionary)

    def start():
        ranks = word_ranks(path)

        def step(ids, texts):
            found = [find_spans(t or "", ranks, least_cost) for t in texts.to_pylist()]
            return ids, texts, [[dict(kind=KINDS[k], start=a, end=b, cost=c) for a, k, b, c in spans] for spans in found]

        return step

    schema = "doc_id bigint, text string, found array<struct<kind: string, start: bigint, end: bigint, cost: double>>"
    return map_parts(documents(docs), start, schema)


def joined(spans: Column) -> Column:
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))))


def secret_report(docs: DataFrame) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans."""
    found = secret_spans(docs)
    count = lambda kind: F.size(F.filter("found", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")
    base = F.filter("found", lambda s: s["kind"] != "guess")
    return found.select(
        "doc_id", count("assign"), count("access"), count("hex"), F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("found")).alias("spans")
    )


def redact(text: str, spans: list[tuple[int, int]], mark: str = "[secret]") -> str:
    """The text with each merged span replaced by ``mark``."""
    made, place = [], 0
    for start, end in sorted(spans):
        if end <= place:
            continue
        if start >= place:
            made += [text[place:start], mark]
        place = max(place, end)
    return "".join(made) + text[place:]


def redacted(docs: DataFrame, dictionary: str = DICTIONARY, least_cost: float = LEAST_COST) -> DataFrame:
    """All rows of ``docs``, every secret in ``text`` replaced by a mark and ``n_chars`` (if there is one) set to the new length."""
    rows, passed = with_rows(docs)
    path = public_tokenizers.path(dictionary)

    def start():
        ranks = word_ranks(path)

        def step(_ids, texts, more):
            made = [None if t is None else redact(t, [(a, b) for a, _, b, _ in find_spans(t, ranks, least_cost)]) for t in texts.to_pylist()]
            return more, made

        return step

    cleaned = map_parts(rows, start, StructType(passed.fields).add("clean", "string")).select("row.*", "clean")
    found = {"text": F.col("clean")}
    if "n_chars" in docs.columns:
        found["n_chars"] = F.length("clean").cast(docs.schema["n_chars"].dataType)
    return cleaned.withColumns(found).select(*docs.columns)
