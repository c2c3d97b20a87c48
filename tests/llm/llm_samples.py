"""Rows that every document operator has to take, and plain Python forms of what they should return."""

from __future__ import annotations

import random
import re
import zlib

WORD = re.compile("[^\x20\x09-\x0d]+")
ASCII_LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})

# doc_id, text, and columns whose names the operators use themselves
ODD = [
    (1, None, "en", "a", 0, 0.5, "x"),
    (2, "", "en", "a", 0, 0.5, "x"),
    (3, "   \n\t ", None, "a", 6, None, None),
    (4, "one", "en", None, 3, 0.5, "x"),
    (None, "a row without an id, but with some words in it", "en", "a", 45, 0.5, "x"),
    (5, "the same row twice over, word for word", "en", "a", 38, 0.5, "x"),
    (5, "the same row twice over, word for word", "en", "a", 38, 0.5, "x"),
    (6, "the same id with one text", "en", "a", 25, 0.5, "x"),
    (6, "and the same id with quite another text in it", "en", "a", 45, 0.5, "x"),
    (7, "12345 67890 !!! ???", "de", "a", 19, 0.5, "x"),
    (8, "w" * 20_000, "de", "a", 20_000, 0.5, "x"),
    (9, "lang word " * 4_000, "de", "a", 40_000, 0.5, "x"),
    (10, "Äpfel und Öl, naïve cœur 日本語 текст \x1c odd \U0001f600 signs", "fr", "a", 50, 0.5, "x"),
]
ODD_SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, score double, row string"


def words(text: str | None) -> list[str]:
    return WORD.findall(text or "")


def some_texts(seed: int, n: int, letters: str = "abcd", longest: int = 60) -> list[str]:
    """Texts of few words, so that much repeats; some are copies or cut out of others."""
    draw = random.Random(seed)
    made: list[str] = []
    for _ in range(n):
        if made and draw.random() < 0.5:
            old = draw.choice(made).split(" ")
            a = draw.randrange(len(old) + 1)
            piece = old[a : a + draw.randrange(longest)]
            rest = [draw.choice(letters) for _ in range(draw.randrange(8))]
            made.append(" ".join(rest[:3] + piece + rest[3:]))
        else:
            made.append(" ".join(draw.choice(letters) for _ in range(draw.randrange(longest))))
    return made


def remainder(doc_id: int | None, by: int) -> int:
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % by


def later_words_removed(docs: list[tuple[int, str | None]], window: int) -> dict[int, tuple[int, int, str]]:
    """Words, words removed and the rest of each document; ids have to be unique."""
    seen, made = set(), {}
    for doc_id, text in sorted(docs):
        own = words(text)
        gone = [False] * len(own)
        for k in range(len(own) - window + 1):
            phrase = tuple(own[k : k + window])
            if phrase in seen:
                gone[k : k + window] = [True] * window
            seen.add(phrase)
        kept = " ".join(w for w, g in zip(own, gone, strict=True) if not g)
        made[doc_id] = (len(own), sum(gone), kept)
    return made


def repeated_bytes_removed(docs: list[tuple[int, str | None]], window: int) -> dict[int, tuple[int, int, bytes]]:
    """Bytes removed, spans and the rest of each document."""
    counts: dict[bytes, int] = {}
    raws = {doc_id: (text or "").encode() for doc_id, text in docs}
    for raw in raws.values():
        for k in range(len(raw) - window + 1):
            counts[raw[k : k + window]] = counts.get(raw[k : k + window], 0) + 1
    made = {}
    for doc_id, raw in raws.items():
        gone = bytearray(len(raw))
        for k in range(len(raw) - window + 1):
            if counts[raw[k : k + window]] > 1:
                gone[k : k + window] = b"\x01" * window
        spans = len(re.findall(b"\x01+", bytes(gone)))
        made[doc_id] = (sum(gone), spans, bytes(b for b, g in zip(raw, gone, strict=True) if not g))
    return made


def shingles(text: str | None, size: int = 3) -> frozenset:
    own = words((text or "").translate(ASCII_LOWER))
    if len(own) < size:
        return frozenset([tuple(own)] if own else [])
    return frozenset(tuple(own[k : k + size]) for k in range(len(own) - size + 1))


def classes(docs: list[tuple[int, str | None]], percent: int = 85, size: int = 3) -> dict[int, int]:
    """Least id of each document's class of linked documents, all pairs compared."""
    sets = {doc_id: shingles(text, size) for doc_id, text in docs}
    parent = {doc_id: doc_id for doc_id in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {doc_id: find(doc_id) for doc_id in ids}
