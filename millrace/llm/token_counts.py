"""Operator 1: exact token counts at every prefix of a text, by dynamic programming.

For byte-pair encoding the encoding of a prefix is the encoding of a shorter prefix and one more token:
the only token that ends there and stays next to its predecessor when the two are encoded together. So
one pass over a pretoken gives the count at each of its prefixes, and joining the pretokens gives it for the
text. The counts are kept as one signed byte per byte of text (the change from prefix to prefix), from
which truncation and budget questions are answered without encoding anything again.

Null text counts as empty: no bytes, no tokens. A repeated row gives a repeated result; a null id stays null.
"""

from __future__ import annotations

import json

import numpy as np
import public_tokenizers
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from millrace.llm.texts import Cache, documents, map_parts

TOKENIZER = "byte_bpe_50k.json"
PRETOKEN = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
# Stretches whose counts do not depend on what stands around them: pretokens, but a run of white space
# together with the word after it, for a prefix that ends in the run takes the run as one pretoken.
UNIT = regex.compile(r" ?\p{L}+|\s\s+\S*|'s|'t|'re|'ve|'m|'ll|'d| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s")
# White space as the tokenizer has it, which leaves U+001C to U+001F out.
LEADING = regex.compile(r"\s*")
WHOLE_UNIT = regex.compile(r"\s*\S+|\s+")
# Below this character both libraries know the same letters and numbers.
PAIRS_KEPT = 500_000
SETTLED = "\u0500"
UNSETTLED = regex.compile("[\u0500-\U0010ffff]")
ODD = regex.compile(r"\s\s|'re|'ve|'ll|[^\x00-\u04FF]")


def byte_of_letter() -> dict[str, int]:
    """The letters that byte-level vocabularies write for bytes: printable ones stand for themselves."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    other = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(other)}


def as_steps(counts: list[int]) -> tuple[bytes, int]:
    return bytes([(b - a) & 255 for a, b in zip([0, *counts], counts, strict=False)]), counts[-1]


class PrefixCounts:
    """Token counts of all prefixes under one byte-level BPE vocabulary."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            stored = json.load(file)
        letters = byte_of_letter()
        to_bytes = lambda s: bytes(letters[c] for c in s)
        self.special = [x["content"] for x in stored["added_tokens"]]
        self.vocabulary = {to_bytes(t) for t in stored["model"]["vocab"] if t not in self.special}
        merges = [m if isinstance(m, list) else m.split(" ") for m in stored["model"]["merges"]]
        self.rank = {(to_bytes(a), to_bytes(b)): i for i, (a, b) in enumerate(merges)}
        self.halves: dict[bytes, tuple[int, bytes, bytes]] = {}
        for (a, b), i in self.rank.items():
            self.halves.setdefault(a + b, (i, a, b))
        # longest token by its last four bytes; where they end none, a token has at most three bytes
        self.reach: dict[bytes, int] = {}
        for token in self.vocabulary:
            if len(token) > 3:
                self.reach[token[-4:]] = max(len(token), self.reach.get(token[-4:], 0))
        self.known: dict[tuple[bytes, bytes], bool] = {}
        self.pre_tokenizer = Tokenizer.from_file(path).pre_tokenizer
        self.units, self.whole_units = Cache(self.unit, 500_000), Cache(self.whole, 50_000)
        self.split = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")") if self.special else None

    def stays(self, left: bytes, right: bytes) -> bool:
        """Whether token ``right`` after ``left`` (nothing: b"") is left as it is by the encoding.

        Undo the merges of both tokens, latest first, and look for an earlier merge across their border.

        ``bound`` is the rank of the merge undone last: a merge across the border of a lower rank would have
        come before it. Of equal ranks the one further left comes first.
        """
        merge, parts, bound = self.rank, self.halves, len(self.rank)
        while True:
            across = merge.get((left, right))
            if across is not None and across < bound:
                return False
            at_left, at_right = parts.get(left), parts.get(right)
            if at_left is None and at_right is None:
                return True
            if at_right is None or (at_left is not None and at_left[0] > at_right[0]):
                bound, left = at_left[0], at_left[2]
            else:
                bound, right = at_right[0] + 1, at_right[1]

    def pretoken(self, text: bytes) -> list[int]:
        """Token count of each prefix of one pretoken, from the prefix of one byte on."""
        last, counts = [b""], [0]
        self.extend(text, last, counts)
        return counts[1:]

    def extend(self, text: bytes, last: list[bytes], counts: list[int]) -> None:
        """Last token and count of the prefixes that are not there yet."""
        vocabulary, known, reach = self.vocabulary, self.known, self.reach.get
        for end in range(len(counts), len(text) + 1):
            longest = reach(text[end - 4 : end], 3) if end > 3 else end
            for start in range(end - longest if end > longest else 0, end):
                token = text[start:end]
                if token in vocabulary:
                    if start:
                        pair = (last[start], token)
                        good = known.get(pair)
                        if good is None:
                            if len(known) > PAIRS_KEPT:
                                known.clear()
                            good = known[pair] = self.stays(*pair)
                        if not good:
                            continue
                    last.append(token)
                    counts.append(counts[start] + 1)
                    break

    def learn(self, units: set[str]) -> None:
        """Counts of units not met before; in order, so that each goes on from what it shares with the one before."""
        kept = self.units
        missing = sorted(u for u in units - kept.young.keys() if u not in kept.old and not ODD.search(u))
        if len(kept.young) + len(missing) > kept.most:
            kept.old, kept.young = kept.young, {}
        before, last, counts = b"", [b""], [0]
        for unit in missing:
            raw, same = unit.encode(), 0
            while raw[same : same + 1] == before[same : same + 1] and same < len(raw):
                same += 1
            del last[same + 1 :], counts[same + 1 :]
            self.extend(raw, last, counts)
            kept.young[unit] = as_steps(counts[1:])
            before = raw

    def texts(self, texts: list[str]) -> list[tuple[bytes, int]]:
        """``text`` for several texts at once."""
        plain = [not UNSETTLED.search(t) and not any(s in t for s in self.special) for t in texts]
        cut = [UNIT.findall(t) if p else [] for t, p in zip(texts, plain, strict=True)]
        self.learn(set().union(*cut))
        young, slow = self.units.young.get, self.units.get
        made = []
        for text, units, p in zip(texts, cut, plain, strict=True):
            if p:
                found = [young(u) or slow(u) for u in units]
                made.append((b"".join([f[0] for f in found]), sum([f[1] for f in found])))
            else:
                made.append(self.text(text))
        return made

    def unit(self, unit: str) -> tuple[bytes, int]:
        """Changes of the count along a unit, and its total."""
        return self.whole(unit) if ODD.search(unit) else as_steps(self.pretoken(unit.encode()))

    def whole(self, unit: str) -> tuple[bytes, int]:
        """The same for a stretch of several pretokens."""
        return as_steps(self._counts(unit))

    def _counts(self, unit: str) -> list[int]:
        counts: list[int] = []
        spaces = LEADING.match(unit).end()
        # a prefix that ends in the leading white space is one run of white space
        leading = self.pretoken(unit[:spaces].encode())
        total = 0
        # letter classes of later Unicode versions differ between the libraries: there the tokenizer's own count
        words = PRETOKEN.findall(unit) if max(unit) < SETTLED else self.own_words(unit)
        for word in words:
            own = self.pretoken(word.encode())
            if word in ("'re", "'ve", "'ll"):
                own[1] = 2  # a contraction cut short is an apostrophe and a letter
            counts += [total + n for n in own]
            total += own[-1]
        counts[: len(leading)] = leading
        return counts

    def own_words(self, unit: str) -> list[str]:
        return [unit[a:b] for _, (a, b) in self.pre_tokenizer.pre_tokenize_str(unit)]

    def found(self, text: str) -> list[tuple[bytes, int]]:
        """Steps and totals along a text without special strings."""
        if not UNSETTLED.search(text):
            young, slow = self.units.young.get, self.units.get
            return [young(u) or slow(u) for u in UNIT.findall(text)]
        # letters that the libraries class differently must not be cut by our own pattern
        return [self.whole_units.get(u) for u in WHOLE_UNIT.findall(text)]

    def text(self, text: str) -> tuple[bytes, int]:
        """Changes of the count along a whole text, and its total."""
        if self.split is None or not any(s in text for s in self.special):
            made = self.found(text)
            return b"".join([m[0] for m in made]), sum([m[1] for m in made])
        made, total, before = [], 0, ""
        for piece in self.split.split(text):
            if piece not in self.special:
                found = self.found(piece)
                made += [steps for steps, _ in found]
                total += sum(n for _, n in found)
                before = (WHOLE_UNIT.findall(piece) or [""])[-1]
                continue
            # inside the special string a prefix is plain text that goes on from the text before
            inside = np.frombuffer(self.whole(before + piece[:-1])[0], dtype=np.int8)[len(before.encode()) :]
            made.append(inside.tobytes() + np.int8(1 - int(inside.sum(dtype=np.int64))).tobytes())
            total, before = total + 1, ""
        return b"".join(made), total


def prefix_counts(docs: DataFrame, tokenizer: str = TOKENIZER, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_tokens and ``steps``: one signed byte per byte of text, the change of the token count.

    The count of a prefix that ends after byte i is the sum of the first i steps; it is exact at the end of each
    character. See ``count_at`` and ``bytes_within``.
    """
    path = public_tokenizers.path(tokenizer)

    def start():
        counter = PrefixCounts(path)

        def step(ids, texts):
            made = counter.texts([t or "" for t in texts.to_pylist()])
            return ids, [len(s) for s, _ in made], [n for _, n in made], [s for s, _ in made]

        return step

    return map_parts(documents(docs, id_col, text_col), start, "doc_id bigint, n_bytes bigint, n_tokens bigint, steps binary")


def count_at(steps: bytes, n_bytes: int) -> int:
    """Tokens of the first ``n_bytes`` bytes of the text."""
    return int(np.frombuffer(steps, dtype=np.int8)[:n_bytes].sum(dtype=np.int64))


def bytes_within(steps: bytes, budget: int) -> int:
    """Length in bytes of the longest prefix of at most ``budget`` tokens (it may end inside a character)."""
    fits = np.flatnonzero(np.cumsum(np.frombuffer(steps, dtype=np.int8), dtype=np.int64) <= budget)
    return int(fits[-1]) + 1 if len(fits) else 0


def token_counts(docs: DataFrame, limit: int = 1024) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit, and the bytes that fit the limit."""
    counted = prefix_counts(docs)
    return counted.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
