"""Exact token counts at every prefix, by dynamic programming over a BPE vocabulary.

The merges of a text of bytes end in one token; that token and the count at each prefix follow
from shorter prefixes: the last token of ``text[:i]`` is the one token ``t`` that ends there and
that stands beside the last token of ``text[:i - len(t)]`` without being merged with it. One pass
gives the counts of all prefixes, and those of a text are those of its pre-tokens, added up. How
many tokens a text has, where a budget of tokens ends and what a prefix costs are then look-ups.
"""

from __future__ import annotations

import functools
import json

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spendlake.llm import pretokens
from spendlake.llm.batches import short_batches
from spendlake.llm.texthash import pieces

TOKEN_LIMIT = 1024

# Pre-tokens kept with their counts, and pairs of tokens, in each worker: two generations of so many.
CACHE_SIZE = 250_000

COUNTED = T.StructType(
    [
        T.StructField("n_bytes", T.LongType()),
        T.StructField("n_tokens", T.LongType()),
        T.StructField("limit_chars", T.LongType()),
    ]
)


def _byte_letters() -> dict[str, int]:
    """The printable letter that stands for each byte in the vocabulary file, by the public rule."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    moved = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(moved)}


class PrefixCounter:
    def __init__(self, definition: dict):
        """``definition`` is a tokenizer file: a byte-level BPE with the usual pattern and no normaliser."""
        model, letters = definition["model"], _byte_letters()
        as_bytes = {token: bytes(letters[c] for c in token) for token in model["vocab"]}
        self.ids = {as_bytes[token]: number for token, number in model["vocab"].items()}
        self.special = [t["content"] for t in definition["added_tokens"]]
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.ranks = {(as_bytes[a], as_bytes[b]): rank for rank, (a, b) in enumerate(merges)}
        # Every ending of a token, with the token itself where the ending is one.
        self._endings: dict[bytes, bool] = {}
        for token in self.ids:
            for start in range(len(token)):
                self._endings.setdefault(token[start:], token[start:] in self.ids)
        self._beside: dict[tuple[bytes, bytes], bool] = {}
        self._counts: dict[str, int] = {}
        self._older: dict[str, int] = {}

    def merge(self, word: bytes) -> list[bytes]:
        """Tokens of a few bytes by plain merging."""
        parts = [word[i : i + 1] for i in range(len(word))]
        while len(parts) > 1:
            rank, at = min((self.ranks.get(pair, len(self.ranks)), i) for i, pair in enumerate(zip(parts, parts[1:])))
            if rank == len(self.ranks):
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def stand_beside(self, left: bytes, right: bytes) -> bool:
        """Whether two tokens in a row stay what they are."""
        known = self._beside.get((left, right))
        if known is None:
            if len(self._beside) >= CACHE_SIZE:
                self._beside.clear()
            known = self._beside[left, right] = self.merge(left + right) == [left, right]
        return known

    def word_counts(self, word: bytes) -> list[int]:
        """Tokens of every prefix of a pre-token, the empty one first."""
        counts, last = [0], [b""]
        endings, beside = self._endings, self.stand_beside
        for end in range(1, len(word) + 1):
            for start in range(end - 1, -1, -1):
                token = word[start:end]
                known = endings.get(token)
                if known is None:
                    raise ValueError(f"no token ends in {token!r}")
                if known and (not start or beside(last[start], token)):
                    counts.append(counts[start] + 1)
                    last.append(token)
                    break
        return counts

    def _missing(self, words: list[str]) -> None:
        if len(self._counts) > CACHE_SIZE:
            self._counts, self._older = {}, self._counts
        known, older = self._counts, self._older
        for word in set(words).difference(known):
            count = older.get(word)
            if count is None:
                raw = word.encode()
                count = 1 if raw in self.ids and self._whole(raw) else self.word_counts(raw)[-1]
            known[word] = count

    def _whole(self, raw: bytes) -> bool:
        """Whether a pre-token that is in the vocabulary is reached by its merges."""
        return len(raw) == 1 or self.merge(raw) == [raw]

    def count_all(self, texts: list[str], limit: int) -> list[tuple[int, int]]:
        """Per text its tokens, and the code points of its longest run of whole pre-tokens within ``limit`` tokens."""
        split = [self._parts(text) for text in texts]
        first = np.concatenate([[0], np.cumsum([len(parts) for parts in split])]).astype(np.int64).tolist()
        parts = [part for parts in split for part in parts]
        words, bounds = pretokens.split(["" if p in self.special else p for p in parts])
        self._missing(words)
        counts = np.fromiter(map(self._counts.__getitem__, words), np.int64, len(words))
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        found = []
        for number, text in enumerate(texts):
            steps, sizes = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
            for k in range(first[number], first[number + 1]):
                own, special = slice(bounds[k], bounds[k + 1]), parts[k] in self.special
                steps.append(np.ones(1, np.int64) if special else counts[own])
                sizes.append(np.full(1, len(parts[k])) if special else lengths[own])
            upto = np.cumsum(np.concatenate(steps))
            total = int(upto[-1]) if len(upto) else 0
            fits = int(np.searchsorted(upto, limit, side="right"))
            found.append((total, len(text) if total <= limit else int(np.concatenate(sizes)[:fits].sum())))
        return found

    def _parts(self, text: str) -> list[str]:
        """The text cut at the special strings, which stay as parts of their own."""
        parts = [text]
        for special in self.special:
            if special in text:
                parts = [x for part in parts for x in (_cut(part, special) if part not in self.special else [part])]
        return parts

    def prefix_counts(self, text: str) -> np.ndarray:
        """Tokens of ``text[:i]`` for every i from 0 to the length; special strings count once complete.

        A cut inside a pre-token leaves its beginning, which is a pre-token as well but in two cases:
        white space before the cut is one run, and a contraction cut short is an apostrophe and letters.
        Both are counted as the shorter text has them, and so is a special string cut short.
        """
        result, base, context = [0], 0, ""
        for part in self._parts(text):
            if part in self.special:
                inner = self._plain_counts(context + part)[len(context) + 1 :]
                result += [base + n for n in inner[:-1]] + [result[-1] + 1]
                base, context = result[-1], ""
            else:
                result += [base + n for n in self._plain_counts(part)[1:]]
                context = part
        return np.array(result, np.int64)

    def _plain_counts(self, text: str) -> list[int]:
        words, _ = pretokens.split([text])
        result, done, run, run_from = [0], 0, "", 0
        for word in words:
            blank = len(word) - len(word.lstrip())
            for size in range(1, len(word) + 1):
                part = word[:size]
                if size <= blank:
                    run_from = run_from if run else done
                    run += part[-1]
                    result.append(run_from + self.word_counts(run.encode())[-1])
                elif word[0] == "'" and size < len(word) and part[1:].isalpha():
                    result.append(done + 1 + self.word_counts(part[1:].encode())[-1])
                else:
                    result.append(done + self.word_counts(part.encode())[-1])
            done += self.word_counts(word.encode())[-1]
            if blank < len(word):
                run = ""
        return result

    def truncate(self, text: str, budget: int) -> str:
        """The longest prefix of at most ``budget`` tokens."""
        fits = np.flatnonzero(self.prefix_counts(text) <= budget)
        return text[: int(fits[-1])] if len(fits) else ""


def _cut(text: str, special: str) -> list[str]:
    """The text around each occurrence of ``special``, and the occurrences, without empty parts."""
    parts = text.split(special)
    woven = [part for before in parts[:-1] for part in (before, special)] + parts[-1:]
    return [part for part in woven if part]


@functools.cache
def counter(path: str) -> PrefixCounter:
    with open(path, encoding="utf-8") as file:
        return PrefixCounter(json.load(file))


def counts_of(text: Column | str, path: str, limit: int = TOKEN_LIMIT) -> Column:
    """Struct of n_bytes, n_tokens and limit_chars; null text counts as empty."""

    def apply(array: pa.Array) -> pa.Array:
        columns: tuple[list, list, list] = ([], [], [])
        for start, end in pieces(array):
            texts = [t or "" for t in array.slice(start, end - start).to_pylist()]
            for text, (tokens, chars) in zip(texts, counter(path).count_all(texts, limit), strict=True):
                columns[0].append(len(text.encode()))
                columns[1].append(tokens)
                columns[2].append(chars)
        return pa.StructArray.from_arrays([pa.array(c, pa.int64()) for c in columns], COUNTED.fieldNames())

    return F.arrow_udf(apply, returnType=COUNTED)(text)


def token_counts(docs: DataFrame, path: str, limit: int = TOKEN_LIMIT) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): n_bytes, n_tokens, over_limit, limit_chars.

    limit_chars is the number of code points of the whole pre-tokens that fit into ``limit`` tokens. The
    vocabulary's special strings count as one token each. A null or empty text counts 0 throughout.
    Repeated rows and null ids each give a row; other columns are left out. No rows give none.
    """
    made = short_batches(docs).select("doc_id", counts_of("text", path, limit).alias("made"))
    return made.select(
        "doc_id", "made.n_bytes", "made.n_tokens", (F.col("made.n_tokens") > limit).alias("over_limit"), "made.limit_chars"
    )
