"""Secret scans through a trigram inverted index.

Every rule is a regular expression. From its parsed form comes a Boolean query over trigrams
that any text with a match must satisfy. The texts of a task are indexed in segments: the
postings of the trigrams that some rule asks for. The query of a rule is answered by
intersecting and uniting postings, and only its candidates are run through the expression.
A rule without mandatory trigrams scans every text.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable
from dataclasses import dataclass
from functools import cached_property
from re import _constants as sre
from re import _parser as sre_parser

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spendlake.llm.batches import short_batches
from spendlake.llm.texthash import Texts, pieces

# A query is True (every text), a trigram, or ("and" | "or", queries).
Query = bool | bytes | tuple

# So many alternative strings are followed side by side before they are settled as trigrams.
_MAX_STRINGS = 64


@dataclass(frozen=True)
class Rule:
    """A kind of secret. Matches whose ``group`` has fewer than ``least`` characters are dropped."""

    kind: str
    pattern: str
    least: int = 0
    group: int = 0
    ignore_case: bool = False

    @cached_property
    def regex(self) -> re.Pattern:
        return re.compile(self.pattern, re.ASCII | (re.IGNORECASE if self.ignore_case else 0))

    def spans(self, text: str) -> list[tuple[int, int]]:
        """Leftmost matches that do not overlap, without those that are too short."""
        return [m.span() for m in self.regex.finditer(text) if len(m[self.group]) >= self.least]


# The base rules. A run of hex digits is always matched to its end, so asking
# for 16 in the pattern finds the same spans as dropping shorter runs.
BASE_RULES = (
    Rule(
        "assign",
        r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        least=12,
        group=2,
        ignore_case=True,
    ),
    Rule("access", r"AKIA[A-Z0-9]+", least=18),
    Rule("hex", r"[0-9a-f]{16,}"),
)

MORE_RULES = (
    Rule("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("code_host", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("chat", r"xox[baprs]-[A-Za-z0-9-]{10,}"),
    Rule("web_token", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
)

RULES = BASE_RULES + MORE_RULES

FOUND = T.StructType(
    [
        T.StructField("counts", T.ArrayType(T.LongType())),
        T.StructField("base_sha256", T.StringType()),
        T.StructField("spans", T.StringType()),
    ]
)

REDACTED = T.StructType([T.StructField("text", T.StringType()), T.StructField("n_spans", T.LongType())])

MASK = "[SECRET]"


def trigram_query(pattern: str) -> Query:
    """What every match of ``pattern`` contains, in ASCII lower case."""
    strings, query = _follow(sre_parser.parse(pattern))
    return _both(query, _settle(strings))


def _both(left: Query, right: Query) -> Query:
    if left is True or right is True:
        return right if left is True else left
    return ("and", (left, right))


def _any(queries: list[Query]) -> Query:
    return True if not queries or any(q is True for q in queries) else ("or", tuple(queries))


def _settle(strings: set[str]) -> Query:
    """Query for text that holds one of the strings."""
    alternatives: list[Query] = []
    for string in sorted(strings):
        raw = string.lower().encode()
        grams = sorted({raw[i : i + 3] for i in range(len(raw) - 2)})
        alternatives.append(("and", tuple(grams)) if grams else True)
    return _any(alternatives)


def _characters(members) -> set[str] | None:
    """The characters of a small class; None for any other."""
    found: set[str] = set()
    for op, value in members:
        if op is sre.LITERAL:
            found.add(chr(value))
        elif op is sre.RANGE and value[1] - value[0] < 8:
            found |= {chr(c) for c in range(value[0], value[1] + 1)}
        else:
            return None
    return found if len(found) <= 8 else None


def _exact(op, value) -> set[str] | None:
    """All strings that a part can match, where they are few."""
    if op is sre.LITERAL:
        return {chr(value)}
    if op is sre.IN:
        return _characters(value)
    if op is sre.SUBPATTERN:
        return _sequence(value[-1])
    if op is sre.BRANCH:
        parts = [_sequence(branch) for branch in value[1]]
        return None if None in parts else set().union(*parts)
    if op in (sre.MAX_REPEAT, sre.MIN_REPEAT) and value[1] <= 3:
        once = _sequence(value[2])
        if once is None or len(once) > 8:
            return None
        runs = {""}
        found = set(runs) if value[0] == 0 else set()
        for times in range(1, int(value[1]) + 1):
            runs = {a + b for a in runs for b in once}
            if times >= value[0]:
                found |= runs
        return found
    return None


def _sequence(parts) -> set[str] | None:
    strings = {""}
    for op, value in parts:
        found = _exact(op, value)
        if found is None or len(strings) * len(found) > _MAX_STRINGS:
            return None
        strings = {a + b for a in strings for b in found}
    return strings


def _follow(parts) -> tuple[set[str], Query]:
    """Strings that the end of the match may consist of, and the query for all before them."""
    strings, query = {""}, True
    for op, value in parts:
        found = _exact(op, value)
        if found is not None and len(strings) * len(found) <= _MAX_STRINGS:
            strings = {a + b for a in strings for b in found}
            continue
        query, strings = _both(query, _settle(strings)), {""}
        if op is sre.SUBPATTERN or (op in (sre.MAX_REPEAT, sre.MIN_REPEAT) and value[0] > 0):
            ends, inner = _follow(value[-1])
            query = _both(query, _both(inner, _settle(ends)))
        elif op is sre.BRANCH:
            options = [_follow(branch) for branch in value[1]]
            query = _both(query, _any([_both(inner, _settle(ends)) for ends, inner in options]))
    return strings, query


def _grams(query: Query) -> set[bytes]:
    if query is True:
        return set()
    return {query} if isinstance(query, bytes) else set().union(*map(_grams, query[1]))


class Segment:
    """Postings of the asked trigrams over some texts: for each, the texts that hold it, in order."""

    def __init__(self, texts: Texts, asked: list[bytes], numbers: np.ndarray):
        lower = _LOWER[texts.bytes].astype(np.int32)
        codes = (lower[:-2] << 16) | (lower[1:-1] << 8) | lower[2:]
        hits = np.flatnonzero(numbers[codes])
        owner = np.searchsorted(texts.bounds, hits, side="right") - 1
        inside = hits + 3 <= texts.bounds[owner + 1]
        marks = numbers[codes[hits[inside]]].astype(np.int64) - 1
        pairs = np.unique(marks * texts.count + owner[inside])
        cuts = np.searchsorted(pairs, np.arange(len(asked) + 1) * texts.count)
        self.count = texts.count
        self.postings = {gram: pairs[cuts[i] : cuts[i + 1]] - i * texts.count for i, gram in enumerate(asked)}

    def answer(self, query: Query) -> np.ndarray:
        if query is True:
            return np.arange(self.count)
        if isinstance(query, bytes):
            return self.postings[query]
        answers = [self.answer(q) for q in query[1]]
        if query[0] == "and":
            found = min(answers, key=len)
            for other in answers:
                found = np.intersect1d(found, other, assume_unique=True) if len(found) else found
            return found
        return np.unique(np.concatenate(answers))


_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


class Scanner:
    """Finds the spans of a list of rules in Arrow arrays of texts."""

    def __init__(self, rules: Iterable[Rule] = RULES):
        self.rules = list(rules)
        self.queries = [trigram_query(rule.pattern) for rule in self.rules]
        self.asked = sorted(set().union(*map(_grams, self.queries)))

    @cached_property
    def numbers(self) -> np.ndarray:
        """For each trigram its number among the asked ones, from 1; 0 for others."""
        numbers = np.zeros(1 << 24, np.uint8 if len(self.asked) < 256 else np.uint16)
        for i, gram in enumerate(self.asked):
            numbers[int.from_bytes(gram)] = i + 1
        return numbers

    def scan(self, array: pa.Array) -> list[list[tuple[int, int, int]]]:
        """Per text its spans as (start, number of the rule, end), in order; null text has none."""
        found: list[list[tuple[int, int, int]]] = [[] for _ in range(len(array))]
        for start, end in pieces(array):
            part = array.slice(start, end - start)
            texts = part.to_pylist()
            segment = Segment(Texts(part), self.asked, self.numbers)
            for number, (rule, query) in enumerate(zip(self.rules, self.queries, strict=True)):
                for row in segment.answer(query):
                    if texts[row]:
                        found[start + row] += [(a, number, b) for a, b in rule.spans(texts[row])]
        for spans in found:
            spans.sort()
        return found


def _listed(spans: list[tuple[int, int, int]], rules: list[Rule]) -> str:
    return ",".join(f"{rules[n].kind}:{a}:{b}" for a, n, b in spans)


def find_secrets(text: Column | str, rules: Iterable[Rule] = RULES) -> Column:
    """Struct of counts (per rule), base_sha256 (of the base rules' spans) and spans (all, as kind:start:end)."""
    rules = list(rules)
    kept: list[Scanner] = []

    def apply(array: pa.Array) -> pa.Array:
        if not kept:
            kept.append(Scanner(rules))
        rows = []
        for spans in kept[0].scan(array):
            base = [span for span in spans if span[1] < len(BASE_RULES)]
            counts = [0] * len(rules)
            for span in spans:
                counts[span[1]] += 1
            digest = hashlib.sha256(_listed(base, rules).encode()).hexdigest()
            rows.append({"counts": counts, "base_sha256": digest, "spans": _listed(spans, rules)})
        return pa.array(rows, pa.struct([("counts", pa.list_(pa.int64())), ("base_sha256", pa.string()), ("spans", pa.string())]))

    return F.arrow_udf(apply, returnType=FOUND)(text)


def redact(text: Column | str, rules: Iterable[Rule] = RULES) -> Column:
    """Struct of the text with every span masked (overlapping ones as one) and the number of masks."""
    rules = list(rules)
    kept: list[Scanner] = []

    def apply(array: pa.Array) -> pa.Array:
        if not kept:
            kept.append(Scanner(rules))
        texts, counts = [], []
        for text, spans in zip(array.to_pylist(), kept[0].scan(array), strict=True):
            merged: list[list[int]] = []
            for start, _, end in spans:
                if merged and start < merged[-1][1]:
                    merged[-1][1] = max(merged[-1][1], end)
                else:
                    merged.append([start, end])
            if merged:
                edges = [0, *(edge for span in merged for edge in span), len(text)]
                text = MASK.join(text[edges[i] : edges[i + 1]] for i in range(0, len(edges), 2))
            texts.append(text)
            counts.append(len(merged))
        return pa.StructArray.from_arrays([pa.array(texts, pa.string()), pa.array(counts, pa.int64())], ["text", "n_spans"])

    return F.arrow_udf(apply, returnType=REDACTED)(text)


def secret_scan(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): counts of the base kinds, their digest, all spans.

    Spans are in code points, end exclusive. A null or empty text has no spans: counts of 0,
    the digest of nothing and an empty list. Repeated rows and null ids each give a row; other
    columns are left out. No rows give none.
    """
    found = short_batches(docs).select("doc_id", find_secrets("text").alias("found"))
    counts = [F.col("found.counts")[i].alias(f"n_{rule.kind}") for i, rule in enumerate(BASE_RULES)]
    return found.select("doc_id", *counts, "found.base_sha256", "found.spans")


def mask_secrets(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` with secrets masked in ``text``; n_chars follows where the text changed."""
    rows = short_batches(docs).select(F.struct("*").alias("row_"))
    made = rows.select("row_", redact("row_.text").alias("masked_"))
    changed = F.col("masked_.n_spans") > 0
    values = {
        "text": F.when(changed, F.col("masked_.text")).otherwise(F.col("row_.text")),
        "n_chars": F.when(changed, F.length("masked_.text")).otherwise(F.col("row_.n_chars")),
    }
    types = dict(docs.dtypes)
    return made.select(
        *[(values[c].cast(types[c]) if c in values else F.col("row_")[c]).alias(c) for c in docs.columns]
    )
