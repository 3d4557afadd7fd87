"""Groups of spelling variants: words one edit apart, found by pivotal grams.

The grams of a word are its bigrams with their positions; the rarer come first in one order for all
words. One edit harms at most two neighbouring bigrams, so of two disjoint ones, the pivots, one stands
unharmed. The pivots are the lightest disjoint pair among the first three grams of the word, by dynamic
programming. If the third gram of word r is no rarer than that of word s stands in the order, an unharmed
pivot of r is among the grams of s up to its third, its prefix. So pivots meet prefixes, and not all grams:

* at the same position, where the edit lies behind the gram, and then all before it is the same;
* or as far from the end, where the edit lies before the gram, and then all behind it is the same;
* in words of equal length or one more or less.

These limits are the key that both sides are joined on; what meets is verified by its edit distance.
"""

from __future__ import annotations

import functools
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from spendlake.llm.batches import short_batches
from spendlake.llm.texthash import Texts, pieces
from spendlake.session import stored

MIN_CHARS = 5
MIN_COUNT = 3
# A form must occur so many times as often as the word.
FORM_RATIO = 2
# Of so many runs one, by its checksum, loses a code point.
DAMAGE_EVERY = 97

# Prefix grams, before ties: bigrams times edits, and one more.
PREFIX_GRAMS = 3

# Distinct words that a task counts before it hands them on.
HELD_WORDS = 200_000

# Runs of more bytes have their checksums taken one by one.
_LONG_RUN = 64


class _Runs(Texts):
    """Words are maximal runs of ASCII letters and the letters U+00C0 to U+00FF, A-Z as a-z."""

    def __init__(self, array: pa.Array):
        super().__init__(array)
        upper = (self.bytes >= 65) & (self.bytes <= 90)
        self.bytes = np.where(upper, self.bytes + np.uint8(32), self.bytes)

    @functools.cached_property
    def _in_word(self) -> np.ndarray:
        lead = self.bytes == 0xC3  # of the two bytes of U+00C0 to U+00FF, and of no other character
        inside = ((self.bytes >= 97) & (self.bytes <= 122)) | lead
        inside[1:] |= lead[:-1]
        return inside

    def runs(self, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Start, end and text of the runs of at least so many code points."""
        starts, ends, bounds = self.words()
        owner = np.repeat(np.arange(self.count), np.diff(bounds))
        begun = np.concatenate([[0], np.cumsum((self.bytes & 0xC0) != 0x80)])
        kept = begun[ends] - begun[starts] >= least
        return starts[kept], ends[kept], owner[kept]


def _crc_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = (table >> np.uint32(1)) ^ (np.uint32(0xEDB88320) * (table & np.uint32(1)))
    return table


_CRC = _crc_table()


def checksums(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, before: np.ndarray) -> np.ndarray:
    """CRC-32 of each slice of the bytes, going on from the checksum of what stands before it."""
    state = before ^ np.uint32(0xFFFFFFFF)
    sizes = ends - starts
    done, left = 0, np.flatnonzero((sizes > 0) & (sizes <= _LONG_RUN))
    while len(left):
        now = state[left]
        state[left] = _CRC[(now ^ data[starts[left] + done]) & np.uint32(255)] ^ (now >> np.uint32(8))
        done += 1
        left = left[sizes[left] > done]
    for at in np.flatnonzero(sizes > _LONG_RUN).tolist():
        state[at] = zlib.crc32(data[starts[at] : ends[at]], int(before[at])) ^ 0xFFFFFFFF
    return state ^ np.uint32(0xFFFFFFFF)


def _counted(ids: list, array: pa.Array) -> Iterator[tuple[bytes, int]]:
    """Words of some texts with their numbers, a word perhaps more than once."""
    texts = _Runs(array)
    starts, ends, owner = texts.runs(MIN_CHARS)
    names = np.array([zlib.crc32(f"{'' if i is None else i}:".encode()) for i in ids], np.uint32)
    sums = checksums(texts.bytes, starts, ends, names[owner])
    harmed = sums % np.uint32(DAMAGE_EVERY) == 0
    for a, b, total in zip(starts[harmed].tolist(), ends[harmed].tolist(), sums[harmed].tolist(), strict=True):
        run = texts.bytes[a:b].tobytes().decode()
        place = total % len(run)
        if len(run) > MIN_CHARS:
            yield (run[:place] + run[place + 1 :]).encode(), 1
    starts, ends = starts[~harmed], ends[~harmed]
    first, place = texts.distinct(starts, ends)
    data = texts.bytes.tobytes()
    for a, b, n in zip(starts[first].tolist(), ends[first].tolist(), np.bincount(place).tolist(), strict=True):
        yield data[a:b], n


def vocabulary(docs: DataFrame) -> DataFrame:
    """(word, n): the words of ``docs`` (doc_id, text), damaged runs included, and how often each occurs.

    Tasks count before they hand on, so a frequent word costs a few rows of each task.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[bytes, int] = {}

        def handed() -> pa.RecordBatch:
            words = pa.array(list(held), pa.binary()).cast(pa.string())
            return pa.RecordBatch.from_arrays([words, pa.array(list(held.values()), pa.int64())], names=["word", "n"])

        for batch in batches:
            for start, end in pieces(batch.column(1)):
                ids, texts = (batch.column(i).slice(start, end - start) for i in (0, 1))
                for word, n in _counted(ids.to_pylist(), texts):
                    held[word] = held.get(word, 0) + n
                if len(held) > HELD_WORDS:
                    yield handed()
                    held.clear()
        if held:
            yield handed()

    parts = short_batches(docs.select("doc_id", "text")).mapInArrow(count, "word string, n long")
    return parts.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= MIN_COUNT)


def pivots(grams: list[tuple[int, int]], weight: dict[int, int]) -> list[int]:
    """Positions of the two disjoint bigrams of least weight together; ``grams`` are (position, gram) by position.

    Dynamic programming from the left: the lightest single gram that ends before each position, then the
    lightest pair that ends there.
    """
    single: list[tuple[int, int]] = []  # of the grams up to each: least weight of one, and its position
    best: tuple[int, int, int] | None = None
    behind = 0  # grams that lie wholly before the one at hand
    for position, gram in grams:
        while behind < len(single) and grams[behind][0] + 2 <= position:
            behind += 1
        if behind:
            other, at = single[behind - 1]
            pair = (other + weight[gram], at, position)
            best = pair if best is None else min(best, pair)
        own = (weight[gram], position)
        single.append(min(single[-1], own) if single else own)
    return list(best[1:])


def _sides(word: str) -> tuple[list[int], list[int]]:
    """Checksums of the word up to and with each code point, and of it from each code point on (read backwards)."""
    points = [c.encode() for c in word]
    left, right, upto, back = [], [0] * len(points), 0, 0
    for point in points:
        upto = zlib.crc32(point, upto)
        left.append(upto)
    for at in range(len(points) - 1, -1, -1):
        back = zlib.crc32(points[at], back)
        right[at] = back
    return left, right


def _grams(words: DataFrame) -> DataFrame:
    places = F.sequence(F.lit(1), F.length("word") - 1)
    return words.select(F.explode(F.transform(places, lambda i: F.substring("word", i, F.lit(2)))).alias("gram"))


def _keyed(words: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Pivots and prefix grams of ``words`` (word, n) under the keys that they are joined on.

    Bigrams of 90 letters are 8,100 at most, so their ranks go to every task.
    """
    counts = _grams(words).groupBy("gram").agg(F.count(F.lit(1)).alias("n")).collect()  # 8,100 rows at most
    order = {row.gram: rank for rank, row in enumerate(sorted(counts, key=lambda row: (row.n, row.gram)))}
    weight = {order[row.gram]: row.n for row in counts}

    def keys(batches: Iterator[pa.RecordBatch], pivotal: bool) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[tuple] = []
            for word, n in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                size = len(word)
                ranks = [order[word[i : i + 2]] for i in range(size - 1)]
                last = sorted(ranks)[PREFIX_GRAMS - 1]
                prefix = [(at, rank) for at, rank in enumerate(ranks) if rank <= last]
                left, right = _sides(word)
                letters = sum(1 << bit for bit in {ord(c) % 63 for c in word})
                chosen = pivots(prefix, weight) if pivotal else [at for at, _ in prefix]
                for at in chosen:
                    for other in (size - 1, size, size + 1) if pivotal else (size,):
                        rows.append((word, n, last, letters, False, other, at + 2, left[at + 1]))
                        rows.append((word, n, last, letters, True, other, size - at, right[at]))
                if len(rows) > HELD_WORDS:
                    yield made(rows)
                    rows = []
            if rows:
                yield made(rows)

    names = ["word", "n", "last", "letters", "from_end", "size", "part", "sum"]
    types = [pa.string(), pa.int64(), pa.int32(), pa.int64(), pa.bool_(), pa.int32(), pa.int32(), pa.int64()]
    schema = "word string, n long, last int, letters long, from_end boolean, size int, part int, sum long"

    def made(rows: list[tuple]) -> pa.RecordBatch:
        columns = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)]
        return pa.RecordBatch.from_arrays(columns, names=names)

    sides = (words.mapInArrow(functools.partial(keys, pivotal=pivotal), schema) for pivotal in (True, False))
    return tuple(sides)


def near_pairs(words: DataFrame) -> DataFrame:
    """(a, a_n, b, b_n), a before b: all pairs of ``words`` (word, n; of four or more code points) one edit apart."""
    asked, held = _keyed(words.select("word", "n"))
    asked = asked.withColumnsRenamed({"word": "left", "n": "left_n", "last": "left_last", "letters": "left_letters"})
    held = held.withColumnsRenamed({"word": "right", "n": "right_n", "last": "right_last", "letters": "right_letters"})
    alike = F.bit_count(F.col("left_letters").bitwiseXOR(F.col("right_letters"))) <= 2  # one edit adds and takes a letter
    met = asked.join(held, ["from_end", "size", "part", "sum"]).filter(
        (F.col("left_last") <= F.col("right_last"))
        & alike
        & (F.col("left") != F.col("right"))
        & (F.levenshtein("left", "right", 1) == 1)
    )
    ordered = F.col("left") < F.col("right")
    sides = {"a": ("left", "right"), "a_n": ("left_n", "right_n"), "b": ("right", "left"), "b_n": ("right_n", "left_n")}
    return met.select(*[F.when(ordered, F.col(x)).otherwise(F.col(y)).alias(k) for k, (x, y) in sides.items()]).distinct()


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root) of words with a form: the last form of the chain. Each round doubles the steps that are taken.

    Counts at least double along a chain, so it ends, after fewer steps than a count has binary digits.
    """
    now = stored(forms.select("word", F.col("form").alias("root")), "forms")
    while True:
        following = now.select(F.col("word").alias("via"), F.col("root").alias("further"))
        moved = now.join(following, F.col("root") == F.col("via"), "left")
        seen = Observation()
        moved = moved.select("word", F.coalesce("further", "root").alias("root"), F.col("via").isNotNull().alias("moved"))
        moved = moved.observe(seen, F.max("moved").alias("any"))
        now = stored(moved, "forms").drop("moved")
        if not seen.get["any"]:
            return now


def spelling_variants(docs: DataFrame) -> DataFrame:
    """The words of ``docs`` (doc_id, text) with the spellings that they vary: word, form, root, n, n_near, form_n.

    Words are runs of ASCII letters and U+00C0 to U+00FF, A-Z lower-cased; a run whose CRC-32 of
    ``doc_id:run`` is divisible by 97 loses a code point. Of the results those count that have 5 code points
    or more and occur three times or more. ``n_near`` counts the words one edit away; ``form`` is the most
    frequent of them (ties: the least) where it is at least twice as frequent; ``root`` is the last form of the
    chain, the word itself without one. Null and empty texts have no words, and a null doc_id reads as nothing;
    repeated rows count each time; other columns are left out; no rows give none.
    """
    words = stored(vocabulary(docs), "words")
    pairs = stored(near_pairs(words), "near-pairs")
    back = pairs.select(F.col("b").alias("a"), F.col("b_n").alias("a_n"), F.col("a").alias("b"), F.col("a_n").alias("b_n"))
    best = F.min(F.struct((-F.col("b_n")).alias("less"), F.col("b").alias("form"))).alias("best")
    near = pairs.unionByName(back).groupBy("a").agg(F.count(F.lit(1)).alias("n_near"), best)
    joined = words.join(near, F.col("word") == F.col("a"), "left")
    often = -F.col("best.less") >= FORM_RATIO * F.col("n")
    formed = joined.select(
        "word",
        F.when(often, F.col("best.form")).alias("form"),
        "n",
        F.coalesce("n_near", F.lit(0)).alias("n_near"),
        F.when(often, -F.col("best.less")).alias("form_n"),
    )
    formed = stored(formed, "formed")
    roots = _roots(formed.filter("form is not null")).withColumnRenamed("word", "of")
    named = formed.join(roots, F.col("word") == F.col("of"), "left")
    return named.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
