"""Packing of tokenised documents into fixed-length training sequences.

Documents are tokenised where they lie. Only their pieces' lengths travel. Full pieces are sequences; the
others are dealt evenly over shards, and each shard is packed best-fit decreasing: the longest piece first, each
into the sequence it leaves the least room in. A segment tree over the remaining capacities
finds that sequence in as many steps as the capacity has binary digits.
"""

from __future__ import annotations

import functools
import os
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from spendlake.llm.batches import short_batches
from spendlake.llm.texthash import Texts, pieces
from spendlake.session import stored

SEQUENCE_TOKENS = 2048
END_ID = 0

# Pieces per shard, on average. A shard leaves a few sequences part empty, among thousands.
SHARD_PIECES = 32_768

# Parts of words kept with their ids in each worker: two generations of so many.
CACHE_SIZE = 150_000

# Texts are tokenised together in pieces of about this many bytes.
BATCH_BYTES = 1 << 20

# Single words are handed to the tokenizer in lines of so many.
_LINE = 1000

PIECE_SCHEMA = "doc_id long, piece int, start long, length long, ids_crc32 long"


class WordTokenizer:
    """Ids of whole texts by a lower-casing tokenizer whose pre-tokens hold letters or symbols, never both or white space.

    Such a tokenizer gives a text the ids of its words, one after the other, and those of a word are
    those of the parts before and after a change from a letter to a symbol. So every part is encoded once.
    Apostrophes, which contractions need, are not cut off; a text with a special string is encoded whole.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        names = self.tokenizer.get_vocab()
        self.ends_word = np.zeros(max(names.values()) + 1, bool)
        self.ends_word[[number for name, number in names.items() if name.endswith("</w>")]] = True
        self._known: dict[bytes, bytes] = {}
        self._older: dict[bytes, bytes] = {}

    def _encode(self, words: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(words, add_special_tokens=False)
        return [np.array(e.ids, "<u4").tobytes() for e in found]

    def _learn(self, parts: list[bytes]) -> None:
        """Encodes parts that are not known yet: those that are one pre-token many to a line."""
        single, other = [], []
        for part in parts:
            word = part.decode()
            (single if word.isalpha() and (part.isascii() or word.lower().isalpha()) else other).append(part)
        for start in range(0, len(single), _LINE):
            line = single[start : start + _LINE]
            ids = self._encode([b" ".join(line).decode()])[0]
            ends = ((np.flatnonzero(self.ends_word[np.frombuffer(ids, "<u4")]) + 1) * 4).tolist()
            if len(ends) == len(line):
                self._known.update(zip(line, [ids[a:b] for a, b in zip([0, *ends], ends)], strict=True))
            else:
                self._known.update(zip(line, self._encode([part.decode() for part in line]), strict=True))
        self._known.update(zip(other, self._encode([part.decode() for part in other]), strict=True))

    def encode_all(self, array: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the texts one behind the other, and the bounds of each text's own; null is empty."""
        texts = Texts(array)
        raw = texts.bytes
        whole = np.flatnonzero(texts.totals(_followed(raw, ord("<"), ord("|"))) > 0)
        lower = np.where((raw >= 65) & (raw <= 90), raw + np.uint8(32), raw)
        texts.bytes = lower
        cuts = np.zeros(len(raw), bool)
        cuts[1:] = _LETTER[lower[:-1]] & _SYMBOL[lower[1:]]
        cuts[texts.bounds[:-1][texts.bounds[:-1] < len(raw)]] = False
        starts, ends, bounds = texts.words(cuts)
        first, place = texts.distinct(starts, ends)
        data = lower.tobytes()
        parts = [data[a:b] for a, b in zip(starts[first].tolist(), ends[first].tolist(), strict=True)]
        if len(self._known) > CACHE_SIZE:
            self._known, self._older = {}, self._known
        known, older = self._known, self._older
        missing = []
        for part in parts:
            if part not in known:
                ids = older.get(part)
                if ids is None:
                    missing.append(part)
                else:
                    known[part] = ids
        self._learn(missing)
        found = [known[part] for part in parts]
        sizes = np.fromiter(map(len, found), np.int64, len(found)) // 4
        flat = np.frombuffer(b"".join(found), "<u4")
        counts = sizes[place]
        upto = np.concatenate([[0], np.cumsum(counts)]).astype(np.int64)
        base = (np.cumsum(sizes) - sizes)[place]
        ids = flat[np.arange(upto[-1]) + np.repeat(base - upto[:-1], counts)]
        limits = upto[bounds]
        if not len(whole):
            return ids, limits
        own = np.split(ids, limits[1:-1])
        for row, made in zip(whole, self._encode([array[int(r)].as_py() for r in whole]), strict=True):
            own[row] = np.frombuffer(made, "<u4")
        return np.concatenate(own), np.concatenate([[0], np.cumsum([len(x) for x in own])]).astype(np.int64)


def _followed(raw: np.ndarray, byte: int, after: int) -> np.ndarray:
    found = np.zeros(len(raw), bool)
    found[:-1] = (raw[:-1] == byte) & (raw[1:] == after)
    return found


_LETTER = np.zeros(256, bool)
_LETTER[97:123] = True
_SYMBOL = np.zeros(256, bool)
_SYMBOL[[b for b in range(33, 127) if not chr(b).isalnum() and chr(b) != "'"]] = True


@functools.cache
def word_tokenizer(path: str) -> WordTokenizer:
    return WordTokenizer(path)


def cut(ids: bytes, size: int = SEQUENCE_TOKENS) -> Iterator[tuple[int, bytes]]:
    """Start and ids of each piece of at most ``size`` tokens."""
    for start in range(0, len(ids), 4 * size):
        yield start // 4, ids[start : start + 4 * size]


def tokenised_pieces(docs: DataFrame, path: str, size: int = SEQUENCE_TOKENS) -> DataFrame:
    """One row per piece of each document with its length and the checksum of its ids."""

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        end_id = np.array([END_ID], "<u4").tobytes()
        for batch in batches:
            for first, last in pieces(batch.column(1), BATCH_BYTES):
                names_, texts = (batch.column(i).slice(first, last - first) for i in (0, 1))
                ids, bounds = word_tokenizer(path).encode_all(texts)
                rows = []
                for place, doc_id in enumerate(names_.to_pylist()):
                    own = ids[bounds[place] : bounds[place + 1]].tobytes() + end_id
                    for number, (start, part) in enumerate(cut(own, size)):
                        rows.append((doc_id, number, start, len(part) // 4, zlib.crc32(part)))
                kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
                names = [f.split(" ")[0] for f in PIECE_SCHEMA.split(", ")]
                columns = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return short_batches(docs).select(F.col("doc_id").cast("long"), "text").mapInArrow(apply, PIECE_SCHEMA)


class OpenSequences:
    """Open sequences by remaining capacity: a segment tree that counts them, with a stack for each capacity."""

    def __init__(self, capacity: int):
        self.leaves = 1 << capacity.bit_length()
        self.counts = [0] * (2 * self.leaves)
        self.stacks: list[list[int]] = [[] for _ in range(capacity + 1)]

    def push(self, room: int, sequence: int) -> None:
        self.stacks[room].append(sequence)
        self._add(room, 1)

    def _add(self, room: int, change: int) -> None:
        node = room + self.leaves
        while node:
            self.counts[node] += change
            node >>= 1

    def pop_tightest(self, length: int) -> tuple[int, int] | None:
        """Room and number of the open sequence with the least room for ``length``; it is closed."""
        node, counts = length + self.leaves, self.counts
        while not counts[node]:  # up to the first subtree to the right that holds one
            while node & 1:
                node >>= 1
            if not node:
                return None
            node += 1
        while node < self.leaves:  # down to its leftmost leaf
            node = 2 * node if counts[2 * node] else 2 * node + 1
        room = node - self.leaves
        self._add(room, -1)
        return room, self.stacks[room].pop()


def best_fit_decreasing(lengths: np.ndarray, capacity: int = SEQUENCE_TOKENS) -> tuple[np.ndarray, np.ndarray]:
    """Sequence and offset of every piece; no length is above the capacity."""
    sequence, offset = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    open_, made = OpenSequences(capacity), 0
    for at in np.argsort(-lengths, kind="stable").tolist():
        length = int(lengths[at])
        found = open_.pop_tightest(length)
        room, number = found if found else (capacity, made)
        made += not found
        sequence[at], offset[at] = number, capacity - room
        if room > length:
            open_.push(room - length, number)
    return sequence, offset


def pack(docs: DataFrame, path: str, size: int = SEQUENCE_TOKENS) -> DataFrame:
    """One row per piece of each row of ``docs`` (doc_id, text): where its tokens go.

    Columns doc_id, piece, start, length, ids_crc32, sequence_id, offset. A document is its ids and END_ID;
    a null or empty text is END_ID alone. Only documents longer than ``size`` are cut. Repeated rows and
    null ids are packed like any other; other columns are left out. No rows give none. ``path`` is the
    tokenizer file, the same on every machine.

    Pieces are stored once; a full one is a sequence by itself and goes no further. So a document adds one piece at most
    to the shards, however long it is, and what a shard holds is bounded by SHARD_PIECES.
    """
    made = stored(tokenised_pieces(docs, path, size), "pieces")
    row = F.monotonically_increasing_id()
    full = made.filter(F.col("length") == size).select("*", (-1 - row).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    rest = made.filter(F.col("length") < size)
    shards = max(1, -(-rest.count() // SHARD_PIECES))

    def apply(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["length", "doc_id", "piece", "ids_crc32"], kind="stable")
        sequence, offset = best_fit_decreasing(frame["length"].to_numpy(), size)
        return frame.assign(sequence_id=frame["shard"] * (1 << 32) + sequence, offset=offset).drop(columns="shard")

    dealt = rest.withColumn("shard", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32", row), F.lit(shards)))
    schema = f"{PIECE_SCHEMA}, sequence_id long, offset long"
    return full.unionByName(dealt.groupBy("shard").applyInPandas(apply, schema))
