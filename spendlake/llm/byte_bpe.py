"""Byte-level BPE encoding and decoding by a rank file.

Texts are cut by ``pretokens`` (code-point classes and a scan, no regular expression). The
merges of a pre-token are done once and kept in a bounded cache. A text's tokens keep their
byte offsets, so that any range of tokens decodes to its own slice of bytes.
"""

from __future__ import annotations

import base64
import functools
import hashlib
import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spendlake.llm import pretokens
from spendlake.llm.batches import short_batches
from spendlake.llm.texthash import pieces

# Pre-tokens kept with their ids in each worker: two generations of so many.
CACHE_SIZE = 250_000

# Up to this many bytes the pair to merge is found by looking at all pairs, beyond by a heap.
_SHORT = 48

ENCODED = T.StructType(
    [
        T.StructField("n_tokens", T.LongType()),
        T.StructField("ids_sha256", T.StringType()),
        T.StructField("decoded_sha256", T.StringType()),
    ]
)


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as file:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}


class ByteBpe:
    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.vocabulary = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            self.vocabulary[rank] = token
        self._cache: dict[str, bytes] = {}
        self._older: dict[str, bytes] = {}

    def merge(self, word: bytes) -> list[int]:
        """Ids of a pre-token: of its neighbouring parts the pair of least rank is merged, the leftmost first."""
        whole = self.ranks.get(word)
        if whole is not None:
            return [whole]
        return self._merge_short(word) if len(word) <= _SHORT else self._merge_long(word)

    def _merge_short(self, word: bytes) -> list[int]:
        ranks, none = self.ranks, len(self.vocabulary)
        cuts = list(range(len(word) + 1))
        pair_ranks = [ranks.get(word[i : i + 2], none) for i in range(len(word) - 1)]
        while pair_ranks:
            least = min(pair_ranks)
            if least == none:
                break
            at = pair_ranks.index(least)
            del cuts[at + 1], pair_ranks[at]
            if at < len(pair_ranks):
                pair_ranks[at] = ranks.get(word[cuts[at] : cuts[at + 2]], none)
            if at:
                pair_ranks[at - 1] = ranks.get(word[cuts[at - 1] : cuts[at + 1]], none)
        return [ranks[word[a:b]] for a, b in zip(cuts, cuts[1:])]

    def _merge_long(self, word: bytes) -> list[int]:
        ranks, size = self.ranks, len(word)
        after, before = list(range(1, size + 2)), list(range(-1, size))
        alive = bytearray(b"\1") * size

        def pair(start: int) -> tuple[int, int, int] | None:
            middle = after[start]
            if middle >= size:
                return None
            rank = ranks.get(word[start : after[middle]])
            return None if rank is None else (rank, start, after[middle])

        heap = [found for found in map(pair, range(size)) if found]
        heapq.heapify(heap)
        while heap:
            _, start, end = heapq.heappop(heap)
            if not alive[start] or after[start] >= size or after[after[start]] != end:
                continue
            middle = after[start]
            alive[middle] = 0
            after[start] = end
            if end < size:
                before[end] = start
            for changed in (start, before[start]):
                if changed >= 0 and (found := pair(changed)):
                    heapq.heappush(heap, found)
        found, start = [], 0
        while start < size:
            found.append(ranks[word[start : after[start]]])
            start = after[start]
        return found

    def encode_all(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        words, bounds = pretokens.split(texts)
        if len(self._cache) > CACHE_SIZE:
            self._cache, self._older = {}, self._cache
        cache, older = self._cache, self._older
        for word in set(words).difference(cache):
            ids = older.get(word)
            cache[word] = np.array(self.merge(word.encode()), "<u4").tobytes() if ids is None else ids
        coded = [cache[word] for word in words]
        return [b"".join(coded[a:b]) for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)]

    def encode(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """Ids, and the byte offset of every token with the end as a last one."""
        ids = np.frombuffer(self.encode_all([text])[0], "<u4")
        sizes = np.array([len(self.vocabulary[i]) for i in ids.tolist()], np.int64)
        return ids, np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)

    def decode(self, ids: np.ndarray | bytes) -> bytes:
        """Bytes of the tokens; a range of a text's ids gives the bytes between its offsets."""
        ids = np.frombuffer(ids, "<u4") if isinstance(ids, bytes) else ids
        return b"".join(map(self.vocabulary.__getitem__, ids.tolist()))


@functools.cache
def coder(path: str) -> ByteBpe:
    return ByteBpe(read_ranks(path))


def digests(text: Column | str, path: str) -> Column:
    """Struct of n_tokens, ids_sha256 and decoded_sha256; null text counts as empty."""

    def apply(array: pa.Array) -> pa.Array:
        code = coder(path)
        columns: tuple[list, list, list] = ([], [], [])
        for start, end in pieces(array):
            texts = [t or "" for t in array.slice(start, end - start).to_pylist()]
            for ids in code.encode_all(texts):
                columns[0].append(len(ids) // 4)
                columns[1].append(hashlib.sha256(ids).hexdigest())
                columns[2].append(hashlib.sha256(code.decode(ids)).hexdigest())
        kinds = (pa.int64(), pa.string(), pa.string())
        return pa.StructArray.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ENCODED.fieldNames()
        )

    return F.arrow_udf(apply, returnType=ENCODED)(text)


def encode_documents(docs: DataFrame, path: str) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): number of tokens, digests of ids and of decoded bytes.

    Special strings are ordinary text. A null or empty text has no tokens. Repeated rows and null ids
    each give a row; other columns are left out. No rows give none. ``path`` is the rank file, the same on
    every machine.
    """
    return short_batches(docs).select("doc_id", digests("text", path).alias("made")).select("doc_id", "made.*")
