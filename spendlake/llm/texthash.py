"""Words, lines and their hashes for a whole Arrow array of texts at once, with numpy.

The texts of an array lie one behind the other in one byte buffer. Words are maximal runs
of bytes other than space and the controls 0x09 to 0x0D; no word or line crosses a text.
The hash of a slice takes in eight bytes at a time and mixes all bits after each step, for all slices
at once; long slices go through BLAKE2 one by one.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Texts are worked on in pieces of about this many bytes; a longer text is a piece of its own.
PIECE_BYTES = 512 << 10

# Slices of more bytes are hashed one by one.
LONG_SLICE = 512

_BASE = np.uint64(0x9E3779B97F4A7C15)


def pieces(array: pa.Array, size: int = PIECE_BYTES, row_bytes: int = 0) -> Iterator[tuple[int, int]]:
    """Ranges of whole rows of about ``size`` bytes each; a row counts its text and ``row_bytes`` more."""
    lengths = np.asarray(pc.fill_null(pc.binary_length(array), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    start, total = 0, 0
    for row, length in enumerate((lengths + row_bytes).tolist()):
        if total and total + length > size:
            yield start, row
            start, total = row, 0
        total += length
    if start < len(lengths):
        yield start, len(lengths)


class Texts:
    """The bytes of some texts, null as empty, and where each begins."""

    def __init__(self, array: pa.Array):
        array = pc.fill_null(array.cast(pa.large_string()), "")
        _, offsets, data = array.buffers()
        bounds = np.frombuffer(offsets, dtype=np.int64)[array.offset : array.offset + len(array) + 1]
        raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.empty(0, np.uint8)
        self.bytes = raw[bounds[0] : bounds[-1]]
        self.bounds = bounds - bounds[0]
        self.count = len(array)

    @functools.cached_property
    def _eights(self) -> np.ndarray:
        """At every byte the eight bytes from there on as one number; zeros follow the last."""
        padded = np.concatenate([self.bytes, np.zeros(8, np.uint8)])
        return np.ndarray((len(self.bytes) + 1,), "<u8", buffer=padded, strides=(1,))

    def hash_slices(self, starts: np.ndarray, ends: np.ndarray, seed: int = 0) -> np.ndarray:
        """One 64-bit hash for each slice of the bytes; equal slices hash equal wherever they stand.

        Hashes of different seeds are independent of each other.
        """
        sizes = ends - starts
        hashes = mix(sizes.astype(np.uint64) + np.uint64((seed + 1) * int(_BASE) & _ALL))
        done, left = 0, np.flatnonzero((sizes > 0) & (sizes <= LONG_SLICE))
        while len(left):
            rest = sizes[left] - done
            chunk = self._eights[starts[left] + done] & _LOW_BYTES[np.minimum(rest, 8)]
            hashes[left] = mix((hashes[left] ^ chunk) + _BASE)
            done, left = done + 8, left[rest > 8]
        for at in np.flatnonzero(sizes > LONG_SLICE).tolist():
            one = hashlib.blake2b(self.bytes[starts[at] : ends[at]], digest_size=8, salt=seed.to_bytes(8, "little"))
            hashes[at] = np.frombuffer(one.digest(), "<u8")[0]
        return hashes

    def distinct(self, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number of one slice of each content, and for every slice the place of its content among these.

        Hashes find the equal slices, and their bytes confirm it.
        """
        _, first, place = np.unique(self.hash_slices(starts, ends), return_index=True, return_inverse=True)
        if self._equal(starts, ends, first[place]):
            return first, place
        numbers: dict[bytes, int] = {}
        data = self.bytes.tobytes()
        place = np.array([numbers.setdefault(data[a:b], len(numbers)) for a, b in zip(starts, ends, strict=True)])
        return np.unique(place, return_index=True)[1], place

    def _equal(self, starts: np.ndarray, ends: np.ndarray, other: np.ndarray) -> bool:
        """Whether every slice holds the same bytes as the slice of the number beside it."""
        sizes = ends - starts
        if (sizes != sizes[other]).any():
            return False
        done, left = 0, np.flatnonzero((sizes > 0) & (sizes <= LONG_SLICE))
        while len(left):
            rest = sizes[left] - done
            low = _LOW_BYTES[np.minimum(rest, 8)]
            if ((self._eights[starts[left] + done] ^ self._eights[starts[other[left]] + done]) & low).any():
                return False
            done, left = done + 8, left[rest > 8]
        return all(
            np.array_equal(self.bytes[starts[at] : ends[at]], self.bytes[starts[other[at]] : ends[other[at]]])
            for at in np.flatnonzero(sizes > LONG_SLICE).tolist()
        )

    @functools.cached_property
    def _in_word(self) -> np.ndarray:
        return _WORD_BYTE[self.bytes]

    def words(self, cuts: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Start and end byte of every word, and the first word of each text (with a closing bound).

        ``cuts`` flags bytes at which a word begins even within a run.
        """
        inside = self._in_word
        opens, closes = inside.copy(), inside.copy()
        opens[1:] &= ~inside[:-1]
        closes[:-1] &= ~inside[1:]
        if cuts is not None:
            opens |= cuts
            closes[:-1] |= cuts[1:]
        filled = self.bounds[:-1][self.bounds[1:] > self.bounds[:-1]]
        opens[filled] = inside[filled]
        last = filled[1:] - 1
        closes[last] = inside[last]
        starts, ends = np.flatnonzero(opens), np.flatnonzero(closes) + 1
        return starts, ends, np.searchsorted(starts, self.bounds)

    def lines(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        r"""Start and end byte and text of every \n-split line that holds a word."""
        breaks = np.flatnonzero(self.bytes == 10)
        starts = np.sort(np.concatenate([self.bounds[:-1], breaks + 1]), kind="stable")
        ends = np.sort(np.concatenate([breaks, self.bounds[1:]]), kind="stable")
        owner = np.searchsorted(self.bounds, starts, side="right") - 1
        # A text's last line ends where the next text begins, and empty texts share one place.
        inside = np.concatenate([[0], np.cumsum(self._in_word)])
        held = (ends > starts) & (inside[ends] > inside[starts])
        return starts[held], ends[held], owner[held]

    def totals(self, flags: np.ndarray) -> np.ndarray:
        """How many bytes of each text are flagged."""
        sums = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
        return sums[self.bounds[1:]] - sums[self.bounds[:-1]]


_ALL = 2**64 - 1

# The low 0 to 8 bytes of a number.
_LOW_BYTES = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)

_WORD_BYTE = np.ones(256, bool)
_WORD_BYTE[[9, 10, 11, 12, 13, 32]] = False


def mix(values: np.ndarray) -> np.ndarray:
    """A well-spread 64-bit value of each 64-bit value, one to one."""
    values = values ^ (values >> np.uint64(30))
    values = values * np.uint64(0xBF58476D1CE4E5B9)
    values = values ^ (values >> np.uint64(27))
    values = values * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


def windows(hashes: np.ndarray, width: int) -> np.ndarray:
    """Hash of every run of ``width`` neighbours."""
    count = len(hashes) - width + 1
    if count <= 0:
        return np.empty(0, np.uint64)
    total = np.zeros(count, np.uint64)
    for place in range(width):
        total = total * _BASE + hashes[place : place + count]
    return mix(total)


def text_of(bounds: np.ndarray) -> np.ndarray:
    """Number of the owner of each item, from the items' bounds per owner."""
    return np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
