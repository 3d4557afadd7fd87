r"""Boundaries of pre-tokens without regular expressions.

Stands for the pattern of ``public_tokenizers.PATTERN``:
``'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+``.
Each code point gets a class, with what the pattern looks ahead for (the letters of a
contraction, the end of a run of white space) folded in. A class is a function from the
state before a code point to the state after it. Those functions and all their compositions
are a small monoid, so a scan with its multiplication table, which is associative, gives
the state everywhere: first within blocks side by side, then over the blocks' totals.
"""

from __future__ import annotations

import functools

import numpy as np
import regex

# Classes of code points. An apostrophe that contraction letters follow carries their number.
LETTER, NUMBER, OTHER, SHORT, LONG, SPACE, LEAD, LAST = range(8)
# Added for the first code point of a text.
FIRST = 8

# States: nothing can be continued; in a run of a kind; after a space that takes the next run; in a contraction.
_NONE, _LETTERS, _NUMBERS, _OTHERS, _SPACES, _LED, _ONE_LEFT, _TWO_LEFT = range(8)

# Rows of code points that are scanned side by side.
_BLOCK = 256


def _step(kind: int, state: int) -> tuple[int, bool]:
    """State after a code point, and whether it begins a pre-token."""
    if kind >= FIRST:
        return _step(kind - FIRST, _NONE)
    if state in (_ONE_LEFT, _TWO_LEFT):
        return (_NONE if state == _ONE_LEFT else _ONE_LEFT), False
    run = {LETTER: _LETTERS, NUMBER: _NUMBERS, OTHER: _OTHERS, SHORT: _OTHERS, LONG: _OTHERS}.get(kind)
    if run is not None:
        if state in (run, _LED):
            return run, False
        return {SHORT: _ONE_LEFT, LONG: _TWO_LEFT}.get(kind, run), True
    if kind == SPACE:
        return _SPACES, state != _SPACES
    return (_LED if kind == LEAD else _NONE), True


@functools.cache
def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Element of each class, products of elements, state that an element leads to, begins by (class, state)."""
    kinds, states = range(2 * FIRST), range(8)
    functions = [tuple(_step(k, s)[0] for s in states) for k in kinds]
    elements = list(dict.fromkeys(functions))
    for element in elements:  # grows while it is walked
        for function in dict.fromkeys(functions):
            product = tuple(function[s] for s in element)
            if product not in elements:
                elements.append(product)
    number = {element: i for i, element in enumerate(elements)}
    products = np.array([[number[tuple(b[s] for s in a)] for b in elements] for a in elements], np.uint16)
    begins = np.array([[_step(k, s)[1] for s in states] for k in kinds], bool)
    return np.array([number[f] for f in functions], np.uint16), products, np.array(elements, np.uint8), begins


@functools.cache
def _classes() -> np.ndarray:
    """Class of every code point by its general category, from the regex module's tables."""
    table = np.full(0x110000, OTHER, np.uint8)
    everything = "".join(map(chr, range(0xD800))) + "".join(map(chr, range(0xE000, 0x110000)))
    for kind, pattern in ((LETTER, r"\p{L}+"), (NUMBER, r"\p{N}+"), (SPACE, r"\s+")):
        for match in regex.finditer(pattern, everything):
            start, end = (p if p < 0xD800 else p + 0x800 for p in (match.start(), match.end() - 1))
            table[start : end + 1] = kind
    return table


def kinds_of(points: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Class of each code point of some texts that lie one behind the other."""
    kinds = _classes()[points]
    size = len(points)
    first = np.zeros(size + 3, bool)
    first[bounds[:-1][bounds[:-1] < size]] = True
    first[size:] = True
    padded = np.concatenate([points, np.zeros(3, points.dtype)])
    quotes = np.flatnonzero(points == ord("'"))
    one, two = padded[quotes + 1], padded[quotes + 2]
    near = ~first[quotes + 1]
    short = near & np.isin(one, [ord(c) for c in "stmd"])
    pairs = (("r", "e"), ("v", "e"), ("l", "l"))
    long = near & ~first[quotes + 2] & np.any([(one == ord(a)) & (two == ord(b)) for a, b in pairs], axis=0)
    kinds[quotes[short]], kinds[quotes[long]] = SHORT, LONG
    blank = kinds == SPACE
    ends = blank.copy()
    ends[:-1] &= ~blank[1:]
    if size:
        ends[-1] = False
    ends &= ~first[1 : size + 1]
    kinds[ends] = np.where(points[ends] == 32, LEAD, LAST)
    kinds[first[:size]] += FIRST
    return kinds


def _states(kinds: np.ndarray) -> np.ndarray:
    """State before each code point."""
    of_kind, products, leads, _ = _tables()
    blocks = -(-len(kinds) // _BLOCK)
    padded = np.zeros(blocks * _BLOCK, np.uint8)
    padded[: len(kinds)] = kinds
    steps = of_kind[np.ascontiguousarray(padded.reshape(blocks, _BLOCK).T)]
    size = len(products)
    flat = products.ravel()
    total = steps[0]
    for row in steps[1:]:
        total = flat[total.astype(np.int64) * size + row]
    reach = 1
    while reach < blocks:  # every block's total times all before it
        total[reach:] = flat[total[:-reach].astype(np.int64) * size + total[reach:]]
        reach *= 2
    state = np.full(blocks, _NONE, np.uint8)
    state[1:] = leads[total[:-1], _NONE]
    moves = np.ascontiguousarray(leads).ravel()
    found = np.empty((_BLOCK, blocks), np.uint8)
    for place, row in enumerate(steps):
        found[place] = state
        state = moves[row.astype(np.int64) * 8 + state]
    return found.T.reshape(-1)[: len(kinds)]


def boundaries(points: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Where pre-tokens begin, in order; ``bounds`` are the texts' bounds among the code points."""
    if not len(points):
        return np.empty(0, np.int64)
    kinds = kinds_of(points, bounds)
    return np.flatnonzero(_tables()[3].ravel()[kinds.astype(np.int64) * 8 + _states(kinds)])


def split(texts: list[str]) -> tuple[list[str], np.ndarray]:
    """All pre-tokens of some texts, and the bounds of each text's own among them."""
    whole = "".join(texts)
    points = np.frombuffer(whole.encode("utf-32-le"), np.uint32)
    bounds = np.concatenate([[0], np.cumsum([len(t) for t in texts], dtype=np.int64)]).astype(np.int64)
    starts = boundaries(points, bounds)
    places = starts.tolist()
    pieces = [whole[a:b] for a, b in zip(places, [*places[1:], len(whole)])]
    return pieces, np.searchsorted(starts, bounds)
