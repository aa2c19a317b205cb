"""Windows of a sequence, gathered by their least hashed gram.

Equal windows have equal grams and so the same least one, their anchor. Neighbouring windows mostly
share it: a run of windows with one anchor is a segment. Two equal windows always lie in
segments of the same anchor, so searching each anchor's segments on their own loses nothing, and
an anchor that occurs once has nothing to search.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np

_ODD = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xD6E8FEB86659FD93)
_INVERSE = np.uint64(pow(int(_ODD), -1, 1 << 64))


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * _MIX
    return x ^ (x >> np.uint64(29))


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``n`` powers of the base and of its inverse, modulo 2 ** 64."""
    up = np.full(n, _ODD)
    down = np.full(n, _INVERSE)
    up[:1] = down[:1] = 1
    return np.multiply.accumulate(up), np.multiply.accumulate(down)


class Prefix:
    """Hashes of all ranges of a sequence of integers, from its running sums."""

    def __init__(self, values: np.ndarray):
        up, self.down = powers(len(values) + 1)
        self.sums = np.zeros(len(values) + 1, np.uint64)
        np.cumsum(values * up[:-1], out=self.sums[1:])

    def ranges(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mixed((self.sums[ends] - self.sums[starts]) * self.down[starts])

    def grams(self, size: int) -> np.ndarray:
        n = len(self.sums) - size
        if n <= 0:
            return np.empty(0, np.uint64)
        return mixed((self.sums[size:] - self.sums[:-size]) * self.down[:n])


def window_minima(values: np.ndarray, width: int) -> np.ndarray:
    """The least of each ``width`` neighbouring values, by doubling."""
    if len(values) < width:
        return np.empty(0, values.dtype)
    low, size = values, 1
    while 2 * size <= width:
        low, size = np.minimum(low[:-size], low[size:]), 2 * size
    rest = width - size
    return np.minimum(low[: len(low) - rest], low[rest:]) if rest else low


class Segments(NamedTuple):
    """Runs of windows ``first`` to ``last`` (inclusive) of sequence ``row`` with one ``anchor``;
    ``again`` where the anchor's gram occurs more than once in the run."""

    row: np.ndarray
    first: np.ndarray
    last: np.ndarray
    anchor: np.ndarray
    again: np.ndarray


def segments(grams: np.ndarray, begins: np.ndarray, lengths: np.ndarray, window: int, gram: int) -> Segments:
    """Segments of sequences that lie one after the other; ``first`` and ``last`` count from each
    sequence's begin. ``grams`` are hashes of ``gram`` neighbouring items."""
    width = window - gram + 1
    minima = window_minima(grams, width)
    count = np.maximum(lengths - window + 1, 0)
    row = np.repeat(np.arange(len(begins)), count)
    where = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count) + begins[row]
    value = minima[where]
    change = np.ones(len(row), bool)
    change[1:] = (value[1:] != value[:-1]) | (row[1:] != row[:-1])
    starts = np.flatnonzero(change)
    ends = np.append(starts[1:], len(row)) - 1
    if not len(starts):
        none = np.empty(0, np.int64)
        return Segments(none, none, none, np.empty(0, np.uint64), np.empty(0, bool))
    first, last, anchor = where[starts], where[ends], value[starts]
    # Places of anchor grams: a bit table first, then exactly.
    table = np.zeros(1 << 20, bool)
    table[anchor & np.uint64((1 << 20) - 1)] = True
    near = np.flatnonzero(table[grams & np.uint64((1 << 20) - 1)])
    order = np.argsort(grams[near], kind="stable")
    near, held = near[order], grams[near][order]
    distinct, begin = np.unique(held, return_index=True)
    stop = np.append(begin[1:], len(held))
    at = np.searchsorted(distinct, anchor)
    # Within one value places ascend, so (value, place) is one ascending sequence of pairs.
    rank = np.repeat(np.arange(len(distinct)), stop - begin)
    span = np.int64(len(grams) + 1)
    pairs = rank * span + near
    again = np.searchsorted(pairs, at * span + last + width) - np.searchsorted(pairs, at * span + first) > 1
    owner = row[starts]
    return Segments(owner, first - begins[owner], last - begins[owner], anchor, again)
