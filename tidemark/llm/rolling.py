"""Hashes of byte ranges and words, vectorised over a buffer of many texts.

The hash of bytes b[s:e] is the sum of T[b[j]] * B**(j - s) modulo 2**64, with a fixed table T of
odd-looking numbers and an odd B: prefix sums give any range with one subtraction and one
product.  Equal ranges have equal hashes; different ones collide with a chance near 2**-64.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np

_BASE = 0x9E3779B97F4A7C15 | 1
_MASK = (1 << 64) - 1


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def numbers(n: int, seed: int) -> np.ndarray:
    """``n`` fixed pseudo-random 64-bit numbers."""
    return mix((np.arange(1, n + 1, dtype=np.uint64) + np.uint64(seed << 20)) * np.uint64(_BASE))


BYTE = numbers(256, 1)
FOLDED = BYTE.copy()
FOLDED[65:91] = BYTE[97:123]
BLANK = np.zeros(256, bool)
BLANK[[32, 9, 10, 11, 12, 13]] = True

_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _grown(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers[0]) < n:
        size = max(n, 1 << 20)
        for k, base in enumerate((_BASE, pow(_BASE, -1, 1 << 64))):
            steps = np.full(size, base & _MASK, dtype=np.uint64)
            steps[0] = 1
            _powers[k] = np.multiply.accumulate(steps)
    return _powers[0][:n], _powers[1][:n]


class Hashed:
    """Range hashes of one sequence of 64-bit numbers."""

    def __init__(self, values: np.ndarray):
        power, self._back = _grown(len(values) + 1)
        self._sums = np.zeros(len(values) + 1, np.uint64)
        np.cumsum(values * power[: len(values)], out=self._sums[1:])

    def ranges(self, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        return (self._sums[end] - self._sums[begin]) * self._back[begin]

    def grams(self, k: int) -> np.ndarray:
        """The hash of the ``k`` numbers from each position on."""
        n = len(self._sums) - k
        return (self._sums[k:] - self._sums[:n]) * self._back[:n]


# A minimum carries its position in this many bits; longer sequences are cut into overlapping stretches.
_POSITION_BITS = 27


def least_places(grams: np.ndarray, wide: int, stretch: int = 1 << _POSITION_BITS) -> np.ndarray:
    """Where the least of each ``wide`` neighbouring numbers stands, the leftmost of equals (in all but the low bits).

    ``stretch`` numbers are taken at a time, each stretch beginning where the windows of the one before end, so the
    result does not depend on it and sequences may have any length.
    """
    # The high bits of the hash decide, then the position: one number to take minima of.
    low = np.uint64((1 << _POSITION_BITS) - 1)
    windows = len(grams) - wide + 1
    places = np.empty(max(windows, 0), np.int64)
    for begin in range(0, windows, stretch - wide + 1):
        part = grams[begin: begin + stretch]
        least, step = (part & ~low) | np.arange(len(part), dtype=np.uint64), 1
        while step * 2 <= wide:
            least = np.minimum(least[:-step], least[step:])
            step *= 2
        if step < wide:
            least = np.minimum(least[: len(least) - (wide - step)], least[wide - step:])
        places[begin: begin + len(least)] = (least & low).astype(np.int64) + begin
    return places


def least_runs(grams: Sequence[np.ndarray], wide: int, offsets: np.ndarray, length: int):
    """Runs of windows of ``wide`` grams (``length`` items) with the same least gram, the leftmost of equals.

    With several kinds of grams the windows of a run agree in all.  ``offsets`` tell where each text begins and ends among
    the items; no window leaves its text.  Returns text number, first window, number of windows, and
    the place of the least gram of each kind, per run.
    """
    none = np.zeros(0, np.int64)
    if len(grams[0]) < wide:
        return none, none, none, [none for _ in grams]
    places = [least_places(kind, wide) for kind in grams]
    n = len(places[0])
    text = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))[:n]
    valid = np.arange(n) + length <= offsets[1:][text]
    fresh = np.ones(n, bool)
    fresh[1:] = text[1:] != text[:-1]
    for place in places:
        fresh[1:] |= place[1:] != place[:-1]
    first = np.flatnonzero(fresh & valid)
    stops = np.append(np.flatnonzero(fresh | ~valid), n)
    windows = stops[np.searchsorted(stops, first, side="right")] - first
    return text[first], first, windows, [place[first] for place in places]


def word_ranges(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Begin, end and text number of every word; words never cross texts."""
    n = len(data)
    if n == 0:
        none = np.zeros(0, np.int64)
        return none, none, none
    blank = BLANK[data]
    before, after = np.empty(n, bool), np.empty(n, bool)
    before[1:], before[0] = blank[:-1], True
    after[:-1], after[-1] = blank[1:], True
    starts, ends = offsets[:-1], offsets[1:]
    before[starts[starts < n]] = True
    after[ends[ends > 0] - 1] = True
    begin = np.flatnonzero(~blank & before)
    end = np.flatnonzero(~blank & after) + 1
    return begin, end, np.searchsorted(ends, begin, side="right")


def word_grams(words: np.ndarray, width: int) -> np.ndarray:
    """Hash of every run of ``width`` words, those across texts included."""
    n = len(words) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    total = np.zeros(n, np.uint64)
    for k, factor in enumerate(numbers(width, 2) | np.uint64(1)):
        total += mix(words[k: k + n] + np.uint64(k + 1)) * factor
    return mix(total)


def shingles(words: np.ndarray, text: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash and text number of every run of ``width`` words within one text."""
    grams = word_grams(words, width)
    inside = text[: len(grams)] == text[width - 1: width - 1 + len(grams)]
    return grams[inside], text[: len(grams)][inside]
