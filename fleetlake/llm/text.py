"""Words and windows of many texts as numpy arrays, inside a task.

Words are runs of bytes that are not ASCII white space. A word's hash is 64 bits of a polynomial
in its bytes, so hashing costs a few operations per byte and none per word in Python.
"""

from __future__ import annotations

import numpy as np

_WHITE = np.zeros(256, bool)
_WHITE[[9, 10, 11, 12, 13, 32]] = True
_SEGMENT = 1 << 20
_BASE = 0x9E3779B97F4A7C55  # odd, so it has an inverse modulo 2**64


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values in which every input bit moves every output bit."""
    x = x.astype(np.uint64, copy=True)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x ^= x >> np.uint64(shift)
        x *= np.uint64(factor)
    x ^= x >> np.uint64(31)
    return x


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


class _Polynomial:
    """Hashes of spans of a sequence of 64-bit values, by prefix sums."""

    def __init__(self, base: int):
        self.base, self.inverse = base, pow(base, -1, 1 << 64)
        self.up = self.down = np.ones(1, np.uint64)

    def spans(self, values: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        n = len(values) + 1
        if n > len(self.up):
            self.up, self.down = _powers(self.base, 2 * n), _powers(self.inverse, 2 * n)
        sums = np.zeros(n, np.uint64)
        np.cumsum(values * self.up[: n - 1], out=sums[1:])
        return mix((sums[last] - sums[first]) * self.down[first] + (last - first).astype(np.uint64))


_BYTES = mix(np.arange(1, 257, dtype=np.uint64))
_LOWER = np.arange(256)
_LOWER[65:91] += 32
_LOWER_BYTES = _BYTES[_LOWER]
_BY_BYTE = _Polynomial(_BASE)
_BY_WORD = _Polynomial(0xD1342543DE82EF95)
_BY_WORD_CHECK = _Polynomial(0xA0761D6478BD642F)


def word_spans(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of every word of a byte array."""
    inside = np.zeros(len(data) + 2, np.int8)
    inside[1:-1] = ~_WHITE[data]
    edges = np.diff(inside)
    return np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)


class Words:
    """The words of several texts: ``hashes``, ``text`` (index of its text), spans in ``data``."""

    def __init__(self, texts: list[bytes], lower: bool = False):
        self.data = np.frombuffer(b" ".join(texts), np.uint8)
        lengths = np.fromiter(map(len, texts), np.int64, len(texts))
        self.begins = np.concatenate([[0], np.cumsum(lengths + 1)])[: len(texts)].astype(np.int64)
        self.first, self.last = word_spans(self.data)
        self.text = np.searchsorted(self.begins, self.first, side="right") - 1
        # bounds[i], bounds[i + 1]: the words of text i.
        self.bounds = np.searchsorted(self.first, np.append(self.begins, len(self.data) + 1))
        self.hashes = self._hash(_LOWER_BYTES if lower else _BYTES)

    def _hash(self, table: np.ndarray) -> np.ndarray:
        out, at = np.empty(len(self.first), np.uint64), 0
        while at < len(self.first):
            # A segment of about a megabyte that ends with a word, so temporary arrays stay small.
            start = self.first[at]
            stop = max(at + 1, int(np.searchsorted(self.last, start + _SEGMENT)))
            values = table[self.data[start : self.last[stop - 1]]]
            out[at:stop] = _BY_BYTE.spans(values, self.first[at:stop] - start, self.last[at:stop] - start)
            at = stop
        return out

    def windows(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """First word and hash of every run of ``k`` words of one text."""
        n = len(self.hashes) - k + 1
        if n <= 0:
            return np.empty(0, np.int64), np.empty(0, np.uint64)
        starts = np.flatnonzero(self.text[:n] == self.text[k - 1 :])
        out = np.empty(len(starts), np.uint64)
        for at in range(0, len(starts), _SEGMENT):
            part = starts[at : at + _SEGMENT]
            low = part[0]
            out[at : at + _SEGMENT] = _BY_WORD.spans(self.hashes[low : part[-1] + k], part - low, part - low + k)
        return starts, out

    def check(self, starts: np.ndarray, k: int) -> np.ndarray:
        """A second hash, of 32 bits, of the runs of ``k`` words at ascending ``starts``."""
        out = np.empty(len(starts), np.uint32)
        for at in range(0, len(starts), _SEGMENT):
            part = starts[at : at + _SEGMENT]
            low = part[0]
            spans = _BY_WORD_CHECK.spans(self.hashes[low : part[-1] + k], part - low, part - low + k)
            out[at : at + _SEGMENT] = spans >> np.uint64(32)
        return out

    def words_of(self, i: int) -> np.ndarray:
        return self.hashes[self.bounds[i] : self.bounds[i + 1]]


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Place of the leftmost least value of each run of ``width``."""
    n = len(values) - width + 1
    best, place = values[:n].copy(), np.arange(n)
    for j in range(1, width):
        less = values[j : j + n] < best
        best[less] = values[j : j + n][less]
        place[less] = np.flatnonzero(less) + j
    return place
