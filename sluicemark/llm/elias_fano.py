"""Elias-Fano sequences and the n-gram trie shard built of them, in memory-mapped arrays."""

from __future__ import annotations

from pathlib import Path

import numpy as np

STEPS = 4096  # quantisation steps per factor of ten
_MOST_CODE = 0x7FFF


def quantise(probabilities: np.ndarray) -> np.ndarray:
    """Codes from 1 up, in steps of -log10; 0 is left for what is not there."""
    return np.minimum(np.rint(-np.log10(probabilities) * STEPS) + 1, _MOST_CODE).astype(np.int16)


_OF_CODE = np.append(0.0, 10.0 ** (-np.arange(_MOST_CODE) / STEPS))


def probability(codes: np.ndarray) -> np.ndarray:
    return _OF_CODE[codes]


def _packed(values: np.ndarray, width: int) -> np.ndarray:
    """Values of ``width`` bits one after the other in 64-bit words, and one word more."""
    words = np.zeros(len(values) * width // 64 + 2, dtype=np.uint64)
    if width:
        at = np.arange(len(values), dtype=np.int64) * width
        word, shift = at >> 6, (at & 63).astype(np.uint64)
        np.bitwise_or.at(words, word, values << shift)
        over = shift + np.uint64(width) > 64
        np.bitwise_or.at(words, word[over] + 1, values[over] >> (np.uint64(64) - shift[over]))
    return words


_ONES, _HIGHS = np.uint64(0x0101010101010101), np.uint64(0x8080808080808080)
_IN_BYTE = np.array([[([i for i in range(8) if b >> i & 1] + [0] * 8)[k] for k in range(8)] for b in range(256)], dtype=np.uint8).reshape(-1)


def _select(words: np.ndarray, nth: np.ndarray) -> np.ndarray:
    """Place of the ``nth`` (from 0) set bit of each word: the byte first, from sums of ones per byte, then the bit in it."""
    pairs = words - ((words >> np.uint64(1)) & np.uint64(0x5555555555555555))
    fours = (pairs & np.uint64(0x3333333333333333)) + ((pairs >> np.uint64(2)) & np.uint64(0x3333333333333333))
    sums = (((fours + (fours >> np.uint64(4))) & np.uint64(0x0F0F0F0F0F0F0F0F)) * _ONES).view(np.uint64)  # ones up to each byte
    nth = nth.astype(np.uint64)
    full = ((nth * _ONES) | _HIGHS) - sums  # a byte keeps its high bit where its sum is at most nth
    byte = (np.bitwise_count(full & _HIGHS) << 3).astype(np.uint64)
    before = ((sums << np.uint64(8)) >> byte) & np.uint64(0xFF)
    octet = (words >> byte) & np.uint64(0xFF)
    return byte.astype(np.int64) + _IN_BYTE[((octet << np.uint64(3)) + nth - before).astype(np.int64)]


class EliasFano:
    """A non-decreasing sequence: low bits packed, high bits in unary with counts of ones per word."""

    def __init__(self, n: int, width: int, low: np.ndarray, high: np.ndarray, ones: np.ndarray):
        self.n, self.width, self.low, self.high, self.ones = n, width, low, high, ones
        self.zeros = np.arange(len(ones), dtype=np.int64) * 64 - ones  # before each word

    @staticmethod
    def write(values: np.ndarray, folder: Path, name: str) -> EliasFano:
        n = len(values)
        universe = int(values[-1]) + 1 if n else 1
        width = max(0, (universe // max(n, 1)).bit_length() - 1)
        bits = (values >> width).astype(np.int64) + np.arange(n)
        high = np.zeros((n + (universe >> width)) // 64 + 2, dtype=np.uint64)
        np.bitwise_or.at(high, bits >> 6, np.uint64(1) << (bits & 63).astype(np.uint64))
        ones = np.concatenate([[0], np.cumsum(np.bitwise_count(high), dtype=np.int64)])[:-1]
        low = _packed(values.astype(np.uint64) & np.uint64((1 << width) - 1), width)
        return EliasFano(n, width, *[mapped(a, folder, f"{name}-{i}") for i, a in enumerate((low, high, ones))])

    def _low(self, at: np.ndarray) -> np.ndarray:
        if not self.width:
            return np.zeros(len(at), dtype=np.int64)
        bit = at * self.width
        word, shift = bit >> 6, (bit & 63).astype(np.uint64)
        # A shift by 64 is not defined, so the next word's part is shifted in two steps.
        found = (self.low[word] >> shift) | ((self.low[word + 1] << (np.uint64(63) - shift)) << np.uint64(1))
        return (found & np.uint64((1 << self.width) - 1)).astype(np.int64)

    def access(self, at: np.ndarray) -> np.ndarray:
        """Values at the given places."""
        word = np.searchsorted(self.ones, at, "right") - 1
        place = word * 64 + _select(self.high[word], at - self.ones[word])
        return ((place - at) << self.width) | self._low(at)

    def _before(self, part: np.ndarray) -> np.ndarray:
        """How many values have a high part smaller than ``part``."""
        nth = np.maximum(part - 1, 0)
        word = np.minimum(np.searchsorted(self.zeros, nth, "right") - 1, len(self.high) - 1)
        place = word * 64 + _select(~self.high[word], nth - self.zeros[word])
        return np.where(part > 0, np.minimum(place - nth, self.n), 0)

    def _bucket(self, part: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where the values of a high part begin and end."""
        first = self._before(part)
        # Its values are the ones that follow in unary; up to 63 of them show in one word's width.
        place = first + part
        word, shift = place >> 6, (place & 63).astype(np.uint64)
        ahead = ~((self.high[word] >> shift) | ((self.high[np.minimum(word + 1, len(self.high) - 1)] << (np.uint64(63) - shift)) << np.uint64(1)))
        run = np.bitwise_count((ahead & (~ahead + np.uint64(1))) - np.uint64(1)).astype(np.int64)
        end = first + run
        if len(long := np.flatnonzero(run >= 64)):
            end[long] = self._before(part[long] + 1)
        return first, np.minimum(end, self.n)

    def successor(self, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Place of the first value that is not smaller (``n`` if there is none), and whether it is equal."""
        last = int(self.access(np.array([self.n - 1]))[0]) if self.n else -1
        beyond = values > last
        asked = np.where(beyond, 0, values)
        first, end = self._bucket(asked >> self.width)
        low, stop = asked & ((1 << self.width) - 1), end.copy()
        at = np.flatnonzero(first < end)
        while len(at):  # binary search among values of one high part
            middle = (first[at] + end[at]) >> 1
            smaller = self._low(middle) < low[at]
            first[at[smaller]], end[at[~smaller]] = middle[smaller] + 1, middle[~smaller]
            at = at[first[at] < end[at]]
        equal = (first < stop) & ~beyond
        at = np.flatnonzero(equal)
        equal[at] = self._low(first[at]) == low[at]
        return np.where(beyond, self.n, first), equal


def mapped(values: np.ndarray, folder: Path, name: str) -> np.ndarray:
    """The array written to a file and mapped back for reading."""
    if not len(values):
        return values
    path = folder / name
    values.tofile(path)
    return np.memmap(path, dtype=values.dtype, mode="r")


class TrieShard:
    """Contexts, each with its successors in order.

    Contexts and pointers are monotone.  A successor is kept relative to its context: its word is added to the last
    value of the context before, so that all of a level is one monotone sequence and a word is found by one successor search.
    """

    def __init__(self, contexts: np.ndarray, words: np.ndarray, probabilities: np.ndarray, counts: np.ndarray, folder: Path):
        """Entries sorted by context and word, each pair once."""
        own, starts = np.unique(contexts, return_index=True)
        bounds = np.concatenate([starts, [len(contexts)]]).astype(np.int64)
        base = np.concatenate([[0], np.cumsum(words[bounds[1:] - 1] + 1)])[:-1] if len(own) else np.zeros(0, dtype=np.int64)
        self.contexts = EliasFano.write(own.astype(np.int64), folder, "contexts")
        self.pointers = EliasFano.write(bounds, folder, "pointers")
        self.successors = EliasFano.write(words + np.repeat(base, np.diff(bounds)), folder, "successors")
        self.codes = mapped(quantise(probabilities), folder, "codes")
        self.counts = mapped(counts.astype(np.min_scalar_type(int(counts.max()) if len(counts) else 0)), folder, "counts")

    def find(self, contexts: np.ndarray, sizes: np.ndarray, words: np.ndarray) -> np.ndarray:
        """Place of each asked successor, -1 where it is not there; ``contexts[i]`` is asked for its next ``sizes[i]`` of ``words``."""
        found = np.full(len(words), -1, dtype=np.int64)
        if not self.contexts.n or not len(words):
            return found
        node, known = self.contexts.successor(contexts)
        node = node[known]
        first, end = self.pointers.access(node), self.pointers.access(node + 1)
        base = np.where(first > 0, self.successors.access(np.maximum(first - 1, 0)) + 1, 0)
        there = np.flatnonzero(np.repeat(known, sizes))
        asked = words[there] + np.repeat(base, sizes[known])
        place, equal = self.successors.successor(asked)
        inside = equal & (place < np.repeat(end, sizes[known]))
        found[there[inside]] = place[inside]
        return found
