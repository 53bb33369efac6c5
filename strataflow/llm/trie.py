"""Monotone sequences in Elias-Fano form, and a two-level n-gram trie made of them."""

from __future__ import annotations

import mmap

import numpy as np

from .common import U64

ONE = U64(1)


def _select_table() -> np.ndarray:
    """Place of the k-th set bit of every byte."""
    bits = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little")
    table = np.zeros((256, 8), np.uint8)
    for byte in range(256):
        where = np.flatnonzero(bits[byte])
        table[byte, : len(where)] = where
    return table


class Mapped:
    """Arrays in one anonymous memory map; no file is behind it."""

    def __init__(self, arrays: dict[str, np.ndarray]):
        size = sum(-(-a.nbytes // 8) * 8 for a in arrays.values()) or 8
        self.map = mmap.mmap(-1, size)
        self.arrays, at = {}, 0
        for name, a in arrays.items():
            view = np.frombuffer(self.map, a.dtype, a.size, at)
            view[:] = a
            self.arrays[name] = view
            at += -(-a.nbytes // 8) * 8

    def __getitem__(self, name):
        return self.arrays[name]


class EliasFano:
    """A sorted sequence of whole numbers below `bound`: low bits packed, high bits as a row of zeros and ones."""

    table = _select_table()

    def __init__(self, values: np.ndarray, bound: int):
        n = self.n = len(values)
        values = values.astype(np.uint64)
        self.low = max(0, (bound // max(n, 1)).bit_length() - 1)
        self.low = min(self.low, 62)
        high = (values >> U64(self.low)).astype(np.int64)
        self.buckets = int((bound - 1) >> self.low) + 1 if bound > 0 else 1
        ones = high + np.arange(n)
        words = np.zeros((n + self.buckets + 64) // 64 + 1, np.uint64)
        np.bitwise_or.at(words, ones >> 6, ONE << (ones & 63).astype(np.uint64))
        packed = np.zeros((n * self.low) // 64 + 2, np.uint64)
        if self.low:
            rest = values & U64((1 << self.low) - 1)
            bit = np.arange(n, dtype=np.int64) * self.low
            word, shift = bit >> 6, (bit & 63).astype(np.uint64)
            np.bitwise_or.at(packed, word, rest << shift)
            over = np.flatnonzero(shift.astype(np.int64) + self.low > 64)
            np.bitwise_or.at(packed, word[over] + 1, rest[over] >> (U64(64) - shift[over]))
        zeros = np.cumsum(64 - np.bitwise_count(words).astype(np.int64))
        self.levels = Mapped({"high": words, "low": packed, "zeros": zeros})

    def _select_zero(self, k: np.ndarray) -> np.ndarray:
        """Place of the k-th zero (from 0) in the high part."""
        zeros = self.levels["zeros"]
        word = np.searchsorted(zeros, k, "right")
        left = k - np.where(word > 0, zeros[np.maximum(word - 1, 0)], 0)
        bits = ~self.levels["high"][word]
        place, going = np.zeros(len(k), np.int64), np.ones(len(k), bool)
        for byte in range(8):
            own = ((bits >> U64(8 * byte)) & U64(255)).astype(np.int64)
            count = np.bitwise_count(own.astype(np.uint8)).astype(np.int64)
            here = going & (left < count)
            place[here] = 8 * byte + self.table[own[here], left[here]]
            going &= ~here
            left = np.where(going, left - count, left)
        return word * 64 + place

    def start(self, bucket: np.ndarray) -> np.ndarray:
        """How many values have a high part below `bucket`."""
        out = np.zeros(len(bucket), np.int64)
        some = bucket > 0
        out[some] = self._select_zero(bucket[some] - 1) - (bucket[some] - 1)
        return np.minimum(out, self.n)

    def lows(self, i: np.ndarray) -> np.ndarray:
        if not self.low:
            return np.zeros(len(i), np.uint64)
        bit = i * self.low
        word, shift = bit >> 6, (bit & 63).astype(np.uint64)
        packed = self.levels["low"]
        out = packed[word] >> shift
        over = shift.astype(np.int64) + self.low > 64
        out[over] |= packed[word[over] + 1] << (U64(64) - shift[over])
        return out & U64((1 << self.low) - 1)

    def successor(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each x the place of the first value that is not below it, and whether it is x."""
        x = x.astype(np.uint64)
        bucket = np.minimum((x >> U64(self.low)).astype(np.int64), self.buckets)
        lo, hi = self.start(bucket), self.start(np.minimum(bucket + 1, self.buckets))
        end = hi.copy()
        want = x & U64((1 << self.low) - 1) if self.low else np.zeros(len(x), np.uint64)
        live = np.flatnonzero(lo < hi)
        while len(live):
            mid = (lo[live] + hi[live]) // 2
            less = self.lows(mid) < want[live]
            lo[live[less]] = mid[less] + 1
            hi[live[~less]] = mid[~less]
            live = live[lo[live] < hi[live]]
        found = np.zeros(len(x), bool)
        some = np.flatnonzero((lo < end) & (bucket < self.buckets))
        found[some] = self.lows(lo[some]) == want[some]
        return lo, found

    def nbytes(self) -> int:
        return sum(a.nbytes for a in self.levels.arrays.values())


#: A code is a probability's logarithm in steps; 0 means that the gram is absent.
DEEPEST, CODES = -9.0, 255


def quantise(p: np.ndarray) -> np.ndarray:
    step = np.rint((np.log10(np.maximum(p, 1e-300)) - DEEPEST) / -DEEPEST * (CODES - 1))
    return (1 + np.clip(step, 0, CODES - 1)).astype(np.uint8)


def meaning() -> np.ndarray:
    """Probability of each code."""
    out = 10 ** (DEEPEST + (np.arange(CODES + 1) - 1) * (-DEEPEST / (CODES - 1)))
    out[0] = 0
    return out


class Trie:
    """Contexts, their successors, and a code for each pair.

    Contexts and words are sorted 64-bit keys in Elias-Fano form. A successor is numbered within its context's range:
    context number times words plus word number, so all pairs are one rising sequence, and a pair is found by one
    successor search over all of them.
    """

    def __init__(self, context: np.ndarray, word: np.ndarray, probability: np.ndarray, bits: int = 64):
        order = np.lexsort((word, context))
        contexts, a = np.unique(context, return_inverse=True)
        words, b = np.unique(word, return_inverse=True)
        self.contexts, self.words = EliasFano(contexts, 1 << 64), EliasFano(words, 1 << bits)
        self.width = max(len(words), 1)
        pairs = a.astype(np.int64) * self.width + b
        self.pairs = EliasFano(pairs[order], max(len(contexts), 1) * self.width)
        self.codes = Mapped({"codes": quantise(probability)[order]})["codes"]

    def find(self, context: np.ndarray, word: np.ndarray) -> np.ndarray:
        """Codes of (context, word) pairs, 0 where absent."""
        out = np.zeros(len(context), np.uint8)
        if not self.pairs.n:
            return out
        a, ok_a = self.contexts.successor(context)
        b, ok_b = self.words.successor(word)
        some = np.flatnonzero(ok_a & ok_b)
        i, ok = self.pairs.successor(a[some] * self.width + b[some])
        out[some[ok]] = self.codes[i[ok]]
        return out
