"""Elias-Fano coded monotone sequences, queried for many positions at once."""

from __future__ import annotations

import numpy as np

_U = np.uint64
STEP = 16        # every so many ones (zeros) their position is noted
_EACH, _TOP = _U(0x0101010101010101), _U(0x8080808080808080)      # ones, high bits of all bytes
# the place of the k-th one in a byte, at 8 * byte + k
_IN_BYTE = np.array([([p for p in range(8) if b >> p & 1] + [0] * 8)[k]
                     for b in range(256) for k in range(8)], _U)


def _place(w: np.ndarray, k: np.ndarray) -> np.ndarray:
    """The bit of the k-th one in each word ``w``, which has more than k ones: its
    byte by comparing k with the ones up to each byte, then a table."""
    x = w - ((w >> _U(1)) & _U(0x5555555555555555))
    x = (x & _U(0x3333333333333333)) + ((x >> _U(2)) & _U(0x3333333333333333))
    x = ((x + (x >> _U(4))) & _U(0x0F0F0F0F0F0F0F0F)) * _EACH
    byte = np.bitwise_count((((k * _EACH) | _TOP) - x) & _TOP).astype(_U) << _U(3)
    k = k - (((x << _U(8)) >> byte) & _U(255))
    return byte + _IN_BYTE[((((w >> byte) & _U(255)) << _U(3)) | k).astype(np.int64)]


class EliasFano:
    """A non-decreasing sequence of unsigned integers.

    The low bits of each value are packed; the high bits are a unary bit vector
    in which the i-th one stands at ``high(i) + i``.
    """

    def __init__(self, arrays: dict[str, np.ndarray], prefix: str = ""):
        self.n, self.bits = (int(x) for x in arrays[prefix + "meta"])
        self.low, self.high = arrays[prefix + "low"], arrays[prefix + "high"]
        self.ones, self.zeros = arrays[prefix + "ones"], arrays[prefix + "zeros"]
        self.before = arrays[prefix + "before"]

    @staticmethod
    def encode(values: np.ndarray, prefix: str = "") -> dict[str, np.ndarray]:
        v = np.asarray(values, _U)
        n = len(v)
        top = int(v[-1]) + 1 if n else 1
        bits = max(0, (top // max(1, n)).bit_length() - 1)
        low = np.zeros((n * bits + 63) // 64 + 2, _U)
        if bits:
            part = v & _U((1 << bits) - 1)
            at = np.arange(n, dtype=_U) * _U(bits)
            word, off = (at >> _U(6)).astype(np.int64), at & _U(63)
            # values are disjoint in bits, so adding is setting
            np.add.at(low, word, part << off)
            over = off + _U(bits) > _U(64)
            np.add.at(low, word[over] + 1, part[over] >> (_U(64) - off[over]))
        one = (v >> _U(bits)).astype(np.int64) + np.arange(n)
        size = (int(one[-1]) if n else 0) + 2
        flags = np.zeros(-(-size // 64) * 64 + 64, np.uint8)
        flags[one] = 1
        high = np.packbits(flags, bitorder="little").view(_U)
        zero = np.flatnonzero(flags == 0)
        before = np.cumsum(np.bitwise_count(high), dtype=np.int64) - np.bitwise_count(high)
        return {prefix + "meta": np.array([n, bits], np.int64), prefix + "low": low,
                prefix + "high": high, prefix + "before": before.astype(np.uint32), prefix + "ones": one[::STEP].astype(np.uint32),
                prefix + "zeros": zero[::STEP].astype(np.uint32)}

    def _select(self, i: np.ndarray, marks: np.ndarray, flip: bool) -> np.ndarray:
        """Bit position of the i-th one (zero, if ``flip``).

        Two marks bound the word; between them the counts of ones before each
        word are searched by halves, so crowded or empty stretches cost little."""
        i = i.astype(np.int64)
        m = i >> 4
        lo = (marks[m] >> 6).astype(np.int64)
        hi = (marks[np.minimum(m + 1, len(marks) - 1)] >> 6).astype(np.int64)
        hi = np.where(m + 1 < len(marks), hi, len(self.high) - 1)

        def before(word):
            ones = self.before[word].astype(np.int64)
            return (word << 6) - ones if flip else ones

        act = np.flatnonzero(lo < hi)
        while len(act):
            mid = (lo[act] + hi[act] + 1) >> 1
            up = before(mid) <= i[act]
            lo[act] = np.where(up, mid, lo[act])
            hi[act] = np.where(up, hi[act], mid - 1)
            act = act[lo[act] < hi[act]]
        word, k = lo, i - before(lo)
        w = self.high[word]
        if flip:
            w = ~w
        return (word << 6) + _place(w, k.astype(_U)).astype(np.int64)

    def _low(self, i: np.ndarray) -> np.ndarray:
        if not self.bits:
            return np.zeros(len(i), _U)
        at = i.astype(_U) * _U(self.bits)
        word, off = (at >> _U(6)).astype(np.int64), at & _U(63)
        x = (self.low[word] >> off) | ((self.low[word + 1] << _U(1)) << (_U(63) - off))
        return x & _U((1 << self.bits) - 1)

    def access(self, i: np.ndarray) -> np.ndarray:
        """The values at positions ``i``."""
        i = np.asarray(i, np.int64)
        if not len(i):
            return np.empty(0, _U)
        high = self._select(i, self.ones, False) - i
        return (high.astype(_U) << _U(self.bits)) | self._low(i)

    def access_two(self, i: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The values at ``i`` and at ``i + 1``, whose one mostly stands in the same word."""
        i = np.asarray(i, np.int64)
        if not len(i):
            return np.empty(0, _U), np.empty(0, _U)
        at = self._select(i, self.ones, False)
        rest = (self.high[at >> 6] >> (at & 63).astype(_U)) >> _U(1)
        after = at + 1 + np.bitwise_count((rest & (~rest + _U(1))) - _U(1))
        far = np.flatnonzero(rest == 0)
        after[far] = self._select(i[far] + 1, self.ones, False)
        return (((at - i).astype(_U) << _U(self.bits)) | self._low(i),
                ((after - i - 1).astype(_U) << _U(self.bits)) | self._low(i + 1))

    def find(self, value: np.ndarray) -> np.ndarray:
        """The position of each value's first occurrence, -1 where there is none:
        the values with its high bits, then a successor search in their low bits."""
        value = np.asarray(value, _U)
        out = np.full(len(value), -1, np.int64)
        if not self.n or not len(value):
            return out
        h = (value >> _U(self.bits)).astype(np.int64)
        # the last high part has its closing zero in the vector's padding
        last = int(self.access(np.array([self.n - 1]))[0]) >> self.bits
        ok = np.flatnonzero(h <= last)
        h = h[ok]
        # a high part's values are the ones between two zeros
        begin = np.zeros(len(h), np.int64)
        some = np.flatnonzero(h > 0)
        begin[some] = self._select(h[some] - 1, self.zeros, True) + 1
        lo = begin - h
        off = (begin & 63).astype(_U)
        rest = ~(self.high[begin >> 6] >> off)
        run = np.bitwise_count((rest & (~rest + _U(1))) - _U(1)).astype(np.int64)
        end = lo + run
        far = np.flatnonzero(run >= 64 - (begin & 63))      # the run leaves its word
        end[far] = self._select(h[far], self.zeros, True) - h[far]
        want = value[ok] & _U((1 << self.bits) - 1)
        hi = end.copy()
        act = np.flatnonzero(lo < hi)
        while len(act):
            mid = (lo[act] + hi[act]) >> 1
            less = self._low(mid) < want[act]
            lo[act] = np.where(less, mid + 1, lo[act])
            hi[act] = np.where(less, hi[act], mid)
            act = act[lo[act] < hi[act]]
        hit = np.flatnonzero(lo < end)
        hit = hit[self._low(lo[hit]) == want[hit]]
        out[ok[hit]] = lo[hit]
        return out
