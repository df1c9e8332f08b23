"""Elias-Fano coded monotone sequences over numpy arrays, made to be read from memory-mapped bytes.

Values keep their low bits packed; their high bits are a unary bit vector whose zeros separate buckets. The zeros before
each 64-bit word are stored, so many values are searched for at once: a select and the next zero give a value's bucket. An
interpolation search over the bucket's low bits (of 52 bits at most) finds it.
"""

from __future__ import annotations

import functools

import numpy as np

_U = np.uint64
_ONES = np.array([bin(i).count("1") for i in range(256)], np.uint8)
# The place of one number r in a byte, at r * 256 + byte.
_IN_BYTE = np.array([[*(i for i in range(8) if b >> i & 1), *[0] * 8][r] for r in range(8) for b in range(256)], np.int64)
_EACH, _TOP = _U(0x0101010101010101), _U(0x8080808080808080)  # the lowest and the highest bit of each byte


def encode(values: np.ndarray, universe: int) -> bytes:
    """Sorted distinct or repeated ``values`` below ``universe``."""
    n = values.size
    low_bits = min(52, max(0, (universe // n).bit_length() - 1)) if n else 0
    values = values.astype(_U, copy=False)
    high = (values >> _U(low_bits)).astype(np.int64) if n else np.zeros(0, np.int64)
    length = n + ((universe - 1) >> low_bits if universe else 0) + 1 if n else 0
    vector = np.zeros(-(-length // 64) * 64, bool)
    vector[high + np.arange(n)] = True
    packed = np.packbits(vector, bitorder="little")
    zeros = np.zeros(packed.size // 8 + 1, "<u8")
    zeros[1:] = np.cumsum(64 - _ONES[packed].reshape(-1, 8).sum(1, dtype=np.int64))
    lows = [np.zeros(0, np.uint8)]
    shifts = np.arange(low_bits, dtype=_U)
    for a in range(0, n if low_bits else 0, 1 << 16):  # a multiple of 8 values, so blocks end on whole bytes
        bits = ((values[a : a + (1 << 16), None] >> shifts) & _U(1)).astype(np.uint8)
        lows.append(np.packbits(bits.reshape(-1), bitorder="little"))
    low = np.concatenate(lows)
    low = np.concatenate([low, np.zeros(16 - low.size % 8, np.uint8)])
    head = np.array([n, low_bits, zeros.size, packed.size, low.size], "<i8")
    return head.tobytes() + zeros.tobytes() + packed.tobytes() + low.tobytes()


class EliasFano:
    """Reads what ``encode`` wrote, in place. ``size`` is the number of bytes that it takes."""

    def __init__(self, data: np.ndarray):
        self.n, bits, n_zeros, n_packed, n_low = data[:40].view("<i8").tolist()
        self.bits = _U(bits)
        at = 40
        self.zeros = data[at : (at := at + 8 * n_zeros)].view("<u8")
        self.high = data[at : (at := at + n_packed)]
        low = data[at : (at := at + n_low)]
        self.low = np.ndarray((max(0, n_low - 7),), "<u8", low, 0, (1,))  # the eight bytes from each byte on
        self.size = at

    def _lows(self, i: np.ndarray) -> np.ndarray:
        if not self.bits:
            return np.zeros(i.size, _U)
        bit = i * int(self.bits)
        return (self.low[bit >> 3] >> (bit & 7).view(_U)) & ((_U(1) << self.bits) - _U(1))

    @functools.cached_property
    def ones(self) -> np.ndarray:
        """The ones before each 64-bit word of the high bits."""
        return (np.arange(self.zeros.size, dtype=np.int64) << 6) - self.zeros.astype(np.int64)

    @staticmethod
    def _pick(word: np.ndarray, rest: np.ndarray) -> np.ndarray:
        """Position of one number ``rest`` in each 64-bit word: its byte by sums of ones up to each byte, then a table."""
        sums = word - ((word >> _U(1)) & _U(0x5555555555555555))
        sums = (sums & _U(0x3333333333333333)) + ((sums >> _U(2)) & _U(0x3333333333333333))
        sums = ((sums + (sums >> _U(4))) & _U(0x0F0F0F0F0F0F0F0F)) * _EACH
        rest = rest.astype(_U, copy=False)
        place = np.bitwise_count(((rest * _EACH | _TOP) - sums) & _TOP).astype(_U) << _U(3)  # bytes that end before it
        rest = rest - ((sums << _U(8)) >> place & _U(255))
        return place.view(np.int64) + _IN_BYTE[(rest << _U(8) | (word >> place & _U(255))).view(np.int64)]

    def _select_zero(self, j: np.ndarray) -> np.ndarray:
        """Position of zero number ``j`` in the high bits."""
        word = np.searchsorted(self.zeros, j.astype(np.uint64), "right") - 1
        return word * 64 + self._pick(~self.high.view("<u8")[word], j - self.zeros[word].astype(np.int64))

    def _next_zero(self, j: np.ndarray, place: np.ndarray) -> np.ndarray:
        """Position of zero number ``j``, the first one from ``place`` on: mostly in the same word, else it is selected."""
        rest = ~self.high.view("<u8")[place >> 6] >> (place & 63).astype(_U)
        out = place + np.bitwise_count((rest & (~rest + _U(1))) - _U(1))
        far = np.flatnonzero(rest == 0)
        out[far] = self._select_zero(j[far])
        return out

    def at(self, i: np.ndarray) -> np.ndarray:
        """The values at these places."""
        word = np.searchsorted(self.ones, i, "right") - 1
        high = word * 64 + self._pick(self.high.view("<u8")[word], i - self.ones[word]) - i
        return (high.astype(_U) << self.bits) | self._lows(i)

    def find(self, values: np.ndarray) -> np.ndarray:
        """Index of each value, or -1."""
        out = np.full(values.size, -1, np.int64)
        if not self.n or not values.size:
            return out
        values = values.astype(_U, copy=False)
        high = (values >> self.bits).astype(np.int64)
        some = np.flatnonzero(high < int(self.zeros[-1]))
        high, want = high[some], values[some] & ((_U(1) << self.bits) - _U(1))
        new = np.ones(high.size, bool)  # neighbours often ask for one bucket
        new[1:] = high[1:] != high[:-1]
        bucket = high[new]
        begin = np.zeros_like(bucket)
        later = np.flatnonzero(bucket > 0)
        begin[later] = self._select_zero(bucket[later] - 1) + 1 - bucket[later]
        end = np.minimum(self._next_zero(bucket, begin + bucket) - bucket, self.n)
        place = np.cumsum(new) - 1
        begin, end = np.minimum(begin, end)[place], end[place]
        live = np.flatnonzero(begin < end)
        at, lo, hi, want = some[live], begin[live], end[live], want[live]
        below, above, turn = np.zeros(live.size), np.full(live.size, float(1 << int(self.bits))), 0
        while at.size:  # interpolation, as ids are spread evenly; every third turn halves, whatever the spread
            n = hi - lo
            step = n >> 1 if turn % 3 == 2 else np.minimum(((want - below) / (above - below) * n).astype(np.int64), n - 1)
            mid = lo + step
            value = self._lows(mid)
            hit = value == want
            out[at[hit]] = mid[hit]
            less = value < want
            lo, hi = np.where(less, mid + 1, lo), np.where(less, hi, mid)
            below, above = np.where(less, value, below), np.where(less, above, value)
            stay = np.flatnonzero(~hit & (lo < hi))
            at, lo, hi, want, below, above, turn = at[stay], lo[stay], hi[stay], want[stay], below[stay], above[stay], turn + 1
        return out

    def values(self) -> np.ndarray:
        """All values in order."""
        at = np.flatnonzero(np.unpackbits(self.high, bitorder="little"))
        i = np.arange(self.n)
        return ((at - i).astype(_U) << self.bits) | self._lows(i)
