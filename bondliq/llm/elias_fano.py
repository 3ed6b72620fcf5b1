"""Elias-Fano coding of rising sequences, with vectorised search."""

from __future__ import annotations

import numpy as np

U64 = np.uint64
#: values coded or decoded at once
CHUNK = 500_000


#: 0x01 and 0x80 in each byte, and where bit number r of a byte's set bits is, by 8 byte + r
ONES, TOPS = U64(0x0101010101010101), U64(0x8080808080808080)
IN_BYTE = np.array([([i for i in range(8) if b >> i & 1] + 8 * [0])[r] for b in range(256) for r in range(8)], dtype=np.int64)


def _pick(words: np.ndarray, r: np.ndarray) -> np.ndarray:
    """Position of the set bit number ``r`` (from 0) of each 64-bit word."""
    r = r.astype(U64)
    s = words - ((words >> U64(1)) & U64(0x5555555555555555))
    s = (s & U64(0x3333333333333333)) + ((s >> U64(2)) & U64(0x3333333333333333))
    s = ((s + (s >> U64(4))) & U64(0x0F0F0F0F0F0F0F0F)) * ONES  # set bits up to each byte
    before = (((((r * ONES) | TOPS) - s) & TOPS) >> U64(7)) * ONES >> U64(56)  # bytes before the bit's
    at = np.minimum(before, U64(7)) << U64(3)
    r = r - (((s << U64(8)) >> at) & U64(255))
    return at.astype(np.int64) + IN_BYTE[((((words >> at) & U64(255)) << U64(3)) | (r & U64(7))).astype(np.int64)]


class EliasFano:
    """``n`` values that do not fall. The low bits lie in a flat array; the high bits
    are a bit vector in which value ``i`` sets bit (high + i), so a block of equal high
    parts is found by counting zeros. ``ones`` and ``zeros`` count the set bits before each
    word and the others."""

    FIELDS = ("shape", "low", "high", "ones", "zeros")

    def __init__(self, shape, low, high, ones, zeros):
        self.shape, self.low, self.high, self.ones, self.zeros = shape, low, high, ones, zeros
        self.n, self.bits, self.top = (int(x) for x in shape)

    @classmethod
    def build(cls, values: np.ndarray) -> EliasFano:
        n, top = len(values), int(values[-1]) if len(values) else 0
        bits = max(0, (top // max(n, 1)).bit_length() - 1)
        kind = next(t for t in (np.uint8, np.uint16, np.uint32, np.uint64) if bits <= np.dtype(t).itemsize * 8)
        low, words = np.empty(n, dtype=kind), np.zeros((n + (top >> bits)) // 64 + 2, dtype=U64)
        for i in range(0, n, CHUNK):
            v = values[i:i + CHUNK].astype(U64)
            at = (v >> U64(bits)).astype(np.int64) + np.arange(i, i + len(v))
            np.bitwise_or.at(words, at // 64, U64(1) << (at % 64).astype(U64))
            low[i:i + CHUNK] = v & U64((1 << bits) - 1)
        ones = np.concatenate([[0], np.cumsum(np.bitwise_count(words[:-1]), dtype=np.int64)])
        return cls(np.array([n, bits, top]), low, words, ones, 64 * np.arange(len(ones), dtype=np.int64) - ones)

    def arrays(self) -> dict[str, np.ndarray]:
        return {f: getattr(self, f) for f in self.FIELDS}

    def _before_zero(self, k: np.ndarray) -> np.ndarray:
        """Values before zero number ``k`` of the high bits (0 for k < 0)."""
        some = np.maximum(k, 0)
        w = np.searchsorted(self.zeros, some, side="right") - 1
        at = 64 * w + _pick(~self.high[w], some - self.zeros[w])
        return np.where(k < 0, 0, at - some)

    def get(self, i: np.ndarray) -> np.ndarray:
        """The values at positions ``i``."""
        w = np.searchsorted(self.ones, i, side="right") - 1
        at = 64 * w + _pick(self.high[w], i - self.ones[w])
        return ((at - i) << self.bits) | self.low[i].astype(np.int64)

    def successor(self, x: np.ndarray) -> np.ndarray:
        """Position of the first value that is not below ``x``."""
        x = np.asarray(x, dtype=np.int64)
        inside = np.clip(x, 0, self.top)
        h, low = inside >> self.bits, inside & ((1 << self.bits) - 1)
        begin, end = self._before_zero(h - 1), self._before_zero(h)
        stop = end.copy()
        while (open_ := begin < end).any():  # halve all blocks at once
            mid = (begin + end) >> 1
            less = open_ & (self.low[np.minimum(mid, self.n - 1)].astype(np.int64) < low)
            begin, end = np.where(less, mid + 1, begin), np.where(open_ & ~less, mid, end)
        return np.where(x > self.top, self.n, np.minimum(begin, stop))

    def all(self) -> np.ndarray:
        """All values."""
        out = np.flatnonzero(np.unpackbits(self.high.view(np.uint8), bitorder="little"))
        for i in range(0, self.n, CHUNK):
            some = out[i:i + CHUNK]
            some -= np.arange(i, i + len(some))
            some <<= self.bits
            some |= self.low[i:i + CHUNK].astype(np.int64)
        return out

    def find(self, x: np.ndarray) -> np.ndarray:
        """Position of ``x``, or -1. Values must differ from one another."""
        x = np.asarray(x, dtype=np.int64)
        if not self.n:
            return np.full(len(x), -1, dtype=np.int64)
        inside = np.clip(x, 0, self.top)
        h, low = inside >> self.bits, (inside & ((1 << self.bits) - 1)).astype(self.low.dtype)
        begin, end = self._before_zero(h - 1), self._before_zero(h)
        ok = (begin < end) & (x == inside)
        some = np.flatnonzero(ok & (end - begin > 1))
        begin_, end_, low_ = begin[some], end[some], low[some]
        while len(some):  # halve the blocks that have several values
            mid = (begin_ + end_) >> 1
            above = self.low[mid] > low_
            begin_, end_ = np.where(above, begin_, mid), np.where(above, mid, end_)
            begin[some] = begin_
            more = end_ - begin_ > 1
            some, begin_, end_, low_ = some[more], begin_[more], end_[more], low_[more]
        at = np.minimum(begin, self.n - 1)
        return np.where(ok & (self.low[at] == low), at, -1)
