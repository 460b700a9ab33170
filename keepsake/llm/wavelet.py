"""A wavelet matrix: a sequence of symbols as one bit-plane for each bit of their codes.

Codes are ranks among the distinct symbols, so a block with few of them has few planes. Plane by
plane, from the highest bit, the sequence is stably parted into zeros and ones. Access, counting
and lookup take a step per plane, by rank and select on packed bits.
"""

from __future__ import annotations

import numpy as np


class BitPlane:
    """n packed bits with rank (ones before a place) and select (place of the k-th zero or one)."""

    def __init__(self, packed: bytes, n: int):
        padded = packed + b"\0" * (-len(packed) % 8 + 8)
        self.n = n
        self.words = np.frombuffer(padded, "<u8")
        counts = np.bitwise_count(self.words).astype(np.int64)
        self.before = np.concatenate(([0], np.cumsum(counts)))
        self.zeros = n - int(self.before[-1])

    def bits(self) -> np.ndarray:
        raw = self.words.view(np.uint8)
        return np.unpackbits(raw, count=self.n, bitorder="little").view(np.bool_)

    def get(self, at: np.ndarray) -> np.ndarray:
        at = np.asarray(at, np.int64)
        return (self.words[at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1)

    def rank1(self, at: np.ndarray) -> np.ndarray:
        at = np.asarray(at, np.int64)
        mask = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[at >> 6] + np.bitwise_count(self.words[at >> 6] & mask)

    def select(self, bit: int, k: np.ndarray) -> np.ndarray:
        """The place of the k-th (from 0) bit of this kind."""
        k = np.asarray(k, np.int64)
        before = self.before if bit else np.arange(len(self.before)) * 64 - self.before
        word = np.searchsorted(before, k, side="right") - 1
        own = self.words[word] if bit else ~self.words[word]
        spread = np.unpackbits(own.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        inner = (np.cumsum(spread, axis=1) == (k - before[word] + 1)[:, None]).argmax(1)
        return word * 64 + inner


class WaveletMatrix:
    def __init__(self, symbols: np.ndarray, planes: list[BitPlane], n: int):
        self.symbols, self.planes, self.n = symbols, planes, n

    @staticmethod
    def pack(values: np.ndarray) -> tuple[bytes, bytes]:
        """(symbols, planes) of a sequence of unsigned 32-bit values, as bytes."""
        symbols, now = _codes(values)
        planes = []
        for bit in range(_width(len(symbols)) - 1, -1, -1):
            ones = (now & now.dtype.type(1 << bit)) != 0
            planes.append(np.packbits(ones, bitorder="little").tobytes())
            now = np.concatenate((now.take(np.flatnonzero(~ones)), now.take(np.flatnonzero(ones))))
        return symbols.astype("<u4").tobytes(), b"".join(planes)

    @classmethod
    def load(cls, symbols: bytes, planes: bytes, n: int) -> WaveletMatrix:
        known = np.frombuffer(symbols, "<u4")
        size = -(-n // 8)
        return cls(
            known,
            [BitPlane(planes[i * size : (i + 1) * size], n) for i in range(_width(len(known)))],
            n,
        )

    def all(self) -> np.ndarray:
        """The whole sequence: partings undone from the lowest plane up."""
        kind = np.uint16 if len(self.planes) <= 16 else np.uint32
        codes = np.zeros(self.n, kind)
        for bit, plane in enumerate(reversed(self.planes)):
            ones = plane.bits()
            zero_at, one_at = np.flatnonzero(~ones), np.flatnonzero(ones)
            above = np.empty_like(codes)
            above[zero_at] = codes[: len(zero_at)]
            above[one_at] = codes[len(zero_at) :] | kind(1 << bit)
            codes = above
        return self.symbols[codes] if self.n else np.zeros(0, np.uint32)

    def access(self, at) -> np.ndarray:
        """The symbols at the given places."""
        at = np.asarray(at, np.int64)
        codes = np.zeros(at.shape, np.int64)
        for plane in self.planes:
            bit, ones = plane.get(at), plane.rank1(at)
            codes = codes << 1 | bit.astype(np.int64)
            at = np.where(bit == 1, plane.zeros + ones, at - ones)
        return self.symbols[codes]

    def _range(self, symbol: int, end: int) -> tuple[int, int, int] | None:
        """(code, start, end) of the symbol's places before `end`, in the lowest order."""
        code = int(np.searchsorted(self.symbols, symbol))
        if code == len(self.symbols) or self.symbols[code] != symbol:
            return None
        a, b = 0, end
        for depth, plane in enumerate(self.planes):
            ones = plane.rank1(np.array([a, b]))
            if code >> (len(self.planes) - 1 - depth) & 1:
                a, b = (plane.zeros + ones).tolist()
            else:
                a, b = a - int(ones[0]), b - int(ones[1])
        return code, a, b

    def count(self, symbol: int, end: int | None = None) -> int:
        """How often the symbol occurs before place `end`, or at all."""
        found = self._range(symbol, self.n if end is None else end)
        return found[2] - found[1] if found else 0

    def occurrences(self, symbol: int) -> np.ndarray:
        """All places of the symbol, in order."""
        found = self._range(symbol, self.n)
        if not found:
            return np.zeros(0, np.int64)
        code, a, b = found
        at = np.arange(a, b)
        for bit, plane in enumerate(reversed(self.planes)):
            one = code >> bit & 1
            at = plane.select(one, at - plane.zeros if one else at)
        return at


def _width(n_symbols: int) -> int:
    return max(1, (n_symbols - 1).bit_length()) if n_symbols else 0


def _codes(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct values in order, and each value's rank among them."""
    if not len(values):
        return np.zeros(0, np.uint32), np.zeros(0, np.uint16)
    top = int(values.max()) + 1
    if top <= 1 << 22:  # a table of all possible values is small
        seen = np.zeros(top, bool)
        seen[values] = True
        symbols = np.flatnonzero(seen)
        rank = np.cumsum(seen) - 1
        kind = np.uint16 if len(symbols) <= 1 << 16 else np.uint32
        return symbols, rank.astype(kind)[values]
    symbols, codes = np.unique(values, return_inverse=True)
    return symbols, codes.astype(np.uint16 if len(symbols) <= 1 << 16 else np.uint32)
