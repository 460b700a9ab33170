"""Vectorised work on batches of texts inside Arrow tasks: code points, words, hashes.

Every hash is a function of the characters alone, so it is the same in every task and run. Texts
go in whole; batches are cut between texts so that the arrays stay small.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_BASE_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_SHINGLE_BASES = np.array(
    [0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5, 0x9FB21C651E98DF25,
     0xD6E8FEB86659FD93], dtype=np.uint64)

# White space of the word rule [^\x20\x09-\x0D]+.
WORD_BREAKS = (0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D)

_powers = np.ones(1, np.uint64)
_inverses = np.ones(1, np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers whose every output bit depends on every input bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def runs(texts: list[str], most: int = 1 << 19) -> Iterator[tuple[int, int]]:
    """Cut a list into runs of at most `most` characters, or of one longer text."""
    start = total = 0
    for i, t in enumerate(texts):
        if i > start and total + len(t) > most:
            yield start, i
            start, total = i, 0
        total += len(t) + 1
    if start < len(texts):
        yield start, len(texts)


def code_points(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The texts' characters as one array, a blank after each, and where each text begins (and,
    last, the length of all)."""
    joined = " ".join(texts) + " "
    codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    bounds = np.zeros(len(texts) + 1, np.int64)
    np.cumsum([len(t) + 1 for t in texts], out=bounds[1:])
    return codes, bounds


def _scales(n: int) -> tuple[np.ndarray, np.ndarray]:
    global _powers, _inverses
    if len(_powers) < n:
        size = 1 << max(n - 1, 1).bit_length()
        steps = np.full(size, _BASE)
        steps[0] = 1
        _powers = np.cumprod(steps, dtype=np.uint64)
        steps = np.full(size, _BASE_INVERSE)
        steps[0] = 1
        _inverses = np.cumprod(steps, dtype=np.uint64)
    return _powers, _inverses


class Rolling:
    """Hashes of any substring in constant time, from prefix sums of scaled characters."""

    def __init__(self, codes: np.ndarray):
        powers, self._inverses = _scales(len(codes) + 1)
        self._sums = np.zeros(len(codes) + 1, np.uint64)
        np.cumsum(mix(codes.astype(np.uint64) + np.uint64(1)) * powers[: len(codes)],
                  out=self._sums[1:])

    def sums(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """What `hashes` mixes; the sum of a substring follows from those of its parts (`joined`)."""
        return (self._sums[ends] - self._sums[starts]) * self._inverses[starts]

    def hashes(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mix(self.sums(starts, ends))

    def grams(self, n: int) -> np.ndarray:
        """The hash of the n characters from every place on; the last n - 1 places have none."""
        last = len(self._sums) - n
        return mix((self._sums[n:] - self._sums[:last]) * self._inverses[:last] + np.uint64(n))


def joined(left: int, length: int, right: int) -> int:
    """The sum of a substring whose first `length` characters have the sum `left`, the rest `right`."""
    return (left + pow(int(_BASE), length, 1 << 64) * right) % (1 << 64)


def spans(inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where maximal runs of True start and end (end exclusive)."""
    edge = np.diff(np.concatenate(([0], inside.view(np.int8), [0])))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def is_break(codes: np.ndarray) -> np.ndarray:
    return (codes == 0x20) | ((codes >= 0x09) & (codes <= 0x0D))


def lower_ascii(codes: np.ndarray) -> np.ndarray:
    return np.where((codes >= 65) & (codes <= 90), codes + np.uint32(32), codes)


def word_hashes(texts: list[str], lower: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of all texts, A-Z lower-cased if wanted, and where each text's words
    begin."""
    codes, bounds = code_points(texts)
    if lower:
        codes = lower_ascii(codes)
    starts, ends = spans(~is_break(codes))
    return Rolling(codes).hashes(starts, ends), np.searchsorted(starts, bounds)


def shingle_hashes(texts: list[str], width: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the runs of `width` words of every text, and where each text's runs begin.

    A text with fewer words gives one hash, of all its words; one without words gives none.
    """
    words, bounds = word_hashes(texts)
    return combine(words, bounds, width)


def combine(words: np.ndarray, bounds: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    n_words = np.diff(bounds)
    counts = np.where(n_words >= width, n_words - width + 1, np.minimum(n_words, 1))
    out_bounds = np.concatenate(([0], np.cumsum(counts)))
    if len(words) >= width:
        last = len(words) - width + 1
        whole = np.zeros(last, np.uint64)
        for k in range(width):
            whole += words[k : k + last] * _SHINGLE_BASES[k]
        whole = mix(whole)
    else:
        whole = np.zeros(0, np.uint64)
    owner = np.repeat(np.arange(len(n_words)), counts)
    place = bounds[owner] + np.arange(len(owner)) - out_bounds[owner]
    out = np.zeros(len(owner), np.uint64)
    full = n_words[owner] >= width
    out[full] = whole[place[full]]
    for i in np.flatnonzero((n_words > 0) & (n_words < width)):
        own = words[bounds[i] : bounds[i + 1]]
        total = (own * _SHINGLE_BASES[: len(own)]).sum(dtype=np.uint64)
        out[out_bounds[i]] = mix(np.array([total + np.uint64(len(own))]))[0]
    return out, out_bounds


def run_hashes(
    words: np.ndarray, bounds: np.ndarray, n: int, width: int
) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of every text's runs of exactly n words, equal to the shingle hash that a text of
    only these words has under `width`, and where each text's runs begin."""
    counts = np.maximum(np.diff(bounds) - n + 1, 0)
    out_bounds = np.concatenate(([0], np.cumsum(counts)))
    owner = np.repeat(np.arange(len(counts)), counts)
    place = bounds[:-1][owner] + np.arange(len(owner)) - out_bounds[:-1][owner]
    total = np.zeros(len(owner), np.uint64)
    for k in range(n):
        total += words[place + k] * _SHINGLE_BASES[k]
    return mix(total + np.uint64(n) if n < width else total), out_bounds
