"""Words and shingles of whole texts as numpy arrays, many texts at a time.

A word is a run of characters other than space and U+0009 to U+000D. Texts are joined, turned into code
points and hashed with one running sum, so the cost per character does not depend on how texts are cut.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np

# One text of any length is handled at once; shorter ones are taken together up to this many characters.
CHUNK_CHARS = 1 << 20

_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_BASE = 0x9E3779B97F4A7C15 | 1
_powers: tuple[np.ndarray, np.ndarray] = (np.ones(1, np.uint64), np.ones(1, np.uint64))


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64 bits: equal inputs stay equal, unequal ones stay unequal."""
    x = x ^ (x >> np.uint64(30))
    x *= _M1
    x ^= x >> np.uint64(27)
    x *= _M2
    x ^= x >> np.uint64(31)
    return x


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base and of its inverse modulo 2**64."""
    global _powers
    if len(_powers[0]) < n:
        size = max(n, CHUNK_CHARS + 4096)
        made = []
        for base in (_BASE, pow(_BASE, -1, 1 << 64)):
            out = np.full(size, np.uint64(base), np.uint64)
            out[0] = 1
            made.append(np.cumprod(out, dtype=np.uint64))
        _powers = (made[0], made[1])
    return _powers


def chunks(texts: Sequence[str], limit: int = CHUNK_CHARS) -> Iterator[tuple[int, int]]:
    """Consecutive ranges of texts with at most ``limit`` characters together, or one longer text."""
    start = size = 0
    for i, text in enumerate(texts):
        if i > start and size + len(text) > limit:
            yield start, i
            start, size = i, 0
        size += len(text) + 1
    if start < len(texts):
        yield start, len(texts)


@dataclass
class Words:
    """``codes``: all code points, a newline after each text; ``prefix``: running hash sum over them;
    ``starts``/``ends``: of each word; ``bounds``: texts' offsets into the words."""

    codes: np.ndarray
    prefix: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    bounds: np.ndarray
    offsets: np.ndarray

    def span_hashes(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Hash of the characters from each start up to its end."""
        inverse = _power_tables(len(self.codes) + 1)[1]
        return mix((self.prefix[ends] - self.prefix[starts]) * inverse[starts])

    @property
    def hashes(self) -> np.ndarray:
        return self.span_hashes(self.starts, self.ends)

    @property
    def text_of_word(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.bounds) - 1), np.diff(self.bounds))


def _separators(punctuation: bool) -> np.ndarray:
    """Whether each code below 128 ends a word; the last place stands for all other codes."""
    codes = np.arange(129)
    out = (codes == 32) | ((codes >= 9) & (codes <= 13))
    if punctuation:
        out |= np.array([c < 128 and not chr(c).isalnum() for c in range(129)])
    return out


WHITE, WHITE_AND_PUNCTUATION = _separators(False), _separators(True)


def split(texts: Sequence[str], lower: bool = True, separators: np.ndarray = WHITE) -> Words:
    """Words of the texts; ``lower`` turns A-Z to a-z first; ``separators``: which ASCII codes end a word."""
    codes = np.frombuffer(("\n".join(texts) + "\n").encode("utf-32-le", "surrogatepass"), np.uint32)
    if lower:
        codes = np.where(codes - np.uint32(65) < 26, codes | np.uint32(32), codes)
    offsets = np.zeros(len(texts) + 1, np.int64)
    np.cumsum([len(t) + 1 for t in texts], out=offsets[1:])
    space = separators[np.minimum(codes, np.uint32(128))]
    edge = np.flatnonzero(space[1:] != space[:-1]) + 1
    if not space[0]:
        edge = np.concatenate([[0], edge])
    starts, ends = edge[0::2], edge[1::2]
    powers = _power_tables(len(codes) + 1)[0]
    prefix = np.zeros(len(codes) + 1, np.uint64)
    np.cumsum(mix(codes.astype(np.uint64)) * powers[: len(codes)], out=prefix[1:])
    return Words(codes, prefix, starts, ends, np.searchsorted(starts, offsets), offsets)


def joined(hashes: np.ndarray, width: int) -> np.ndarray:
    """Hash of every run of ``width`` hashes; element i covers i to i + width - 1."""
    n = max(len(hashes) - width + 1, 0)
    out = hashes[:n].copy()
    for j in range(1, width):
        out = mix(out * _M2 + hashes[j : j + n])
    return out
