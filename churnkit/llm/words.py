"""Words and runs of words as 64-bit hashes, whole blocks of documents at a time."""

from __future__ import annotations

from dataclasses import dataclass
from functools import cache
from hashlib import blake2b

import numpy as np

_U = np.uint64
_BLOCK = 1 << 19
_LONG = 256

# Space and U+0009 to U+000D end a word.
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers whose every output bit depends on every input bit."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
        return x ^ (x >> _U(31))


@cache
def _byte_codes() -> np.ndarray:
    return mix(np.arange(1, 257, dtype=_U) * _U(0x9E3779B97F4A7C15)) | _U(1)


@cache
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    base = 0xD6E8FEB86659FD93
    inverse = pow(base, -1, 1 << 64)
    return tuple(np.cumprod(np.concatenate([[_U(1)], np.full(n - 1, _U(b))]), dtype=_U) for b in (base, inverse))


@dataclass
class Words:
    """Words of a block of documents, in order.

    ``first`` has each document's first word and, last, the number of words; ``bounds`` likewise its first byte.
    """

    data: np.ndarray
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray
    bounds: np.ndarray

    def bytes_per_doc(self, marked: np.ndarray) -> np.ndarray:
        """How many of each document's bytes are marked."""
        return np.diff(np.concatenate([[0], np.cumsum(marked)])[self.bounds])

    def words_per_doc(self, marked: np.ndarray) -> np.ndarray:
        """How many of each document's words are marked."""
        return np.diff(np.concatenate([[0], np.cumsum(marked)])[self.first])

    @property
    def doc(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))

    def hashes(self) -> np.ndarray:
        """One number per word: a polynomial of its bytes, from running sums, mixed with its length.

        Of long words, for which different ones are known that agree in any such polynomial, a cryptographic hash.
        """
        if not len(self.start):
            return np.empty(0, _U)
        out = np.empty(len(self.start), _U)
        codes = _byte_codes()
        lo = 0
        while lo < len(self.start):  # blocks of words keep the running sums small
            hi = max(lo + 1, int(np.searchsorted(self.end, self.start[lo] + _BLOCK, "right")))
            a, b = int(self.start[lo]), int(self.end[hi - 1])
            size = 1 << max(10, (b - a).bit_length())
            up, down = _powers(size)
            with np.errstate(over="ignore"):
                sums = np.concatenate([[_U(0)], np.cumsum(codes[self.data[a:b]] * up[: b - a], dtype=_U)])
                s, e = self.start[lo:hi] - a, self.end[lo:hi] - a
                out[lo:hi] = mix((sums[e] - sums[s]) * down[s] + (e - s).astype(_U))
            lo = hi
        for i in np.flatnonzero(self.end - self.start > _LONG).tolist():
            word = self.data[self.start[i] : self.end[i]].tobytes()
            out[i] = int.from_bytes(blake2b(word, digest_size=8).digest(), "little")
        return out

    def windows(self, k: int, hashes: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of all runs of k words inside one document, and the word at which each begins."""
        h = self.hashes() if hashes is None else hashes
        n = len(h) - k + 1
        if n <= 0:
            return np.empty(0, _U), np.empty(0, np.int64)
        last = np.repeat(self.first[1:], np.diff(self.first)) - k  # last start inside the word's document
        at = np.flatnonzero(np.arange(len(h)) <= last)
        return self._joined(h, at, k), at

    @staticmethod
    def _joined(h: np.ndarray, at: np.ndarray, k: int) -> np.ndarray:
        with np.errstate(over="ignore"):
            total = np.zeros(len(at), _U)
            factor = 0x9E3779B97F4A7C15
            for j in range(k):
                total += h[at + j] * _U(factor)
                factor = factor * 0xD1342543DE82EF95 % (1 << 64)
            return mix(total + _U(k))


def split_words(texts: list[bytes], lower: bool = False) -> Words:
    """Words of UTF-8 texts; with ``lower``, A to Z are lower-cased first and nothing else is."""
    joined = b"\n".join([*texts, b""])
    data = np.frombuffer(joined.translate(_LOWER) if lower else joined, np.uint8)
    ends = np.cumsum([len(t) + 1 for t in texts])
    space = _SPACE[data]
    edge = np.flatnonzero(space[1:] != space[:-1]) + 1
    if len(space) and not space[0]:
        edge = np.concatenate([[0], edge])
    start, end = edge[::2], edge[1::2]
    first = np.concatenate([[0], np.searchsorted(start, ends)]) if texts else np.zeros(1, np.int64)
    bounds = np.concatenate([[0], ends]).astype(np.int64)
    return Words(data, start.astype(np.int64), end.astype(np.int64), first.astype(np.int64), bounds)


def covered(starts: np.ndarray, k: int, n: int) -> np.ndarray:
    """Which of n words lie in a run of k that begins at one of the starts."""
    marks = np.bincount(starts, minlength=n + 1) - np.bincount(starts + k, minlength=n + 1)
    return np.cumsum(marks[:n]) > 0
