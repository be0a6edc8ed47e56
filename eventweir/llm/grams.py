"""Hashed character n-grams of whole texts, many texts at a time, in numpy."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

#: Code points that are worked on at a time.
PART = 1 << 18
#: Longest n-gram.
LONGEST = 8
_STEP = np.uint64(0x100000001B3)
_MIX = np.uint64(0x9E3779B97F4A7C15)  # golden ratio, for multiplicative hashing


def _folded() -> np.ndarray:
    """Code points of the first plane in lower case; ASCII other than letters becomes a space."""
    table = np.arange(1 << 16, dtype=np.uint32)
    for point in range(1 << 16):
        lower = chr(point).lower()
        if len(lower) == 1:
            table[point] = ord(lower)
        if point < 128 and not chr(point).isalpha():
            table[point] = 32
    return table


_TABLE: list[np.ndarray] = []


def folded(text: str) -> np.ndarray:
    """The code points of a text, folded."""
    if not _TABLE:
        _TABLE.append(_folded())
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    return np.where(points < 1 << 16, _TABLE[0][np.minimum(points, 0xFFFF)], points)


class Batch:
    """Some parts of texts as one array of folded code points.

    ``numbers`` tells which text each part is of, ``starts`` where it begins.  Two spaces stand
    before each part and ``LONGEST`` after the last, so every part has n-grams of its own.
    """

    def __init__(self, numbers: list[int], parts: list[str]):
        self.numbers = np.array(numbers, np.int64)
        sizes = np.array([len(p) + 2 for p in parts], np.int64)
        self.starts, self.size = np.cumsum(sizes) - sizes, int(sizes.sum())
        self.points = folded("  ".join(["", *parts]) + " " * LONGEST)

    def hashes(self, n: int) -> np.ndarray:
        """The 64-bit hash of the n-gram that begins at each place."""
        hashed = np.zeros(self.size, np.uint64)
        for i in range(n):
            hashed = hashed * _STEP + self.points[i : i + self.size]
        return hashed * _MIX

    def buckets(self, n: int, bits: int) -> np.ndarray:
        """The bucket of the n-gram that begins at each place, the first bits of its hash."""
        return (self.hashes(n) >> np.uint64(64 - bits)).astype(np.int64)

    def words(self) -> tuple[np.ndarray, np.ndarray]:
        """Where each word, a run without spaces, begins, and the 64-bit hash of the whole word."""
        inside = np.r_[False, self.points != 32, False]
        edges = np.flatnonzero(inside[1:] != inside[:-1])
        begin, end = edges[::2], edges[1::2]
        powers, inverses = _powers(len(self.points) + 1)
        total = np.zeros(len(self.points) + 1, np.uint64)
        np.cumsum(self.points * powers[:-1], out=total[1:])
        hashed = (total[end] - total[begin]) * inverses[begin]
        hashed ^= hashed >> np.uint64(29)
        return begin, hashed * _MIX


_POWERS: list[tuple[np.ndarray, np.ndarray]] = []


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of ``_STEP`` and of its inverse, modulo 2 to the 64th."""
    if not _POWERS or len(_POWERS[0][0]) < n:
        steps = np.full(n, _STEP, np.uint64)
        backs = np.full(n, np.uint64(pow(int(_STEP), -1, 1 << 64)), np.uint64)
        steps[0] = backs[0] = 1
        _POWERS[:] = [(np.cumprod(steps), np.cumprod(backs))]
    powers, inverses = _POWERS[0]
    return powers[:n], inverses[:n]


def batches(texts: list[str], window: int = 0, overlap: int = 0) -> Iterator[Batch]:
    """Whole texts in batches of about ``PART`` code points; those over ``window``, by default as
    many, go in several parts.

    Each part but a text's last goes on for ``overlap`` code points into the next.
    """
    window = window or PART
    numbers: list[int] = []
    parts: list[str] = []
    size = 0
    for number, text in enumerate(texts):
        for at in range(0, len(text) or 1, window):
            part = text[at : at + window + overlap]
            numbers.append(number)
            parts.append(part)
            size += len(part) + 2
            if size >= PART:
                yield Batch(numbers, parts)
                numbers, parts, size = [], [], 0
    if numbers:
        yield Batch(numbers, parts)
