"""Vectorised pre-tokenisation of byte-level BPE, and distinct words of a block.

``cuts`` finds where the matches of the public tokenizers' pattern begin, for many
texts at once: contractions, letters, numbers and other signs with one space
before them, and runs of white space that leave their last sign to what follows.
"""

from __future__ import annotations

import unicodedata
from functools import cache

import numpy as np

from .common import random_words

#: Words that are hashed together.
PART = 100_000
LETTER, NUMBER, SPACE, OTHER = 1, 2, 3, 0
#: The code points with the Unicode property White_Space.
WHITE_SPACE = (0x9, 0xA, 0xB, 0xC, 0xD, 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)
#: What the pattern splits off after an apostrophe.
CONTRACTIONS = ("s", "t", "re", "ve", "m", "ll", "d")


def _class(c: int) -> int:
    kind = unicodedata.category(chr(c))[0]
    return SPACE if c in WHITE_SPACE else LETTER if kind == "L" else NUMBER if kind == "N" else OTHER


@cache
def _plane() -> np.ndarray:
    """The classes of the first 65,536 code points."""
    return np.array([_class(c) for c in range(0x10000)], np.uint8)


def classes(points: np.ndarray) -> np.ndarray:
    """The class of every code point."""
    if not len(points) or points.max() < 0x10000:
        return _plane()[points]
    kind = _plane()[points & 0xFFFF]
    far = np.flatnonzero(points >= 0x10000)
    some, index = np.unique(points[far], return_inverse=True)
    kind[far] = np.array([_class(int(c)) for c in some], np.uint8)[index]
    return kind


def code_points(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of the texts one after another, and the n + 1 offsets."""
    points = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    return points, np.concatenate([[0], np.cumsum([len(x) for x in texts])]).astype(np.int64)


def cuts(points: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Ascending start positions of the pre-tokens of all texts."""
    n = len(points)
    if not n:
        return np.zeros(0, np.int64)
    kind = classes(points)
    head = np.zeros(n + 1, bool)  # a text begins here
    head[offsets[offsets < n]] = True
    head[n] = True
    white = kind == SPACE
    start = np.ones(n, bool)
    same = kind[1:] == kind[:-1]
    absorbed = (points[:-1] == 32) & ~white[1:]  # the space before goes with what follows
    last = np.zeros(n - 1, bool)  # last white space of a run that something follows in its text
    last[: n - 2] = white[1:-1] & ~white[2:] & ~head[2:n] if n > 2 else last[: max(0, n - 2)]
    start[1:] = ~((same & ~(white[1:] & last)) | absorbed)
    start |= head[:n]
    # Contractions: an apostrophe that begins a pre-token takes its ending along.
    marks = np.flatnonzero((points == 39) & start)
    if len(marks):
        edge = offsets[np.searchsorted(offsets, marks, "right")]  # the text's end
        for ending in CONTRACTIONS:
            fits = marks + len(ending) < edge
            for i, sign in enumerate(ending):
                fits &= points[np.minimum(marks + 1 + i, n - 1)] == ord(sign)
            after = marks[fits] + 1 + len(ending)
            start[marks[fits] + 1] = False
            inner = after[after < n]
            start[inner[~head[inner] & (kind[inner] == LETTER)]] = True
    return np.flatnonzero(start)


class Distinct:
    """The distinct pre-tokens of some texts by ascending hash: ``hashes``, a further 32 bits in
    ``checks``, the ``index`` of every occurrence into them, and occurrences per text in ``counts``."""

    def __init__(self, texts: list[str]):
        points, offsets = code_points(texts)
        begin = cuts(points, offsets)
        self.whole, self.counts = "".join(texts), np.zeros(len(texts), np.int64)
        self.hashes, self.checks, self.index, self.begin, self.end = np.zeros(0, np.uint64), np.zeros(0, np.uint32), np.zeros(0, np.int32), begin, begin
        if not len(begin):
            return
        end = np.append(begin[1:], len(points))
        mixed, check = self._hashed(points, begin, end)
        order = np.argsort(mixed)
        ranked = mixed[order]
        new = np.ones(len(order), bool)
        new[1:] = ranked[1:] != ranked[:-1]
        first = order[new]
        self.index = np.empty(len(order), np.int32)
        self.index[order] = np.cumsum(new, dtype=np.int32) - 1
        self.hashes, self.checks, self.begin, self.end = ranked[new], check[first], begin[first], end[first]
        if not np.array_equal(self.checks[self.index], check):
            raise ValueError("two words share a hash")
        self.counts = np.bincount(np.searchsorted(offsets, begin, "right") - 1, minlength=len(texts))

    @staticmethod
    def _hashed(points: np.ndarray, begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """64 and 32 bits per word, some words at a time to keep intermediate arrays small."""
        longest = int((end - begin).max())
        wide, narrow = random_words(21, longest), random_words(23, longest).astype(np.uint32)
        mixed, check = np.empty(len(begin), np.uint64), np.empty(len(begin), np.uint32)
        for a in range(0, len(begin), PART):
            b = min(a + PART, len(begin))
            first, lengths = begin[a:b] - begin[a], end[a:b] - begin[a:b]
            signs = points[begin[a] : end[b - 1]]
            inside = np.arange(len(signs), dtype=np.int32) - np.repeat(first.astype(np.int32), lengths)
            mixed[a:b] = np.add.reduceat(signs * wide[inside], first) + lengths.astype(np.uint64) * random_words(22, 1)
            check[a:b] = np.add.reduceat(signs * narrow[inside], first, dtype=np.uint32)
        return mixed, check

    def words(self, which: np.ndarray | slice = slice(None)) -> list[str]:
        return [self.whole[a:b] for a, b in zip(self.begin[which].tolist(), self.end[which].tolist())]
