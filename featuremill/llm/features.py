"""Hashed text features for the numpy classifiers: which words and which beginnings of words a
text has, and which beginnings two or more of its different words share. A feature is a
32-bit hash; a model keeps only the hashes it gives a weight."""

from __future__ import annotations

import re
from zlib import crc32

import numpy as np

WORD = re.compile(r"[^\W\d_]+")
#: Lengths of the word beginnings that count as features of their own.
STEMS = (4, 5)


def word_features(word: str) -> tuple[int, ...]:
    """Hashes of a word and of its beginnings."""
    return (crc32(word.encode()), *(crc32(f"{word[:n]}-".encode()) for n in STEMS if len(word) > n))


def again(feature: int) -> int:
    """Hash of the feature that two or more different words of a text have ``feature``."""
    return crc32(b"again", feature)


def text_features(text: str) -> np.ndarray:
    """Distinct feature hashes of a text, ascending."""
    met, shared = set(), set()
    for w in set(WORD.findall(text.lower())):
        for h in word_features(w):
            (shared if h in met else met).add(h)
    return np.unique(np.fromiter([*met, *map(again, shared)], np.uint32))


class KnownFeatures:
    """Finds the features of a text that are among the given ones."""

    def __init__(self, hashes: np.ndarray, memo: int = 400_000):
        self.known = frozenset(hashes.tolist())
        self.limit = memo
        self._memo: dict[str, tuple[int, ...]] = {}

    def found(self, text: str) -> list[int]:
        memo, known = self._memo, self.known
        if len(memo) > self.limit:
            memo.clear()
        met, shared = set(), set()
        for word in set(WORD.findall(text.lower())):
            own = memo.get(word)
            if own is None:
                own = tuple(h for h in word_features(word) if h in known or again(h) in known)
                if len(word) <= 64:
                    memo[word] = own
            for h in own:
                (shared if h in met else met).add(h)
        return [h for h in met.union(map(again, shared)) if h in known]


class LinearScorer:
    """Sum of the weights of the features that a text has, plus a bias, as a logistic score."""

    def __init__(self, hashes: np.ndarray, weights: np.ndarray, bias: float):
        self.weight = dict(zip(hashes.tolist(), weights.tolist()))
        self.bias = bias
        self.features = KnownFeatures(hashes)

    def margin(self, text: str) -> float:
        return self.bias + sum(self.weight[h] for h in sorted(self.features.found(text)))

    def score(self, text: str) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.margin(text), -40, 40))))


class SparseRows:
    """Rows of present features, over a chosen vocabulary of hashes."""

    def __init__(self, rows: list[np.ndarray], vocabulary: np.ndarray):
        kept = [np.searchsorted(vocabulary, r[np.isin(r, vocabulary, assume_unique=True)]) for r in rows]
        self.size = len(vocabulary)
        self.row = np.repeat(np.arange(len(rows)), [len(k) for k in kept])
        self.column = np.concatenate(kept) if kept else np.empty(0, np.int64)
        self.n = len(rows)

    def times(self, weights: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, weights[self.column], self.n)

    def back(self, values: np.ndarray) -> np.ndarray:
        return np.bincount(self.column, values[self.row], self.size)
