"""Linear models over the words of a text: which words, beginnings and shapes occur in it."""

from __future__ import annotations

import math
from collections.abc import Iterable
from dataclasses import dataclass
from itertools import chain

import numpy as np

#: Features a model keeps, and words a worker remembers before it starts anew.
MAX_FEATURES, MEMORY = 2_048, 400_000
_MARKS = ".,;:!?\"'()[]{}|#*$%&<>"


_BEGINNINGS = (4, 5, 6)


def word_features(word: str) -> tuple[str, ...]:
    """The word without its marks in lower case, and its beginnings, which endings do not change."""
    w = word.strip(_MARKS).lower()
    return (f"w {w}", *(f"p {w[:k]}" for k in _BEGINNINGS if len(w) > k)) if w else ()


def shape_features(text: str, words: list[str], distinct: set[str]) -> list[str]:
    """Coarse steps of how the whole text looks: capitals, marks, repetition, length."""
    n = max(1, len(text))
    letters = sum(map(str.isupper, words))
    marks = sum(map(text.count, _MARKS)) if text else 1
    shares = {
        "upper": letters / max(1, len(words)),
        "marks": 4 * marks / n,
        "same": 1 - len(distinct) / max(1, len(words)),
    }
    steps = [f"s {k} {min(9, int(10 * v))}" for k, v in shares.items()]
    return [*steps, f"s words {len(words).bit_length()}"]


class _Numbers(dict[str, int]):
    """Names by number, counted up as they are first asked for."""

    def __missing__(self, name: str) -> int:
        self[name] = number = len(self)
        return number


class TextFeatures:
    """The features of a sample's texts as sorted numbers, four bytes each; every name is held once."""

    def __init__(self, texts: Iterable[str]):
        numbers, seen = _Numbers(), {}
        self.rows: list[np.ndarray] = []
        for text in texts:
            words = text.split()
            distinct = set(words)
            for word in distinct.difference(seen):
                seen[word] = tuple(numbers[f] for f in word_features(word))
            found = set(chain.from_iterable(map(seen.__getitem__, distinct)))
            found.update(numbers[f] for f in shape_features(text, words, distinct))
            self.rows.append(np.sort(np.fromiter(found, np.int32, len(found))))
        self.names = list(numbers)

    def counts(self, rows: np.ndarray) -> np.ndarray:
        """In how many of the texts that a mask picks each feature occurs."""
        total = np.zeros(len(self.names), np.int64)
        for row in np.flatnonzero(rows):
            total[self.rows[row]] += 1
        return total


@dataclass(frozen=True)
class Vocabulary:
    """The features a model looks at, by number."""

    index: dict[str, int]

    def matrix(self, found: TextFeatures) -> np.ndarray:
        column = np.array([self.index.get(f, -1) for f in found.names], np.int64)
        x = np.zeros((len(found.rows), len(self.index)), np.float32)
        for row, numbers in zip(x, found.rows, strict=True):
            at = column[numbers]
            row[at[at >= 0]] = 1
        return x


def choose_features(found: TextFeatures, classes: np.ndarray, among: np.ndarray | None = None, most: int = MAX_FEATURES) -> Vocabulary:
    """The features whose share differs most between a class and the rest, over all texts or those a mask picks; shapes always stay."""
    among = np.ones(len(classes), bool) if among is None else among
    total, n = found.counts(among), int(among.sum())
    frequent = np.flatnonzero(total >= 3)
    value = dict.fromkeys(frequent.tolist(), 0.0)
    for c in sorted(set(classes[among].tolist())):
        mine = among & (classes == c)
        own, m = found.counts(mine), int(mine.sum())
        for f, a, count in zip(frequent.tolist(), own[frequent].tolist(), total[frequent].tolist(), strict=True):
            b = count - a
            odds = math.log((a + 0.5) / (m - a + 0.5)) - math.log((b + 0.5) / (n - m - b + 0.5))
            value[f] = max(value[f], abs(odds) * math.sqrt(count))
    names = found.names
    shapes = sorted(names[f] for f in np.flatnonzero(total).tolist() if names[f].startswith("s "))
    ranked = sorted((-v, names[f]) for f, v in value.items() if not names[f].startswith("s "))
    return Vocabulary({f: i for i, f in enumerate([*shapes, *(f for _, f in ranked[:most])])})


def fit_softmax(
    x: np.ndarray, y: np.ndarray, classes: int, weight: np.ndarray, ridge: float = 1e-3, steps: int = 150
) -> np.ndarray:
    """Weights (features + intercept, classes) by accelerated gradient descent on the weighted log loss."""
    a = np.ones((len(x), x.shape[1] + 1), np.float32)
    a[:, :-1] = x
    del x  # the caller's matrix may go
    target = np.eye(classes, dtype=np.float32)[y]
    share = (weight / weight.sum()).astype(np.float32)
    w = np.zeros((a.shape[1], classes), np.float32)
    # The loss's curvature is at most half the largest eigenvalue of the weighted Gram matrix.
    v = np.ones(a.shape[1], np.float32)
    for _ in range(20):
        v = a.T @ (share * (a @ v))
        size = np.sqrt((v * v).sum())
        v /= max(size, np.float32(1e-12))
    curve = float(0.55 * size + ridge)
    ahead, momentum = w, 1.0
    for _ in range(steps):
        z = a @ ahead
        z -= z.max(axis=1, keepdims=True)
        p = np.exp(np.maximum(z, np.float32(-60)))
        p /= p.sum(axis=1, keepdims=True)
        grad = a.T @ ((p - target) * share[:, None]) + ridge * ahead
        new = ahead - grad / curve
        following = (1 + math.sqrt(1 + 4 * momentum**2)) / 2  # a plain float keeps the arrays at 32 bits
        ahead = new + (momentum - 1) / following * (new - w)
        w, momentum = new, following
    return w


def softmax(z: np.ndarray) -> np.ndarray:
    z = z - z.max(axis=1, keepdims=True)
    p = np.exp(z)
    return p / p.sum(axis=1, keepdims=True)


class _Seen(dict[str, tuple[int, ...]]):
    """The feature numbers of a word, found when it is first asked for."""

    def __init__(self, index: dict[str, int]):
        super().__init__()
        self.whole = {f[2:]: i for f, i in index.items() if f.startswith("w ")}
        self.beginning = {f[2:]: i for f, i in index.items() if f.startswith("p ")}

    def __missing__(self, word: str) -> tuple[int, ...]:
        w = word.strip(_MARKS).lower()
        found = [self.whole[w]] if w in self.whole else []
        for k in _BEGINNINGS:
            if len(w) > k and w[:k] in self.beginning:
                found.append(self.beginning[w[:k]])
        self[word] = numbers = tuple(found)
        return numbers


class Scorer:
    """Finds a model's features in texts; words seen before cost one look-up."""

    def __init__(self, vocabulary: Vocabulary):
        self.index = vocabulary.index
        self.seen = _Seen(self.index)

    def rows(self, texts: Iterable[str]) -> list[tuple[np.ndarray, int]]:
        """Feature numbers of each text and its word count."""
        out = []
        for text in texts:
            words = text.split()
            distinct = set(words)
            found = set(chain.from_iterable(map(self.seen.__getitem__, distinct)))
            found.update(self.index[f] for f in shape_features(text, words, distinct) if f in self.index)
            out.append((np.fromiter(found, np.int64, len(found)), len(words)))
            if len(self.seen) > MEMORY:
                self.seen.clear()
        return out
