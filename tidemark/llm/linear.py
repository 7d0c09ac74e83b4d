"""Hashed text features and proximal fits, shared by the two classifiers.

A document's features are hashed from its words; equal words of a batch are
hashed once. Fits run on a bounded sample of rows in sparse numpy arrays.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from tidemark.llm.common import batches_of, ragged_gather, runs

BATCH_CHARS = 1 << 22
SHAPE_CHARS = 16
_UPPER, _LOWER, _DIGIT = re.compile(r"[A-Z\xc0-\xde]+"), re.compile(r"[a-z\xdf-\xff]+"), re.compile(r"[0-9]+")


def bucket(name: str, bits: int) -> int:
    return zlib.crc32(name.encode("utf-8", "surrogatepass")) >> (32 - bits)


def shape(word: str) -> str:
    """Runs of capitals, small letters and digits as X, x and 9; other characters stay.
    The feature is the first SHAPE_CHARS of it; the word itself is a feature whole."""
    return _DIGIT.sub("9", _LOWER.sub("x", _UPPER.sub("X", word)))[:SHAPE_CHARS]


def batch_words(texts: list[str], lower: bool) -> Iterator[tuple[int, int, list[str], np.ndarray, np.ndarray]]:
    """(first text, end, distinct words, word number at each position, offsets by text) of batches of texts."""
    for a, b in batches_of(texts, BATCH_CHARS):
        column = pa.array(texts[a:b], pa.large_string())
        split = pc.ascii_split_whitespace(pc.utf8_lower(column) if lower else column)
        words = split.flatten()
        keep = pc.not_equal(words, "")
        at = runs(keep.to_numpy(zero_copy_only=False).astype(np.int64))[split.offsets.to_numpy() - split.offsets[0].as_py()]
        coded = pc.dictionary_encode(words.filter(keep))
        yield a, b, coded.dictionary.to_pylist(), coded.indices.to_numpy(), at


class Rows:
    """Sparse rows: feature numbers and values, by row offsets.

    Features of fewer than ``least`` rows are left out. With ``scaled`` the others
    are divided by their root mean square, so that rare ones fit at the pace of
    common ones; without it, common ones carry the fit.
    """

    def __init__(self, index: np.ndarray, value: np.ndarray, offsets: np.ndarray, size: int, least: int = 1, scaled: bool = True):
        self.n = len(offsets) - 1
        keep = np.bincount(index, minlength=size) >= max(1, least)
        here = keep[index]
        self.used, self.columns = np.flatnonzero(keep), int(keep.sum())
        self.index = (np.cumsum(keep, dtype=np.int32) - 1)[index[here]]
        self.row = np.repeat(np.arange(self.n, dtype=np.int32), np.diff(offsets))[here]
        self.value = value[here].astype(np.float32)
        self.scale = np.sqrt(np.bincount(self.index, self.value ** 2, self.columns) / max(1, self.n)) if scaled else np.ones(self.columns)
        self.value /= self.scale.astype(np.float32)[self.index]

    def weights(self, w: np.ndarray, size: int) -> np.ndarray:
        """Weights of the unscaled features, by feature number."""
        out = np.zeros(size)
        out[self.used] = w / self.scale
        return out

    def dot(self, w: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, w[self.index] * self.value, self.n)

    def back(self, r: np.ndarray) -> np.ndarray:
        return np.bincount(self.index, r[self.row] * self.value, self.columns)

    def norm(self, steps: int = 12) -> float:
        """Largest singular value of the rows with a column of ones beside them."""
        v, one, size = np.ones(self.columns), 1.0, 1.0
        for _ in range(steps):
            u = self.dot(v) + one
            v, one = self.back(u), float(u.sum())
            size = np.sqrt(v @ v + one * one)
            v, one = v / size, one / size
        return float(np.sqrt(size))


def fista(rows: Rows, gradient: Callable[[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]], free: np.ndarray, project: Callable[[np.ndarray], np.ndarray],
          curvature: float, l1: float, l2: float, steps: int) -> tuple[np.ndarray, np.ndarray]:
    """Minimise mean loss + l1 |w| + l2/2 w² over weights w and free parameters.

    ``gradient(scores, free)`` gives the loss's derivative by each row's score
    and its mean derivative by the free parameters; ``curvature`` bounds the
    second derivative.
    """
    w, z, f, g, t = np.zeros(rows.columns), np.zeros(rows.columns), free, free.copy(), 1.0
    rate = 1.0 / (1.1 * curvature * rows.norm() ** 2 / max(1, rows.n) + l2)
    for _ in range(steps):
        by_score, by_free = gradient(rows.dot(z), g)
        step = z - rate * (rows.back(by_score) / rows.n + l2 * z)
        new_w = np.sign(step) * np.maximum(np.abs(step) - rate * l1, 0)
        new_f = project(g - rate * by_free)
        new_t = (1 + np.sqrt(1 + 4 * t * t)) / 2
        z, g = new_w + (t - 1) / new_t * (new_w - w), new_f + (t - 1) / new_t * (new_f - f)
        w, f, t = new_w, new_f, new_t
    return w, f


class WordWeights:
    """Summed weight of a word's features; a bounded cache keeps those of words seen."""

    def __init__(self, weights: np.ndarray, features: Callable[[str], list[int]], cache_words: int = 300_000):
        used = np.flatnonzero(weights)
        self.weights = dict(zip(used.tolist(), weights[used].tolist()))
        self.features, self.cache_words, self.cache = features, cache_words, {}

    def of(self, words: list[str]) -> np.ndarray:
        known, weight, features = self.cache, self.weights.get, self.features
        out = np.fromiter((known[w] if w in known else sum([weight(f, 0.0) for f in features(w)]) for w in words), np.float64, len(words))
        if len(known) < self.cache_words:
            known.update(zip(words[:self.cache_words - len(known)], out.tolist()))
        return out


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


def sum_by_text(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    total = np.concatenate(([0.0], np.cumsum(values)))
    return total[offsets[1:]] - total[offsets[:-1]]


def text_rows(each: list[tuple[np.ndarray, np.ndarray]], size: int, least: int = 1, scaled: bool = True) -> Rows:
    """``Rows`` of the (features, values) of each text."""
    at = runs(np.array([len(i) for i, _ in each], np.int64))
    return Rows(np.concatenate([i for i, _ in each]), np.concatenate([v for _, v in each]), at, size, least, scaled)


def word_features(texts: list[str], lower: bool, features: Callable[[str], list[int]], repeat_bucket: int | None = None,
                  distinct_words: bool = False) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
    """(features, counts, words) of each text: the features of its words, counted
    for each occurrence or, with ``distinct_words``, once for equal words."""
    for _, _, words, which, at in batch_words(texts, lower):
        own = [features(w) for w in words]
        n = np.fromiter(map(len, own), np.int64, len(own))
        flat, start = np.array([f for fs in own for f in fs], np.int64), runs(n)[:-1]
        for a, b in zip(at[:-1].tolist(), at[1:].tolist()):
            here = which[a:b]
            distinct, times = np.unique(here, return_counts=True)
            index = ragged_gather(flat, start[distinct], n[distinct])
            weight = np.repeat(np.ones_like(times) if distinct_words else times, n[distinct])
            if repeat_bucket is not None:
                index, weight = np.append(index, repeat_bucket), np.append(weight, int((here[1:] == here[:-1]).sum()))
            index, inverse = np.unique(index, return_inverse=True)
            yield index.astype(np.int32), np.bincount(inverse, weight, len(index)).astype(np.float32), b - a
