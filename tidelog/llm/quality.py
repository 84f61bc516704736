"""Quality classifier: Naive Bayes support vectors.

Features of a text are which n-grams it holds: byte n-grams, n-grams of kinds
of characters with runs taken as one, and n-grams of "same word again". Each is
scaled by the log of how much more often it is in texts of one class, and a
linear hinge-loss model is fitted to the scaled indicators by dual coordinate
descent.
"""

from __future__ import annotations

import operator
import zlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.llm.common import map_rows, remainder
from tidelog.llm.labelled import HELD_OUT, labelled_sample
from tidelog.llm.linear_svm import dual_coordinate_descent, logistic_scale, scores

#: Labelled documents of each class that the model is fitted to, at most.
PER_CLASS = 3000
THRESHOLD = 0.3

_BITS = 18
SIZE = 1 << _BITS
COST = 1.0
#: Bytes looked at together, so that memory does not follow the length of a text.
_STRETCH = 1 << 20

_BYTE_GRAMS = (1, 2, 3)
_KIND_GRAMS = (4, 5, 6)
_AGAIN_GRAMS = (1, 2, 3, 4, 6, 8)

# Kinds: capital, small or beyond ASCII, digit; white space and marks stand for themselves.
_KINDS = np.array(
    [1 if 65 <= b <= 90 else 2 if b >= 128 or 97 <= b <= 122 else 3 if 48 <= b <= 57 else b for b in range(256)],
    dtype=np.uint64,
)


def _codes(symbols: np.ndarray, n: int, family: int) -> np.ndarray:
    """A feature number for each n-gram of ``symbols``."""
    if len(symbols) < n:
        return np.zeros(0, dtype=np.int64)
    key = symbols[: len(symbols) - n + 1].copy()
    for i in range(1, n):
        key = key * np.uint64(257) + symbols[i : len(symbols) - n + 1 + i]
    key = (key + np.uint64(16 * family + n << 50)) * np.uint64(0x9E3779B97F4A7C15)
    return (key >> np.uint64(64 - _BITS)).astype(np.int64)


class Features:
    """Numbers of the n-grams that a text holds, each once, in ascending order."""

    def __init__(self):
        self.seen = np.zeros(SIZE, dtype=bool)

    def __call__(self, text: str | None) -> np.ndarray:
        raw = np.frombuffer((text or "").encode("utf-8", "surrogatepass"), dtype=np.uint8)
        overlap = 64
        for at in range(0, max(len(raw), 1), _STRETCH):
            part = raw[max(0, at - overlap) : at + _STRETCH]
            symbols = part.astype(np.uint64)
            for n in _BYTE_GRAMS:
                self.seen[_codes(symbols, n, 0)] = True
            kinds = _KINDS[part]
            if len(kinds):
                kinds = kinds[np.concatenate(([True], kinds[1:] != kinds[:-1]))]
            for n in _KIND_GRAMS:
                self.seen[_codes(kinds, n, 1)] = True
        words = (text or "").split()
        again = np.fromiter(map(operator.eq, words, words[1:]), dtype=np.uint64, count=max(len(words) - 1, 0))
        if again.any():
            for n in _AGAIN_GRAMS:
                self.seen[_codes(again, n, 2)] = True
        found = np.flatnonzero(self.seen)
        self.seen[found] = False
        return found


class Model:
    """Log-count ratios, weights times ratios, bias, and the score's slope and offset."""

    def __init__(self, ratios: np.ndarray, weights: np.ndarray, bias: float):
        self.squares = (ratios * ratios).astype(np.float32)
        self.products = (ratios * weights).astype(np.float32)
        self.bias, self.slope, self.offset = bias, 1.0, 0.0

    def margin(self, found: np.ndarray) -> float:
        length = float(np.sqrt(self.squares[found].sum(dtype=np.float64)))
        return self.bias + (float(self.products[found].sum(dtype=np.float64)) / length if length else 0.0)


def fit_margins(rows: list[np.ndarray], signs: np.ndarray) -> Model:
    up, down = np.ones(SIZE), np.ones(SIZE)
    for found, sign in zip(rows, signs):
        (up if sign > 0 else down)[found] += 1
    ratios = np.log((up / up.sum()) / (down / down.sum()))
    scaled = []
    for found in rows:
        values = ratios[found]
        scaled.append((found, values / max(float(np.linalg.norm(values)), 1e-12)))
    costs = np.where(signs > 0, 1 / max((signs > 0).mean(), 1e-9), 1 / max((signs < 0).mean(), 1e-9)) * COST / 2
    weights, bias = dual_coordinate_descent(scaled, signs, SIZE, costs)
    return Model(ratios, weights, bias)


def fit_model(rows: list[np.ndarray], labels: list[int], counts: dict[int, int], folds: int = 3) -> Model | None:
    """Model of the sample; margins of left-out thirds set the score's scale, classes weighted by ``counts``."""
    signs = np.where(np.array(labels) == 1, 1.0, -1.0)
    if len(set(labels)) < 2:
        return None
    model = fit_margins(rows, signs)
    fold = np.arange(len(rows)) % folds
    margins = np.array([model.margin(r) for r in rows])
    for k in range(folds):
        rest = np.flatnonzero(fold != k)
        if len(set(signs[rest])) == 2:
            part = fit_margins([rows[i] for i in rest], signs[rest])
            for i in np.flatnonzero(fold == k):
                margins[i] = part.margin(rows[i])
    share = {s: counts[int(s > 0)] / max(int((signs == s).sum()), 1) for s in (1.0, -1.0)}
    model.slope, model.offset = logistic_scale(margins, signs, np.array([share[s] for s in signs]))
    return model


def fit_quality(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> tuple[Model | None, float]:
    """The model, and the share of label 1 that stands in where there are not both labels.

    Features are made in tasks; the driver gets those of 2 * ``per_class``
    texts at most, and fits.
    """
    sample, counts = labelled_sample(docs, labels, "quality", per_class)

    def start():
        features = Features()
        return lambda texts: {"found": [features(t).astype("<i4").tobytes() for t in texts]}

    found = map_rows(sample, ["text"], start, {"found": "binary"}, drop=("text",)).collect()
    found.sort(key=lambda r: (zlib.crc32(str(r["doc_id"]).encode()), r["doc_id"]))
    rows = [np.frombuffer(r["found"], dtype="<i4") for r in found]
    total = sum(counts.values())
    prior = (counts.get(1, 0) + 1) / (total + 2)
    return fit_model(rows, [r["label"] for r in found], counts), prior


def score_quality(
    docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS, name: str = "score"
) -> DataFrame:
    """``docs`` with the column ``name``, 0 to 1: how likely label 1 is, from the text alone.

    Null and empty texts hold no n-gram and get the score of the bias;
    repeated rows get equal scores. With labels of one class or none, every
    score is the smoothed share of label 1. Other columns pass; one named
    so is replaced.
    """
    model, prior = fit_quality(docs, labels, per_class)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def start():
        features, fitted = Features(), shared.value

        def step(texts):
            if fitted is None:
                return {name: [prior] * len(texts)}
            margins = np.array([fitted.margin(features(t)) for t in texts])
            return {name: scores(margins, fitted.slope, fitted.offset)}

        return step

    return map_rows(docs, ["text"], start, {name: "double"})


def quality_report(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> DataFrame:
    """doc_id, held_out, score and predicted (score at least ``THRESHOLD``)."""
    scored = score_quality(docs.select("doc_id", "text"), labels, per_class)
    return scored.select(
        "doc_id",
        (remainder("doc_id", HELD_OUT) == 0).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )


def keep_good(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> DataFrame:
    """Rows of ``docs`` whose score reaches ``THRESHOLD``; columns as given."""
    kept = score_quality(docs, labels, per_class, name="quality_score_").where(F.col("quality_score_") >= THRESHOLD)
    return kept.drop("quality_score_")
