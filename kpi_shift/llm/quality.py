"""Quality of a text by naive-Bayes support vectors.

Presence of hashed n-grams (words, word pairs, and runs of one to three word shapes, where a word that repeats the one
before it has a shape of its own) is scaled by the log-count ratio of the two classes; a linear hinge-loss model is
fitted to the scaled vectors by dual coordinate descent. Its weights are mixed with their mean size, as a prior towards
plain naive Bayes, and margins become probabilities by a logistic curve fitted to held-out folds.

The classifier is fitted on the driver to at most ``SAMPLE`` labelled rows, those whose ids hash lowest. Scoring reads
every text once, as a whole, and shuffles nothing.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kpi_shift.llm.text import SPACED, hashed_words, mix, texts_of

BITS = 18
SAMPLE = 10_000
FOLDS = 3
EPOCHS = 10
COST = 1.0
MIX = 0.25
SMOOTHING = 1.0
THRESHOLD = 0.3
_U = np.uint64


@dataclass
class Model:
    """Weight and squared log-count ratio of each feature, and the logistic curve of the margin."""

    weights: np.ndarray
    ratios2: np.ndarray
    bias: float
    slope: float
    offset: float


def _byte_classes() -> np.ndarray:
    kinds = np.arange(256)
    kinds[65:91], kinds[97:123], kinds[48:58], kinds[128:] = 65, 97, 48, 97
    return mix(kinds.astype(_U) + _U(1))


_CLASSES = _byte_classes()


def _shapes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of each word's kinds of characters, runs of one kind taken once."""
    kinds = _CLASSES[data]
    change = np.ones(len(data), bool)
    change[1:] = kinds[1:] != kinds[:-1]
    change[starts] = True
    at = np.flatnonzero(change)
    first, last = np.searchsorted(at, starts), np.searchsorted(at, ends)
    place = np.arange(len(at)) - np.repeat(first, np.diff(np.append(first, len(at)))) if len(first) and first[0] == 0 else None
    if place is None:  # blanks before the first word
        place = np.arange(len(at)) - first[np.maximum(np.searchsorted(first, np.arange(len(at)), "right") - 1, 0)]
    sums = np.concatenate(([_U(0)], np.cumsum(mix(kinds[at] + place.astype(_U) * _U(0x9E3779B97F4A7C15)), dtype=_U)))
    return mix(sums[last] - sums[first])


def features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (text, feature), each once, in order."""
    words, starts, ends, counts = hashed_words(data, offsets, SPACED)
    if not len(words):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    text = np.repeat(np.arange(len(counts)), counts)
    shapes = _shapes(data, starts, ends)
    inside = text[1:] == text[:-1]
    again = np.concatenate(([False], (words[1:] == words[:-1]) & inside))
    shapes = np.where(again, _U(0x5851F42D4C957F2D), shapes)
    keys = []

    def add(kind: int, values: np.ndarray, of: np.ndarray) -> None:
        hashed = mix(values + _U(kind * 0xA0761D6478BD642F % (1 << 64))) & _U((1 << BITS) - 1)
        keys.append((of.astype(_U) << _U(BITS)) | hashed)

    pair = shapes[:-1] * _U(3) + shapes[1:]
    add(1, words, text)
    add(2, (words[:-1] * _U(3) + words[1:])[inside], text[1:][inside])
    add(3, shapes, text)
    add(4, pair[inside], text[1:][inside])
    three = inside[1:] & inside[:-1]
    add(5, (pair[:-1] * _U(3) + shapes[2:])[three], text[2:][three])
    key = np.concatenate(keys)
    key.sort()
    key = key[np.concatenate(([True], key[1:] != key[:-1]))].astype(np.int64)
    return key >> BITS, key & ((1 << BITS) - 1)


def _feature_lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        lists = []
        for first, end, data, offsets in texts_of(batch.column(1)):
            text, feature = features(data, offsets)
            cuts = np.searchsorted(text, np.arange(end - first + 1))
            lists += [feature[a:b].astype("<i4").tobytes() for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(lists, pa.binary())], ["label", "features"])


def labelled_sample(labels: DataFrame, label: str, training: Column, size: int) -> DataFrame:
    """One row per labelled training document, at most ``size``: those whose ids hash lowest, the same in every run."""
    known = labels.where(training & F.col("doc_id").isNotNull() & F.col(label).isin(0, 1))
    one = known.groupBy("doc_id").agg(F.max(label).cast("int").alias("label"))
    return one.orderBy(F.xxhash64("doc_id"), "doc_id").limit(size)


def _dual_descent(rows: list[np.ndarray], values: list[np.ndarray], y: np.ndarray, cost: float, epochs: int) -> np.ndarray:
    """Weights of a linear model with hinge loss; the last one belongs to a constant of 1. Rows have unit length."""
    w, alpha, rng = np.zeros((1 << BITS) + 1), np.zeros(len(rows)), np.random.default_rng(7)
    for _ in range(epochs):
        moved = 0
        for i in rng.permutation(len(rows)):
            gradient = y[i] * (w[rows[i]] @ values[i] + w[-1]) - 1
            new = min(max(alpha[i] - gradient / 2, 0.0), cost)
            if (step := new - alpha[i]) != 0:
                alpha[i] = new
                w[rows[i]] += step * y[i] * values[i]
                w[-1] += step * y[i]
                moved += abs(step) > 1e-3
        if not moved:
            break
    return w


def logistic_curve(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2) -> tuple[float, float]:
    """Slope and offset of P(y = 1 | x), by Newton's method with a small penalty on the slope."""
    a, b = 0.0, float(np.log((y.sum() + 1) / (len(y) - y.sum() + 1)))
    target = np.where(y == 1, (y.sum() + 1) / (y.sum() + 2), 1 / (len(y) - y.sum() + 2))
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a * x + b, -30, 30)))
        g, h = p - target, np.maximum(p * (1 - p), 1e-9)
        jacobian = np.array([[h @ (x * x) + ridge, h @ x], [h @ x, h.sum() + 1e-9]])
        step = np.linalg.solve(jacobian, [g @ x + ridge * a, g.sum()])
        a, b = a - step[0], b - step[1]
        if abs(step).max() < 1e-8:
            break
    return float(a), float(b)


def _ratios(rows: list[np.ndarray], y: np.ndarray) -> np.ndarray:
    counts = [
        np.bincount(np.concatenate([r for r, v in zip(rows, y, strict=True) if v == side] or [np.zeros(0, int)]), minlength=1 << BITS) + SMOOTHING
        for side in (1, -1)
    ]
    return np.log(counts[0] / counts[0].sum()) - np.log(counts[1] / counts[1].sum())


def _fit_once(rows: list[np.ndarray], y: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    r = _ratios(rows, y)
    values = [r[i] / max(float(np.sqrt(r[i] @ r[i])), 1e-12) for i in rows]
    w = _dual_descent(rows, values, y, COST, EPOCHS)
    plain = w[:-1]
    return r * ((1 - MIX) * np.abs(plain).mean() + MIX * plain) / MIX, r, w[-1]


def _margin(rows: list[np.ndarray], weights: np.ndarray, r: np.ndarray, bias: float) -> np.ndarray:
    return np.array([weights[i].sum() / max(float(np.sqrt(r[i] @ r[i])), 1e-12) + bias for i in rows])


def fit(rows: list[np.ndarray], labels: np.ndarray) -> Model:
    """A model of feature lists with labels 0 and 1; with a single class, or no row, the smoothed share of ones."""
    y = np.where(labels == 1, 1, -1)
    if len(set(labels.tolist())) < 2:
        zero = np.zeros(1 << BITS, np.float32)
        return Model(zero, zero, 0.0, 0.0, float(np.log((labels.sum() + 1) / (len(labels) - labels.sum() + 1))))
    margins, fold = np.zeros(len(rows)), np.arange(len(rows)) % FOLDS
    for k in range(FOLDS):
        inner = [i for i in range(len(rows)) if fold[i] != k]
        weights, r, bias = _fit_once([rows[i] for i in inner], y[inner])
        outer = np.flatnonzero(fold == k)
        margins[outer] = _margin([rows[i] for i in outer], weights, r, bias)
    slope, offset = logistic_curve(margins, (y == 1).astype(float))
    weights, r, bias = _fit_once(rows, y)
    return Model(weights.astype(np.float32), (r * r).astype(np.float32), float(bias), slope, offset)


def train(documents: DataFrame, labels: DataFrame, training: Column, label: str = "quality", sample: int = SAMPLE) -> Model:
    """Fit to at most ``sample`` of the rows of ``labels`` for which ``training`` holds.

    The sample is broadcast to the documents: its size is bounded by ``sample`` rows of an id and a label.
    Rows that share a labelled id count once, with their least text; null texts only where an id has no other.
    """
    chosen = labelled_sample(labels, label, training, sample)
    found = documents.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    # of the rows that share an id one is learned from, so what comes to the driver is bounded by the sample too
    found = found.groupBy("doc_id").agg(F.max("label").alias("label"), F.min("text").alias("text")).select("label", "text")
    got = found.mapInArrow(_feature_lists, "label int, features binary").collect()
    rows = [np.frombuffer(r.features, "<i4").astype(np.int64) for r in got]
    return fit(rows, np.array([r.label for r in got], np.int64))


def _score(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model.value
        for batch in batches:
            scores = np.zeros(batch.num_rows)
            at = batch.schema.get_field_index("text")
            for first, end, data, offsets in texts_of(batch.column(at)):
                text, feature = features(data, offsets)
                total = np.bincount(text, m.weights[feature], end - first)
                norm = np.sqrt(np.bincount(text, m.ratios2[feature], end - first))
                margin = total / np.maximum(norm, 1e-12) + m.bias
                scores[first:end] = 1 / (1 + np.exp(-np.clip(m.slope * margin + m.offset, -30, 30)))
            yield batch.drop_columns(["text"]).append_column("score", pa.array(scores))

    return run


def score(documents: DataFrame, model: Model, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` and ``score``, the probability of label 1, of every row.

    A null or empty text has no features and gets the score of a zero vector. Repeated rows are scored each for itself, an
    empty table gives an empty result; columns other than ``text`` and ``keep`` are not read.
    """
    rows = documents.select(*keep, "text")
    schema = ", ".join(f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in keep) + ", score double"
    return rows.mapInArrow(_score(documents.sparkSession.sparkContext.broadcast(model)), schema)


def held_out(parts: int, part: int) -> Column:
    """Rows whose crc32(doc_id as text) leaves ``part``; a null id is not held out."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % parts == part, F.lit(False))


def predictions(scored: DataFrame, out: Column, threshold: float = THRESHOLD) -> DataFrame:
    predicted = F.when(F.col("score") >= threshold, 1).otherwise(0)
    return scored.select("doc_id", out.alias("held_out"), "score", predicted.alias("predicted"))
