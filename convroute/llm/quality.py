"""Quality by Naive Bayes support vectors (operator 8).

Each n-gram indicator is scaled by its class log-count ratio: how much more often it occurs in documents of label
1 than of label 0, smoothed.  A linear model with hinge loss is fitted to the scaled, length-normalised vectors by
dual coordinate descent: one variable per document, each step solving exactly for one of them.  N-grams are taken
from words and from word shapes (capitals, digits, signs), as both tell prose from debris.  A part of the sample
is kept out of the fit and used to turn margins into probabilities.

The model is two numbers for each of ``2 ** bits`` features, which bounds what is broadcast.  It is fitted in one
task on a bounded sample: ``sample_rows`` labelled documents at most, and no more once ``sample_features`` features
are read.  Scoring runs where documents are read; nothing is shuffled.

Null and empty texts have margin 0 from their features and get the score of the bias.  Without labels of both
kinds the score is the share of 1s, smoothed.  Repeated rows score alike; null ids pass through.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import DoubleType, StructField

from convroute.llm.ngrams import Gram, hashed, indicators, labelled_features, read_sample
from convroute.llm.tables import map_texts
from convroute.llm.words import alphanumeric, split_shapes, split_words


@dataclass(frozen=True)
class SupportConfig:
    bits: int = 18
    word_grams: tuple[Gram, ...] = ((0,), (0, 1))
    shape_grams: tuple[Gram, ...] = ((0,), (0, 1), (0, 1, 2))
    smoothing: float = 1.0
    #: Largest dual variable: the cost of a document on the wrong side, weighted by the rarity of its class.
    cost: float = 4.0
    passes: int = 12
    tolerance: float = 1e-3
    #: One of so many sample rows serves the calibration instead of the fit.
    calibration_every: int = 4
    sample_rows: int = 20_000
    sample_features: int = 1 << 24


@dataclass(frozen=True)
class SupportModel:
    #: Scale and weight by feature; margins are slope * margin + offset in log-odds.
    ratios: np.ndarray
    weights: np.ndarray
    bias: float
    slope: float
    offset: float


def extract(texts: pa.Array, config: SupportConfig) -> tuple[np.ndarray, np.ndarray]:
    words = hashed(split_words(texts, alphanumeric()), config.word_grams, config.bits, salt=2)
    shapes = hashed(split_shapes(texts), config.shape_grams, config.bits, salt=3)
    return indicators(len(texts), config.bits, [words, shapes])


def log_count_ratios(
    labels: np.ndarray, first: np.ndarray, features: np.ndarray, size: int, smoothing: float
) -> np.ndarray:
    label = np.repeat(labels, np.diff(first))
    counts = [np.bincount(features[label == k], minlength=size) + smoothing for k in (1, 0)]
    return np.log(counts[0] / counts[0].sum()) - np.log(counts[1] / counts[1].sum())


def dual_coordinate_descent(
    row: Callable[[int], tuple[np.ndarray, np.ndarray]],
    signs: np.ndarray,
    limits: np.ndarray,
    size: int,
    config: SupportConfig,
) -> tuple[np.ndarray, float]:
    """Weights and bias of the hinge-loss model. ``row`` gives (features, values) of unit length; the bias is a feature."""
    weights, bias = np.zeros(size), 0.0
    dual = np.zeros(len(signs))
    order = np.random.default_rng(7)
    for _ in range(config.passes):
        worst = 0.0
        for i in order.permutation(len(signs)).tolist():
            at, value = row(i)
            slope = signs[i] * (float(weights[at] @ value) + bias) - 1.0
            # The curvature is the squared length of the row: its own and the bias feature's.
            new = min(max(dual[i] - slope / (1.0 + (1.0 if len(at) else 0.0)), 0.0), limits[i])
            step = new - dual[i]
            if step:
                worst = max(worst, abs(step))
                dual[i] = new
                weights[at] += step * signs[i] * value
                bias += step * signs[i]
        if worst < config.tolerance:
            break
    return weights, bias


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -35.0, 35.0)))


def calibrate(margins: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """Slope and offset of the log-odds by Newton steps on smoothed targets; the slope stays positive."""
    ones = float(labels.sum())
    target = np.where(labels == 1, (ones + 1) / (ones + 2), 1 / (len(labels) - ones + 2))
    x = np.stack([margins, np.ones(len(margins))], 1)
    theta = np.array([1.0, 0.0])
    for _ in range(50):
        p = _sigmoid(x @ theta)
        gradient = x.T @ (p - target) + 1e-3 * (theta - [1.0, 0.0])
        hessian = (x * (p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2)
        step = np.linalg.solve(hessian, gradient)
        theta -= step * min(1.0, 2.0 / max(1e-12, float(np.abs(step).max())))
        if np.abs(step).max() < 1e-8:
            break
    return max(float(theta[0]), 1e-3), float(theta[1])


def support_vectors(
    labels: np.ndarray, first: np.ndarray, features: np.ndarray, config: SupportConfig
) -> SupportModel:
    size = 1 << config.bits
    place = np.arange(len(labels))
    kept_out = place % config.calibration_every == 0
    fits = [labels[~kept_out], labels[kept_out]]
    if any(len(part) == 0 or part.min() == part.max() for part in fits):
        share = (labels.sum() + 1.0) / (len(labels) + 2.0)
        offset = float(np.log(share / (1 - share)))
        return SupportModel(np.zeros(size), np.zeros(size), 0.0, 1.0, offset)
    fit_rows = np.repeat(~kept_out, np.diff(first))
    fit_first = np.concatenate([[0], np.cumsum(np.diff(first)[~kept_out])])
    ratios = log_count_ratios(fits[0], fit_first, features[fit_rows], size, config.smoothing)

    def row(i: int) -> tuple[np.ndarray, np.ndarray]:
        at = features[first[i] : first[i + 1]]
        value = ratios[at]
        norm = np.sqrt(value @ value)
        return (at, value / norm) if norm > 0 else (at[:0], value[:0])

    signs = np.where(labels == 1, 1.0, -1.0)
    share = np.where(labels == 1, fits[0].mean(), 1 - fits[0].mean())
    limits = config.cost * 0.5 / share
    fit = np.flatnonzero(~kept_out)
    weights, bias = dual_coordinate_descent(lambda i: row(fit[i]), signs[fit], limits[fit], size, config)
    margins = np.array([float(weights[at] @ value) + bias for at, value in map(row, place[kept_out])])
    slope, offset = calibrate(margins, fits[1])
    return SupportModel(ratios, weights, bias, slope, offset)


def fit(
    documents: DataFrame, labels: DataFrame, label: str, config: SupportConfig = SupportConfig()
) -> SupportModel:
    """Fit on ``documents`` (doc_id, text) and ``labels`` (doc_id, ``label``), already restricted to rows to learn."""
    sample = labelled_features(documents, labels, label, config.sample_rows, lambda texts: extract(texts, config))

    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = support_vectors(*read_sample(batches, config.sample_features), config)
        arrays = [
            model.ratios.astype("<f8").tobytes(),
            model.weights.astype("<f8").tobytes(),
            model.bias,
            model.slope,
            model.offset,
        ]
        names = ["ratios", "weights", "bias", "slope", "offset"]
        yield pa.RecordBatch.from_arrays([pa.array([x]) for x in arrays], names=names)

    schema = "ratios binary, weights binary, bias double, slope double, offset double"
    row = sample.mapInArrow(train, schema).first()
    if row is None:
        return support_vectors(np.zeros(0, np.int64), np.zeros(1, np.int64), np.zeros(0, np.int32), config)
    return SupportModel(np.frombuffer(row[0], "<f8"), np.frombuffer(row[1], "<f8"), row[2], row[3], row[4])


def score(
    documents: DataFrame,
    model: SupportModel,
    config: SupportConfig = SupportConfig(),
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """(id, score): probability of label 1 for each row."""
    shared = documents.sparkSession.sparkContext.broadcast(model)

    def make() -> Callable[[pa.Array], list[pa.Array]]:
        model = shared.value
        products, squares = model.ratios * model.weights, model.ratios**2

        def compute(texts: pa.Array) -> list[pa.Array]:
            first, features = extract(texts, config)

            def sums(table: np.ndarray) -> np.ndarray:
                running = np.concatenate([[0.0], np.cumsum(table[features])])
                return running[first[1:]] - running[first[:-1]]

            length = np.sqrt(np.maximum(sums(squares), 0.0))
            margin = np.where(length > 1e-9, sums(products) / np.maximum(length, 1e-9), 0.0) + model.bias
            return [pa.array(_sigmoid(model.slope * margin + model.offset))]

        return compute

    return map_texts(documents, {id_column: id_column}, text_column, [StructField("score", DoubleType())], make)
