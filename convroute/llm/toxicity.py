"""Toxicity by FTRL-proximal logistic regression over hashed word n-grams and skip-grams (operator 4).

Each coordinate has a learning rate of its own, and L1 regularisation leaves most weights at exactly zero, so the
model is a short list of (feature, weight) whatever the size of the vocabulary: at most ``2 ** bits`` entries,
which bounds what is broadcast.  Features are indicators: words (lower-cased runs of letters and digits), pairs of
neighbours, pairs with one word between them, and stems of single words, as endings vary.

The model is fitted in one task on a bounded sample: ``sample_rows`` labelled documents at most, and no more once
``sample_features`` features are read.  Everything else runs where documents are read; nothing is shuffled.

Null and empty texts get the score of the bias alone.  Without labels of both kinds the score is the share of 1s,
smoothed.  Repeated rows score alike; null ids pass through (and count as the empty text where ids are hashed).
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField

from convroute.llm.ngrams import Gram, hashed, hashed_stems, indicators, labelled_features, read_sample
from convroute.llm.tables import map_texts
from convroute.llm.words import alphanumeric, split_words


@dataclass(frozen=True)
class FtrlConfig:
    bits: int = 20
    grams: tuple[Gram, ...] = ((0,), (0, 1), (0, 2))
    #: Characters of the stems.
    stems: tuple[int, ...] = (4, 5)
    alpha: float = 0.5
    beta: float = 1.0
    l1: float = 4.0
    l2: float = 1.0
    passes: int = 3
    sample_rows: int = 20_000
    sample_features: int = 1 << 24


@dataclass(frozen=True)
class LinearModel:
    bias: float
    features: np.ndarray
    weights: np.ndarray


def occurrences(texts: pa.Array, config: FtrlConfig) -> list[tuple[np.ndarray, np.ndarray]]:
    words = split_words(texts, alphanumeric())
    return [
        hashed(words, config.grams, config.bits, salt=1),
        hashed_stems(words, config.stems, config.bits, salt=100),
    ]


def extract(texts: pa.Array, config: FtrlConfig) -> tuple[np.ndarray, np.ndarray]:
    return indicators(len(texts), config.bits, occurrences(texts, config))


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -35.0, 35.0)))


def ftrl(labels: np.ndarray, first: np.ndarray, features: np.ndarray, config: FtrlConfig) -> LinearModel:
    """Fit in row order. The bias is one more coordinate, without L1 penalty."""
    if not len(labels) or labels.min() == labels.max():
        share = (labels.sum() + 1.0) / (len(labels) + 2.0)
        return LinearModel(float(np.log(share / (1 - share))), np.zeros(0, np.int64), np.zeros(0))
    z, n = np.zeros(1 << config.bits), np.zeros(1 << config.bits)
    z_bias, n_bias = np.zeros(1), np.zeros(1)

    def weights(z: np.ndarray, n: np.ndarray, l1: float) -> np.ndarray:
        over = np.abs(z) - l1
        rate = (config.beta + np.sqrt(n)) / config.alpha + config.l2
        return np.where(over > 0, -np.sign(z) * over / rate, 0.0)

    def moved(z: np.ndarray, n: np.ndarray, w: np.ndarray, gradient: float) -> tuple[np.ndarray, np.ndarray]:
        after = n + gradient * gradient
        return z + gradient - (np.sqrt(after) - np.sqrt(n)) / config.alpha * w, after

    bounds = first.tolist()
    for _ in range(config.passes):
        for a, b, label in zip(bounds[:-1], bounds[1:], labels.tolist(), strict=True):
            at = features[a:b]
            own_z, own_n = z[at], n[at]
            w, bias = weights(own_z, own_n, config.l1), weights(z_bias, n_bias, 0.0)
            gradient = float(_sigmoid(w.sum() + bias[0])) - label
            z[at], n[at] = moved(own_z, own_n, w, gradient)
            z_bias, n_bias = moved(z_bias, n_bias, bias, gradient)
    w = weights(z, n, config.l1)
    chosen = np.flatnonzero(w)
    return LinearModel(float(weights(z_bias, n_bias, 0.0)[0]), chosen, w[chosen])


def fit(documents: DataFrame, labels: DataFrame, label: str, config: FtrlConfig = FtrlConfig()) -> LinearModel:
    """Fit on ``documents`` (doc_id, text) and ``labels`` (doc_id, ``label``), already restricted to rows to learn."""
    sample = labelled_features(documents, labels, label, config.sample_rows, lambda texts: extract(texts, config))

    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = ftrl(*read_sample(batches, config.sample_features), config)
        at = np.append(model.features, -1)
        yield pa.RecordBatch.from_arrays(
            [pa.array(at, pa.int64()), pa.array(np.append(model.weights, model.bias))], names=["feature", "weight"]
        )

    found = sample.mapInArrow(train, "feature long, weight double").toPandas()
    own = found.feature >= 0
    bias = float(found.weight[~own].iloc[0]) if (~own).any() else 0.0
    return LinearModel(bias, found.feature[own].to_numpy(), found.weight[own].to_numpy())


def score(
    documents: DataFrame,
    model: LinearModel,
    config: FtrlConfig = FtrlConfig(),
    id_column: str = "doc_id",
    text_column: str = "text",
    carry: tuple[str, ...] = (),
) -> DataFrame:
    """(id, score, carried columns): probability of label 1 for each row."""
    shared = documents.sparkSession.sparkContext.broadcast(model)

    def make() -> Callable[[pa.Array], list[pa.Array]]:
        model = shared.value
        dense = np.zeros(1 << config.bits)
        dense[model.features] = model.weights

        def compute(texts: pa.Array) -> list[pa.Array]:
            weighty = [
                (text[dense[feature] != 0], feature[dense[feature] != 0])
                for text, feature in occurrences(texts, config)
            ]
            first, features = indicators(len(texts), config.bits, weighty)
            sums = np.concatenate([[0.0], np.cumsum(dense[features])])
            return [pa.array(_sigmoid(model.bias + sums[first[1:]] - sums[first[:-1]]))]

        return compute

    carried = {f"carried{i}": name for i, name in enumerate(carry)}
    fields = [StructField("score", DoubleType())]
    scored = map_texts(documents, {"id": id_column} | carried, text_column, fields, make)
    return scored.select(
        F.col("id").alias(id_column), "score", *[F.col(ours).alias(name) for ours, name in carried.items()]
    )
