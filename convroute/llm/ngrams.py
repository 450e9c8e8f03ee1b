"""Hashed n-gram indicators of texts, and the labelled sample that classifiers are fitted on."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StructField

from convroute.llm.tables import map_texts
from convroute.llm.words import RunHashes, Words, mixed

#: Which words of a window an n-gram takes, by their places.
Gram = tuple[int, ...]

_FACTORS = np.array([0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB], np.uint64)


def hashed(words: Words, grams: tuple[Gram, ...], bits: int, salt: int) -> tuple[np.ndarray, np.ndarray]:
    """(text, feature) of every n-gram inside one text, repeats included."""
    word = RunHashes(words.data)(words.start, words.end) + np.uint64(salt)
    text = words.text_of_word()
    texts, features = [], []
    for k, gram in enumerate(grams):
        n = max(0, len(word) - gram[-1])
        value = np.full(n, k + 1, np.uint64)
        for place, factor in zip(gram, _FACTORS, strict=False):
            value = value * factor + word[place : place + n]
        inside = text[:n] == text[gram[-1] : gram[-1] + n]
        texts.append(text[:n][inside])
        features.append((mixed(value[inside]) >> np.uint64(64 - bits)).astype(np.int64))
    return np.concatenate(texts), np.concatenate(features)


def hashed_stems(words: Words, lengths: tuple[int, ...], bits: int, salt: int) -> tuple[np.ndarray, np.ndarray]:
    """(text, feature) of the first characters of every word, for each length that the word reaches.

    Stems stand for words whose endings vary.
    """
    run = RunHashes(words.data)
    begins = np.flatnonzero((words.data & 0xC0) != 0x80)
    begins = np.concatenate([begins, np.full(max(lengths) + 1, len(words.data))])
    place = np.searchsorted(begins, words.start)
    text = words.text_of_word()
    texts, features = [], []
    for k in lengths:
        end = begins[place + k]
        long = end <= words.end
        value = run(words.start[long], end[long]) + np.uint64(salt + k)
        texts.append(text[long])
        features.append((mixed(value) >> np.uint64(64 - bits)).astype(np.int64))
    return np.concatenate(texts), np.concatenate(features)


def indicators(n_texts: int, bits: int, parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct features of each text: where each text begins (and the end), and the features in order."""
    keys = np.concatenate([(text << bits) | feature for text, feature in parts])
    keys.sort()
    if len(keys):
        keys = keys[np.concatenate([[True], keys[1:] != keys[:-1]])]
    return np.searchsorted(keys >> bits, np.arange(n_texts + 1)), (keys & ((1 << bits) - 1)).astype(np.int32)


def remainder(id_column: str, modulus: int) -> Column:
    """crc32 of the id as text (null: empty text), modulo ``modulus``."""
    return F.crc32(F.coalesce(F.col(id_column).cast("string"), F.lit("")).cast("binary")) % modulus


def labelled_features(
    documents: DataFrame,
    labels: DataFrame,
    label: str,
    rows: int,
    extract: Callable[[pa.Array], tuple[np.ndarray, np.ndarray]],
) -> DataFrame:
    """(label, features) of at most ``rows`` labelled documents in one ordered partition.

    ``labels`` has ``doc_id`` and the label, which counts as 1 if any of a document's rows says so.  The sample is
    the rows of lowest hash of the id: any subset of the labels, the same on every run.  Its ids are broadcast,
    which ``rows`` bounds; features are computed where the documents are read.
    """
    sample = (
        labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull())
        .groupBy("doc_id")
        .agg(F.max((F.col(label) > 0).cast("int")).alias("__label"))
        .withColumn("__order", F.xxhash64("doc_id"))
        .orderBy("__order", "doc_id")
        .limit(rows)
    )
    texts = documents.select("doc_id", F.col("text").alias("__document"))
    chosen = texts.join(F.broadcast(sample), "doc_id")

    def make() -> Callable[[pa.Array], list[pa.Array]]:
        def compute(batch: pa.Array) -> list[pa.Array]:
            first, features = extract(batch)
            return [pa.ListArray.from_arrays(pa.array(first, pa.int32()), pa.array(features, pa.int32()))]

        return compute

    fields = [StructField("features", ArrayType(IntegerType()))]
    keys = {"order": "__order", "doc_id": "doc_id", "label": "__label"}
    found = map_texts(chosen, keys, "__document", fields, make)
    return found.repartition(1).sortWithinPartitions("order", "doc_id", "features").select("label", "features")


def read_sample(batches: Iterator[pa.RecordBatch], most_features: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(labels, first, features) of the rows until ``most_features`` features are reached."""
    labels, sizes, features = [], [], []
    total = 0
    for batch in batches:
        if total >= most_features:
            continue
        column = batch.column("features")
        labels.append(batch.column("label").to_numpy(zero_copy_only=False))
        sizes.append(np.diff(column.offsets.to_numpy()))
        features.append(column.flatten().to_numpy(zero_copy_only=False).copy())
        total += len(features[-1])
    if not labels:
        return np.zeros(0, np.int64), np.zeros(1, np.int64), np.zeros(0, np.int32)
    first = np.concatenate([[0], np.cumsum(np.concatenate(sizes))])
    return np.concatenate(labels), first, np.concatenate(features)
