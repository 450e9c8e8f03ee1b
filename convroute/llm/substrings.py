"""Exact removal of repeated passages by super-k-mer partitioning (operator 1).

A window is ``window`` consecutive words of one document.  Its minimiser is the least hash of the runs of
``minimiser`` words in it, so equal windows have equal minimisers.  Consecutive windows that share one are a
super-k-mer and travel as one packed string, which is far shorter than its windows.  Strings of one minimiser meet
in one bucket, where the windows are sorted and counted (by 128 bits of hash each).

1.  ``super_kmers``: minimiser, place and length of every super-k-mer, one stored row per document, no text.
2.  Minimisers that occur once cannot belong to a repeated window.  They are counted (combined before the shuffle),
    and only super-k-mers of repeated minimisers go on; a super-k-mer that holds its minimiser twice counts twice.
3.  Their strings are cut out of the texts and sent to their buckets.
4.  Buckets are split into parts of about ``bucket_rows`` strings, so that no task gets a hot minimiser whole.  A
    window that occurs twice in a part is repeated.  Parts of a split bucket also pass on each of their distinct
    windows once, and those that occur once in two parts are found by one more aggregation.
5.  Covered word ranges are grouped by document and joined to the texts, which were shuffled once for both joins.

Documents are told apart by 128 bits of hash of id and text: rows that are equal in both get equal results.  Null
and empty texts have no words.  Texts of fewer words than a window keep all.  All memory is bounded by one document
or one part of a bucket.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from convroute.llm.tables import row_keys
from convroute.llm.words import RunHashes, blank_separated, run_hashes, slices, split_words, word_hashes
from convroute.workspace import Workspace


@dataclass(frozen=True)
class WindowConfig:
    #: Words of a window and of the runs that minimisers are chosen from.
    window: int = 35
    minimiser: int = 12
    #: Strings of one part of a bucket, about.
    bucket_rows: int = 1024
    #: Windows of one super-k-mer at most; repetitive texts would make longer ones.
    longest: int = 4096
    #: Rows that one task counts together.
    counted_rows: int = 2048

    def __post_init__(self) -> None:
        if not 1 <= self.minimiser <= self.window:
            raise ValueError("minimisers must fit into windows")


_TABLE = blank_separated(lower=False)
_KEYS = ("k1", "k2")


def _keyed(df: DataFrame, id_column: str, text_column: str, carry: tuple[str, ...]) -> DataFrame:
    """(k1, k2, id, text, carried columns) under names of our own."""
    chosen = df.select(
        F.col(id_column).alias("id"),
        F.col(text_column).alias("text"),
        *[F.col(name).alias(f"carried{i}") for i, name in enumerate(carry)],
    )
    return chosen.select(*[key.alias(name) for name, key in row_keys("id", "text").items()], *chosen.columns)


def _sliding_least(values: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Least value of every ``width`` consecutive ones and its leftmost place, by doubling."""
    least, place, have = values, np.arange(len(values)), 1
    while have < width:
        step = min(have, width - have)
        left = least[: len(least) - step] <= least[step:]
        place = np.where(left, place[: len(place) - step], place[step:])
        least = np.minimum(least[: len(least) - step], least[step:])
        have += step
    return least, place


def super_kmers_of(texts: pa.Array, config: WindowConfig) -> tuple[np.ndarray, ...]:
    """(text, minimiser, first window, windows, repeats) of the super-k-mers of some texts.

    ``repeats`` tells whether the least hash occurs at more than one place, so that windows may repeat inside.
    """
    words = split_words(texts, _TABLE)
    window, m = config.window, config.minimiser
    if len(words) < window:
        none = np.zeros(0, np.int64)
        return none, none, none, none, none.astype(bool)
    runs = RunHashes(words.data)(words.start[: len(words) - m + 1], words.end[m - 1 :])
    least, place = _sliding_least(runs, window - m + 1)
    text = words.text_of_word()
    inside = text[: len(least)] == text[window - 1 :]
    at = np.flatnonzero(inside)
    least, place, text = least[at], place[at], text[at]
    number = at - words.first[text]
    new = np.ones(len(at), bool)
    new[1:] = (least[1:] != least[:-1]) | (text[1:] != text[:-1]) | (number[1:] % config.longest == 0)
    moved = np.zeros(len(at), bool)
    moved[1:] = ~new[1:] & (place[1:] != place[:-1])
    first = np.flatnonzero(new)
    length = np.diff(np.append(first, len(at)))
    repeats = np.add.reduceat(moved.astype(np.int64), first) > 0 if len(first) else np.zeros(0, bool)
    return text[first], least[first].view(np.int64), number[first], length, repeats


def super_kmers(documents: DataFrame, config: WindowConfig) -> DataFrame:
    """(k1, k2, minimisers, firsts, lengths, repeats) of every document with at least one window."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                text, least, first, length, repeats = super_kmers_of(part.column("text"), config)
                owners, begin = np.unique(text, return_index=True)
                offsets = pa.array(np.append(begin, len(text)), pa.int32())
                arrays = [part.column(k).take(pa.array(owners)) for k in _KEYS]
                for values, kind in ((least, pa.int64()), (first, pa.int32()), (length, pa.int32()),
                                     (repeats, pa.bool_())):
                    arrays.append(pa.ListArray.from_arrays(offsets, pa.array(values, kind)))
                yield pa.RecordBatch.from_arrays(
                    arrays, names=[*_KEYS, "minimisers", "firsts", "lengths", "repeats"]
                )

    schema = (
        "k1 long, k2 long, minimisers array<long>, firsts array<int>, lengths array<int>, repeats array<boolean>"
    )
    return documents.select(*_KEYS, "text").mapInArrow(run, schema)


def _strings(found: DataFrame, config: WindowConfig) -> DataFrame:
    """(minimiser, part, parts, k1, k2, first, packed): the text of each chosen super-k-mer."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                words = split_words(part.column("text"), _TABLE)
                chosen = part.column("chosen")
                counts = np.diff(chosen.offsets.to_numpy())
                flat = chosen.flatten()
                owner = np.repeat(np.arange(part.num_rows), counts)
                first, length, parts = (flat.field(n).to_numpy().astype(np.int64) for n in ("first", "length", "parts"))
                minimiser = flat.field("minimiser").to_numpy()
                begin = words.start[words.first[owner] + first]
                end = words.end[words.first[owner] + first + length + config.window - 2]
                raw = words.data.tobytes()
                packed = [raw[a:b] for a, b in zip(begin.tolist(), end.tolist(), strict=True)]
                keys = [part.column(k).to_numpy()[owner] for k in _KEYS]
                spread = (keys[0] ^ (first * 0x9E3779B1)) & 0x7FFFFFFF
                arrays = [minimiser, spread % parts, parts, *keys, first, packed]
                kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(a, k) for a, k in zip(arrays, kinds, strict=True)],
                    names=["minimiser", "part", "parts", *_KEYS, "first", "packed"],
                )

    schema = "minimiser long, part long, parts long, k1 long, k2 long, first long, packed binary"
    return found.mapInArrow(run, schema)


def _count_chunk(table: pa.Table, config: WindowConfig) -> pa.RecordBatch:
    """Repeated windows of whole parts of buckets, as covered word ranges; and what other parts must know.

    Rows with ``times`` are distinct windows of split buckets: hash, times, and the owner of one that occurs once.
    """
    column = {name: table.column(name).to_numpy() for name in ("minimiser", "part", "parts", *_KEYS, "first")}
    words = split_words(table.column("packed").combine_chunks(), _TABLE)
    n = config.window
    bucket = np.ones(table.num_rows, bool)
    bucket[1:] = (np.diff(column["minimiser"]) != 0) | (np.diff(column["part"]) != 0)
    bucket = np.cumsum(bucket)
    row = words.text_of_word()
    at = np.flatnonzero(row[: len(row) - n + 1] == row[n - 1 :])
    one, two = (run_hashes(word_hashes(words, which), n)[at] for which in (0, 1))
    row = row[at]
    place = column["first"][row] + at - words.first[row]
    order = np.lexsort((two, one, bucket[row]))
    sorted_bucket, sorted_one, sorted_two = bucket[row][order], one[order], two[order]
    new = np.ones(len(order), bool)
    new[1:] = (np.diff(sorted_bucket) != 0) | (sorted_one[1:] != sorted_one[:-1]) | (sorted_two[1:] != sorted_two[:-1])
    starts = np.flatnonzero(new)
    times = np.diff(np.append(starts, len(order)))
    repeated = np.zeros(len(order), bool)
    repeated[order] = np.repeat(times > 1, times)

    # Ranges of covered words: windows come in order of row and place.
    hit = np.flatnonzero(repeated)
    joins = np.zeros(len(hit), bool)
    joins[1:] = (row[hit[1:]] == row[hit[:-1]]) & (place[hit[1:]] - place[hit[:-1]] <= n)
    opens = np.flatnonzero(~joins)
    closes = np.append(opens[1:], len(hit)) - 1 if len(opens) else opens
    ranges = [column[k][row[hit[opens]]] for k in _KEYS] + [place[hit[opens]], place[hit[closes]] + n]

    # One row for each distinct window of a split bucket.
    lone = order[starts]
    shared = np.flatnonzero(column["parts"][row[lone]] > 1)
    lone, times = lone[shared], times[shared]
    none = np.zeros(len(opens), np.int64)
    arrays = [
        np.concatenate([ranges[0], column["k1"][row[lone]]]),
        np.concatenate([ranges[1], column["k2"][row[lone]]]),
        np.concatenate([ranges[2], place[lone]]),
        np.concatenate([ranges[3], place[lone] + n]),
        np.concatenate([none, one[lone].view(np.int64)]),
        np.concatenate([none, two[lone].view(np.int64)]),
        np.concatenate([none, times]),
    ]
    return pa.RecordBatch.from_arrays(
        [pa.array(a, pa.int64()) for a in arrays], names=[*_KEYS, "begin", "end", "one", "two", "times"]
    )


def _counted(strings: DataFrame, config: WindowConfig) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: pa.Table | None = None
        for batch in batches:
            for begin in range(0, batch.num_rows, config.counted_rows):
                part = pa.Table.from_batches([batch.slice(begin, config.counted_rows)])
                kept = part if kept is None else pa.concat_tables([kept, part])
                if kept.num_rows < config.counted_rows:
                    continue
                # The last part of a bucket may go on in the next batch.
                minimiser, number = (kept.column(name).to_numpy() for name in ("minimiser", "part"))
                other = np.flatnonzero((minimiser != minimiser[-1]) | (number != number[-1]))
                if len(other):
                    whole = int(other[-1]) + 1
                    yield _count_chunk(kept.slice(0, whole), config)
                    kept = kept.slice(whole)
        if kept is not None and kept.num_rows:
            yield _count_chunk(kept, config)

    gathered = strings.repartition("minimiser", "part").sortWithinPartitions("minimiser", "part")
    return gathered.mapInArrow(
        run, "k1 long, k2 long, begin long, end long, one long, two long, times long"
    )


def _removed(joined: DataFrame, carried: list[str], untouched: bool) -> DataFrame:
    fields = [joined.schema[name] for name in ("id", *carried)]
    schema = StructType(
        [
            *fields,
            StructField("n_words", LongType()),
            StructField("n_removed", LongType()),
            StructField("kept_text", StringType()),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                words = split_words(part.column("text"), _TABLE)
                ranges = part.column("ranges")
                sizes = np.diff(ranges.offsets.to_numpy())
                flat = ranges.flatten()
                owner = words.first[np.repeat(np.arange(part.num_rows), sizes)]
                change = np.zeros(len(words) + 1, np.int64)
                np.add.at(change, owner + flat.field("begin").to_numpy(), 1)
                np.add.at(change, owner + flat.field("end").to_numpy(), -1)
                gone = np.cumsum(change[:-1]) > 0
                byte_kept = np.repeat(~gone, words.end - words.start + 1)
                kept_bytes = np.concatenate([[0], np.cumsum(byte_kept)])
                raw = words.data[byte_kept].tobytes()
                bounds = np.append(words.start, len(words.data))[words.first]
                cut = kept_bytes[bounds].tolist()
                # Each word brings a blank along; the last one goes.
                texts = [raw[a : max(a, b - 1)].decode() for a, b in zip(cut[:-1], cut[1:], strict=True)]
                removed = np.concatenate([[0], np.cumsum(gone)])[words.first]
                if untouched:
                    whole = part.column("text").to_pylist()
                    texts = [t if n else w for t, w, n in zip(texts, whole, np.diff(removed).tolist(), strict=True)]
                arrays = [part.column(f.name) for f in fields]
                arrays += [
                    pa.array(words.counts, pa.int64()),
                    pa.array(np.diff(removed), pa.int64()),
                    pa.array(texts, pa.string()),
                ]
                yield pa.RecordBatch.from_arrays(arrays, names=schema.names)

    return joined.select(*[f.name for f in fields], "text", "ranges").mapInArrow(run, schema)


def remove_repeats(
    df: DataFrame,
    config: WindowConfig = WindowConfig(),
    id_column: str = "doc_id",
    text_column: str = "text",
    carry: tuple[str, ...] = (),
    untouched: bool = False,
) -> DataFrame:
    """(id, carried columns, n_words, n_removed, kept_text) of every row.

    A word goes if some window that covers it begins at another place too, in this document or another.  Kept words
    are joined by one blank; with ``untouched``, texts that lose nothing stay as they are.
    """
    documents = _keyed(df, id_column, text_column, carry)
    stored = Workspace(df.sparkSession, "super-kmers").save(super_kmers(documents, config), "places")
    each = stored.select(
        *_KEYS, F.explode(F.arrays_zip("minimisers", "firsts", "lengths", "repeats")).alias("s")
    ).select(
        *_KEYS,
        F.col("s.minimisers").alias("minimiser"),
        F.col("s.firsts").alias("first"),
        F.col("s.lengths").alias("length"),
        F.col("s.repeats").alias("repeats"),
    )
    repeated = (
        each.groupBy("minimiser")
        .agg(F.count(F.lit(1)).alias("n"), F.max("repeats").alias("inside"))
        .where((F.col("n") > 1) | F.col("inside"))
        .select("minimiser", F.ceil(F.col("n") / config.bucket_rows).alias("parts"))
    )
    chosen = (
        each.join(repeated, "minimiser")
        .groupBy(*_KEYS)
        .agg(F.collect_set(F.struct("first", "length", "parts", "minimiser")).alias("chosen"))
    )
    strings = _strings(documents.join(chosen, [*_KEYS]), config)
    counted = _counted(strings, config)
    # Ranges found inside a part go along under their document's key: else buckets would be counted twice.
    is_range = F.col("times") == 0
    by = {ours: F.when(is_range, F.col(key)).otherwise(F.col(ours)) for ours, key in zip(("one", "two"), _KEYS, strict=True)}
    found = (
        counted.withColumns(by)
        .groupBy(is_range.alias("is_range"), "one", "two")
        .agg(
            F.sum("times").alias("n"),
            F.collect_list(F.when(F.col("times") <= 1, F.struct(*_KEYS, "begin", "end"))).alias("owners"),
        )
        .where("is_range or n > 1")
        .select(F.inline("owners"))
    )
    ranges = found.groupBy(*_KEYS).agg(F.collect_list(F.struct("begin", "end")).alias("ranges"))
    none = F.array().cast("array<struct<begin:bigint,end:bigint>>")
    joined = documents.join(ranges, [*_KEYS], "left").withColumn("ranges", F.coalesce("ranges", none))
    carried = [f"carried{i}" for i in range(len(carry))]
    result = _removed(joined, carried, untouched)
    return result.select(
        F.col("id").alias(id_column),
        *[F.col(ours).alias(name) for ours, name in zip(carried, carry, strict=True)],
        "n_words",
        "n_removed",
        "kept_text",
    )
