"""Packing of token streams into sequences of bounded length (operator 9).

Documents keep their order: each task lays the tokens of its rows end to end and cuts the stream into windows of
at most ``length`` tokens.  Where to cut is a shortest path, solved block by block by dynamic programming.  A
window costs its padding, and its end costs a penalty by what it truncates: nothing at the end of a document,
little at the end of a sentence, and elsewhere (tried on a grid of tokens, so that some cut is always in reach) a
fifth of a window, so that boundaries that near win: under 2 % of the windows end inside a sentence though a boundary
lies in their last tenth (tested).
As padding is ``length`` less the distance of two cuts, the best previous cut is the least value in a sliding
window, which a monotone queue gives in constant time.

What remains at the end of a block leads the next block.  At the end of a task it is cut into powers of two, which
need no padding, so small tasks do not pad more than large ones.  Nothing is shuffled: tasks number sequences in
ranges of their own (by partition), and memory holds one block (or one longer document).

Null and empty texts are the end token alone.  Repeated rows are packed as often as they occur.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StructField, StructType

from convroute.llm.byte_bpe import Encoder
from convroute.llm.words import slices


@dataclass(frozen=True)
class PackingConfig:
    length: int = 1024
    end_token: int = 0
    #: Penalties of a cut inside a document, in tokens of padding.
    sentence_penalty: int = 4
    #: A fifth of a window, so that boundaries within reach of that are chosen instead.
    elsewhere_penalty: int = 205
    #: Distance of the cuts tried inside sentences.
    grid: int = 32
    #: Tokens solved at once.
    block_tokens: int = 1 << 18

    def __post_init__(self) -> None:
        if not 0 < self.grid <= self.length:
            raise ValueError("grid must be between 1 and length")


#: Sequence numbers of one task.
_TASK_RANGE = 1 << 40

_encoders: dict[str, tuple[Encoder, np.ndarray]] = {}


def _encoder(vocabulary: str) -> tuple[Encoder, np.ndarray]:
    """The encoder, and for each id whether it ends a sentence; kept as long as the Python worker."""
    if vocabulary not in _encoders:
        encoder = Encoder(vocabulary)
        # The vocabulary shows a line feed as U+010A.
        ends = np.array([encoder.token(i).endswith((".", "!", "?", "\u010a")) for i in range(encoder.size)])
        _encoders[vocabulary] = encoder, ends
    return _encoders[vocabulary]


def best_cuts(places: np.ndarray, penalties: np.ndarray, length: int) -> list[int]:
    """Indices of the cheapest cuts of a stream that begins at place 0.

    ``places`` ascend and leave no gap over ``length``; the last is the end of the stream.  The path may stop at
    any place within ``length`` of the end; what is left there is not a window yet.
    """
    stops, penalty = [0, *places.tolist()], [0, *penalties.tolist()]
    # A cut's cost plus its place: the window before it adds length - (place - previous place) and the penalty.
    value, previous = [0] * len(stops), [-1] * len(stops)
    queue: list[int] = [0]
    head = 0
    for j in range(1, len(stops)):
        reach = stops[j] - length
        while stops[queue[head]] < reach:
            head += 1
        previous[j] = best = queue[head]
        value[j] = v = value[best] + length + penalty[j]
        while len(queue) > head and value[queue[-1]] >= v:
            queue.pop()
        queue.append(j)
    tail = [j for j in range(len(stops)) if stops[-1] - stops[j] < length]
    # What is left after the last cut leads the next block and costs nothing yet.
    j = min(tail, key=lambda k: (value[k] - stops[k], -k))
    path = []
    while j > 0:
        path.append(j - 1)
        j = previous[j]
    return path[::-1]


def _powers_of_two(total: int) -> list[int]:
    return [1 << bit for bit in reversed(range(total.bit_length())) if total >> bit & 1]


@dataclass
class _Document:
    key: object
    ids: np.ndarray
    #: Tokens of this document that earlier blocks have packed.
    done: int
    total: int


class _Packer:
    def __init__(self, config: PackingConfig, ends_sentence: np.ndarray, first_sequence: int):
        self.config, self.ends_sentence, self.sequence = config, ends_sentence, first_sequence
        self.documents: list[_Document] = []
        self.tokens = 0

    def add(self, key: object, ids: np.ndarray) -> Iterator[list[tuple]]:
        self.documents.append(_Document(key, ids, 0, len(ids)))
        self.tokens += len(ids)
        if self.tokens >= self.config.block_tokens:
            yield self._flush(last=False)

    def finish(self) -> Iterator[list[tuple]]:
        if self.tokens:
            yield self._flush(last=True)

    def _flush(self, last: bool) -> list[tuple]:
        config = self.config
        sizes = np.array([len(d.ids) for d in self.documents])
        ends = np.cumsum(sizes)
        stream = np.concatenate([d.ids for d in self.documents])
        penalties = np.full(len(stream) + 1, -1, np.int32)
        for begin, end in zip(ends - sizes, ends, strict=True):
            penalties[begin + config.grid : end : config.grid] = config.elsewhere_penalty
        known = np.minimum(stream, len(self.ends_sentence) - 1)
        penalties[1:][self.ends_sentence[known]] = config.sentence_penalty
        penalties[ends] = 0
        places = np.flatnonzero(penalties[1:] >= 0) + 1
        cuts = places[best_cuts(places, penalties[places], config.length)]
        if last:
            rest = _powers_of_two(len(stream) - (int(cuts[-1]) if len(cuts) else 0))
            cuts = np.concatenate([cuts, (cuts[-1] if len(cuts) else 0) + np.cumsum(rest, dtype=np.int64)]).astype(int)
        if not len(cuts):
            return []
        rows = self._pieces(stream, ends, sizes, cuts)
        self._keep_rest(ends, sizes, int(cuts[-1]))
        self.sequence += len(cuts)
        return rows

    def _pieces(self, stream: np.ndarray, ends: np.ndarray, sizes: np.ndarray, cuts: np.ndarray) -> list[tuple]:
        stops = np.union1d(cuts, ends[ends <= cuts[-1]])
        begins = np.concatenate([[0], stops[:-1]])
        document = np.searchsorted(ends, begins, "right")
        window = np.searchsorted(cuts, begins, "right")
        window_begin = np.concatenate([[0], cuts[:-1]])[window]
        raw = stream.astype("<u4").tobytes()
        rows = []
        for a, b, d, w, o in zip(
            begins.tolist(), stops.tolist(), document.tolist(), window.tolist(), window_begin.tolist(), strict=True
        ):
            doc = self.documents[d]
            start = doc.done + a - int(ends[d] - sizes[d])
            rows.append((doc.key, start, b - a, raw[4 * a : 4 * b], doc.total, self.sequence + w, a - o))
        return rows

    def _keep_rest(self, ends: np.ndarray, sizes: np.ndarray, packed: int) -> None:
        rest = []
        for doc, end, size in zip(self.documents, ends.tolist(), sizes.tolist(), strict=True):
            if end > packed:
                used = max(0, packed - (end - size))
                rest.append(replace(doc, ids=doc.ids[used:].copy(), done=doc.done + used))
        self.documents = rest
        self.tokens = sum(len(d.ids) for d in rest)


def pack(
    df: DataFrame,
    vocabulary: str,
    config: PackingConfig = PackingConfig(),
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """One row per piece: (id, start, length, ids, doc_tokens, sequence_id, offset).

    ``ids`` are little-endian unsigned 32-bit numbers.  A document's pieces lie in consecutive sequences.
    """
    # The number of the stored partition, which keeps packers apart that a coalesced task runs one after another.
    chosen = df.select(
        F.col(id_column).alias(id_column), F.col(text_column).alias("__text"), F.spark_partition_id().alias("__partition")
    )
    key_field = chosen.schema.fields[0]
    names = ("start", "length", "ids", "doc_tokens", "sequence_id", "offset")
    kinds = [BinaryType() if name == "ids" else LongType() for name in names]
    schema = StructType([key_field, *map(StructField, names, kinds)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, ends_sentence = _encoder(vocabulary)
        end = np.array([config.end_token], np.uint32)
        packer: _Packer | None = None
        key_type = None

        def table(rows: list[tuple]) -> pa.RecordBatch:
            columns = list(zip(*rows, strict=True))
            kinds = [key_type, pa.int64(), pa.int64(), pa.binary(), *[pa.int64()] * 3]
            arrays = [pa.array(c, kind) for c, kind in zip(columns, kinds, strict=True)]
            return pa.RecordBatch.from_arrays(arrays, names=[key_field.name, *names])

        for batch in batches:
            key_type = batch.schema.types[0]
            if packer is None and batch.num_rows:
                packer = _Packer(config, ends_sentence, batch.column("__partition")[0].as_py() * _TASK_RANGE)
            for part in slices(batch, "__text"):
                keys = part.column(0).to_pylist()
                for key, text in zip(keys, part.column("__text").to_pylist(), strict=True):
                    for rows in packer.add(key, np.concatenate([encoder.ids(text or ""), end])):
                        if rows:
                            yield table(rows)
        for rows in packer.finish() if packer else ():
            yield table(rows)

    return chosen.mapInArrow(run, schema)
