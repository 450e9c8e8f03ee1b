"""Chat formatting by token-level assembly (operator 5).

Every turn's text is encoded by itself and spliced between reserved ids, which no text can produce: system texts
between <<SYS>> and <</SYS>>, user texts between [INST] and [/INST], assistant texts before </s>, any other role by
name.  <s> opens the conversation.  In the text form of the template the same strings mark turns, so a control
string that occurs in a text gets a backslash after its first character (one more if it has some there already),
and reading takes it out again.  Only the tokens of assistant texts are under the loss mask; its spans are running
sums of segment lengths.

Texts are encoded where they are read.  Only ids are shuffled, by conversation, and laid end to end as they stream
by in order of turn.  A conversation of any length is written in chunks of about ``chunk_tokens`` tokens that end
with a turn, so memory holds one chunk.  Its rows do pass one task, as offsets run through it.

Null texts are empty, null roles are the role ''; null conversation ids are one conversation, null turns come
first.  Turns of equal number are ordered by role and ids, and repeated rows stay.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, LongType, StringType, StructField, StructType
from tokenizers import Tokenizer

from convroute.llm.byte_bpe import UnitValues, bytes_of_symbols
from convroute.llm.words import slices

BEGIN, END = "<s>", "</s>"
SYSTEM, SYSTEM_END = "<<SYS>>", "<</SYS>>"
USER, USER_END = "[INST]", "[/INST]"
ROLE, ROLE_TEXT, ROLE_END = "<|role|>", "<|text|>", "<|end|>"
CONTROLS = (BEGIN, END, SYSTEM, SYSTEM_END, USER, USER_END, ROLE, ROLE_TEXT, ROLE_END)

_RESTS = "|".join(re.escape(c[1:]) for c in CONTROLS)
_FIRSTS = "".join(sorted({re.escape(c[0]) for c in CONTROLS}))
_ESCAPABLE = re.compile(rf"([{_FIRSTS}])(\\*)(?={_RESTS})")


def _escapes(match: re.Match) -> bool:
    """Whether the first character and what follows are one control string."""
    return any(c[0] == match[1] and match.string.startswith(c[1:], match.end()) for c in CONTROLS)


def escape(text: str) -> str:
    return _ESCAPABLE.sub(lambda m: m[0] + "\\" if _escapes(m) else m[0], text)


def unescape(text: str) -> str:
    return _ESCAPABLE.sub(lambda m: m[0][:-1] if m[2] and _escapes(m) else m[0], text)


@dataclass(frozen=True)
class ChatConfig:
    vocabulary: str
    #: Ids of the control strings, in order, are counted from here; None: right after the vocabulary.
    first_reserved: int | None = None
    chunk_tokens: int = 65_536


@dataclass
class Codec:
    """Texts to ids and back; made once per Python worker."""

    config: ChatConfig
    reserved: dict[str, int] = field(init=False)

    def __post_init__(self) -> None:
        tokenizer = Tokenizer.from_file(self.config.vocabulary)
        tokenizer.encode_special_tokens = True
        size = tokenizer.get_vocab_size(with_added_tokens=True)
        start = size if self.config.first_reserved is None else self.config.first_reserved
        self.reserved = {control: start + i for i, control in enumerate(CONTROLS)}
        self.controls = {number: control for control, number in self.reserved.items()}
        with open(self.config.vocabulary, encoding="utf-8") as file:
            vocabulary = json.load(file)["model"]["vocab"]
        symbol = bytes_of_symbols()
        self._bytes = {number: bytes(symbol[c] for c in token) for token, number in vocabulary.items()}

        def ids(units: list[str]) -> list[bytes]:
            return [np.asarray(e.ids, "<u4").tobytes() for e in tokenizer.encode_batch_fast(units, add_special_tokens=False)]

        self._units = UnitValues(ids)

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        return [np.frombuffer(raw, "<u4") for raw in self._units.of([escape(t) for t in texts])]

    def decode(self, ids: list[int]) -> str:
        """Escaped text of ids without reserved ones."""
        return b"".join(map(self._bytes.__getitem__, ids)).decode()

    def turn(self, role: str, name: np.ndarray, content: np.ndarray) -> tuple[np.ndarray, int, int]:
        """Ids of one turn, where its content begins and its length."""
        opening, closing = {
            "system": ([SYSTEM], SYSTEM_END),
            "user": ([USER], USER_END),
            "assistant": ([], END),
        }.get(role, ([ROLE, name, ROLE_TEXT], ROLE_END))
        segments = [s if isinstance(s, np.ndarray) else np.array([self.reserved[s]]) for s in opening]
        segments += [content, np.array([self.reserved[closing]])]
        ends = np.cumsum([len(s) for s in segments])
        return np.concatenate(segments).astype("<u4"), int(ends[-2]) - len(content), len(content)

    def turns(self, ids: np.ndarray) -> Iterator[tuple[str, str, int, int]]:
        """(role, text, first and end of the content's ids) of every turn."""
        values = ids.tolist()
        marks = np.flatnonzero(ids >= self.reserved[BEGIN]).tolist()
        begin, role = 0, None
        for at in marks:
            control = self.controls.get(values[at])
            if control in (BEGIN, SYSTEM, USER, ROLE):
                begin, role = at + 1, None
            elif control == ROLE_TEXT:
                role = unescape(self.decode(values[begin:at]))
                begin = at + 1
            elif control is not None:
                named = {SYSTEM_END: "system", USER_END: "user", END: "assistant"}.get(control, role)
                yield named or "", unescape(self.decode(values[begin:at])), begin, at
                begin, role = at + 1, None

    def text(self, ids: np.ndarray) -> str:
        """The text form of the template."""
        parts, begin, values = [], 0, ids.tolist()
        for at in np.flatnonzero(ids >= self.reserved[BEGIN]).tolist():
            parts += [self.decode(values[begin:at]), self.controls[values[at]]]
            begin = at + 1
        return "".join(parts) + self.decode(values[begin:])


_codecs: dict[tuple[str, int | None], Codec] = {}


def codec(config: ChatConfig) -> Codec:
    key = config.vocabulary, config.first_reserved
    if key not in _codecs:
        _codecs[key] = Codec(config)
    return _codecs[key]


def _encoded(conversations: DataFrame, config: ChatConfig) -> DataFrame:
    """(conversation, turn, role, ids, content_first, content_length) of every row."""
    chosen = conversations.select(
        F.col("conv_id").alias("conversation"), F.col("turn"), F.coalesce("role", F.lit("")).alias("role"), "text"
    )
    schema = StructType(
        [
            *chosen.schema.fields[:3],
            StructField("ids", BinaryType()),
            StructField("content_first", LongType()),
            StructField("content_length", LongType()),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(config)
        for batch in batches:
            for part in slices(batch, "text"):
                roles = part.column("role").to_pylist()
                contents = own.encode(part.column("text").fill_null("").to_pylist())
                turns = [own.turn(*x) for x in zip(roles, own.encode(roles), contents, strict=True)]
                arrays = [part.column(i) for i in range(3)] + [
                    pa.array([ids.tobytes() for ids, _, _ in turns], pa.binary()),
                    pa.array([first for _, first, _ in turns], pa.int64()),
                    pa.array([length for _, _, length in turns], pa.int64()),
                ]
                yield pa.RecordBatch.from_arrays(arrays, names=schema.names)

    return chosen.mapInArrow(run, schema)


def format_conversations(conversations: DataFrame, config: ChatConfig) -> DataFrame:
    """(conv_id, chunk, first_token, input_ids, loss_spans): rows of a conversation are adjacent and in order.

    ``input_ids`` are little-endian unsigned 32-bit numbers, ``first_token`` is the place of the first in its
    conversation, ``loss_spans`` are [begin, end) places in the chunk, one for each assistant turn.
    """
    ordered = (
        _encoded(conversations, config)
        .repartition("conversation")
        .sortWithinPartitions("conversation", "turn", "role", "ids")
    )
    span = StructType([StructField("begin", LongType()), StructField("end", LongType())])
    schema = StructType(
        [
            StructField("conv_id", ordered.schema["conversation"].dataType),
            StructField("chunk", LongType()),
            StructField("first_token", LongType()),
            StructField("input_ids", BinaryType()),
            StructField("loss_spans", ArrayType(span)),
        ]
    )
    span_type = pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begin_id = np.array([codec(config).reserved[BEGIN]], "<u4").tobytes()
        current: object = None
        started = False
        chunk, offset, done = 0, 0, 0
        parts: list[bytes] = []
        spans: list[dict[str, int]] = []
        rows: list[tuple] = []

        def close() -> None:
            nonlocal chunk, offset, done, parts, spans
            rows.append((current, chunk, done, b"".join(parts), spans))
            chunk, done, offset, parts, spans = chunk + 1, done + offset, 0, [], []

        def written(kind: pa.DataType) -> pa.RecordBatch:
            kinds = [kind, pa.int64(), pa.int64(), pa.binary(), span_type]
            columns = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)]
            rows.clear()
            return pa.RecordBatch.from_arrays(columns, names=schema.names)

        kind = None
        for batch in batches:
            kind = batch.schema.types[0]
            size = 0
            columns = (batch.column(n).to_pylist() for n in ("conversation", "role", "content_first", "content_length"))
            for row, (key, role, first, length) in enumerate(zip(*columns, strict=True)):
                if not started or key != current:
                    if parts:
                        close()
                    current, started, chunk, done = key, True, 0, 0
                    parts, offset = [begin_id], 1
                raw = batch.column("ids")[row].as_py()
                if role == "assistant":
                    spans.append({"begin": offset + first, "end": offset + first + length})
                parts.append(raw)
                offset += len(raw) // 4
                size += len(raw)
                if offset >= config.chunk_tokens:
                    close()
                if rows and size >= 4 * config.chunk_tokens:
                    size = 0
                    yield written(kind)
            if rows:
                yield written(kind)
        if parts:
            close()
        if rows:
            yield written(kind)

    return ordered.mapInArrow(run, schema)


def read_turns(formatted: DataFrame, config: ChatConfig) -> DataFrame:
    """(conv_id, chunk, place, role, text) of every turn, read from the ids. A chunk is read by itself."""
    schema = StructType(
        [
            formatted.schema["conv_id"],
            StructField("chunk", LongType()),
            StructField("place", LongType()),
            StructField("role", StringType()),
            StructField("text", StringType()),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(config)
        for batch in batches:
            for row in range(batch.num_rows):
                found = list(own.turns(np.frombuffer(batch.column("input_ids")[row].as_py(), "<u4")))
                arrays = [
                    pa.array([batch.column("conv_id")[row].as_py()] * len(found), batch.schema.field("conv_id").type),
                    pa.array([batch.column("chunk")[row].as_py()] * len(found), pa.int64()),
                    pa.array(range(len(found)), pa.int64()),
                    pa.array([role for role, _, _, _ in found], pa.string()),
                    pa.array([text for _, text, _, _ in found], pa.string()),
                ]
                yield pa.RecordBatch.from_arrays(arrays, names=schema.names)

    return formatted.select("conv_id", "chunk", "input_ids").mapInArrow(run, schema)


class _Digest:
    """Running digests of one conversation, from what is read back."""

    def __init__(self, key: object):
        self.key, self.turns, self.loss_chars, self.chars = key, 0, 0, 0
        self.all, self.loss = hashlib.sha256(), hashlib.sha256()

    def add(self, own: Codec, ids: np.ndarray, spans: list[dict[str, int]]) -> None:
        for role, text, _, _ in own.turns(ids):
            self.turns += 1
            self.all.update(f"{role}\n{text}\n".encode())
        values = ids.tolist()
        for span in spans:
            text = unescape(own.decode(values[span["begin"] : span["end"]]))
            self.loss_chars += len(text)
            self.loss.update(text.encode())
        self.chars += len(own.text(ids))

    def row(self) -> tuple:
        return self.key, self.turns, self.all.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars


def digests(formatted: DataFrame, config: ChatConfig) -> DataFrame:
    """One row per conversation, read back from ``format_conversations`` as its rows stream by in order.

    A digest runs through a whole conversation, so one task must see it; it holds one chunk at a time.
    """
    names = ("n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars")
    kinds = [StringType() if name.endswith("sha256") else LongType() for name in names]
    schema = StructType([formatted.schema["conv_id"], *map(StructField, names, kinds)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(config)
        current: _Digest | None = None
        types = None

        def written(rows: list[tuple]) -> pa.RecordBatch:
            arrays = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), types, strict=True)]
            return pa.RecordBatch.from_arrays(arrays, names=schema.names)

        for batch in batches:
            text, number = pa.string(), pa.int64()
            types = [batch.schema.field("conv_id").type, number, text, number, text, number]
            rows = []
            for i in range(batch.num_rows):
                key, chunk = batch.column("conv_id")[i].as_py(), batch.column("chunk")[i].as_py()
                if current is None or chunk == 0:
                    if current:
                        rows.append(current.row())
                    current = _Digest(key)
                ids = np.frombuffer(batch.column("input_ids")[i].as_py(), "<u4")
                current.add(own, ids, batch.column("loss_spans")[i].as_py())
            if rows:
                yield written(rows)
        if current:
            yield written([current.row()])

    return formatted.mapInArrow(run, schema)
