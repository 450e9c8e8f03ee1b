"""Exact removal of repeated byte strings by a run-length compressed Burrows-Wheeler index (operator 11).

Texts are UTF-8 bytes.  A window is ``window`` consecutive bytes of one document; it is a repeat if the same bytes
start earlier: in a document before it, or earlier in its own.  Bytes under a repeat go.

1.  Equal texts are one content.  Its first row (least id) speaks for it, the others repeat it whole.
2.  The anchor of a window is the least hash of the runs of ``anchor`` bytes in it, so equal windows have equal
    anchors.  Consecutive windows of one anchor are a string.  Anchors that occur once are dropped: their windows
    occur once.  Strings of the others are cut out of the texts and sent to the bucket of their anchor.  Until then
    strings are numbers only, and the texts are shuffled once for all steps.
3.  Equal strings of a bucket are one.  The others, in the order of their documents, make one text, of which ``RunIndex`` is built: the runs of its
    Burrows-Wheeler transform, with the place of each run's first suffix, of the suffix before it, and the length
    they share.  Inside a run both places move on together and the length falls by one for each byte, so streaming
    over the text gives every place's matching statistics from the samples alone: the longest match with the suffix
    before it, and where that is.  Repetitive texts have few runs, however long they are.
4.  Matches of at least ``window`` bytes link places to chains; all places of a chain hold one window, and all but
    the first are repeats.
5.  Hot buckets are split into parts by bytes, each with an index of its own.  Parts pass on the first place of each of
    their windows, keyed by 128 bits of XXH3, and one more grouping marks those that are not the first of all.

Documents are ordered by id, nulls first; rows of one id but different texts by hash of the text.  Rows equal in id
and text are one document and get equal results.  Null and empty texts have no bytes.  Memory is bounded by one
document, one index of about ``index_bytes`` bytes, or one part of a bucket.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, BooleanType, IntegerType, LongType, StructField, StructType

from convroute.llm.words import RunHashes, slices, utf8
from convroute.workspace import Workspace


#: A string is one number: (first window * _LENGTHS + number of windows) * 2 + whether its anchor stands at two places.
_LENGTHS = 1 << 13


@dataclass(frozen=True)
class IndexConfig:
    #: Bytes of a window and of the runs that anchors are chosen from.
    window: int = 100
    anchor: int = 24
    #: Windows of one string at most; periodic texts would make longer ones.
    longest: int = 4096
    #: Bytes of strings in one index, and in one part of a split bucket, about.
    index_bytes: int = 1 << 18
    part_bytes: int = 1 << 20

    def __post_init__(self) -> None:
        if not 1 <= self.anchor <= self.window:
            raise ValueError("anchors must fit into windows")
        if self.longest >= _LENGTHS:
            raise ValueError("strings are too long to be packed")


# --- The index ------------------------------------------------------------------------------------

#: Symbols (a byte and one, or 0 for the end of a string) of nine bits that fit into the first sorting key.
_FIRST = 7


def suffix_order(symbols: np.ndarray, string: np.ndarray, left: np.ndarray) -> np.ndarray:
    """Order of all suffixes by prefix doubling; only suffixes that are still tied are sorted again.

    ``string`` is the number of each place's string and ``left`` the symbols before its end sign.  A suffix ends with
    its string; equal ones are ordered by string.
    """
    n = len(symbols)
    string, left = string.astype(np.int32), left.astype(np.int32)
    key = np.zeros(n, np.int64)
    padded = np.concatenate([symbols.astype(np.int64), np.zeros(_FIRST, np.int64)])
    for ahead in range(_FIRST):
        key = key << 9 | np.where(left >= ahead, padded[ahead : ahead + n], 0)
    order = np.argsort(key)
    slots, keys = np.arange(n), key[order]
    rank = np.empty(n, np.int32)
    have = _FIRST
    while True:
        new = np.ones(len(slots), bool)
        new[1:] = keys[1:] != keys[:-1]
        rank[order[slots]] = np.maximum.accumulate(np.where(new, slots, 0))
        tied = ~new
        tied[:-1] |= ~new[1:]
        slots = slots[tied]
        if not len(slots):
            return order
        at = order[slots]
        later = at + have
        second = np.where(left[at] >= have, rank[np.minimum(later, n - 1)], string[at])
        keys = rank[at].astype(np.int64) << 32 | second
        again = np.argsort(keys)
        order[slots], keys = at[again], keys[again]
        have *= 2


def _shared(data: np.ndarray, a: np.ndarray, b: np.ndarray, most: np.ndarray) -> np.ndarray:
    """Length of the common prefix of the places ``a`` and ``b``, at most ``most``; eight bytes at a time."""
    held = np.concatenate([data, np.zeros(16, np.uint8)])
    eight = np.ndarray(len(data) + 8, "<u8", held.data, strides=(1,))
    length = np.zeros(len(a), np.int64)
    live = np.flatnonzero(most > 0)
    while len(live):
        differ = eight[a[live] + length[live]] ^ eight[b[live] + length[live]]
        low = differ & (~differ + np.uint64(1))
        same = np.where(differ == 0, 8, np.bitwise_count(low - np.uint64(1)) >> 3)
        length[live] += same
        live = live[(same == 8) & (length[live] < most[live])]
    return np.minimum(length, most)


@dataclass
class RunIndex:
    """Run-length compressed transform of some strings, with the samples of its run borders in order of place."""

    #: Symbol and length of each run.
    heads: np.ndarray
    lengths: np.ndarray
    #: First place of each run, the place of the suffix before it, and the length that both share.
    place: np.ndarray
    before: np.ndarray
    shared: np.ndarray

    @classmethod
    def of(cls, data: np.ndarray, ends: np.ndarray) -> RunIndex:
        """``data`` holds all strings, each followed by one byte for its end sign, which stands at ``ends``."""
        n = len(data)
        string = np.repeat(np.arange(len(ends)), np.diff(ends, prepend=-1))
        left = ends[string] - np.arange(n)
        symbols = np.where(left > 0, data.astype(np.int16) + 1, 0)
        order = suffix_order(symbols, string, left)
        previous = np.concatenate([[0], symbols[:-1]])[order]
        # The sign before a string's first byte is the end of another string: a run of its own.
        border = np.ones(n, bool)
        border[1:] = (previous[1:] != previous[:-1]) | (previous[1:] == 0)
        rows = np.flatnonzero(border)
        place, before = order[rows], order[rows - 1]
        shared = _shared(data, place, before, np.minimum(left[place], left[before]))
        shared[0] = 0  # no suffix stands before the first row
        by_place = np.argsort(place)
        return cls(
            previous[rows], np.diff(np.append(rows, n)), place[by_place], before[by_place], shared[by_place]
        )

    def matching_statistics(self, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each place, the length of the match with the suffix before it in the order, and its place."""
        sample = np.searchsorted(self.place, places, "right") - 1
        moved = places - self.place[sample]
        return self.shared[sample] - moved, self.before[sample] + moved


def first_places(index: RunIndex, places: np.ndarray, size: int, window: int) -> np.ndarray:
    """For each place, the first place of an equal window. ``places`` are all window starts, ascending."""
    length, before = index.matching_statistics(places)
    link = np.arange(size)
    link[places] = np.where(length >= window, before, places)
    root = link[places]
    while True:
        further = link[root]
        if (further == root).all():
            break
        link[places] = further
        root = link[places]
    first = np.full(size, size)
    np.minimum.at(first, root, places)
    return first[root]


# --- Anchors and strings --------------------------------------------------------------------------


def strings_of(texts: pa.Array, config: IndexConfig) -> tuple[np.ndarray, ...]:
    """(text, anchor, first window, windows, repeats) of the strings of some texts.

    ``repeats`` tells whether the anchor stands at more than one place, so that windows may repeat inside.
    """
    data, offsets = utf8(texts)
    window, m = config.window, config.anchor
    if len(data) < window:
        none = np.zeros(0, np.int64)
        return none, none, none, none, none.astype(bool)
    start = np.arange(len(data) - m + 1)
    hashes = least = RunHashes(data)(start, start + m)
    have, width = 1, window - m + 1
    while have < width:
        step = min(have, width - have)
        least = np.minimum(least[: len(least) - step], least[step:])
        have += step
    # Where a window begins with its anchor, the next window has its anchor elsewhere.
    leaves = hashes[: len(least)] == least
    text = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    at = np.flatnonzero(text[: len(least)] == text[window - 1 :])
    least, leaves, text = least[at], leaves[at], text[at]
    number = at - offsets[text]
    new = np.ones(len(at), bool)
    new[1:] = (least[1:] != least[:-1]) | (text[1:] != text[:-1]) | (number[1:] % config.longest == 0)
    moved = np.zeros(len(at), bool)
    moved[1:] = ~new[1:] & leaves[:-1]
    first = np.flatnonzero(new)
    length = np.diff(np.append(first, len(at)))
    repeats = np.add.reduceat(moved.astype(np.int64), first) > 0 if len(first) else np.zeros(0, bool)
    return text[first], least[first].view(np.int64), number[first], length, repeats


_KEYS = ("k1", "k2")


def _documents(df: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """(id, text, k1, k2): the keys are 128 bits of a text's SHA-256, as numbers."""
    digest = F.sha2(F.coalesce(F.col(text_column), F.lit("")), 256)
    def half(at: int) -> Column:
        # Never null, so that joins add no filter of their own and the texts are shuffled once for all of them.
        return F.coalesce(F.conv(F.substring(digest, at, 16), 16, -10).cast("long"), F.lit(0).cast("long"))

    return df.select(
        F.col(id_column).alias("id"), F.col(text_column).alias("text"), half(1).alias("k1"), half(17).alias("k2")
    )


def _strings(speaking: DataFrame, config: IndexConfig) -> DataFrame:
    """(anchor, d, packed, weight) of every string; an anchor whose weights sum to more than 1 may hold repeats."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                text, anchor, first, length, repeats = strings_of(part.column("text"), config)
                weight = np.where(repeats, 2 + length // config.window, 1)
                arrays = [anchor, part.column("d").to_numpy()[text], (first * _LENGTHS + length) * 2 + repeats, weight]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(a, pa.int64()) for a in arrays], names=["anchor", "d", "packed", "weight"]
                )

    return speaking.select("d", "text").mapInArrow(run, "anchor long, d long, packed long, weight long")


def _cut(found: DataFrame, config: IndexConfig) -> DataFrame:
    """(anchor, part, split, inside, id, k1, k2, first, bytes): each chosen string, of a split bucket or not."""
    schema = StructType().add("anchor", "long").add("part", "long").add("split", "boolean").add("inside", "boolean")
    for name in ("id", *_KEYS):
        schema = schema.add(found.schema[name])
    schema = schema.add("first", "long").add("bytes", "binary")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None
        for batch in batches:
            for part in slices(batch, "text"):
                # Rows equal in id and text stand side by side mostly; one of them is enough.
                keys = [part.column(k).to_numpy() for k in _KEYS]
                fresh = np.ones(part.num_rows, bool)
                fresh[1:] = (np.diff(keys[0]) != 0) | (np.diff(keys[1]) != 0)
                fresh[0] = last != (keys[0][0], keys[1][0])
                last = keys[0][-1], keys[1][-1]
                if not fresh.all():
                    part = part.filter(pa.array(fresh))
                    keys = [k[fresh] for k in keys]
                data, offsets = utf8(part.column("text"))
                chosen = part.column("chosen")
                flat = chosen.flatten()
                owner = np.repeat(np.arange(part.num_rows), np.diff(chosen.offsets.to_numpy()))
                packed, parts = (flat.field(n).to_numpy() for n in ("packed", "parts"))
                inside, packed = packed % 2 == 1, packed // 2
                first, length = packed // _LENGTHS, packed % _LENGTHS
                begin = offsets[owner] + first
                end = begin + length + config.window - 1
                raw = data.tobytes()
                spread = (keys[0][owner] ^ (first * 0x9E3779B1)) & 0x7FFFFFFF
                arrays = [flat.field("anchor"), pa.array(spread % parts), pa.array(parts > 1), pa.array(inside)]
                arrays += [part.column(name).take(pa.array(owner)) for name in ("id", *_KEYS)]
                arrays.append(pa.array(first))
                arrays.append(pa.array([raw[a:b] for a, b in zip(begin.tolist(), end.tolist(), strict=True)], pa.binary()))
                yield pa.RecordBatch.from_arrays(arrays, names=schema.names)

    return found.select("id", *_KEYS, "text", "chosen").mapInArrow(run, schema)


# --- Marking --------------------------------------------------------------------------------------


def _mark(table: pa.Table, config: IndexConfig, names: list[str]) -> pa.RecordBatch:
    """Repeats among the strings of whole parts of buckets, as byte ranges of their documents.

    Rows with a ``key`` are windows of split buckets, each at its first place within the part.
    """
    window = config.window
    anchor, k1, k2, starts = (table.column(name).to_numpy() for name in ("anchor", *_KEYS, "first"))
    split, inside = (table.column(name).to_numpy() for name in ("split", "inside"))
    strings = table.column("bytes").to_pylist()
    size = np.fromiter(map(len, strings), np.int64, len(strings))

    # Equal strings are one, the first; all windows of the others start earlier.
    seen: dict[bytes, int] = {}
    one = np.fromiter((seen.setdefault(x, i) for i, x in enumerate(strings)), np.int64, len(strings))
    own = one == np.arange(len(one))
    copies = np.flatnonzero(~own & ((k1 != k1[one]) | (k2 != k2[one]) | (starts != starts[one])))

    # A string alone in its bucket, with its anchor at one place, holds no window twice.
    rows = np.flatnonzero(own)
    new = np.ones(len(rows) + 1, bool)
    new[1:-1] = np.diff(anchor[rows]) != 0
    rows = rows[~(new[:-1] & new[1:]) | inside[rows] | split[rows]]
    row, place, at, repeated = (np.zeros(0, np.int64) for _ in range(4))
    data = b"".join(strings[i] + b"\x00" for i in rows.tolist())
    if len(rows):
        lengths = size[rows]
        ends = np.cumsum(lengths + 1) - 1
        begins, windows = ends - lengths, lengths - window + 1
        number = np.repeat(np.arange(len(rows)), windows)
        within = np.arange(len(number)) - np.repeat(np.cumsum(windows) - windows, windows)
        place, row = within + begins[number], rows[number]
        at = starts[row] + within
        index = RunIndex.of(np.frombuffer(data, np.uint8), ends)
        repeated = first_places(index, place, len(data), window) != place

    hit = np.flatnonzero(repeated)
    joins = np.zeros(len(hit), bool)
    joins[1:] = (row[hit[1:]] == row[hit[:-1]]) & (at[hit[1:]] - at[hit[:-1]] <= window)
    opens = np.flatnonzero(~joins)
    closes = np.append(opens[1:], len(hit)) - 1 if len(opens) else opens
    alone = np.flatnonzero((repeated == 0) & split[row])
    hashed = [xxhash.xxh3_128_digest(data[p : p + window]) for p in place[alone].tolist()]
    owner = np.concatenate([copies, row[hit[opens]], row[alone]])
    arrays = [table.column(name).combine_chunks().take(pa.array(owner)) for name in ("id", *_KEYS)]
    arrays.append(pa.array(np.concatenate([starts[copies], at[hit[opens]], at[alone]]), pa.int64()))
    arrays.append(
        pa.array(np.concatenate([(starts + size)[copies], at[hit[closes]] + window, at[alone] + window]), pa.int64())
    )
    arrays.append(pa.array([None] * (len(copies) + len(opens)) + hashed, pa.binary()))
    return pa.RecordBatch.from_arrays(arrays, names=names)


def _marked(strings: DataFrame, config: IndexConfig) -> DataFrame:
    """(id, k1, k2, begin, end, key): see ``_mark``."""
    schema = StructType([strings.schema[name] for name in ("id", *_KEYS)])
    schema = schema.add("begin", "long").add("end", "long").add("key", "binary")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        weight, last = 0, None
        for batch in batches:
            anchor, part = (batch.column(name).to_numpy() for name in ("anchor", "part"))
            changes = np.flatnonzero((np.diff(anchor) != 0) | (np.diff(part) != 0)) + 1
            bounds = np.concatenate([[0], changes, [batch.num_rows]]) if batch.num_rows else np.zeros(1, int)
            sizes = np.cumsum(np.concatenate([[0], np.diff(utf8(batch.column("bytes"))[1])]))
            for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
                group = int(anchor[a]), int(part[a])
                # Parts of buckets stay whole, and two parts of one bucket apart: places are compared in an index.
                if held and group != last and (weight >= config.index_bytes or group[0] == last[0]):
                    yield _mark(pa.Table.from_batches(held), config, schema.names)
                    held, weight = [], 0
                held.append(batch.slice(a, b - a))
                weight += int(sizes[b] - sizes[a])
                last = group
        if held:
            yield _mark(pa.Table.from_batches(held), config, schema.names)

    order = ("anchor", "part", "id", *_KEYS, "first")
    gathered = strings.repartition("anchor", "part").sortWithinPartitions(*order)
    return gathered.mapInArrow(run, schema)


def remove_earlier_repeats(
    df: DataFrame, config: IndexConfig = IndexConfig(), id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """(id, n_bytes, n_removed, spans, kept) of every row: removed byte ranges, and the bytes that are left."""
    documents = _documents(df, id_column, text_column)
    contents = documents.groupBy(*_KEYS).agg(F.min(F.struct("id")).alias("first"))
    contents = contents.select(F.monotonically_increasing_id().alias("d"), *_KEYS, F.col("first.id").alias("first_id"))
    contents = Workspace(df.sparkSession, "run-index").save(contents, "contents")
    # The other condition never holds; it keeps ids out of the join keys, so that all joins share one shuffle of texts.
    is_first = F.col("id").eqNullSafe(F.col("first_id")) | F.col("d").isNull()
    strings = _strings(documents.join(contents, [*_KEYS]).where(is_first), config)
    # Strings have about one and a half windows' bytes each.
    repeated = (
        strings.groupBy("anchor")
        .agg(F.sum("weight").alias("weight"))
        .where("weight > 1")
        .select("anchor", F.ceil(F.col("weight") * (1.5 * config.window) / config.part_bytes).alias("parts"))
    )
    chosen = (
        strings.select("anchor", "d", "packed")
        .join(repeated, "anchor")
        .groupBy("d")
        .agg(F.collect_set(F.struct("packed", "parts", "anchor")).alias("chosen"))
        .join(contents, "d")
        .select("d", *_KEYS, "first_id", "chosen")
    )
    speaking = documents.join(chosen, [*_KEYS]).where(is_first)
    marked = _marked(_cut(speaking, config), config)
    # One grouping for both kinds of rows: ranges stand alone, windows meet the same window of other parts.
    group = Window.partitionBy("key", *[F.when(F.col("key").isNull(), F.col(k)) for k in (*_KEYS, "begin")])
    place = F.struct("id", *_KEYS, "begin")
    gone = marked.withColumn("least", F.min(F.when(F.col("key").isNotNull(), place)).over(group)).where(
        F.col("key").isNull() | (place != F.col("least"))
    )
    ranges = gone.groupBy(*_KEYS).agg(F.collect_list(F.struct("begin", "end")).alias("ranges"))
    found = contents.join(ranges, [*_KEYS], "left")
    none = F.array().cast("array<struct<begin:bigint,end:bigint>>")
    joined = documents.join(found, [*_KEYS]).select(
        "id", "text", F.coalesce("ranges", none).alias("ranges"), (~is_first).alias("copy")
    )
    return _kept(joined, config).withColumnRenamed("id", id_column)


def _kept(joined: DataFrame, config: IndexConfig) -> DataFrame:
    span = StructType([StructField("begin", LongType()), StructField("end", LongType())])
    schema = StructType(
        [
            joined.schema["id"],
            StructField("n_bytes", LongType()),
            StructField("n_removed", LongType()),
            StructField("spans", ArrayType(span)),
            StructField("kept", BinaryType()),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                data, offsets = utf8(part.column("text"))
                size = np.diff(offsets)
                copy = part.column("copy").to_numpy(zero_copy_only=False) & (size >= config.window)
                ranges = part.column("ranges")
                flat = ranges.flatten()
                owner = np.repeat(np.arange(part.num_rows), np.diff(ranges.offsets.to_numpy()))
                change = np.zeros(len(data) + 1, np.int64)
                np.add.at(change, offsets[owner] + flat.field("begin").to_numpy(), 1)
                np.add.at(change, offsets[owner] + flat.field("end").to_numpy(), -1)
                np.add.at(change, offsets[:-1][copy], 1)
                np.add.at(change, offsets[1:][copy], -1)
                gone = np.cumsum(change[:-1]) > 0
                # Spans end with their text.
                edge = np.zeros(len(data) + 1, bool)
                edge[offsets] = True
                before = np.concatenate([[False], gone[:-1]]) if len(gone) else gone
                after = np.concatenate([gone[1:], [False]]) if len(gone) else gone
                opens = np.flatnonzero(gone & (~before | edge[:-1]))
                closes = np.flatnonzero(gone & (~after | edge[1:])) + 1
                counts = np.searchsorted(opens, offsets)
                base = np.repeat(offsets[:-1], np.diff(counts))
                spans = pa.StructArray.from_arrays(
                    [pa.array(opens - base, pa.int64()), pa.array(closes - base, pa.int64())], names=["begin", "end"]
                )
                removed = np.diff(np.concatenate([[0], np.cumsum(gone)])[offsets])
                kept = data[~gone].tobytes()
                cut = np.concatenate([[0], np.cumsum(size - removed)]).tolist()
                arrays = [
                    part.column("id"),
                    pa.array(size, pa.int64()),
                    pa.array(removed, pa.int64()),
                    pa.ListArray.from_arrays(pa.array(counts, pa.int32()), spans),
                    pa.array([kept[a:b] for a, b in zip(cut[:-1], cut[1:], strict=True)], pa.binary()),
                ]
                yield pa.RecordBatch.from_arrays(arrays, names=schema.names)

    return joined.mapInArrow(run, schema)
