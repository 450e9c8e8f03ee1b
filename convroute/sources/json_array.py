"""Read files that hold one JSON array of objects, each file by many tasks.

Files are read as text that is cut at every closing brace, which Spark splits like lines; no task needs more than its
own byte ranges.  Where in the text a range begins (inside a string or not, how deep) is not known to its task, but what
the range does to either state is:

1.  Each range is summarised: whether its quotes change the state, and for both states the change of depth, the least
    depth after a closing brace, and how often that depth is reached.  Escaped signs are taken out first; a backslash
    never stands just before a cut, so the summary does not depend on its neighbours.
2.  The summaries of a file are composed in order, one row for each range.  This gives the state at which each range
    begins, and how many objects end before it.  An object ends where the depth comes back to 1 outside a string.  A
    file that does not end outside its array is refused.
3.  The ranges are read again from their states and give whole objects, numbered by their place in the file, and
    pieces of objects that reach into other ranges: two for each range at most, which are grouped and joined.

Memory is bounded by one object and, in the driver, by a few numbers for each range.  Empty files have no objects.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Ranges that the driver composes; beyond them, raise ``spark.sql.files.maxPartitionBytes``.
MOST_RANGES = 1 << 20

_RANGE = ("file_path", "file_block_start")

_SUMMARY = "file_path string, file_block_start long, flips boolean, change array<long>, least array<long>, ends array<long>"


def _signs(text: str) -> list[str]:
    """The text's parts between quotes, without escaped signs."""
    if "\\" in text:
        text = text.replace("\\\\", "").replace('\\"', "")
    return text.split('"')


def _depth(parts: list[str], inside: bool) -> int:
    """Change of depth by the parts outside strings, before the closing brace."""
    outside = "".join(parts[inside::2])
    return outside.count("{") + outside.count("[") - outside.count("]") - outside.count("}")


class _Summary:
    """What a range does to a state, for a start outside a string and inside one."""

    def __init__(self) -> None:
        self.flips = False
        self.change, self.least, self.ends = [0, 0], [0, 0], [0, 0]

    def add(self, text: str) -> None:
        parts = _signs(text)
        flips = len(parts) % 2 == 0
        for start in (0, 1):
            inside = bool(start) != self.flips
            self.change[start] += _depth(parts, inside)
            if inside == flips:  # the closing brace stands outside a string
                self.change[start] -= 1
                if not self.ends[start] or self.change[start] < self.least[start]:
                    self.least[start], self.ends[start] = self.change[start], 0
                self.ends[start] += self.change[start] == self.least[start]
        self.flips ^= flips

    def row(self, key: tuple) -> list:
        return [*key, self.flips, self.change, self.least, self.ends]


def _ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple, bool, list[str]]]:
    """(range, whether it begins, texts) for each batch's part of a range."""
    last = None
    for batch in batches:
        files, blocks, texts = (batch.column(i).to_pylist() for i in range(3))
        begin = 0
        for end in range(1, len(texts) + 1):
            if end == len(texts) or files[end] != files[begin] or blocks[end] != blocks[begin]:
                key = files[begin], blocks[begin]
                yield key, key != last, texts[begin:end]
                last, begin = key, end


def _summarised(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["file_path", "file_block_start", "flips", "change", "least", "ends"]
    kinds = [pa.string(), pa.int64(), pa.bool_(), *[pa.list_(pa.int64())] * 3]

    def table(row: list) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row, kinds, strict=True)], names=names)

    key, summary = None, _Summary()
    for now, begins, texts in _ranges(batches):
        if begins:
            if key:
                yield table(summary.row(key))
            key, summary = now, _Summary()
        for text in texts:
            summary.add(text)
    if key:
        yield table(summary.row(key))


def compose(rows: list[tuple]) -> dict[tuple[str, int], tuple[bool, int, int]]:
    """(inside a string, depth, objects that ended before) at the start of each range, from summaries in order."""
    states: dict[tuple[str, int], tuple[bool, int, int]] = {}
    file, inside, depth, ended = None, False, 0, 0
    for path, block, flips, change, least, ends in rows:
        if path != file:
            _check_end(file, inside, depth)
            file, inside, depth, ended = path, False, 0, 0
        states[path, block] = inside, depth, ended
        if ends[inside] and depth + least[inside] == 1:
            ended += ends[inside]
        depth += change[inside]
        inside ^= flips
    _check_end(file, inside, depth)
    return states


def _check_end(file: str | None, inside: bool, depth: int) -> None:
    # What follows the last brace is read as if another brace closed it.
    if file is not None and (inside or depth != -1):
        raise ValueError(f"{file} does not hold one whole JSON array")


def read_objects(spark: SparkSession, path: str) -> DataFrame:
    """(file_path, file_block_start, row_index, value): each object's JSON text and its place in its file's array."""
    cut = spark.read.option("lineSep", "}").text(path)
    ranges = cut.select("_metadata.file_path", "_metadata.file_block_start", "value")
    found = ranges.mapInArrow(_summarised, _SUMMARY).orderBy(*_RANGE).limit(MOST_RANGES + 1).collect()
    if len(found) > MOST_RANGES:
        raise ValueError(f"more than {MOST_RANGES} ranges: raise spark.sql.files.maxPartitionBytes")
    states = spark.sparkContext.broadcast(compose([tuple(row) for row in found]))

    def read(want_whole: bool):
        def objects(key: tuple, texts: Iterator[str]) -> Iterator[tuple[bool, int, str]]:
            """(whole, place, text) of a range's objects and pieces."""
            inside, depth, ended = states.value[key]
            whole, held = depth <= 1 and not inside, []
            for text in texts:
                parts = _signs(text)
                depth += _depth(parts, inside)
                inside ^= len(parts) % 2 == 0
                held.append(text)
                if not inside:
                    depth -= 1
                    if depth == 1:
                        yield whole, ended, "}".join([*held, ""])
                        whole, held = True, []
                        ended += 1
            if held and (depth > 1 or inside):
                yield False, ended, "}".join([*held, ""])

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            def texts_of(first: list[str]) -> Iterator[str]:
                nonlocal following
                yield from first
                for now, begins, texts in parts:
                    if begins:
                        following = now, texts
                        return
                    yield from texts

            parts = _ranges(batches)
            following = next(((key, texts) for key, _, texts in parts), None)
            while following:
                (key, first), following = following, None
                rows, size = [], 0
                for whole, place, text in objects(key, texts_of(first)):
                    if whole == want_whole:
                        rows.append((place, text))
                        size += len(text)
                    if size > 1 << 20:
                        yield table(key, rows)
                        rows, size = [], 0
                if rows:
                    yield table(key, rows)

        def table(key: tuple, rows: list[tuple[int, str]]) -> pa.RecordBatch:
            # The text of an object begins with its brace; what stands before it belongs to the array.
            values = [text[text.find("{") :] if want_whole else text for _, text in rows]
            arrays = [pa.array([key[0]] * len(rows)), pa.array([key[1]] * len(rows), pa.int64())]
            arrays += [pa.array([place for place, _ in rows], pa.int64()), pa.array(values, pa.string())]
            return pa.RecordBatch.from_arrays(arrays, names=[*_RANGE, "row_index", "value"])

        return ranges.mapInArrow(run, "file_path string, file_block_start long, row_index long, value string")

    pieces = read(want_whole=False).groupBy("file_path", "row_index").agg(
        F.min("file_block_start").alias("file_block_start"),
        F.array_sort(F.collect_list(F.struct("file_block_start", "value"))).alias("pieces"),
    )
    text = F.array_join(F.transform("pieces", lambda p: p["value"]), "")
    joined = pieces.select(*_RANGE, "row_index", F.substring(text, F.instr(text, "{"), F.length(text)).alias("value"))
    return read(want_whole=True).unionByName(joined)
