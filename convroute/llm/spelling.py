"""Spelling variants by a bit-sliced position index (operator 13).

Words are runs of Latin letters, lower-cased within A-Z, that have at least ``least_length`` letters and ``least_count``
occurrences.  Two words are near if one inserted, deleted or replaced letter turns one into the other.  A word's form is
its most frequent near word, if that is ``form_factor`` times as frequent as the word itself; following forms leads to
the word's root.

1.  Runs are found and counted with Spark's own functions, combined before the shuffle.
2.  The one error of two near words lies in the first ``part`` letters or behind them, so the words agree in the last
    ``part`` letters or in the first.  A word goes to a shard by its beginning and to one by its end, both by length; as
    a member it goes to those of the lengths next to its own too.  Shards are as many as the words of their length ask
    for, and large ones are divided into blocks of members and of queries.
3.  A cell (a block of members, a block of queries) keeps, for a position and a letter, the bitset of members that have
    it there.  All queries walk their letters at once; four bitsets for each query tell which members agree so far
    without an error, or with one letter replaced, one letter more, or one less, which shifts the member's position by
    one.  64 members are compared by one operation.
4.  Members stand by frequency, so a query's lowest bit is its best near word and the number of bits counts all: no
    pairs are written.  Shards of the beginning count near words that agree there, those of the end the others.
5.  Forms are followed by doubling: each step is a factor of ``form_factor``, so chains are short.

A null text has no words and a null id counts as an empty one.  Rows that are repeated count again.  All results but
the documents' own words are bounded by the vocabulary; a task holds one cell, a few bitsets for each of its queries.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from convroute.workspace import Workspace


@dataclass(frozen=True)
class SpellingConfig:
    least_length: int = 7
    least_count: int = 2
    form_factor: int = 10
    #: Letters of a word's beginning and end that choose its shards.
    part: int = 3
    #: Words of a length in one shard, members and queries of one cell, about.
    shard_words: int = 2048
    cell_members: int = 8192
    cell_queries: int = 1024

    def __post_init__(self) -> None:
        # The letters left beside an error must hold one of the two parts whole.
        if self.least_length < 2 * self.part + 1 or self.form_factor < 2:
            raise ValueError("words are too short for their parts, or forms not more frequent")


#: Letters of a word, as a pattern (fixed value).
LETTERS = "[A-Za-zÀ-ÿ]+"

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def runs(df: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(id, run): every run of letters in the texts, lower-cased within A-Z; ids as text."""
    name = F.coalesce(F.col(id_column).cast("string"), F.lit("")).alias("id")
    found = df.select(name, F.explode(F.regexp_extract_all(text_column, F.lit(LETTERS), F.lit(0))).alias("run"))
    ascii_only = F.length("run") == F.octet_length("run")
    return found.select("id", F.when(ascii_only, F.lower("run")).otherwise(F.translate("run", _UPPER, _LOWER)).alias("run"))


def with_slips(found: DataFrame, one_in: int) -> DataFrame:
    """The runs as words, of which one in ``one_in`` loses a letter, chosen by checksum of id and run."""
    found = found.select("run", F.crc32(F.concat("id", F.lit(":"), "run").cast("binary")).alias("h"), F.length("run").alias("n"))
    at = (F.col("h") % F.col("n")).cast("int")
    cut = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.col("n")))
    return found.select(F.when(F.col("h") % one_in == 0, cut).otherwise(F.col("run")).alias("word"))


def vocabulary(words: DataFrame, config: SpellingConfig = SpellingConfig()) -> DataFrame:
    """(word, n) of every word that is long and frequent enough."""
    long = words.where(F.length("word") >= config.least_length)
    return long.groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= config.least_count)


# --- The index ------------------------------------------------------------------------------------


class PositionIndex:
    """Bitsets of the members that have a letter at a position; letters beyond a member's end have none.

    Positions are made when they are asked for, and only the last few are kept.
    """

    def __init__(self, members: list[str], part: int):
        self.part = part
        self.size = len(members)
        self.width = -(-self.size // 64)
        lengths = np.fromiter(map(len, members), np.int64, self.size)
        codes = np.frombuffer("".join(members).encode("utf-32-le"), np.uint32)
        self.letters = np.unique(codes)
        longest = int(lengths.max(initial=0))
        self._letter = np.full((self.size, longest), len(self.letters), np.int16)
        inside = np.arange(longest) < lengths[:, None]
        self._letter[inside] = np.searchsorted(self.letters, codes)
        self._lengths = lengths
        self._kept: dict[int, np.ndarray] = {}

    def bits(self, chosen: np.ndarray) -> np.ndarray:
        """A bitset, or one for each row, from truth values."""
        padded = np.zeros((*chosen.shape[:-1], self.width * 64), bool)
        padded[..., : self.size] = chosen
        return np.packbits(padded, axis=-1, bitorder="little").view("<u8")

    def of_length(self, length: int) -> np.ndarray:
        return self.bits(self._lengths == length)

    def at(self, position: int) -> np.ndarray:
        """(letters and one more for unknown ones, words of a bitset)."""
        if position not in self._kept:
            table = np.zeros((len(self.letters) + 1, self.width), "<u8")
            if 0 <= position < self._letter.shape[1]:
                column = self._letter[:, position]
                table[:-1] = self.bits(column == np.arange(len(self.letters))[:, None])
            self._kept = {p: kept for p, kept in self._kept.items() if abs(p - position) < 3}
            self._kept[position] = table
        return self._kept[position]

    def codes(self, words: list[str]) -> np.ndarray:
        """Letter numbers of words of one length."""
        raw = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).reshape(len(words), -1)
        number = np.minimum(np.searchsorted(self.letters, raw), len(self.letters) - 1)
        return np.where(self.letters[number] == raw, number, len(self.letters))

    def near(self, queries: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """For each query, the bitsets of its near members, with the same beginning and with another one.

        All queries have one length; a beginning is ``part`` letters.
        """
        codes = self.codes(queries)
        length = codes.shape[1]
        none = np.zeros((len(queries), self.width), "<u8")
        same = np.repeat(self.bits(np.ones(self.size, bool))[None], len(queries), axis=0)
        replaced, more, less, beginning = none, none, none, none
        for i in range(length):
            letter = codes[:, i]
            here = self.at(i)[letter]
            # The member has one letter more: it goes in before this one, and later letters stand one further on.
            more = (more | same) & self.at(i + 1)[letter]
            # The member has one letter less: this one is passed over, and later ones stand one earlier.
            less = (less & self.at(i - 1)[letter]) | same
            replaced = (replaced & here) | same
            same = same & here
            if i + 1 == self.part:
                beginning = same
        # A last letter may be the one that is more; the member itself, with no error, is not near.
        near = replaced & ~same & self.of_length(length)
        near |= (more | same) & self.of_length(length + 1)
        near |= less & self.of_length(length - 1)
        return near & beginning, near & ~beginning


def _lowest(bits: np.ndarray) -> np.ndarray:
    """Number of the lowest bit of each row, which has one."""
    word = np.argmax(bits != 0, axis=1)
    value = bits[np.arange(len(bits)), word]
    low = value & (~value + np.uint64(1))
    return word * 64 + np.bitwise_count(low - np.uint64(1)).astype(np.int64)


#: Bytes of the bitsets of one step.
_STEP_BYTES = 1 << 22


def _cells(rows: DataFrame, config: SpellingConfig) -> DataFrame:
    """(word, n_near, n, form) for each query of each cell that has near members there."""

    def searched(members: list[tuple[int, str]], queries: list[str], side: int) -> tuple[list, ...]:
        members.sort(key=lambda m: (-m[0], m[1]))
        index = PositionIndex([word for _, word in members], config.part)
        step = max(1, _STEP_BYTES // (8 * index.width))
        words, counts, times, forms = [], [], [], []
        for begin in range(0, len(queries), step):
            part = queries[begin : begin + step]
            bits = index.near(part)[side]
            found = np.bitwise_count(bits).sum(axis=1, dtype=np.int64)
            some = np.flatnonzero(found)
            best = _lowest(bits[some]).tolist()
            words += [part[i] for i in some.tolist()]
            counts += found[some].tolist()
            times += [members[i][0] for i in best]
            forms += [members[i][1] for i in best]
        return words, counts, times, forms

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def finished() -> pa.RecordBatch:
            arrays = searched(members, queries, group[0]) if members and queries else ([], [], [], [])
            kinds = (pa.string(), pa.int64(), pa.int64(), pa.string())
            return pa.RecordBatch.from_arrays(
                [pa.array(a, k) for a, k in zip(arrays, kinds, strict=True)], names=["word", "n_near", "n", "form"]
            )

        group: tuple = ()
        members: list[tuple[int, str]] = []
        queries: list[str] = []
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in (*_CELL, "member", "n", "word")]
            for *now, member, n, word in zip(*columns, strict=True):
                if now != group:
                    if group:
                        yield finished()
                    group, members, queries = now, [], []
                if member:
                    members.append((n, word))
                else:
                    queries.append(word)
        if group:
            yield finished()

    ordered = rows.repartition(*_CELL).sortWithinPartitions(*_CELL)
    return ordered.mapInArrow(run, "word string, n_near long, n long, form string")


_CELL = ("side", "length", "shard", "members", "queries")


def near_words(words: DataFrame, config: SpellingConfig = SpellingConfig()) -> DataFrame:
    """(word, n_near, form_n, form) of every word with near words; ``form`` is the most frequent of them."""
    known = words.select("word", "n", F.length("word").alias("length"))
    shards = known.groupBy("length").agg(F.ceil(F.count(F.lit(1)) / config.shard_words).alias("shards"))

    def shard(side: Column, word: str = "word") -> Column:
        """Part of the word that chooses its shard."""
        return F.when(side == 0, F.substring(word, 1, config.part)).otherwise(F.substring(word, -config.part, config.part))

    sides = F.explode(F.array(F.lit(0), F.lit(1))).alias("side")
    each = known.select("word", "n", "length", sides).withColumn("piece", shard(F.col("side")))

    def placed(df: DataFrame) -> DataFrame:
        number = F.pmod(F.xxhash64("piece", "side"), "shards")
        return df.join(shards, "length").select("word", "n", "side", "length", number.alias("shard"))

    queries = placed(each)
    # Members go to the shards of the query lengths they can be near to; where no word has such a length, to none.
    around = F.explode(F.array(*[F.col("length") + d for d in (-1, 0, 1)]))
    members = placed(each.withColumn("length", around))
    keys = ["side", "length", "shard"]

    def blocks(df: DataFrame, rows: int, name: str) -> DataFrame:
        return df.groupBy(*keys).agg(F.ceil(F.count(F.lit(1)) / rows).alias(name))

    sizes = blocks(queries, config.cell_queries, "query_blocks").join(
        blocks(members, config.cell_members, "member_blocks"), keys
    )

    def spread(df: DataFrame, own: str, own_blocks: str, other: str, other_blocks: str, member: bool) -> DataFrame:
        """Each row in one block of its own kind, beside every block of the other kind."""
        return df.join(sizes, keys).select(
            *keys,
            F.pmod(F.xxhash64("word", F.lit(3)), own_blocks).alias(own),
            F.explode(F.sequence(F.lit(0).cast("long"), F.col(other_blocks) - 1)).alias(other),
            F.lit(member).alias("member"),
            "n",
            "word",
        )

    rows = spread(members, "members", "member_blocks", "queries", "query_blocks", True).unionByName(
        spread(queries, "queries", "query_blocks", "members", "member_blocks", False)
    )
    found = _cells(rows, config)
    best = F.min(F.struct((-F.col("n")).alias("order"), F.col("form").alias("form")))
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("best")).select(
        "word", "n_near", (-F.col("best.order")).alias("form_n"), F.col("best.form").alias("form")
    )


def _roots(forms: DataFrame, workspace: Workspace) -> DataFrame:
    """(word, root) of every word that has a form. Each round doubles the steps that a row has gone."""
    gone = workspace.save(forms.select("word", F.col("form").alias("root")), "forms")
    number = 0
    while True:
        further = gone.select(F.col("word").alias("root"), F.col("root").alias("further"))
        moved = gone.join(further, "root", "left")
        if moved.where("further is not null").isEmpty():
            return gone
        number += 1
        gone = workspace.save(moved.select("word", F.coalesce("further", "root").alias("root")), f"roots-{number}")


def variants(words: DataFrame, config: SpellingConfig = SpellingConfig()) -> DataFrame:
    """(word, n, n_near, form, form_n, root) of every word of a vocabulary of (word, n)."""
    workspace = Workspace(words.sparkSession, "spelling")
    known = workspace.save(words.select("word", "n"), "words")
    near = near_words(known, config)
    frequent = F.col("form_n") >= F.lit(config.form_factor) * F.col("n")
    named = workspace.save(
        known.join(near, "word", "left").select(
            "word",
            "n",
            F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(frequent, F.col("form")).alias("form"),
            F.when(frequent, F.col("form_n")).alias("form_n"),
        ),
        "named",
    )
    roots = _roots(named.where("form is not null"), workspace)
    return named.join(roots, "word", "left").withColumn("root", F.coalesce("root", "word"))
