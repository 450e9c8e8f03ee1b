"""Benchmark decontamination with a distributed positional inverted index (operator 10).

``build_index`` stores, for blocks of consecutive documents, the positions of every test term: one row per block,
with terms in order and the places of each in the block's stream of words.  A frequent term is thereby spread over
all blocks.  ``term_counts`` sums how often each term occurs in the corpus.  ``search`` plans every phrase from its
rarest terms by those counts and, block by block, intersects their posting lists after subtracting each term's
offset in the phrase: a common value is the place where the phrase begins.  The other terms follow from rare to
frequent, so lists stay short.  ``near`` intersects the same lists with slack and gives proximity matches.

The test side is a stated query set: its phrases are sent to all tasks in blocks of at most ``phrases_per_block``,
each searched against the whole index.  Its distinct terms (16 bytes each) are sent at once; more than
``most_terms`` are refused.  Terms are compared by two independent 64-bit hashes of their bytes.  Documents are read
once, and nothing is shuffled but the term counts (and, for several blocks of phrases, the matches).  Memory holds
one block of about ``block_words`` words, or one longer document.

Null and empty texts have no words and match nothing; items without words are never found.  Repeated rows are
searched each for itself; repeated items count by their id.  An item without an id hits words but is named in no list.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass, replace
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, IntegerType, LongType, StringType, StructField, StructType

from convroute.llm.tables import row_keys
from convroute.llm.words import Words, alphanumeric, slices, split_words, word_hashes
from convroute.workspace import Workspace


@dataclass(frozen=True)
class IndexConfig:
    #: Words of a window; shorter items are one window.
    window: int = 13
    block_words: int = 1 << 20
    phrases_per_block: int = 200_000
    most_terms: int = 10_000_000


@dataclass(frozen=True)
class Terms:
    """Test terms, numbered by the order of their first hash."""

    first: np.ndarray
    second: np.ndarray

    def __len__(self) -> int:
        return len(self.first)

    def numbers(self, words: Words) -> np.ndarray:
        """The number of each word, -1 for words that are no test term."""
        if not len(self) or not len(words):
            return np.full(len(words), -1, np.int32)
        one = word_hashes(words, 0)
        place = np.minimum(np.searchsorted(self.first, one), len(self) - 1).astype(np.int32)
        found = np.flatnonzero(self.first[place] == one)
        chosen = replace(words, start=words.start[found], end=words.end[found])
        two = word_hashes(chosen, 1)
        out = np.full(len(words), -1, np.int32)
        good = self.second[place[found]] == two
        out[found[good]] = place[found[good]]
        return out


@dataclass(frozen=True)
class Phrases:
    """Word sequences to look for: term numbers end to end, and the item of each."""

    items: list[object]
    first: np.ndarray
    terms: np.ndarray

    def __len__(self) -> int:
        return len(self.items)


def query_set(items: Iterable[tuple[object, str | None]], window: int) -> tuple[Terms, Phrases]:
    """All terms and distinct windows of the items. Windows of an item without an id are matched but name no item."""
    known = list(items)
    words = split_words(pa.array([text for _, text in known], pa.string()), alphanumeric())
    one, two = word_hashes(words, 0), word_hashes(words, 1)
    first, at, inverse = np.unique(one, return_index=True, return_inverse=True)
    seen: set[tuple[object, bytes]] = set()
    owners, starts, parts = [], [0], []
    for (item, _), a, b in zip(known, words.first[:-1].tolist(), words.first[1:].tolist(), strict=True):
        for begin in range(a, max(a + 1, b - window + 1)):
            terms = inverse[begin : min(b, begin + window)].astype(np.int32)
            if len(terms) and (item, terms.tobytes()) not in seen:
                seen.add((item, terms.tobytes()))
                owners.append(item)
                parts.append(terms)
                starts.append(starts[-1] + len(terms))
    flat = np.concatenate(parts) if parts else np.zeros(0, np.int32)
    return Terms(first, two[at]), Phrases(owners, np.array(starts), flat)


def phrase_blocks(phrases: Phrases, most: int) -> list[Phrases]:
    bounds = [*range(0, max(1, len(phrases)), most), len(phrases)]
    return [
        Phrases(
            phrases.items[a:b],
            phrases.first[a : b + 1] - phrases.first[a],
            phrases.terms[phrases.first[a] : phrases.first[b]],
        )
        for a, b in zip(bounds[:-1], bounds[1:], strict=True)
    ]


# --- Index ----------------------------------------------------------------------------------------


def index_schema(key: StructField) -> StructType:
    return StructType(
        [
            StructField("block", LongType()),
            StructField("keys", ArrayType(key.dataType)),
            # First word of each document in the block's stream, and the end of the last.
            StructField("starts", ArrayType(LongType())),
            StructField("terms", ArrayType(IntegerType())),
            # Where each term's positions begin in ``positions``, and their end.
            StructField("offsets", ArrayType(LongType())),
            # Little-endian 64-bit positions in the block's stream.
            StructField("positions", BinaryType()),
        ]
    )


def build_index(
    documents: DataFrame,
    terms: Terms,
    config: IndexConfig = IndexConfig(),
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """One row per block of documents."""
    # The number of the stored partition, which a coalesced task keeps apart.
    chosen = documents.select(
        F.col(id_column).alias("key"), F.col(text_column).alias("__text"), F.spark_partition_id().alias("__partition")
    )
    schema = index_schema(chosen.schema["key"])
    shared = documents.sparkSession.sparkContext.broadcast(terms)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms = shared.value
        key_type = None
        keys: list[pa.Array] = []
        counts: list[np.ndarray] = []
        numbers: list[np.ndarray] = []
        total = 0
        number: int | None = None

        def block() -> pa.RecordBatch:
            stream = np.concatenate(numbers)
            known = np.flatnonzero(stream >= 0)
            order = known[np.argsort(stream[known], kind="stable")]
            found, first = np.unique(stream[order], return_index=True)
            starts = np.concatenate([[0], np.cumsum(np.concatenate(counts))])
            columns = [
                pa.array([number], pa.int64()),
                pa.array([pa.concat_arrays(keys).to_pylist()], pa.list_(key_type)),
                pa.array([starts], pa.list_(pa.int64())),
                pa.array([found], pa.list_(pa.int32())),
                pa.array([np.append(first, len(order))], pa.list_(pa.int64())),
                pa.array([order.astype("<i8").tobytes()], pa.binary()),
            ]
            return pa.RecordBatch.from_arrays(columns, names=schema.names)

        for batch in batches:
            key_type = batch.schema.types[0]
            if number is None and batch.num_rows:
                number = batch.column("__partition")[0].as_py() << 32
            for part in slices(batch, "__text"):
                words = split_words(part.column("__text"), alphanumeric())
                keys.append(part.column("key"))
                counts.append(words.counts)
                numbers.append(terms.numbers(words))
                total += len(words) + part.num_rows  # rows without words fill a block too
                if total >= config.block_words:
                    yield block()
                    number += 1
                    keys, counts, numbers, total = [], [], [], 0
        if keys:
            yield block()

    return chosen.mapInArrow(run, schema)


def term_counts(index: DataFrame, n_terms: int) -> np.ndarray:
    """Occurrences of each test term in all documents; at most one row per test term reaches the driver."""
    each = index.select(
        F.explode(
            F.transform(
                "terms",
                lambda term, i: F.struct(
                    term.alias("term"),
                    (F.element_at("offsets", i + 2) - F.element_at("offsets", i + 1)).alias("n"),
                ),
            )
        ).alias("t")
    )
    sums = each.groupBy("t.term").agg(F.sum("t.n").alias("n")).toPandas()
    out = np.zeros(n_terms, np.int64)
    out[sums["term"].to_numpy(np.int64)] = sums["n"].to_numpy(np.int64)
    return out


class Block:
    """Posting lists of one row of the index."""

    def __init__(self, batch: pa.RecordBatch, row: int):
        def values(name: str) -> np.ndarray:
            return batch.column(name)[row].values.to_numpy()

        self.starts = values("starts")
        self.terms = values("terms").tolist()
        self._place = {term: i for i, term in enumerate(self.terms)}
        self._offsets = values("offsets")
        self._positions = np.frombuffer(batch.column("positions")[row].as_buffer(), "<i8")

    def positions(self, term: int) -> np.ndarray:
        i = self._place.get(term)
        return self._positions[:0] if i is None else self._positions[self._offsets[i] : self._offsets[i + 1]]

    def has(self, terms: np.ndarray) -> bool:
        return all(t in self._place for t in terms.tolist())


def common(values: np.ndarray, others: np.ndarray) -> np.ndarray:
    """Values that occur in both ordered lists."""
    if not len(values) or not len(others):
        return values[:0]
    at = np.searchsorted(others, values)
    inside = at < len(others)
    return values[inside][others[at[inside]] == values[inside]]


def phrase_places(block: Block, terms: np.ndarray, order: np.ndarray) -> np.ndarray:
    """Where the phrase begins inside one document. ``order``: offsets of its terms, the rarest first."""
    if not block.has(terms):
        return np.zeros(0, np.int64)
    places = None
    for offset in order.tolist():
        shifted = block.positions(int(terms[offset])) - offset
        places = shifted if places is None else common(places, shifted)
        if not len(places):
            return places
    document = np.searchsorted(block.starts, places, "right") - 1
    return places[(places >= 0) & (places + len(terms) <= block.starts[document + 1])]


def near_places(block: Block, terms: np.ndarray, order: np.ndarray, slack: int) -> np.ndarray:
    """Places of the rarest term with every other term within ``slack`` words of it in the same document."""
    if not block.has(terms):
        return np.zeros(0, np.int64)
    places = block.positions(int(terms[order[0]]))
    document = np.searchsorted(block.starts, places, "right") - 1
    low = np.maximum(places - slack, block.starts[document])
    high = np.minimum(places + slack + 1, block.starts[document + 1])
    for offset in order[1:].tolist():
        others = block.positions(int(terms[offset]))
        good = np.searchsorted(others, high) > np.searchsorted(others, low)
        places, low, high = places[good], low[good], high[good]
    return places


def rare_first(phrases: Phrases, counts: np.ndarray) -> list[np.ndarray]:
    return [
        np.argsort(counts[phrases.terms[a:b]], kind="stable")
        for a, b in zip(phrases.first[:-1].tolist(), phrases.first[1:].tolist(), strict=True)
    ]


def search(index: DataFrame, phrases: Phrases, counts: np.ndarray, near: int | None = None) -> DataFrame:
    """One row per document: (block, place, key, n_words, spans, items).

    ``spans`` are the word ranges covered by exact matches, joined where they overlap, and ``items`` the items
    found.  With ``near``, a match is instead all terms of a phrase within so many words of its rarest one, and
    spans are the places of the rarest terms.
    """
    shared = index.sparkSession.sparkContext.broadcast((phrases, rare_first(phrases, counts)))
    span = StructType([StructField("begin", LongType()), StructField("end", LongType())])
    schema = StructType(
        [
            StructField("block", LongType()),
            StructField("place", LongType()),
            StructField("key", index.schema["keys"].dataType.elementType),
            StructField("n_words", LongType()),
            StructField("spans", ArrayType(span)),
            StructField("items", ArrayType(StringType())),
        ]
    )
    span_type = pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        phrases, orders = shared.value
        by_rarest: dict[int, list[int]] = {}
        for i, order in enumerate(orders):
            by_rarest.setdefault(int(phrases.terms[phrases.first[i] + order[0]]), []).append(i)
        for batch in batches:
            for row in range(batch.num_rows):
                block = Block(batch, row)
                spans: list[list[tuple[int, int]]] = [[] for _ in range(len(block.starts) - 1)]
                items: list[set[str]] = [set() for _ in spans]
                for i in (i for term in block.terms for i in by_rarest.get(term, ())):
                    terms = phrases.terms[phrases.first[i] : phrases.first[i + 1]]
                    if near is None:
                        found, length = phrase_places(block, terms, orders[i]), len(terms)
                    else:
                        found, length = near_places(block, terms, orders[i], near), 1
                    documents = np.searchsorted(block.starts, found, "right") - 1
                    begins = found - block.starts[documents]
                    for document, begin in zip(documents.tolist(), begins.tolist(), strict=True):
                        spans[document].append((begin, begin + length))
                        if phrases.items[i] is not None:
                            items[document].add(str(phrases.items[i]))
                columns = [
                    pa.array([batch.column("block")[row].as_py()] * len(spans), pa.int64()),
                    pa.array(range(len(spans)), pa.int64()),
                    batch.column("keys")[row].values,
                    pa.array(np.diff(block.starts), pa.int64()),
                    pa.array([[{"begin": a, "end": b} for a, b in joined(x)] for x in spans], span_type),
                    pa.array([sorted(x) for x in items], pa.list_(pa.string())),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return index.mapInArrow(run, schema)


def joined(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for begin, end in sorted(set(spans)):
        if out and begin <= out[-1][1]:
            out[-1] = out[-1][0], max(out[-1][1], end)
        else:
            out.append((begin, end))
    return out


def contamination(
    documents: DataFrame,
    benchmark: DataFrame,
    config: IndexConfig = IndexConfig(),
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """(id, n_words, n_hit, spans, items) of every row: words inside exact matches of benchmark windows."""
    spark = documents.sparkSession
    rows = ((row[0], row[1]) for row in benchmark.select("item_id", "text").toLocalIterator())
    terms, phrases = query_set(rows, config.window)
    if len(terms) > config.most_terms:
        raise ValueError(f"{len(terms)} test terms; search the benchmark in parts of {config.most_terms} terms")
    index = Workspace(spark, "positional-index").save(
        build_index(documents, terms, config, id_column, text_column), "index"
    )
    counts = term_counts(index, len(terms))
    parts = [search(index, block, counts) for block in phrase_blocks(phrases, config.phrases_per_block)]
    found = parts[0]
    if len(parts) > 1:
        # A span of one part may overlap one of another; ``covered`` counts each word once.
        found = (
            reduce(DataFrame.unionByName, parts)
            .groupBy("block", "place")
            .agg(
                F.first("key").alias("key"),
                F.first("n_words").alias("n_words"),
                F.array_sort(F.flatten(F.collect_list("spans"))).alias("spans"),
                F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
            )
        )
    return found.select(F.col("key").alias(id_column), "n_words", covered("spans").alias("n_hit"), "spans", "items")


def contaminated() -> Column:
    """At least one word in twenty lies in a benchmark window."""
    return (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))


def without_contaminated(
    documents: DataFrame,
    benchmark: DataFrame,
    config: IndexConfig = IndexConfig(),
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """The rows of ``documents`` that are not contaminated.

    Rows are told apart by 128 bits of hash of id and text; rows that are equal in both go or stay together.
    """
    own = [f"c{i}" for i in range(len(documents.columns))]
    rows = documents.toDF(*own)
    id_name, text_name = (own[documents.columns.index(name)] for name in (id_column, text_column))
    rows = rows.withColumns(row_keys(id_name, text_name))
    found = contamination(rows.withColumn("key", F.struct("k1", "k2")), benchmark, config, "key", text_name)
    gone = found.where(contaminated()).select("key.k1", "key.k2")
    return rows.join(gone, ["k1", "k2"], "left_anti").select(*own).toDF(*documents.columns)


def covered(spans: str) -> Column:
    """Words inside at least one of the ordered spans."""
    none = F.lit(0).cast("long")
    return F.aggregate(
        spans,
        F.struct(none.alias("n"), none.alias("reach")),
        lambda total, span: F.struct(
            (total.n + F.greatest(none, span.end - F.greatest(span.begin, total.reach))).alias("n"),
            F.greatest(total.reach, span.end).alias("reach"),
        ),
        lambda total: total.n,
    )
