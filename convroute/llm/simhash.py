"""SimHash near-duplicates by vantage-point trees (operator 6).

Fingerprints: the words of a text (blanks apart, A-Z lower-cased) in shingles of ``shingle`` words, each hashed to
64 bits; a bit of the fingerprint is set if it is set in more than half of the hashes.

Pairs: equal fingerprints are grouped first, so a group of copies is one point however large.  A small vantage-point
tree over a bounded sample of the points splits them into shards: at each node points closer to the node's vantage
point than its radius go one way, the others the other way.  By the triangle inequality a partner within
``distance`` bits can be on the other side only if the point's own distance is within ``distance`` of the radius;
such points are also sent to the other side as queries.  Inside a shard the same bounds prune a tree of its own down
to small leaves, where all pairs are compared by their bits.  So the links found are exact.

A shard holds about ``shard_points`` points of its own, and its guests are divided into parts of about
``guest_points``, so a task's share does not grow; the tree's nodes, at most ``sample_points``, are all that is
broadcast.  Links are cut down to a spanning forest where they are found: no more links than points leave a task.
Fingerprints of random texts lie about 32 bits apart, so the bounds prune weakly at the top and a point is a guest in
many shards; the README gives figures.

Rows with null or empty texts have fingerprint zero and are linked like any other.  Repeated rows share a
fingerprint.  Null ids take part but are never the name of a component unless it has no other.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField

from convroute.llm.components import smallest_reachable
from convroute.llm.tables import map_texts, row_keys
from convroute.llm.words import Words, blank_separated, mixed, split_words
from convroute.workspace import Workspace


@dataclass(frozen=True)
class SimHashConfig:
    shingle: int = 3
    distance: int = 3
    seed: int = 42
    #: Points of one shard, and guests of one of its parts, about.
    shard_points: int = 50_000
    guest_points: int = 250_000
    #: Points the shared tree is built from.
    sample_points: int = 16_384
    #: Points of a leaf inside a shard.
    leaf_points: int = 256


# --- Fingerprints ---------------------------------------------------------------------------------

_TABLE = blank_separated(lower=True)


def _fingerprints(words: Words, config: SimHashConfig) -> np.ndarray:
    raw = memoryview(words.data.tobytes())
    texts = len(words.first) - 1
    begin, end = words.first[:-1], words.first[1:]
    counts = np.where(end > begin, np.maximum(end - begin - config.shingle + 1, 1), 0)
    bounds = np.concatenate([[0], np.cumsum(counts)])
    owner = np.repeat(np.arange(texts), counts)
    first = begin[owner] + np.arange(len(owner)) - bounds[owner]
    last = np.minimum(first + config.shingle, end[owner]) - 1
    digest, seed = xxhash.xxh64_intdigest, config.seed
    hashes = np.fromiter(
        (digest(raw[a:b], seed) for a, b in zip(words.start[first].tolist(), words.end[last].tolist(), strict=True)),
        np.uint64,
        len(owner),
    )
    out = np.zeros(texts, np.uint64)
    for i in np.flatnonzero(counts).tolist():
        part = hashes[bounds[i] : bounds[i + 1]]
        ones = np.zeros(64, np.int64)
        for a in range(0, len(part), 8192):
            bits = np.unpackbits(part[a : a + 8192].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            ones += bits.sum(0, dtype=np.int64)
        out[i] = np.packbits(2 * ones > len(part), bitorder="little").view("<u8")[0]
    return out


def fingerprints(df: DataFrame, config: SimHashConfig, keys: dict[str, str], text_column: str) -> DataFrame:
    """(keys, fingerprint) of every row, as a signed 64-bit number. ``keys``: new name to column."""

    def make() -> Callable[[pa.Array], list[pa.Array]]:
        return lambda texts: [pa.array(_fingerprints(split_words(texts, _TABLE), config).view(np.int64))]

    return map_texts(df, keys, text_column, [StructField("fingerprint", LongType())], make)


# --- Trees ----------------------------------------------------------------------------------------


class Node(NamedTuple):
    """A vantage point; points closer than ``radius`` belong to ``near``. Leaves are shard numbers."""

    vantage: np.uint64
    radius: int
    near: Node | int
    far: Node | int


def bits_apart(points: np.ndarray, vantage: np.uint64) -> np.ndarray:
    return np.bitwise_count(points ^ vantage).astype(np.int16)


def best_radius(distances: np.ndarray, reach: int) -> tuple[int, float] | None:
    """The radius that leaves the fewest comparisons, and their share of all; None if none leaves fewer."""
    closer = np.concatenate([[0], np.cumsum(np.bincount(distances, minlength=66))]).astype(np.float64)
    radius, total = np.arange(1, 65), len(distances)
    near, with_guests = closer[radius], closer[np.minimum(radius + reach, 65)]
    work = near * with_guests + (total - near) ** 2
    work[(near == 0) | (near == total)] = np.inf
    best = int(work.argmin())
    return (int(radius[best]), float(work[best]) / total**2) if work[best] < total**2 else None


def shared_tree(sample: np.ndarray, most: int, reach: int) -> tuple[Node | int, int]:
    """A tree over a sample of the points whose shards hold ``most`` of them or fewer, and its number of shards."""
    shards = 0

    def grow(points: np.ndarray) -> Node | int:
        nonlocal shards
        if len(points) > most:
            choices = []
            for vantage in points[:: max(1, len(points) // 16)][:16]:
                found = best_radius(bits_apart(points, vantage), reach)
                if found:
                    choices.append((found[1], found[0], vantage))
            if choices:
                _, radius, vantage = min(choices)
                near = bits_apart(points, vantage) < radius
                return Node(vantage, radius, grow(points[near]), grow(points[~near]))
        shards += 1
        return shards - 1

    return grow(sample), shards


def sides(
    own: np.ndarray,
    guests: np.ndarray,
    d_own: np.ndarray,
    d_guests: np.ndarray,
    radius: int,
    reach: int,
    within: bool = True,
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Own points and guests of the near side, then of the far side, by the triangle bounds.

    A pair of own points across the radius is met on the near side, with its far point as a guest.
    """
    near = d_own < radius
    across = own[~near & (d_own < radius + reach)] if within else own[:0]
    yield own[near], np.concatenate([guests[d_guests < radius + reach], across])
    yield own[~near], guests[d_guests >= radius - reach]


def routes(tree: Node | int, points: np.ndarray, reach: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(shard, places of its own points, places of its guests)."""
    stack = [(tree, np.arange(len(points)), np.zeros(0, np.int64))]
    while stack:
        node, own, guests = stack.pop()
        if isinstance(node, int):
            yield node, own, guests
        elif len(own) or len(guests):
            d_own, d_guests = bits_apart(points[own], node.vantage), bits_apart(points[guests], node.vantage)
            parts = sides(own, guests, d_own, d_guests, node.radius, reach)
            stack += [(child, *part) for child, part in zip((node.near, node.far), parts, strict=True)]


def linked_pairs(
    points: np.ndarray, own: np.ndarray, guests: np.ndarray, reach: int, leaf: int, within: bool = True
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of places at most ``reach`` bits apart, own with guests and (``within``) own with own, in portions."""
    stack = [(own, guests)]
    while stack:
        own, guests = stack.pop()
        if not len(own) or not (within or len(guests)):
            continue
        if len(own) > leaf:
            vantage = points[own[len(own) // 2]]
            d_own, d_guests = bits_apart(points[own], vantage), bits_apart(points[guests], vantage)
            found = best_radius(d_own, reach)
            if found:
                stack += sides(own, guests, d_own, d_guests, found[0], reach, within)
                continue
        for a in range(0, len(own), leaf):
            block = own[a : a + leaf]
            others = np.concatenate([own[a:], guests]) if within else guests
            for b in range(0, len(others), 65_536):
                other = others[b : b + 65_536]
                close = np.bitwise_count(points[block][:, None] ^ points[other][None, :]) <= reach
                x, y = np.nonzero(close)
                x, y = block[x], other[y]
                yield x[x != y], y[x != y]


class Forest:
    """Union-find over places; keeps the links that joined something."""

    def __init__(self, size: int):
        self.parent = list(range(size))
        self.links: list[tuple[int, int]] = []

    def root(self, i: int) -> int:
        while self.parent[i] != i:
            self.parent[i] = self.parent[self.parent[i]]
            i = self.parent[i]
        return i

    def add(self, a: np.ndarray, b: np.ndarray) -> None:
        for i, j in zip(a.tolist(), b.tolist(), strict=True):
            x, y = self.root(i), self.root(j)
            if x != y:
                self.parent[max(x, y)] = min(x, y)
                self.links.append((i, j))


# --- Links between fingerprints -------------------------------------------------------------------


def links(points: DataFrame, config: SimHashConfig = SimHashConfig()) -> DataFrame:
    """(a, b): links that connect what pairs within ``distance`` connect. ``points`` has distinct fingerprints."""
    spark = points.sparkSession
    total = points.count()
    rows = points.orderBy(F.xxhash64("fingerprint"), "fingerprint").limit(config.sample_points)
    sample = rows.toPandas()["fingerprint"].to_numpy(np.int64).view(np.uint64)
    each = max(1.0, total / max(1, len(sample)))
    tree, shards = shared_tree(sample, max(8, int(config.shard_points / each)), config.distance)
    parts = np.ones(shards, np.int64)
    for shard, _, guests in routes(tree, sample, config.distance):
        parts[shard] = max(1, int(np.ceil(len(guests) * each / config.guest_points)))
    shared = spark.sparkContext.broadcast((tree, parts))

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree, parts = shared.value
        for batch in batches:
            points = batch.column("fingerprint").to_numpy().view(np.uint64)
            for shard, own, guests in routes(tree, points, config.distance):
                n = int(parts[shard])
                # A shard's own points go to all of its parts, a guest to one.
                at = np.concatenate([np.tile(own, n), guests])
                home = np.arange(len(at)) < n * len(own)
                part = np.concatenate([np.repeat(np.arange(n), len(own)), mixed(points[guests]) % np.uint64(n)])
                columns = [np.full(len(at), shard), part.astype(np.int64), points[at].view(np.int64), home]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c) for c in columns], names=["shard", "part", "fingerprint", "home"]
                )

    def match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells: dict[tuple[int, int], list[tuple[np.ndarray, np.ndarray]]] = {}
        for batch in batches:
            shard, part = batch.column("shard").to_numpy(), batch.column("part").to_numpy()
            values = batch.column("fingerprint").to_numpy().view(np.uint64)
            home = batch.column("home").to_numpy(zero_copy_only=False)
            for cell in set(zip(shard.tolist(), part.tolist(), strict=True)):
                here = (shard == cell[0]) & (part == cell[1])
                cells.setdefault(cell, []).append((values[here & home], values[here & ~home]))
        for cell, found in cells.items():
            own, guests = (np.sort(np.concatenate(x)) for x in zip(*found, strict=True))
            both = np.concatenate([own, guests])
            places = np.arange(len(both))
            forest = Forest(len(both))
            for a, b in linked_pairs(
                both, places[: len(own)], places[len(own) :], config.distance, config.leaf_points, cell[1] == 0
            ):
                forest.add(a, b)
            if forest.links:
                a, b = np.array(forest.links).T
                yield pa.RecordBatch.from_arrays(
                    [pa.array(both[a].view(np.int64)), pa.array(both[b].view(np.int64))], names=["a", "b"]
                )

    routed = points.select("fingerprint").mapInArrow(route, "shard long, part long, fingerprint long, home boolean")
    return routed.repartition(int(parts.sum()), "shard", "part").mapInArrow(match, "a long, b long")


def _grouped(df: DataFrame, config: SimHashConfig, keys: dict[str, str], text_column: str) -> DataFrame:
    """(keys, fingerprint, group, component_id) of every row; ``id`` is one of the keys."""
    workspace = Workspace(df.sparkSession, "simhash")
    stored = workspace.save(fingerprints(df, config, keys, text_column), "fingerprints")
    points = workspace.save(stored.groupBy("fingerprint").agg(F.min("id").alias("least")), "points")
    found = smallest_reachable(links(points, config), "simhash-components")
    labelled = points.join(found.withColumnRenamed("node", "fingerprint"), "fingerprint", "left").select(
        "fingerprint", "least", F.coalesce("component", "fingerprint").alias("group")
    )
    smallest = labelled.groupBy("group").agg(F.min("least").alias("component_id"))
    named = labelled.join(smallest, "group").select("fingerprint", "group", "component_id")
    return stored.join(named, "fingerprint").select(*keys, "fingerprint", "group", "component_id")


def near_duplicates(
    df: DataFrame, config: SimHashConfig = SimHashConfig(), id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """(id, fingerprint, component_id) of every row: the smallest id that links reach, its own included."""
    found = _grouped(df, config, {"id": id_column}, text_column)
    return found.select(F.col("id").alias(id_column), "fingerprint", "component_id")


def one_of_each_group(
    df: DataFrame, config: SimHashConfig = SimHashConfig(), id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """The rows of ``df`` less all but one of each group: the one of the smallest id.

    Rows are told apart by 128 bits of hash of id and text; of rows that are equal in both, one stays.
    """
    own = [f"c{i}" for i in range(len(df.columns))]
    rows = df.toDF(*own)
    id_name, text_name = (own[df.columns.index(name)] for name in (id_column, text_column))
    rows = rows.withColumns(row_keys(id_name, text_name))
    groups = _grouped(rows, config, {"id": id_name, "k1": "k1", "k2": "k2"}, text_name)
    first = F.min(F.struct(F.col("id").isNull().alias("without"), "id", "k1", "k2")).alias("kept")
    kept = groups.groupBy("group").agg(first).select("kept.k1", "kept.k2")
    return rows.join(kept, ["k1", "k2"], "left_semi").dropDuplicates(["k1", "k2"]).select(*own).toDF(*df.columns)


def as_hex(fingerprint: str) -> Column:
    return F.lower(F.lpad(F.hex(fingerprint), 16, "0"))
