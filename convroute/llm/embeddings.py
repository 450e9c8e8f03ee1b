"""Embedding near-duplicates by product quantisation with inverted lists (operator 2).

Equal vectors are one point, however many copies.  Coarse centroids, fitted on a bounded sample, split the points
into inverted lists; the residual of each point to its centroid is stored as one byte for each subspace, with the
length of what the code leaves out.  A point queries its own list and every later list that can hold a partner: one
whose border lies within the link radius, and whose members' distances to their centroid are within the radius of
the point's.  Both are triangle inequalities, so no link is lost, whatever the vectors are like.  A link between two
lists is found from the earlier one and counted for both ends.  In a list, distances to all codes are sums of one
table look-up per subspace, the tables being made from the query itself (asymmetric).  The triangle inequality turns
such a distance and the stored length into a lower bound, so the codes lose no link either.  What passes is compared
by cosine in double precision.

Vectors in random directions of many dimensions have most borders within the radius, so nearly all lists are searched
and work grows with the square of the points; on vectors that lie in groups or few dimensions few lists are.

Neighbouring small lists stand on one shelf, to which a query goes once.  Shelves are split into cells of bounded
members and queries, so a hot list is many tasks.  Links are not written as pairs: a cell gives the number of links
of each point, and one link per point to a representative that the cell's links reach.  Centroids (``most_lists`` at
most) with their shelves and code books are all that is broadcast.

Vectors that are null, zero, or hold null or non-finite components link with nothing.  Vectors of each length are
searched among their own, one length after another, with lists and codes of their own.  Repeated rows are copies like any other.  Null ids take part and name no component.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from convroute.llm.components import smallest_reachable
from convroute.llm.tables import row_keys
from convroute.workspace import Workspace


@dataclass(frozen=True)
class QuantiserConfig:
    cosine: float = 0.95
    most_lists: int = 16_384
    #: Sample rows for each list, numbers in the whole sample at most, and iterations of the fits.
    rows_per_list: int = 40
    sample_numbers: int = 1 << 24
    rounds: int = 8
    subspaces: int = 8
    codewords: int = 64
    cell_members: int = 2048
    cell_queries: int = 8192

    @property
    def radius(self) -> float:
        return float(np.sqrt(2 - 2 * self.cosine))


#: What rounding may add to a distance of unit vectors.
SLIP = 1e-6


@dataclass(frozen=True)
class Quantiser:
    centroids: np.ndarray
    #: Code words of each subspace, and where each subspace begins.
    books: list[np.ndarray]
    bounds: list[int]

    def squared(self, units: np.ndarray) -> np.ndarray:
        """Squared distance of unit vectors to each centroid."""
        return np.maximum((self.centroids**2).sum(1) + 1 - 2 * units @ self.centroids.T, 0.0)

    def encode(self, residuals: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Codes, and the length of what they leave out."""
        codes = np.zeros((len(residuals), len(self.books)), np.uint8)
        left = np.zeros(len(residuals))
        for s, book in enumerate(self.books):
            part = residuals[:, self.bounds[s] : self.bounds[s + 1]]
            distance = _squared_distances(part, book)
            codes[:, s] = distance.argmin(1)
            left += distance[np.arange(len(part)), codes[:, s]]
        return codes, np.sqrt(np.maximum(left, 0.0))


@dataclass(frozen=True)
class Shelves:
    """Of each list: its shelf, its place in the order of search, and the range of its members' distances to its centroid."""

    shelf: np.ndarray
    place: np.ndarray
    nearest: np.ndarray
    farthest: np.ndarray

    def probes(
        self, quantiser: Quantiser, units: np.ndarray, home: np.ndarray, lists: np.ndarray, radius: float
    ) -> np.ndarray:
        """For each vector and each of ``lists``, whether it is the vector's own or a later one that can hold a partner."""
        centroids, reach = quantiser.centroids, radius + SLIP
        squared = _squared_distances(units, centroids[lists])
        own = ((units - centroids[home]) ** 2).sum(1)
        apart = np.sqrt(_squared_distances(centroids[home], centroids[lists]))
        found = squared - own[:, None] <= 2 * apart * reach + SLIP
        away = np.sqrt(squared)
        found &= (away <= self.farthest[lists] + reach) & (away >= self.nearest[lists] - reach)
        found &= self.place[lists][None, :] > self.place[home][:, None]
        return found | (lists[None, :] == home[:, None])


def shelve(centroids: np.ndarray, counts: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Shelf and place of each list: halves along the longest direction, until a shelf has one list or ``most`` members."""
    shelf, place = np.zeros(len(counts), np.int64), np.zeros(len(counts), np.int64)
    left, shelves, places = [np.arange(len(counts))], 0, 0
    while left:
        lists = left.pop()
        if len(lists) == 1 or counts[lists].sum() <= most:
            shelf[lists], place[lists] = shelves, places + np.arange(len(lists))
            shelves, places = shelves + 1, places + len(lists)
            continue
        own = centroids[lists]
        one = own[((own - own.mean(0)) ** 2).sum(1).argmax()]
        other = own[((own - one) ** 2).sum(1).argmax()]
        order = np.argsort(own @ (other - one), kind="stable")
        members = np.cumsum(counts[lists[order]])
        cut = int(np.clip(np.searchsorted(members, members[-1] / 2) + 1, 1, len(lists) - 1))
        left += [lists[order[cut:]], lists[order[:cut]]]
    return shelf, place


def _squared_distances(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return np.maximum((x**2).sum(1)[:, None] + (y**2).sum(1)[None, :] - 2 * x @ y.T, 0.0)


def k_means(points: np.ndarray, k: int, rounds: int) -> np.ndarray:
    """At most ``k`` centres; empty ones are dropped."""
    points = np.asarray(points, np.float64)
    centres = np.unique(points, axis=0)
    if len(centres) > k:
        centres = centres[np.random.default_rng(11).choice(len(centres), k, replace=False)]
    for _ in range(rounds):
        nearest = np.concatenate(
            [_squared_distances(points[i : i + 4096], centres).argmin(1) for i in range(0, len(points), 4096)]
        )
        counts = np.bincount(nearest, minlength=len(centres))
        order = np.argsort(nearest, kind="stable")
        starts = np.concatenate([[0], np.cumsum(counts)[:-1]])[counts > 0]
        centres = np.add.reduceat(points[order], starts, axis=0) / counts[counts > 0][:, None]
    return centres


def fit(sample: np.ndarray, lists: int, config: QuantiserConfig) -> Quantiser:
    """``sample`` holds unit vectors."""
    dimension = sample.shape[1]
    centroids = k_means(sample, lists, config.rounds) if len(sample) else np.zeros((1, dimension))
    bounds = np.linspace(0, dimension, min(config.subspaces, max(1, dimension)) + 1).astype(int).tolist()
    blank = Quantiser(centroids, [], bounds)
    residuals = sample - centroids[blank.squared(sample).argmin(1)] if len(sample) else np.zeros((1, dimension))
    books = [k_means(residuals[:, a:b], config.codewords, config.rounds) for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
    return Quantiser(centroids, books, bounds)


# --- Vectors --------------------------------------------------------------------------------------


def _vectors(df: DataFrame, id_column: str, vector_column: str) -> DataFrame:
    """(id, vector): the components as little-endian doubles, null for vectors that link with nothing."""
    chosen = df.select(F.col(id_column).alias("id"), F.col(vector_column).cast("array<double>").alias("vector"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column("vector")
            sizes = pa.compute.list_value_length(column).fill_null(0).to_numpy()
            flat = column.flatten()
            values = flat.fill_null(float("nan")).to_numpy(zero_copy_only=False)
            ends = np.cumsum(sizes)
            raw = np.ascontiguousarray(values, "<f8") + 0.0  # -0.0 equals 0.0
            out = []
            for end, size in zip(ends.tolist(), sizes.tolist(), strict=True):
                own = raw[end - size : end]
                out.append(own.tobytes() if size and np.isfinite(own).all() and own.any() else None)
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(out, pa.binary())], names=["id", "vector"])

    return chosen.mapInArrow(run, f"id {chosen.schema['id'].dataType.simpleString()}, vector binary")


def _units(column: pa.Array) -> np.ndarray:
    """Unit vectors of a binary column of equal lengths."""
    rows = np.stack([np.frombuffer(x, "<f8") for x in column.to_pylist()])
    # Scaling first keeps squares of very large or small components finite.
    rows = rows / np.abs(rows).max(1)[:, None]
    return rows / np.sqrt((rows**2).sum(1))[:, None]


def _components_of(a: np.ndarray, b: np.ndarray, size: int) -> np.ndarray:
    """The least place that links reach, for every place."""
    label = np.arange(size)
    while True:
        low = np.minimum(label[a], label[b])
        after = label.copy()
        np.minimum.at(after, label[a], low)
        np.minimum.at(after, label[b], low)
        after = after[after]
        if (after == label).all():
            return label
        label = after


def _close(
    queries: np.ndarray, members: np.ndarray, codes: np.ndarray, left: np.ndarray, centroid: np.ndarray,
    quantiser: Quantiser, config: QuantiserConfig,
) -> tuple[np.ndarray, np.ndarray]:
    """(query, member) places with cosine of at least the threshold: table look-ups, then exact comparison."""
    residuals = queries - centroid
    distance = np.zeros((len(queries), len(members)))
    for s, book in enumerate(quantiser.books):
        part = residuals[:, quantiser.bounds[s] : quantiser.bounds[s + 1]]
        distance += _squared_distances(part, book)[:, codes[:, s]]
    bound = np.sqrt(distance) - left[None, :]
    a, b = np.nonzero(bound <= config.radius + 1e-6)
    found = []
    for i in range(0, len(a), 65_536):
        x, y = a[i : i + 65_536], b[i : i + 65_536]
        good = np.einsum("ij,ij->i", queries[x], members[y]) >= config.cosine
        found.append((x[good], y[good]))
    if not found:
        return a[:0], b[:0]
    return np.concatenate([x for x, _ in found]), np.concatenate([y for _, y in found])


def _matched(cells: DataFrame, shared: Broadcast, config: QuantiserConfig) -> DataFrame:
    """(point, links, linked): numbers of links of points, and links of points to representatives."""

    def rows(point: np.ndarray, links: np.ndarray, linked: np.ndarray) -> pa.RecordBatch:
        columns = [pa.array(point, pa.int64()), pa.array(links, pa.int64()), pa.array(linked, pa.int64())]
        return pa.RecordBatch.from_arrays(columns, names=["point", "links", "linked"])

    def counted(points: np.ndarray, links: np.ndarray) -> pa.RecordBatch:
        some = np.flatnonzero(links)
        return rows(points[some], links[some], points[some])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        quantiser, shelves = shared.value
        cell: int | None = None
        parts: list[pa.RecordBatch] = []
        members: tuple | None = None

        def gathered() -> tuple:
            units = np.concatenate([_units(p.column("vector")) for p in parts])
            codes = np.concatenate(
                [np.stack([np.frombuffer(x, np.uint8) for x in p.column("codes").to_pylist()]) for p in parts]
            )
            return units, codes, *(
                np.concatenate([p.column(n).to_numpy() for p in parts])
                for n in ("remainder", "point", "copies", "list")
            )

        for batch in batches:
            key = batch.column("cell").to_numpy()
            member = batch.column("member").to_numpy(zero_copy_only=False)
            change = np.flatnonzero((np.diff(key) != 0) | (member[1:] != member[:-1])) + 1
            for begin, end in zip([0, *change.tolist()], [*change.tolist(), len(key)], strict=True):
                part = batch.slice(begin, end - begin)
                if key[begin] != cell:
                    if members:
                        yield counted(members[3], met)
                    cell, parts, members = int(key[begin]), [], None
                if member[begin]:
                    parts.append(part)
                    continue
                if not parts:
                    continue
                if not members:
                    members = gathered()
                    # Links of the members that queries of earlier lists found.
                    met = np.zeros(len(members[0]), np.int64)
                units, codes, left, points, copies, listed = members
                lists, starts = np.unique(listed, return_index=True)
                ends = [*starts[1:].tolist(), len(listed)]
                for i in range(0, part.num_rows, 512):
                    block = part.slice(i, 512)
                    own, home, times = (block.column(n).to_numpy() for n in ("point", "list", "copies"))
                    queries = _units(block.column("vector"))
                    probed = shelves.probes(quantiser, queries, home, lists, config.radius)
                    found = []
                    for j, (start, end) in enumerate(zip(starts.tolist(), ends, strict=True)):
                        asking = np.flatnonzero(probed[:, j])
                        if len(asking):
                            x, y = _close(
                                queries[asking], units[start:end], codes[start:end], left[start:end],
                                quantiser.centroids[lists[j]], quantiser, config,
                            )
                            found.append((asking[x], start + y))
                    a = np.concatenate([np.zeros(0, np.int64), *(x for x, _ in found)])
                    b = np.concatenate([np.zeros(0, np.int64), *(y for _, y in found)])
                    a, b = a[own[a] != points[b]], b[own[a] != points[b]]
                    across = home[a] != listed[b]
                    met += np.bincount(b[across], weights=times[a[across]], minlength=len(met)).astype(np.int64)
                    yield counted(own, np.bincount(a, weights=copies[b], minlength=len(own)).astype(np.int64))
                    label = _components_of(a, len(own) + b, len(own) + len(points))
                    names = np.concatenate([own, points])
                    tied = np.flatnonzero(label != np.arange(len(label)))
                    yield rows(names[tied], np.zeros(len(tied), np.int64), names[label[tied]])
        if members:
            yield counted(members[3], met)

    return cells.mapInArrow(run, "point long, links long, linked long")


def near_duplicates(
    df: DataFrame,
    config: QuantiserConfig = QuantiserConfig(),
    id_column: str = "vec_id",
    vector_column: str = "embedding",
) -> DataFrame:
    """(id, n_links, component_id) of every row: other vectors linked directly, smallest id that links reach."""
    workspace = Workspace(df.sparkSession, "embeddings")
    keys = [F.when(F.col("vector").isNotNull(), key).alias(name) for name, key in row_keys("vector").items()]
    vectors = workspace.save(_vectors(df, id_column, vector_column).select("id", "vector", *keys), "vectors")
    # One row per length.
    lengths = sorted(row[0] for row in vectors.where("vector is not null").select(F.length("vector")).distinct().collect())
    named = vectors.where("false").select("k1", "k2", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    for length in lengths:
        named = named.unionByName(_linked(vectors, length // 8, config))
    return vectors.select("id", "k1", "k2").join(named, ["k1", "k2"], "left").select(
        F.col("id").alias(id_column),
        F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"),
        F.when(F.col("n_links").isNull(), F.col("id")).otherwise(F.col("component_id")).alias("component_id"),
    )


def _linked(vectors: DataFrame, dimension: int, config: QuantiserConfig) -> DataFrame:
    """(k1, k2, n_links, component_id) of the distinct vectors of one length."""
    spark = vectors.sparkSession
    workspace = Workspace(spark, "embeddings")
    points = workspace.save(
        vectors.where(F.length("vector") == 8 * dimension)
        .groupBy("vector", "k1", "k2")
        .agg(F.count(F.lit(1)).alias("copies"), F.min("id").alias("least"))
        .withColumn("point", F.monotonically_increasing_id()),
        "points",
    )

    total = points.count()
    lists = int(min(config.most_lists, max(1, 2 ** round(np.log2(max(1, total)) / 2))))
    most = min(lists * config.rows_per_list, max(1, config.sample_numbers // dimension))
    sample = points.orderBy("k1", "k2").limit(most).select("vector").toPandas()["vector"]
    own = _units(pa.array(sample.map(bytes), pa.binary())) if len(sample) else np.zeros((0, dimension))
    quantiser = fit(own, lists, config)
    shared = spark.sparkContext.broadcast(quantiser)

    def stored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, 1024):
                part = batch.slice(i, 1024)
                units = _units(part.column("vector"))
                home = shared.value.squared(units).argmin(1)
                residuals = units - shared.value.centroids[home]
                codes, left = shared.value.encode(residuals)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(home, pa.int64()),
                        *(part.column(n) for n in ("point", "vector", "copies")),
                        pa.array([c.tobytes() for c in codes], pa.binary()),
                        pa.array(left),
                        pa.array(np.sqrt((residuals**2).sum(1))),
                    ],
                    names=["list", "point", "vector", "copies", "codes", "remainder", "away"],
                )

    members = workspace.save(
        points.select("point", "vector", "copies").mapInArrow(
            stored, "list long, point long, vector binary, copies long, codes binary, remainder double, away double"
        ),
        "members",
    )
    # One row per list.
    size = len(quantiser.centroids)
    counts, nearest, farthest = np.zeros(size, np.int64), np.full(size, np.inf), np.full(size, -np.inf)
    for row in members.groupBy("list").agg(F.count(F.lit(1)), F.min("away"), F.max("away")).collect():
        counts[row[0]], nearest[row[0]], farthest[row[0]] = row[1:]
    shelves = Shelves(*shelve(quantiser.centroids, counts, config.cell_members), nearest, farthest)
    index = spark.sparkContext.broadcast((quantiser, shelves))

    def queries(*carried: str) -> DataFrame:
        """A row for each shelf that a point goes to.  Probed anew for each use: that is cheaper than to store it."""

        def probed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            quantiser, shelves = index.value
            order = np.argsort(shelves.place)
            numbers, starts = np.unique(shelves.shelf[order], return_index=True)
            step = max(16, min(1024, (1 << 22) // len(order)))
            for batch in batches:
                for i in range(0, batch.num_rows, step):
                    part = batch.slice(i, step)
                    units, home = _units(part.column("vector")), part.column("list").to_numpy()
                    found = shelves.probes(quantiser, units, home, order, config.radius)
                    at, number = np.nonzero(np.logical_or.reduceat(found, starts, axis=1))
                    rows = pa.array(at)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(numbers[number], pa.int64()), *(part.column(n).take(rows) for n in carried)],
                        names=["shelf", *carried],
                    )

        source = members.select("list", "point", "vector", "copies")
        types = ", ".join(f"{n} {source.schema[n].dataType.simpleString()}" for n in carried)
        return source.mapInArrow(probed, ", ".join(["shelf long", types]) if types else "shelf long")

    shelf_of_list = spark.createDataFrame(list(enumerate(shelves.shelf.tolist())), "list long, shelf long")
    # Into how many rows of members and columns of queries each shelf is split; one row per shelf.
    on_shelves = members.join(F.broadcast(shelf_of_list), "list")
    parts = (
        on_shelves.groupBy("shelf")
        .agg(F.ceil(F.count(F.lit(1)) / config.cell_members).alias("rows"))
        .join(queries().groupBy("shelf").agg(F.ceil(F.count(F.lit(1)) / config.cell_queries).alias("columns")), "shelf")
    )
    parts = F.broadcast(workspace.save(parts, "parts"))
    cell = (F.col("shelf") * (1 << 40) + F.col("row") * (1 << 20) + F.col("column")).alias("cell")
    shown = ("member", "list", "point", "vector", "copies", "codes", "remainder")

    def place(count: str) -> Column:
        return F.pmod(F.xxhash64("point"), count)

    def every(count: str) -> Column:
        return F.explode(F.sequence(F.lit(0).cast("long"), F.col(count) - 1))

    member_cells = (
        on_shelves.join(parts, "shelf")
        .withColumns({"row": place("rows"), "member": F.lit(True)})
        .withColumn("column", every("columns"))
        .select(cell, *shown)
    )
    no_code = {"codes": F.lit(None).cast("binary"), "remainder": F.lit(0.0)}
    query_cells = (
        queries("list", "point", "vector", "copies")
        .join(parts, "shelf")
        .withColumns({"column": place("columns"), "member": F.lit(False), **no_code})
        .withColumn("row", every("rows"))
        .select(cell, *shown)
    )
    cells = (
        member_cells.unionByName(query_cells)
        .repartition("cell")
        .sortWithinPartitions("cell", F.desc("member"), "list", "point")
    )
    found = workspace.save(_matched(cells, index, config), "found")
    ties = found.where("links = 0").select(F.col("point").alias("a"), F.col("linked").alias("b"))
    component = smallest_reachable(ties, "embedding-components").withColumnRenamed("node", "point")
    numbers = found.groupBy("point").agg(F.sum("links").alias("links"))
    labelled = (
        points.select("k1", "k2", "copies", "least", "point")
        .join(component, "point", "left")
        .join(numbers, "point", "left")
        .select(
            "k1", "k2", "least",
            F.coalesce("component", "point").alias("component"),
            (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
        )
    )
    smallest = labelled.groupBy("component").agg(F.min("least").alias("component_id"))
    return labelled.join(smallest, "component").select("k1", "k2", "n_links", "component_id")
