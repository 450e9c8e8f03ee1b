"""Hard-negative mining by segment summary filtering (operator 12).

Vectors are scaled to whole numbers, and scores are their exact inner products.  A vector is cut into segments; each
keeps its mean m and its deviation d, the square root of the squared distances to the mean.  For a segment of n
components, m1 * m2 * n - d1 * d2 <= its part of the score <= m1 * m2 * n + d1 * d2 (Cauchy-Schwarz on what the means
leave), and sums over the segments bound the score.  Bounds are refined level by level, each with half as long
segments; a pair goes to the next level while its bounds leave it open, and only what the last level leaves open is
scored exactly.  Deviations are rounded up, so a bound never loses a row.

1.  ``summaries``: the scaled vector with the summaries of all levels, one stored row for each distinct (id, label,
    vector) and the number of its copies.
2.  Anchors stand in blocks of bounded size and all rows in cells of bounded size.  Each pair of a block and a cell is
    searched by one task, which reads the block's anchors and streams the cell's rows: a stated query set against
    all rows, without a broadcast and without the driver.
3.  Positives: the best rows of the anchor's label in the cell; a pair is open while its upper bound reaches the worst
    of the best so far.  One more grouping takes the best of all cells.
4.  Negatives: for each positive the best rows of other labels whose score lies in its band; a pair is open while its
    bounds meet a band of the anchor, and its upper bound reaches the worst of that band's best so far.

Rows with a null label, a null vector, or a null or non-finite component take no part, nor do rows with a scaled
component of 2^26 or more, whose scores need not fit a long.  Vectors of different lengths are not compared.  Rows
without an id are candidates that come last among ties, but no anchors.  Repeated rows are rows of their own: copies
of an anchor but itself are candidates, and each copy of an anchor gives its rows again.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from convroute.workspace import Workspace


@dataclass(frozen=True)
class MiningConfig:
    scale: int = 256
    positives: int = 5
    negatives: int = 3
    #: Share of the positive's score, in percent, that a negative's score must reach and must not pass.
    least_percent: int = 50
    most_percent: int = 95
    #: Length of the segments of each level, from coarse to fine.
    segments: tuple[int, ...] = (16, 8, 4)
    #: Anchors of one block and rows of one cell, about.
    block_anchors: int = 4096
    cell_rows: int = 65_536
    #: Pairs compared at once in a task.
    pairs_at_once: int = 1 << 21

    def __post_init__(self) -> None:
        if not 0 < self.least_percent <= self.most_percent:
            raise ValueError("the band must not be empty")


#: Components of this size are beyond what is scored.
TOO_LARGE = 1 << 26

#: Pairs are refined one by one rather than all together when fewer than one in this many are open.
_FEW = 8


def scaled(vector: str, config: MiningConfig = MiningConfig()) -> Column:
    return F.transform(vector, lambda x: F.floor(x.cast("double") * config.scale).cast("long"))


def usable(vector: str, config: MiningConfig = MiningConfig()) -> Column:
    """Whether no component is null, non-finite or too large. False for a null vector."""
    bound = TOO_LARGE / config.scale
    small = F.forall(vector, lambda x: F.coalesce(F.abs(x.cast("double")) < bound, F.lit(False)) & ~F.isnan(x.cast("double")))
    return F.coalesce(small, F.lit(False))


class Summaries:
    """Scaled vectors of one length with means and deviations of their segments, level by level."""

    def __init__(self, vectors: np.ndarray, config: MiningConfig):
        self.vectors = vectors
        size = vectors.shape[1]
        self.levels: list[tuple[np.ndarray, np.ndarray]] = []
        for length in config.segments:
            bounds = np.arange(0, size, length)
            counts = np.diff(np.append(bounds, size))
            if not size or (self.levels and len(bounds) == self.levels[-1][0].shape[1]):
                continue
            means = np.add.reduceat(vectors, bounds, axis=1) / counts
            rest = vectors - np.repeat(means, counts, axis=1)
            deviations = np.sqrt(np.add.reduceat(rest * rest, bounds, axis=1))
            # Weighted so that a plain inner product of means gives the middle of the bounds.
            self.levels.append((means * np.sqrt(counts), deviations * (1 + 1e-9) + 1e-9))

    def exact(self, other: Summaries) -> bool:
        """Whether inner products stay whole in double precision."""
        most = [np.abs(s.vectors).max(initial=0) for s in (self, other)]
        return most[0] * most[1] * self.vectors.shape[1] < 2.0**52


def _whole_scores(a: np.ndarray, b: np.ndarray, exact: bool) -> np.ndarray:
    if exact:
        return (a @ b.T).astype(np.int64)
    return a.astype(np.int64) @ b.astype(np.int64).T


def open_scores(
    rows: Summaries, anchors: Summaries, low: np.ndarray, high: np.ndarray, allowed: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """(row, anchor, score) of the allowed pairs whose score may lie between ``low`` and ``high`` of the anchor.

    Pairs whose bounds leave the range at some level are never scored.  Also returns how many were scored.
    """
    exact = rows.exact(anchors)
    live, pairs = allowed, None
    for level, ((row_means, row_devs), (means, devs)) in enumerate(zip(rows.levels, anchors.levels, strict=True)):
        if pairs is None:
            if np.count_nonzero(live) * _FEW < live.size:
                pairs = np.nonzero(live)
            else:
                middle, reach = row_means @ means.T, row_devs @ devs.T
                slack = 1e-6 + 1e-9 * (reach + np.abs(middle))
                live = live & (middle + reach + slack >= low) & (middle - reach - slack <= high)
        if pairs is not None:
            r, a = pairs
            middle = np.einsum("ij,ij->i", row_means[r], means[a])
            reach = np.einsum("ij,ij->i", row_devs[r], devs[a])
            slack = 1e-6 + 1e-9 * (reach + np.abs(middle))
            stay = (middle + reach + slack >= low[a]) & (middle - reach - slack <= high[a])
            pairs = r[stay], a[stay]
    if pairs is None and np.count_nonzero(live) * _FEW >= live.size:
        scores = _whole_scores(rows.vectors, anchors.vectors, exact)
        r, a = np.nonzero(live & (scores >= low) & (scores <= high))
        return r, a, scores[r, a], int(np.count_nonzero(live))
    r, a = pairs if pairs is not None else np.nonzero(live)
    if exact:
        scores = np.einsum("ij,ij->i", rows.vectors[r], anchors.vectors[a]).astype(np.int64)
    else:
        scores = np.einsum("ij,ij->i", rows.vectors[r].astype(np.int64), anchors.vectors[a].astype(np.int64))
    good = (scores >= low[a]) & (scores <= high[a])
    return r[good], a[good], scores[good], len(r)


def _best(group: np.ndarray, score: np.ndarray, ident: np.ndarray, most: int) -> np.ndarray:
    """Places of the first ``most`` of each group by score descending, then id."""
    order = np.lexsort((ident, -score, group))
    sorted_group = group[order]
    new = np.ones(len(order), bool)
    new[1:] = sorted_group[1:] != sorted_group[:-1]
    starts = np.flatnonzero(new)
    rank = np.arange(len(order)) - np.repeat(starts, np.diff(np.append(starts, len(order))))
    return order[rank < most]


_LEAST, _LAST = np.iinfo(np.int64).min, np.iinfo(np.int64).max


def percent(share: int, score: np.ndarray) -> np.ndarray:
    """``share`` percent of the score, rounded down, without a product that could pass a long."""
    return share * (score // 100) + share * (score % 100) // 100


class _Search:
    """The best candidates of each query among rows that come batch by batch; memory holds the best only.

    A query is an anchor with a range of scores.  Several queries may share an anchor.
    """

    def __init__(self, owner: np.ndarray, low: np.ndarray, high: np.ndarray, most: int, anchors: int):
        self.owner, self.low, self.high, self.most, self.anchors = owner, low, high, most, anchors
        self.query = np.zeros(0, np.int64)
        self.score = np.zeros(0, np.int64)
        self.ident = np.zeros(0, np.int64)
        self.floor = low.copy()

    def wanted(self) -> tuple[np.ndarray, np.ndarray]:
        """Range of scores that can still matter to each anchor."""
        low = np.full(self.anchors, _LAST)
        high = np.full(self.anchors, _LEAST)
        np.minimum.at(low, self.owner, self.floor)
        np.maximum.at(high, self.owner, self.high)
        return low, high

    def add(self, anchor: np.ndarray, score: np.ndarray, ident: np.ndarray) -> None:
        # Queries are sorted by anchor: each pair meets all queries of its anchor.
        first, last = np.searchsorted(self.owner, anchor), np.searchsorted(self.owner, anchor, "right")
        each = last - first
        pair = np.repeat(np.arange(len(anchor)), each)
        query = np.arange(len(pair)) - np.repeat(np.cumsum(each) - each, each) + first[pair]
        value = score[pair]
        good = (value >= self.floor[query]) & (value <= self.high[query])
        query, value, name = query[good], value[good], ident[pair[good]]
        query = np.concatenate([self.query, query])
        value = np.concatenate([self.score, value])
        name = np.concatenate([self.ident, name])
        keep = _best(query, value, name, self.most)
        self.query, self.score, self.ident = query[keep], value[keep], name[keep]
        full = np.bincount(self.query, minlength=len(self.owner)) >= self.most
        worst = np.full(len(self.owner), _LAST)
        np.minimum.at(worst, self.query, self.score)
        self.floor = np.where(full, np.maximum(worst, self.low), self.low)


def _vectors(column: pa.Array) -> np.ndarray:
    size = column.value_lengths()[0].as_py() if len(column) else 0
    return column.flatten().to_numpy().astype(np.float64).reshape(len(column), size)


def _searched(cells: DataFrame, config: MiningConfig, same_label: bool) -> DataFrame:
    """Best candidates of each query in each pair of a block and a cell.

    Rows of ``cells`` come sorted by (size, block, cell, candidate): the queries of the block first, then the rows.
    """
    most = config.positives if same_label else config.negatives

    def finished(head: pa.Table, search: _Search) -> pa.RecordBatch:
        rows = search.query
        names = [None if x == _LAST else x for x in search.ident.tolist()]
        arrays = [head.column(n).combine_chunks().take(pa.array(rows)) for n in ("id", "label", "key", "positive", "positive_score")]
        return pa.RecordBatch.from_arrays(
            [*arrays, pa.array(names, pa.int64()), pa.array(search.score, pa.int64())],
            names=["id", "label", "key", "positive", "positive_score", "found", "score"],
        )

    def begin(queries: list[pa.RecordBatch]) -> tuple[pa.Table, _Search, Summaries, dict[str, np.ndarray]]:
        head = pa.Table.from_batches(queries)
        # Queries of one anchor share its vector.
        key = head.column("key").to_numpy()
        order = np.argsort(key, kind="stable")
        head = head.take(pa.array(order))
        key = key[order]
        new = np.ones(len(key), bool)
        new[1:] = key[1:] != key[:-1]
        anchors = head.filter(pa.array(new))
        owner = np.cumsum(new) - 1
        if same_label:
            low, high = np.full(len(key), _LEAST), np.full(len(key), _LAST)
        else:
            score = head.column("positive_score").to_numpy()
            low, high = -percent(config.least_percent, -score), percent(config.most_percent, score)
        search = _Search(owner, low, high, most, len(anchors))
        facts = {"label": anchors.column("label").to_numpy(), "key": anchors.column("key").to_numpy()}
        return head, search, Summaries(_vectors(anchors.column("q").combine_chunks()), config), facts

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, queries, state = None, [], None
        for batch in batches:
            if not batch.num_rows:
                continue
            names = ("size", "block", "cell", "candidate")
            columns = [batch.column(n).to_numpy(zero_copy_only=False).astype(np.int64) for n in names]
            change = np.logical_or.reduce([np.diff(c) != 0 for c in columns])
            bounds = [0, *(np.flatnonzero(change) + 1).tolist(), batch.num_rows]
            for a, b in zip(bounds[:-1], bounds[1:], strict=True):
                now = tuple(int(c[a]) for c in columns[:3])
                if now != group:
                    if state:
                        yield finished(state[0], state[1])
                    group, queries, state = now, [], None
                part = batch.slice(a, b - a)
                if not columns[3][a]:
                    queries.append(part)
                    continue
                if not queries:
                    continue  # no anchor of this length in the block
                state = state or begin(queries)
                _, search, anchors, facts = state
                step = max(1, config.pairs_at_once // max(1, len(facts["key"])))
                for c in range(0, part.num_rows, step):
                    _take(part.slice(c, step), search, anchors, facts)
        if state:
            yield finished(state[0], state[1])

    def _take(part: pa.RecordBatch, search: _Search, anchors: Summaries, facts: dict[str, np.ndarray]) -> None:
        rows = Summaries(_vectors(part.column("q")), config)
        allowed = (part.column("label").to_numpy()[:, None] == facts["label"]) == same_label
        if same_label:  # the first copy of the anchor's row is the anchor itself
            own = np.where(part.column("copy").to_numpy() == 1, part.column("key").to_numpy(), -1)
            allowed &= own[:, None] != facts["key"]
        low, high = search.wanted()
        r, a, score, _ = open_scores(rows, anchors, low, high, allowed)
        ident = part.column("id").fill_null(_LAST).to_numpy()
        search.add(a, score, ident[r])

    ordered = cells.repartition("size", "block", "cell").sortWithinPartitions("size", "block", "cell", "candidate")
    return ordered.mapInArrow(
        run, "id long, label long, key long, positive long, positive_score long, found long, score long"
    )


def hard_negatives(
    df: DataFrame,
    anchors: Column | None = None,
    config: MiningConfig = MiningConfig(),
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    label_column: str = "label",
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    ``anchors`` is a condition on ``id`` and ``label``; all rows with an id by default.
    """
    chosen = df.select(
        F.col(id_column).cast("long").alias("id"),
        F.col(label_column).cast("long").alias("label"),
        F.col(vector_column).alias("v"),
    )
    chosen = chosen.where(F.col("label").isNotNull() & usable("v", config) & (F.size("v") > 0))
    distinct = (
        chosen.select("id", "label", scaled("v", config).alias("q"))
        .groupBy("id", "label", "q")
        .agg(F.count(F.lit(1)).alias("copies"))
    )
    workspace = Workspace(df.sparkSession, "hard-negatives")
    is_anchor = F.col("id").isNotNull() & F.coalesce(F.lit(True) if anchors is None else anchors, F.lit(False))
    # A number of its own for each distinct row, by which copies of an anchor are told from other rows.
    rows = workspace.save(
        distinct.select(
            "*", F.monotonically_increasing_id().alias("key"), is_anchor.alias("anchor"), F.size("q").alias("size")
        ),
        "rows",
    )
    # Blocks and cells are chosen by hash, as many as the counts of each length ask for.
    counts = rows.groupBy("size").agg(
        F.ceil(F.count_if("anchor") / config.block_anchors).alias("blocks"),
        F.ceil(F.count(F.lit(1)) / config.cell_rows).alias("cells"),
    )
    rows = rows.join(counts, "size")
    spread = F.xxhash64("key", F.lit(7))
    no_query = [F.lit(None).cast("long").alias(name) for name in ("positive", "positive_score")]
    wanted = max(config.positives, config.negatives) + 1
    candidates = rows.where("blocks > 0").select(
        "size",
        F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"),
        F.pmod(spread, "cells").alias("cell"),
        F.lit(True).alias("candidate"),
        "id", "label", "key", "q", "copies", *no_query,
    )
    # More copies of one row than a list is long are never looked at.
    copy = F.explode(F.sequence(F.lit(1).cast("long"), F.least("copies", F.lit(wanted).cast("long"))))
    candidates = candidates.withColumn("copy", copy)

    def queries(found: DataFrame) -> DataFrame:
        return found.select(
            "size",
            F.pmod(F.xxhash64("key", F.lit(8)), "blocks").alias("block"),
            F.explode(F.sequence(F.lit(0), F.col("cells") - 1)).alias("cell"),
            F.lit(False).alias("candidate"),
            "id", "label", "key", "q", "copies", "positive", "positive_score", F.lit(0).cast("long").alias("copy"),
        )

    def best(found: DataFrame, keys: list[str], most: int) -> DataFrame:
        order = Window.partitionBy(*keys).orderBy(F.desc("score"), F.asc_nulls_last("found"))
        return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= most)

    every = rows.where("anchor").select("*", *no_query)
    positives = best(
        _searched(queries(every).unionByName(candidates), config, True),
        ["key"],
        config.positives,
    )
    # Equal positives (copies) are one question, asked once.
    positives = workspace.save(
        positives.select("key", F.col("found").alias("positive"), F.col("score").alias("positive_score"), "rank"),
        "positives",
    )
    asked = rows.join(positives.select("key", "positive", "positive_score").distinct(), "key")
    found = best(
        _searched(queries(asked).unionByName(candidates), config, False),
        ["key", "positive", "positive_score"],
        config.negatives,
    )
    # Copies of anchors and of positives give their rows again.
    times = positives.groupBy("key", "positive", "positive_score").agg(F.count(F.lit(1)).alias("times"))
    again = rows.select(F.col("key").alias("k"), "copies")
    joined = found.join(
        times.toDF("tk", "tp", "ts", "times"),
        F.col("key").eqNullSafe(F.col("tk")) & F.col("positive").eqNullSafe(F.col("tp")) & (F.col("positive_score") == F.col("ts")),
    ).join(again, F.col("key") == F.col("k"))
    repeated = joined.withColumn("n", F.explode(F.sequence(F.lit(1), F.col("times") * F.col("copies"))))
    return repeated.select(
        F.col("id").alias("anchor_id"),
        F.col("positive").alias("positive_id"),
        F.col("rank").cast("int").alias("rank"),
        F.col("found").alias("negative_id"),
        "positive_score",
        F.col("score").alias("negative_score"),
    )
