"""Hard negatives by segment summaries, against brute force."""

import math
from collections import Counter

import numpy as np
import pytest

from convroute.llm import hard_negatives
from convroute.llm.hard_negatives import MiningConfig, Summaries


def brute(rows, is_anchor, positives=5, negatives=3, least=50, most=95):
    """Rows of (id, label, vector)."""
    def whole(v):
        good = v is not None and len(v) and all(x is not None and math.isfinite(x) and abs(x) < 2**26 / 256 for x in v)
        return [math.floor(256 * x) for x in v] if good else None

    known = [(i, y, whole(v)) for i, y, v in rows]
    known = [r for r in known if r[1] is not None and r[2] is not None]
    out = []
    for place, (i, y, q) in enumerate(known):
        if i is None or not is_anchor(i):
            continue
        others = [
            (-sum(a * b for a, b in zip(q, r[2])), r[0] if r[0] is not None else math.inf, r[1] == y)
            for other, r in enumerate(known) if other != place and len(r[2]) == len(q)
        ]
        others.sort()
        for score, name, _ in [o for o in others if o[2]][:positives]:
            band = [o for o in others if not o[2] and least * -score <= 100 * -o[0] <= most * -score][:negatives]
            out += [(i, name, rank + 1, o[1], -score, -o[0]) for rank, o in enumerate(band)]
    return Counter(tuple(None if x == math.inf else x for x in row) for row in out)


def mined(df, **more):
    got = hard_negatives.hard_negatives(df, anchors=hard_negatives.F.col("id") % 3 == 0, **more)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return Counter(tuple(r) for r in got.collect())


SCHEMA = "vec_id long, label int, embedding array<double>, id string, key int, q int, size int"
SMALL = MiningConfig(block_anchors=7, cell_rows=20, pairs_at_once=50, segments=(5, 3, 2, 1))


def table(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, 1, 1) for r in rows], SCHEMA).repartition(3)


@pytest.mark.parametrize("config", [MiningConfig(), SMALL])
def test_odd_rows(spark, config):
    rng = np.random.default_rng(3)
    rows = [(i, int(rng.integers(4)), rng.normal(size=6).round(2).tolist()) for i in range(60)]
    rows += [(i, 1, [1.0, 0.5, 0.0, 0.0, 0.0, 0.0]) for i in range(60, 75)]  # ties
    rows += [(i, 2, [1.0, 0.4, 0.0, 0.0, 0.0, 0.0]) for i in range(75, 90)]
    rows += [(90, None, rows[0][2]), (93, 1, None), (96, 1, [None] * 6), (99, 1, [math.nan] + [1.0] * 5), (102, 1, [])]
    rows += [(105, 1, [math.inf] * 6), (108, 1, [1e9] * 6), (111, 3, [0.0] * 6), (114, 1, [1.0, 2.0]), (117, 2, [1.0, 1.2])]
    rows += [(118, 1, [1.0, 1.0]), (None, 1, rows[61][2]), (None, 2, rows[3][2]), (60, 1, rows[60][2]), (60, 1, rows[60][2])]
    rows += [(63, 2, rows[63][2]), rows[76], rows[76], (66, 1, rows[0][2])]
    want = brute(rows, lambda i: i % 3 == 0)
    assert sum(want.values()) > 200
    assert mined(table(spark, rows), config=config) == want


def test_large_components_are_exact(spark):
    rng = np.random.default_rng(4)
    rows = [(i, i % 2, (rng.integers(-(2**24), 2**24, size=8) / 256 + 100_000).tolist()) for i in range(40)]
    assert mined(table(spark, rows), config=SMALL) == brute(rows, lambda i: i % 3 == 0)


def test_one_label_holds_most_rows(spark):
    rng = np.random.default_rng(5)
    rows = [(i, 0 if i % 9 else 1 + i % 2, (rng.normal(size=16) + 0.4).tolist()) for i in range(400)]
    config = MiningConfig(block_anchors=30, cell_rows=50)
    assert mined(table(spark, rows), config=config) == brute(rows, lambda i: i % 3 == 0)


def test_empty_table_and_no_anchor(spark):
    assert not mined(table(spark, []))
    assert not mined(table(spark, [(1, 1, [1.0]), (2, 2, [1.0])]))


def test_bounds_hold_and_prune():
    """Bounds of every level enclose the score; segments of even vectors leave few pairs to score."""
    rng = np.random.default_rng(6)
    config = MiningConfig()
    smooth = np.repeat(rng.normal(size=(300, 8)), 8, axis=1) * 100
    vectors = np.floor(smooth + rng.normal(size=smooth.shape))
    rows, anchors = Summaries(vectors, config), Summaries(vectors[:20], config)
    scores = vectors @ vectors[:20].T
    for (means, devs), (more, reach) in zip(rows.levels, anchors.levels):
        assert (np.abs(scores - means @ more.T) <= devs @ reach.T + 1e-6).all()
    low = np.sort(scores, axis=0)[-5]
    high = np.full(20, np.inf)
    r, a, s, scored = hard_negatives.open_scores(rows, anchors, low, high, np.ones(scores.shape, bool))
    assert sorted(zip(r, a, s)) == sorted((i, j, scores[i, j]) for i, j in zip(*np.nonzero(scores >= low)))
    assert scored < 0.1 * scores.size
