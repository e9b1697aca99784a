"""Hard negatives against all scores, and the trees' order, boxes and pruning."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from shopfloor.llm import rtree


def brute(rows, anchors, low=30, high=90, scale=256):
    rows = sorted({(i, label, tuple(math.floor(scale * x) for x in v)) for i, label, v in rows})
    out = []
    for anchor in rows:
        if not anchors(anchor[0]):
            continue
        scored = [(-sum(a * b for a, b in zip(anchor[2], r[2])), r) for r in rows if r != anchor and len(r[2]) == len(anchor[2])]
        alike = sorted((s, r[0]) for s, r in scored if r[1] == anchor[1])[:5]
        for s, positive in alike:
            window = sorted((t, r[0]) for t, r in scored if r[1] != anchor[1] and low * -s <= 100 * -t <= high * -s)[:10]
            out += [(anchor[0], positive, k + 1, n, -s, -t) for k, (t, n) in enumerate(window)]
    return sorted(out)


def table(spark, rows):
    kind = "vec_id bigint, label int, embedding array<float>, v int, tile string, rank int"
    return spark.createDataFrame([(*r, 1, "t", 2) for r in rows], kind)


def mined(spark, rows, anchors="vec_id % 10 = 0"):
    return sorted(tuple(r) for r in rtree.hard_negatives(table(spark, rows), F.expr(anchors)).collect())


def vectors(n, dims, seed, spread=0.3):
    rng = np.random.default_rng(seed)
    centres = rng.standard_normal((4, dims))
    v = centres[rng.integers(0, 4, n)] + spread * rng.standard_normal((n, dims))
    return (v / np.linalg.norm(v, axis=1, keepdims=True)).astype(np.float32).tolist()


@pytest.mark.parametrize(("n", "dims"), [(300, 3), (700, 16), (400, 1)])
def test_equals_all_scores(spark, n, dims):
    rows = [(i, i % 3, v) for i, v in enumerate(vectors(n, dims, n))]
    got = mined(spark, rows)
    assert got == brute(rows, lambda i: i % 10 == 0) and (got or dims == 1)


def test_many_pieces_groups_and_blocks(spark, monkeypatch):
    """Small pieces, in tasks that get several units."""
    rows = [(i, i % 4, v) for i, v in enumerate(vectors(900, 8, 5))]
    whole = brute(rows, lambda i: i % 10 == 0)
    frame = table(spark, rows)
    points = rtree._points(
        frame.select("vec_id", F.col("label").cast("bigint").alias("label"),
                     F.transform("embedding", lambda x: F.floor(x.cast("double") * 256.0)).alias("v")), 11)
    asked = points.select(F.explode("ids").alias("vec_id"), F.lit(0).cast("bigint").alias("place"), "label", "v").where("vec_id % 10 = 0")
    window = F.expr("array(struct(0 AS number, -36028797018963968L AS low, 36028797018963968L AS high))")
    asked = asked.withColumn("windows", window)
    firsts = sorted({(r[0], r[1], r[4]) for r in whole})
    for groups, blocks in ((1, 1), (7, 3), (3, 5)):
        found = rtree._first(rtree._searched(points, asked, 5, True, groups, blocks), 5).collect()
        assert set(firsts) <= {(r["vec_id"], r["found"], r["score"]) for r in found}
        assert len(found) == 5 * 90


def test_copies_ties_and_hot_vector(spark):
    rng = random.Random(2)
    grid = [[x / 4, y / 4, 0.5] for x in range(-2, 3) for y in range(-2, 3)]
    rows = [(i, rng.randint(0, 2), rng.choice(grid)) for i in range(400)] + [(1000 + i, 1, [0.5, 0.5, 0.5]) for i in range(300)]
    rows += rows[:50] + [(0, 1, [0.25, 0.25, 0.5]), (0, 2, [0.25, 0.25, 0.5])]
    got = mined(spark, rows, "vec_id % 50 = 0")
    assert got == brute(rows, lambda i: i % 50 == 0) and len(got) > 500


def test_defined_rows(spark):
    good = [(i, i % 2, v) for i, v in enumerate(vectors(60, 4, 9))] + [(100 + i, i % 2, v) for i, v in enumerate(vectors(30, 2, 9))]
    bad = [
        (200, None, good[0][2]), (210, 0, None), (220, 0, []), (230, 0, [None, 1.0, 1.0, 1.0]), (240, 1, [float("nan")] * 4),
        (250, 1, [float("inf")] * 4), (260, 1, [1e30] * 4), (None, 1, good[0][2]),
    ]
    got = mined(spark, bad + good)
    assert got == brute(good, lambda i: i % 10 == 0) and got
    assert mined(spark, []) == [] and mined(spark, bad) == [] and mined(spark, good, "vec_id < 0") == []
    alone = [(0, 0, [1.0, 0.0]), (1, 1, [0.5, 0.0])]
    assert mined(spark, alone) == []


def test_large_components_stay_exact(spark):
    rng = np.random.default_rng(4)
    rows = [(i, i % 2, (1e4 * rng.random(20) + 1e4).astype(np.float32).tolist()) for i in range(120)]
    wide = [(i, label, (np.array(v) * (0.6 if label else 1)).astype(np.float32).tolist()) for i, label, v in rows]
    got = mined(spark, wide)
    assert got == brute(wide, lambda i: i % 10 == 0) and len(got) > 300
    assert max(r[4] for r in got) > 2**45


def test_boxes_hold_all_scores_and_prune():
    rng = np.random.default_rng(1)
    centres = 100 * rng.standard_normal((16, 6))
    v = np.floor(centres[rng.integers(0, 16, 4000)] + rng.standard_normal((4000, 6)))
    tree = rtree.Tree(np.zeros(4000, np.int64), v, [np.array([i]) for i in range(4000)])
    assert sorted(i[0] for i in tree.ids) == list(range(4000))
    queries = np.floor(100 * rng.standard_normal((20, 6)))
    bounds = tree.bounds(queries)
    scores = queries @ tree.v.T
    for level, (least, most) in enumerate(bounds):
        width = rtree.LEAF * rtree.FANOUT**level
        for node in range(least.shape[1]):
            part = scores[:, node * width : (node + 1) * width]
            assert (part.min(axis=1) >= least[:, node]).all() and (part.max(axis=1) <= most[:, node]).all()
    looked = 0
    for row, query in enumerate(queries):
        for window in ((-(2**50), 2**50), (0, 5000)):
            finds = []

            def candidates(leaf, low, high):
                found = tree.scores(query, leaf)
                at = leaf * tree.leaf
                return [(int(found[i]), tree.ids[at + i].tolist()) for i in np.flatnonzero((found >= low) & (found <= high))]

            looked += rtree.best_first(tree, bounds, row, window, finds, 10, candidates)
            ids = np.array([i[0] for i in tree.ids])
            inside = (scores[row] >= window[0]) & (scores[row] <= window[1])
            wanted = sorted(zip(-scores[row][inside], ids[inside]))[:10]
            assert sorted((-s, -i) for s, i in finds) == [(int(a), int(b)) for a, b in wanted]
    assert looked < 0.5 * 40 * len(tree.levels[0][0])


def test_cuts_deal_evenly():
    rng = np.random.default_rng(7)
    v = rng.integers(-200, 200, (20000, 12))
    cuts = rtree.make_cuts(v[:4000], 64)
    tiles = cuts.tile(v)
    sizes = np.bincount(tiles)
    assert len(sizes) == rtree._count(cuts) == 64 and sizes.min() > 100 and sizes.max() < 700
    assert rtree.make_cuts(np.ones((100, 3), np.int64), 8).tile(np.ones((5, 3), np.int64)).max() < 8
    assert rtree.make_cuts(np.empty((0, 3), np.int64), 8) is None
