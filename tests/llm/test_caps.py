from __future__ import annotations

import numpy as np
import pytest

from shopfloor.llm import caps

KIND = "vec_id long, embedding array<float>, label int, node long, filter long"


def table(spark, rows):
    return spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], 0, 5, 6) for i, v in rows], KIND)


def brute(rows, threshold):
    fit = [(i, np.array(v, dtype=np.float32).astype(float)) for i, v in rows if v is not None and len(v) and None not in v]
    fit = [(i, v / np.linalg.norm(v)) for i, v in fit if i is not None and np.isfinite(v).all() and v.any()]
    near = [[a != b and len(u) == len(v) and u @ v >= threshold for b, (_, v) in enumerate(fit)] for a, (_, u) in enumerate(fit)]
    root = list(range(len(fit)))
    while True:
        fresh = [min([root[a], *(root[b] for b in range(len(fit)) if near[a][b])], key=lambda r: fit[r][0]) for a in range(len(fit))]
        if fresh == root:
            break
        root = fresh
    return sorted((i, sum(near[a]), fit[root[a]][0]) for a, (i, _) in enumerate(fit))


def clusters(rng, dims, sizes, spread):
    rows = []
    for size in sizes:
        centre = rng.standard_normal(dims)
        rows += [centre + spread * rng.standard_normal(dims) * (i > 0) for i in range(size)]
    return [(int(i), v.tolist()) for i, v in zip(rng.permutation(len(rows)), rows)]


@pytest.mark.parametrize(("small", "piece"), [(48, 1024), (1, 1024), (1, 16)])
def test_links_are_exact_and_nearly_all_found(spark, monkeypatch, small, piece):
    monkeypatch.setattr(caps, "PIECE", piece)
    rows = clusters(np.random.default_rng(3), 64, [1] * 150 + [2] * 30 + [60], 0.25)
    found = caps.near_duplicates(table(spark, rows)).collect()
    got, want = sorted((r["vec_id"], r["n_links"], r["component_id"]) for r in found), brute(rows, 0.9)
    assert [g[0] for g in got] == [w[0] for w in want]
    assert all(g[1] <= w[1] for g, w in zip(got, want))
    assert sum(g[1] for g in got) >= 0.97 * sum(w[1] for w in want)
    assert all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in found)


def test_filters_are_the_best_of_every_code():
    plan = caps.make_plan(300, 12)
    rng = np.random.default_rng(1)
    vectors = rng.standard_normal((20, 12))
    vectors /= np.linalg.norm(vectors, axis=1, keepdims=True)
    number, filter_ = caps.decode(vectors, plan)
    want = set()
    for code, (rotation, blocks) in enumerate(caps._codes(plan)):
        turned = vectors @ rotation
        parts = [turned[:, a:b] @ words.T for (a, b), words in zip(plan.cuts(), blocks)]
        for v in range(20):
            total = parts[0][v][:, None, None] + parts[1][v][None, :, None] + parts[2][v][None, None, :]
            level = np.sort(total.ravel())[-plan.kept]
            for x, y, z in np.argwhere(total >= level):
                want.add((v, ((code * plan.words + x) * plan.words + y) * plan.words + z))
    assert set(zip(number.tolist(), filter_.tolist())) == {(v, int(f)) for v, f in want}
    assert len(number) == len(want) == 20 * plan.codes * plan.kept


def test_more_vectors_get_narrower_filters():
    plans = [caps.make_plan(n, 64) for n in (10, 10_000, 1_000_000)]
    assert plans[0].words < plans[1].words < plans[2].words


@pytest.mark.parametrize(("n", "dims"), [(2000, 64), (20_000, 64), (5_000_000, 64), (1_000_000, 256), (10_000, 3)])
@pytest.mark.parametrize(("low", "high"), [(0.9, 0.91), (0.91, 0.93), (0.93, 0.95)])
def test_pairs_just_above_the_threshold_meet(n, dims, low, high):
    """2,000 pairs of each band, other ones than the plan is made from."""
    plan = caps.make_plan(n, dims)
    rng = np.random.default_rng(8)
    one, other = rng.standard_normal((2, 2000, dims))
    one /= np.linalg.norm(one, axis=1, keepdims=True)
    other -= (one * other).sum(axis=1, keepdims=True) * one
    cosine = rng.uniform(low, high, (2000, 1))
    other = cosine * one + np.sqrt(1 - cosine**2) * other / np.linalg.norm(other, axis=1, keepdims=True)
    filters = [caps.decode(v, plan)[1].reshape(2000, -1) for v in (one, other)]
    met = [len(np.intersect1d(a, b)) > 0 for a, b in zip(*filters)]
    assert np.mean(met) >= 0.99


def test_planted_links_near_the_threshold_are_found(spark):
    rng = np.random.default_rng(6)
    base = rng.standard_normal((6000, 64))
    base /= np.linalg.norm(base, axis=1, keepdims=True)
    twin = rng.standard_normal((2000, 64))
    twin -= (twin * base[:2000]).sum(axis=1, keepdims=True) * base[:2000]
    cosine = rng.uniform(0.895, 0.93, (2000, 1))
    twin = cosine * base[:2000] + np.sqrt(1 - cosine**2) * twin / np.linalg.norm(twin, axis=1, keepdims=True)
    rows = np.concatenate([base, twin]).astype(np.float32)
    unit = rows.astype(float) / np.linalg.norm(rows.astype(float), axis=1, keepdims=True)
    want = (unit @ unit.T >= 0.9).sum(axis=1) - 1
    got = {r["vec_id"]: r["n_links"] for r in caps.near_duplicates(table(spark, enumerate(rows.tolist()))).collect()}
    assert all(got[i] <= n for i, n in enumerate(want))
    assert sum(got.values()) >= 0.99 * want.sum() > 3000


def test_vectors_that_cannot_link_and_copies(spark):
    v = [1.0, 2.0, 3.0, 4.0]
    rows = [
        (9, v), (4, v), (4, v), (7, [2.0, 4.0, 6.0, 8.0]), (1, None), (2, []), (3, [0.0] * 4), (5, [1.0, None, 3.0, 4.0]),
        (6, [float("nan")] * 4), (8, [float("inf"), 1, 1, 1]), (None, v), (10, [1.0, 2.0]), (11, [4.0, -3.0, 2.0, -1.0]),
    ]
    got = sorted(((r["vec_id"] or 0, r["n_links"], r["component_id"], r["kept"]) for r in caps.near_duplicates(table(spark, rows)).collect()), key=str)
    want = [(9, 3, 4, False), (4, 3, 4, True), (4, 3, 4, True), (7, 3, 4, False), (0, 0, None, False)]
    want += [(i, 0, i, True) for i in (1, 2, 3, 5, 6, 8, 10, 11)]
    assert got == sorted(want, key=str)


def test_empty_table(spark):
    assert caps.near_duplicates(table(spark, [])).count() == 0
