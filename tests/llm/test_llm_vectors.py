"""The metric range join and whitening against brute force."""

import math

import numpy as np
import pytest

from barograph.llm import rangejoin
from barograph.llm.rangejoin import Range, near_vectors
from barograph.llm.whitening import Whitening, whiten

SCHEMA = "vec_id long, embedding array<float>, label int"


def clustered(n=400, width=12, seed=2):
    rng = np.random.default_rng(seed)
    base = rng.normal(size=(25, width))
    rows = base[rng.integers(0, 25, n)] + rng.normal(size=(n, width)) * rng.choice([0.02, 0.15, 0.6], n)[:, None]
    rows[:40] = base[0] + rng.normal(size=(40, width)) * 0.01
    rows[40:60] = rows[40]
    rows[60:70] = rows[41] * 3
    return rows.astype(np.float32)


def frame(spark, rows, ids=None):
    ids = list(range(7, 7 + len(rows))) if ids is None else ids
    return spark.createDataFrame([(i, [float(x) for x in r] if r is not None else None, 1) for i, r in zip(ids, rows)], SCHEMA)


def plain_links(rows, ids, least):
    """(id, links, component) of each row, by all pairs."""
    x = rows.astype(np.float64)
    x /= np.linalg.norm(x, axis=1)[:, None]
    near = x @ x.T >= least
    np.fill_diagonal(near, False)
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, j in zip(*np.nonzero(near)):
        a, b = find(i), find(j)
        root[max(a, b)] = min(a, b)
    least_id = {}
    for i in range(len(rows)):
        least_id[find(i)] = min(least_id.get(find(i), 1 << 60), ids[i])
    return sorted((ids[i], int(near[i].sum()), least_id[find(i)]) for i in range(len(rows)))


@pytest.mark.parametrize("limits", [Range(), Range(sample=200, cell=20, rows=16), Range(least=0.8, cell=8, rows=8), Range(pivots=1, rows=50)])
def test_range_join_equals_all_pairs(spark, limits):
    rows = clustered()
    ids = list(np.random.default_rng(1).permutation(len(rows)).tolist())
    got = near_vectors(frame(spark, rows, ids), limits).collect()
    assert sorted((r.vec_id, r.n_links, r.component_id) for r in got) == plain_links(rows, ids, limits.least)
    assert all(r.kept == (r.vec_id == r.component_id) for r in got)


def test_range_join_odd_rows(spark):
    nan, inf = math.nan, math.inf
    rows = [None, [], [0.0, 0.0], [nan, 1.0], [inf, 1.0], [1.0, 0.0], [2.0, 0.0], [1.0, 0.0, 0.0], [3.0, 0.0], [1e-42, 0.0], [3e38, 1e30], [0.0, 5.0]]
    ids = [1, 2, 3, 4, 5, 9, 6, 8, None, 12, 13, 12]
    df = frame(spark, rows, ids).selectExpr("*", "1 as gid", "2 as copies", "'x' as vector")
    got = {(r.vec_id, r.n_links, r.component_id, r.kept) for r in near_vectors(df).collect()}
    alone = {(i, 0, i, True) for i in (1, 2, 3, 4, 5, 8, 12)}
    assert got == alone | {(6, 4, 6, True), (9, 4, 6, False), (None, 4, 6, False), (12, 4, 6, False), (13, 4, 6, False)}
    assert near_vectors(df.limit(0)).count() == 0
    assert near_vectors(df.where("vec_id < 4")).count() == 3


def test_tiles_hold_bounded_blocks_and_near_copies_cost_no_pairs(spark):
    """Thousands of near copies of one vector are counted, not compared."""
    rng = np.random.default_rng(4)
    rows = np.concatenate((rng.normal(size=(100, 8)), rng.normal(size=8) + rng.normal(size=(1500, 8)) * 1e-3))
    df = frame(spark, rows.astype(np.float32))
    sizes, tile = spark.sparkContext.accumulator(0), rangejoin._tile

    def counted(least):
        run = tile(least)

        def count(table):
            side = table.column("side").to_numpy()
            left, right = int((side == 0).sum()), int((side == 1).sum())
            sizes.add(left * (right or left))
            return run(table)

        return count

    rangejoin._tile = counted
    try:
        got = near_vectors(df, Range(cell=100, rows=64)).collect()
    finally:
        rangejoin._tile = tile
    assert sum(r.n_links for r in got) >= 1500 * 1499
    assert sizes.value < 1600 * 1600 / 8


def plain_white(rows, counts=False):
    x = np.floor(64 * rows.astype(np.float64)).astype(np.int64) + 1_000_000
    distinct, times = np.unique(x, axis=0, return_counts=True)
    w = times if counts else np.ones(len(distinct), np.int64)
    n, s = int(w.sum()), w @ distinct
    c = distinct - s / n
    values, vectors = np.linalg.eigh(c.T @ (w[:, None] * c) / n)
    values, vectors = values[::-1], vectors[:, ::-1]
    return n, ((n * x - s) ** 2).sum(axis=1), (x - s / n) @ vectors / np.sqrt(values), values / values.sum()


@pytest.mark.parametrize("weights", ["one", "counts"])
def test_whitening_equals_numpy(spark, weights):
    rows = clustered(width=20) * 3
    got = sorted(whiten(frame(spark, rows), Whitening(weights=weights)).collect())
    n, deviation, white, share = plain_white(rows, weights == "counts")
    table = np.array([r.whitened for r in got]).reshape(len(rows), 16)
    sign = np.sign((table * white[:, :16]).sum(axis=0))
    np.testing.assert_allclose(table * sign, white[:, :16], rtol=1e-7, atol=1e-7)
    assert {r.n for r in got} == {n} and [r.component for r in got[:16]] == list(range(1, 17))
    assert [r.deviation for r in got[::16]] == deviation.tolist()
    np.testing.assert_allclose([r.explained for r in got[:16]], share[:16], rtol=1e-9)
    assert {r.identity_error < 1e-9 for r in got} == {True}


def test_whitening_odd_rows(spark):
    nan = math.nan
    rows = [None, [], [nan, 1.0], [1.0, None], [1.0, 2.0], [1.0, 2.0], [3.0, 1.0], [0.0, 0.0], [5.0], [1e30, 0.0]]
    ids = [1, 2, 3, 4, 5, 5, None, 7, 8, 9]
    df = spark.createDataFrame([(i, r, 0) for i, r in zip(ids, rows)], "vec_id long, embedding array<double>, x int")
    got = whiten(df).collect()
    assert sorted((str(r.vec_id), r.component) for r in got) == [
        ("5", 1), ("5", 1), ("5", 2), ("5", 2), ("7", 1), ("7", 2), ("None", 1), ("None", 2)
    ]
    assert {r.n for r in got} == {3}
    assert whiten(df.limit(0)).count() == 0


def test_whitening_of_huge_entries_is_exact_or_null(spark):
    big = float(1 << 40)
    got = whiten(frame(spark, np.array([[big, 0], [0, big], [0, 0], [1, 1]]))).collect()
    assert {r.deviation for r in got} == {None}
    rows = np.array([[1e6, 0], [1e6 + 1, 0], [1e6, 2]])
    got = sorted(whiten(frame(spark, rows)).collect())
    assert [r.deviation for r in got[::2]] == plain_white(rows.astype(np.float32))[1].tolist()
