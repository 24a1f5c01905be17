"""Whitening and hard negatives against brute force in NumPy; the eigen-solver by itself."""

import math

import numpy as np
import pytest

from listing_yield.llm import hard_negatives, whitening
from listing_yield.session import materialize

RNG = np.random.default_rng(3)


def frame(spark, rows):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").repartition(3)
    for name in ("n", "x", "rank", "component", "anchor_id"):  # clashing names
        df = df.selectExpr("*", f"7 as {name}")
    return df


def odd_rows(count, size=12, labels=3):
    """Vectors of two scales with copies, plus rows that take no part."""
    v = np.float32(RNG.normal(0, 0.3, (count, size)) * np.linspace(1, 2, size) + 0.1)
    v[5], v[6], v[7] = v[4], v[4], v[4]
    rows = [(i, v[i].tolist(), int(i % labels)) for i in range(count)]
    bad = [(900, None, 1), (901, [1.0, None] + [0.0] * (size - 2), 1), (902, [math.nan] * size, 1),
           (903, [math.inf] + [0.0] * (size - 1), 1)]
    return rows, bad


@pytest.mark.parametrize("size,rank,wanted", [(1, 1, 32), (12, 12, 5), (60, 60, 32), (150, 150, 10), (40, 20, 32)])
def test_leading_pairs(size, rank, wanted):
    x = RNG.normal(size=(400, size)) * np.linspace(1, 3, size)
    x[:, rank:] = 0
    x -= x.mean(axis=0)
    a = x.T @ x / len(x)
    values, axes = whitening.leading_pairs(lambda w: x.T @ (x @ w) / len(x), size, wanted)
    k = min(size, wanted)
    assert np.abs(values - np.linalg.eigvalsh(a)[::-1][:k]).max() < 1e-13 * values[0]
    assert np.linalg.norm(a @ axes - axes * values, axis=0).max() < 1e-12 * values[0]
    assert np.abs(axes.T @ axes - np.eye(k)).max() < 1e-13


def test_equal_eigenvalues_are_all_found():
    q = np.linalg.qr(RNG.normal(size=(80, 80)))[0]
    e = np.concatenate([np.full(3, 9.0), np.full(40, 2.0), np.linspace(1, 0.1, 37)])
    values, axes = whitening.leading_pairs(lambda w: q @ (e[:, None] * (q.T @ w)), 80, 10)
    assert np.abs(values - e[:10]).max() < 1e-12
    assert np.abs(axes.T @ axes - np.eye(10)).max() < 1e-13


def test_whitening(spark):
    rows, bad = odd_rows(200)
    rows += [rows[0], (None, rows[1][1], None), (77777, rows[2][1][:9], 0)]  # repeated, no id, short
    out = whitening.whiten(whitening.shifted_vectors(frame(spark, rows + bad)), 8).collect()
    full = np.zeros((len(rows), 12))
    for i, r in enumerate(rows):
        full[i, : len(r[1])] = np.float64(np.float32(r[1]))
    x = [[math.floor(64 * c) + 1000000 for c in r] for r in full]
    n, sums = len(x), [sum(c) for c in zip(*x)]
    deviation = [sum((n * c - s) ** 2 for c, s in zip(r, sums)) for r in x]
    d = np.array([[n * c - s for c, s in zip(r, sums)] for r in x]) / n
    v = d.T @ d / n
    e, u = np.linalg.eigh(v)
    e, u = e[::-1], u[:, ::-1]
    white = d @ u / np.sqrt(e)
    assert len(out) == 8 * n and {r.n for r in out} == {n}
    want = {r[0]: (deviation[i], white[i]) for i, r in enumerate(rows)}
    sign = {r.component: np.sign(r.whitened * white[3][r.component - 1]) for r in out if r.vec_id == 3}
    for r in out:
        dev, w = want[r.vec_id]
        assert r.deviation == dev
        assert abs(r.whitened * sign[r.component] - w[r.component - 1]) < 1e-10
        assert abs(r.explained - e[r.component - 1] / np.trace(v)) < 1e-12
        assert r.identity_error < 1e-10
    counts = {}
    for r in out:
        counts[r.vec_id] = counts.get(r.vec_id, 0) + 1
    assert counts[0] == 16 and counts[None] == 8


def test_whitening_without_variance(spark):
    same = [(i, [0.5, 0.25], 0) for i in range(4)]
    flat = [(i, [0.5, float(i)], 0) for i in range(4)]
    for rows, components in [([], set()), (same, set()), (flat, {1}), ([(1, [], 0)], set()), ([(1, None, 0)], set())]:
        out = whitening.whiten(whitening.shifted_vectors(frame(spark, rows)), 32).collect()
        assert {r.component for r in out} == components


def test_deviations_stay_exact():
    c = whitening.Centre(3, np.array([0, 0]))
    x = np.array([[2**29, 1], [5, -7]])
    assert c.deviations(x).tolist() == [9 * (2**58 + 1), 9 * 74]
    with pytest.raises(OverflowError):
        c.deviations(np.array([[2**31, 2**31]]))


def test_tree_sum_in_levels(spark, monkeypatch):
    monkeypatch.setattr(whitening, "FAN", 2)
    table = spark.range(1000).selectExpr("array(id, 2 * id) as x").repartition(7)
    got = whitening.tree_sum(table, 7, (2,), "int64", lambda x: x.sum(axis=0))
    assert got.tolist() == [499500, 999000]


def brute_negatives(rows, positives, negatives, low, asked):
    rows = sorted({(i, tuple(math.floor(256 * np.float64(np.float32(c))) for c in e), y) for i, e, y in rows})
    dot = lambda a, b: sum(x * y for x, y in zip(a, b))
    out = []
    for i, e, y in rows:
        if not asked(i):
            continue
        scored = sorted((-dot(e, f), j, z) for j, f, z in rows if j != i)
        for s, j, z in [x for x in scored if x[2] == y][:positives]:
            hard = [x for x in scored if x[2] != y and low * -s <= 100 * -x[0] <= 100 * -s][:negatives]
            out += [(i, j, r + 1, x[1], -s, -x[0]) for r, x in enumerate(hard)]
    return sorted(out)


@pytest.mark.parametrize("size,count", [(12, 300), (1, 60), (33, 150)])
def test_hard_negatives(spark, monkeypatch, size, count):
    monkeypatch.setattr(hard_negatives, "BLOCK_VALUES", 40 * size)
    monkeypatch.setattr(hard_negatives, "ANCHOR_VALUES", 7 * size)
    monkeypatch.setattr(hard_negatives, "SHARE", 2)
    monkeypatch.setattr(hard_negatives, "CHUNK", 16)
    rows, bad = odd_rows(count, size)
    copies = [(1000 + i, rows[4][1], i % 3) for i in range(50)]  # equal vectors: ties by vec_id
    rows += copies + [rows[0], (8, rows[3][1], 2), (5000, [0.0] * size, 0)]  # repeated row, one id with two vectors
    nulls = [(None, rows[0][1], 0), (905, rows[0][1], None)] + (bad if size > 1 else bad[:1])
    table = materialize(hard_negatives.labelled_vectors(frame(spark, rows + nulls)), "test-vectors")
    got = hard_negatives.mine(table, table.where("vec_id % 5 = 0"), 3, 4, 70)
    assert sorted(map(tuple, got.collect())) == brute_negatives(rows, 3, 4, 70, lambda i: i % 5 == 0)


def test_hard_negatives_without_rows(spark):
    for rows in ([], [(0, [1.0], 1)], [(0, [], 1), (1, [], 1), (2, [], 0)]):
        table = materialize(hard_negatives.labelled_vectors(frame(spark, rows)), "test-vectors")
        got = hard_negatives.mine(table, table.where("vec_id = 0")).collect()
        assert [tuple(r) for r in got] == ([(0, 1, 1, 2, 0, 0)] if len(rows) == 3 else [])


def test_summaries_bound_scores():
    a, b = RNG.normal(size=(50, 24)), RNG.normal(size=(60, 24))
    exact, last = a @ b.T, None
    for n in hard_negatives.levels(24):
        (ma, sa), (mb, sb) = hard_negatives.summary(a, n), hard_negatives.summary(b, n)
        middle, reach = ma @ mb.T, sa @ sb.T
        assert (middle + reach >= exact - 1e-9).all() and (middle - reach <= exact + 1e-9).all()
        assert last is None or reach.mean() < last  # finer segments bound better
        last = reach.mean()
