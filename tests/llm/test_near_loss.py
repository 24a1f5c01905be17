"""Near-dedup: pairs at the threshold are lost no more often in crowded regions, nor by the signature test."""

from math import comb

import numpy as np

from listing_yield.llm import near_dedup as N


def test_signature_test_keeps_its_exact_bound():
    for percent in (80, 85):
        p = percent / 100
        tail = lambda k: sum(comb(N.MINIMA, i) * p**i * (1 - p) ** (N.MINIMA - i) for i in range(k))
        n = np.array([100, 100])
        kept = []
        for equal in range(N.MINIMA + 1):
            sig = np.zeros((2, N.MINIMA), np.uint8)
            sig[1, equal:] = 1
            if N.likely(sig, n, np.array([[0, 1]]), percent)[0]:
                kept.append(equal)
        assert tail(kept[0]) <= 3e-6 < tail(kept[0] + 1)


def test_crowded_pairs_share_a_region(spark, monkeypatch):
    rng = np.random.default_rng(3)
    monkeypatch.setattr(N, "CROWDED", (1, 1))  # all regions go to depth 5
    left, right = [], []
    for _ in range(5):
        first = rng.integers(0, 1 << 32, (60_000, N.MINIMA), dtype=np.uint32)
        second = np.where(rng.random(first.shape) < 0.8, first, first + 1)
        same = (first == second).reshape(-1, N.TREES, N.BLOCK)
        lost = ~same[:, :, :5].all(2).any(1) & same[:, :, :3].all(2).any(1)  # together at depth 3, nowhere at depth 5
        left.append(first[lost])
        right.append(second[lost])
    m = sum(map(len, left))
    assert m > 300
    rows = list(enumerate(N.prefixes(np.concatenate(left + right)).tolist()))
    spots = N.regions(spark.createDataFrame(rows, "cls long, keys array<long>")).collect()
    members = {}
    for r in spots:
        members.setdefault(r.key, set()).add(r.cls)
    found = {i for s in members.values() for i in s if i < m and i + m in s}
    assert m - len(found) <= 10  # of 300,000 pairs; 1.2e-5 are to be expected, 3.6
