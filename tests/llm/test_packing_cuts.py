"""Packing: cuts at document and sentence ends only, the cheapest over all of them, whenever they are settled."""

import numpy as np
import pytest

from listing_yield.llm import encode, packing as P

SIZES = np.array([1, 2, 3, 4])


def cost(length, window):
    return 0 if length & (length - 1) == 0 else window - length


def cheapest(points, price, window):
    best = {0: 0.0}
    for j in points:
        best[j] = price[j] + min(best[i] + cost(j - i, window) for i in best if j - i <= window)
    return best


@pytest.mark.parametrize("window", [12, 64])
def test_cuts_are_the_cheapest(window):
    rng = np.random.default_rng(1)
    for _ in range(150):
        points = np.cumsum(rng.integers(1, window // 2 + 3, rng.integers(1, 40))).tolist()
        price = dict(zip(points, rng.integers(0, 5, len(points)).astype(float), strict=True))
        whole = P.Cutter(window)
        whole.feed(points, [price[p] for p in points])
        cuts = whole.finish()
        in_parts, parts = P.Cutter(window), []
        at = 0
        while at < len(points):  # fed in any portions, with settled cuts taken on the way
            n = int(rng.integers(1, 9))
            in_parts.feed(points[at: at + n], [price[p] for p in points[at: at + n]])
            parts += in_parts.settled()
            at += n
        parts += in_parts.finish()
        best = cheapest(points, price, window)
        for way in (cuts, parts):
            assert way[-1] == points[-1] and all(b - a <= window for a, b in zip([0, *way], way))
            assert sum(cost(b - a, window) + price[b] for a, b in zip([0, *way], way)) == best[points[-1]]
        assert len(in_parts.came) == 0


def test_cuts_are_settled_as_the_stream_goes_on():
    rng = np.random.default_rng(4)
    cutter, at, held = P.Cutter(1024), 0, []
    for _ in range(60):
        points = (at + np.cumsum(rng.integers(1, 40, 500))).tolist()
        cutter.feed(points, rng.choice([0.0, 2.0], 500).tolist())
        at = points[-1]
        cutter.settled()
        held.append(at - cutter.done)
    assert max(held) < 100_000 and len(cutter.came) < 20_000  # what is kept doesn't grow with the stream


def test_grid_only_beyond_the_window():
    at, kind = P.with_grid(np.array([0, 900, 1924, 2949, 3000]), np.array([0, 1, 0, 1, 0]))
    inside = at[kind == 2]
    assert len(inside) and inside.min() > 1924 and inside.max() < 2949
    assert set(at[kind < 2].tolist()) == {0, 900, 1924, 2949, 3000}


@pytest.mark.parametrize("text,want", [
    ("One. Two! Three? Four", ["One.", " Two!", " Three?", " Four"]),
    ("Pi is 3.14 here. See e.g. this", ["Pi is 3.14 here.", " See e.g. this"]),
    ('He said "Stop." Then went.', ['He said "Stop."', " Then went."]),
    ("\u4f60\u597d\u3002\u518d\u89c1\uff01\u597d", ["\u4f60\u597d\u3002", "\u518d\u89c1\uff01", "\u597d"]),
    ("line one\nline two", ["line one\n", "line two"]), ("www.example.com is", ["www.example.com is"]), ("", [])])
def test_sentence_ends(text, want):
    enc = encode.Encoder()
    sizes = P.token_sizes(enc)
    ids = np.frombuffer(enc.ids(text), "<u4")
    assert sizes[ids].sum() == len(text.encode())
    ends = P.sentence_ends(text.encode(), ids, sizes)
    edges = [0, *[e for e in ends.tolist() if e < len(ids)], len(ids)]
    upto = np.r_[0, np.cumsum(sizes[ids])]
    got = [text.encode()[upto[a]: upto[b]].decode() for a, b in zip(edges, edges[1:])]
    assert [x for x in got if x] == want
