"""Mixing: raking goes on until the margins are met, and says so where they can't be."""

import pytest

from listing_yield.llm import mixing as M


def tables(spark, targets):
    return {m: spark.createDataFrame(t, "category string, target double") for m, t in targets.items()}


def shares(rows, margin):
    total, out = sum(r.weight for r in rows), {}
    for r in rows:
        out[r[margin]] = out.get(r[margin], 0) + r.weight / total
    return out


def test_rakes_until_met(spark):
    cells = spark.createDataFrame(
        [("a", "x", "t", 100_000, 1), ("a", "y", "t", 1, 1), ("b", "x", "t", 1, 1), ("b", "y", "t", 100_000, 1),
         ("a", "x", "u", 10, 1)], "source string, lang string, topic string, tokens long, docs long")
    targets = {"source": [("a", 0.9), ("b", 0.1)], "lang": [("x", 0.2), ("y", 0.8)], "topic": [("t", 0.9), ("u", 0.1)]}
    rows = M.rake(cells, tables(spark, targets)).collect()
    assert rows[0].residual <= M.TOLERANCE
    for m, t in targets.items():
        assert shares(rows, m) == pytest.approx(dict(t), abs=2 * M.TOLERANCE)


def test_infeasible_targets_are_reported(spark):
    # two sources hold language x alone: the default margins contradict each other
    cells = spark.createDataFrame(
        [("a", "x", "t", 700, 1), ("b", "x", "t", 200, 1), ("c", "y", "t", 100, 1)],
        "source string, lang string, topic string, tokens long, docs long")
    with pytest.warns(UserWarning, match="targets not met"):
        rows = M.rake(cells, {m: M.tempered(cells, m, 0.5) for m in M.MARGINS}).collect()
    assert rows[0].residual > 0.01
    docs = spark.createDataFrame([(i, "ab"[i % 2], "x", "one two") for i in range(20)] + [(20, "c", "y", "one")],
                                 "doc_id long, source string, lang string, text string")
    with pytest.warns(UserWarning, match="targets not met"):
        mixed = M.mix(docs, alpha=0.5)
    assert mixed.agg({"residual": "min"}).first()[0] > 0.01 and mixed.count() == 21


def test_default_targets_change_the_shares(spark):
    cells = spark.createDataFrame([("a", 9900), ("b", 100)], "source string, tokens long")
    target = {r.category: r.target for r in M.tempered(cells, "source", M.ALPHA).collect()}
    assert target["b"] > 1.4 * 0.01 and abs(sum(target.values()) - 1) < 1e-12
