"""Ranks of large tables, pages parsed once, elements of nested HTML, counts observed by the job that writes."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from listing_yield import constants as K
from listing_yield.functions import html as H
from listing_yield.operators import stats
from listing_yield.sources import files, payloads


@pytest.mark.parametrize("most", [10_000, 5])
def test_average_ranks(spark, monkeypatch, most):
    monkeypatch.setattr(stats, "SMALL_TABLE", most)
    rng = np.random.default_rng(1)
    x = np.where(rng.random(3000) < 0.35, 4.0, np.round(rng.normal(size=3000), 2))
    y = rng.permutation(3000).astype(float)
    rows = [(i, float(a), float(b)) for i, (a, b) in enumerate(zip(x, y))] + [(9000, None, 1.5), (9001, 2.0, None)]
    df = spark.createDataFrame(rows, "id int, x double, y double").repartition(6)
    got = stats.with_average_ranks(df, {"x": "rx", "y": "ry"}).toPandas().sort_values("id")
    pdf = pd.DataFrame(rows, columns=["id", "x", "y"])
    for c in "xy":
        want = pdf[c].rank(method="average")
        assert np.allclose(got["r" + c].to_numpy(float), want.to_numpy(float), equal_nan=True)
    rho = stats.spearman(df, "x", "y").first()
    both = pdf.dropna()
    assert rho.n_grupos == len(both) and abs(rho.spearman - both.x.rank().corr(both.y.rank())) < 1e-6
    assert stats.spearman(df.limit(0), "x", "y").first().n_grupos == 0


def test_ranks_have_no_task_for_all(spark, monkeypatch):
    monkeypatch.setattr(stats, "SMALL_TABLE", 0)
    df = spark.range(100).selectExpr("double(id % 30) as x")
    plan = stats.value_ranks(df, "x", "r")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("SinglePartition") <= 1  # the ranges' totals only


def test_pages_are_parsed_once(spark):
    pages = ['{"data":[{"id":7,"price":1.5,"operation":"odd","title":"t"}]}', '{"data":{"data":[{"id":"a"},3,null,[1]]}}',
             '{"data":{"data":5},"content":[{"slug":"s","operation":{"value":"Sale"}}]}', "nope", "null", '{"data":{}}', ""]
    df = spark.createDataFrame([(p,) for p in pages], "value string")
    items = payloads.items_from_pages(df)
    got = {(r.it.id, r.it.price, r.it.operation.value, r.it.title, r.it.slug) for r in items.collect()}
    assert got == {("7", "1.5", None, "t", None), ("a", None, None, None, None), (None, None, "Sale", None, "s")}
    rejects = payloads.rejects_from_pages(df)
    assert sorted((r.motivo, r.contenido) for r in rejects.collect()) == sorted([
        ("item_invalido", "3"), ("item_invalido", "null"), ("item_invalido", "[1]"), ("json_invalido", "nope"),
        ("json_invalido", ""), ("sin_lista", "null"), ("sin_lista", '{"data":{}}')])
    for d in (items, rejects):
        assert d._jdf.queryExecution().optimizedPlan().toString().count("parseJson") <= 1
        assert d._jdf.queryExecution().executedPlan().toString().count("VariantExpressionEvalUtils") == 1


HTML = """<div><!-- <article>no</article> --><article id='a' class="c"><div title="a > b" class="x price big"><div>1<br></div>
 2&#8364;&#x41;&amp;</div><p data-price="7 &lt; 8">z</p><article id=in>in<h2>never</h2></article><h2>deep <b>er</b></h2></article></div>
<ARTICLE id = b><H2>q<br/>r</h2><p class=''>unclosed"""


def test_elements(spark):
    d = spark.createDataFrame([(1, HTML), (2, ""), (3, None), (4, "plain < text"), (5, "<article>")], "i int, html string")
    one = d.select("i", F.posexplode(H.cards("html")).alias("n", "card"))
    rows = one.select("i", "n", H.attribute(F.col("card")[0], "id").alias("id"),
                      H.select_text("card", [H.Selector(cls="price")]).alias("price"),
                      H.select_text("card", [H.Selector(attr="data-price", value="data-price")]).alias("attr"),
                      H.select_text("card", [H.Selector(cls="none"), H.Selector(tag="h2")]).alias("h2"),
                      H.select_text("card", [H.Selector(tag="p", cls="")]).alias("p"),
                      F.size("card").alias("size")).orderBy("i", "n").collect()
    assert [(r.i, r.id) for r in rows] == [(1, "a"), (1, "b"), (5, None)]
    a, b, c = rows
    assert (a.price, a.attr) == ("1 2€A&", "7 < 8")
    assert a.h2 == "never" and b.h2 == "q r" and b.p == "unclosed" and c.h2 == ""
    assert c.size == 1


def test_entities(ev):
    texts = ["&#65;&#x1F600;&#X41;", "&#0;&#xD800;&#99999999;", "&amp;#65; &lt;b&gt;", "&nbsp;x", "no", ""]
    assert ev(lambda c: H.decode_entities(F.col(c)), texts) == ["A\U0001F600A", "��&#99999999;", "&#65; <b>",
                                                                " x", "no", ""]


def test_counts_come_from_the_write(spark, tmp_path):
    rows = [(i, r) for i, r in enumerate([None, None, K.REASONS[0], K.REASONS[2], K.REASONS[2], "own reason"])]
    tagged = spark.createDataFrame(rows, "row_id int, motivo_exclusion string").repartition(3)
    got = files.write_excluded_counted(tagged, str(tmp_path / "x"))
    assert {tuple(r) for r in got.collect()} == {(0, "entrada", 6), (100, "conservadas", 2), (1, K.REASONS[0], 1),
                                                 (3, K.REASONS[2], 2), (99, "otras", 1)}
    assert spark.read.parquet(str(tmp_path / "x")).count() == 4
    empty = files.write_excluded_counted(tagged.limit(0), str(tmp_path / "y"))
    assert {tuple(r) for r in empty.collect()} == {(0, "entrada", 0), (100, "conservadas", 0)}
