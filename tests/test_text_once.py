"""Text parsers at size: every character stripped as by NFKD, texts normalized and cards walked once."""

import sys
import unicodedata

from pyspark.sql import functions as F

from listing_yield.functions import html as H
from listing_yield.functions import text as X
from listing_yield.plans.queries_more import card_rows


def test_every_character_is_nfkd(spark):
    points = [p for p in range(1, sys.maxunicode + 1) if not 0xD800 <= p <= 0xDFFF]
    texts = ["".join(map(chr, points[i:i + 4096])) for i in range(0, len(points), 4096)]
    texts += [" … ", "가각힣 ﷺ", "№Ñ²"]
    got = spark.createDataFrame(list(enumerate(texts)), "i int, t string").select("i", X.strip_accents("t").alias("r"))
    want = ["".join(c for c in unicodedata.normalize("NFKD", t) if not unicodedata.combining(c)) for t in texts]
    assert [r.r for r in got.orderBy("i").collect()] == want


def test_characters_that_expand_are_found_by_a_short_class(spark):
    """The class of all of them has hundreds of ranges, which each character of a text would meet."""
    assert X._MAY_EXPAND.count("-") < 20
    plan = spark.range(1).select(X.norm_key(F.col("id").cast("string")).alias("r"))
    assert len(plan._jdf.queryExecution().optimizedPlan().toString()) < 100_000


def test_numbers_are_read_once(spark):
    d = spark.createDataFrame([("3 amb 2 dorm 1 ban 2 cocheras 7 anos antiguedad 1990",)], "t string")
    for col in (X.parse_dormitorios("t", norm=F.col("t")), X.parse_cocheras("t", norm=F.col("t")),
                X.parse_antiguedad("t", 2026, norm=F.col("t"))):
        plan = d.select(col.alias("r"))._jdf.queryExecution().analyzed().toString()
        assert plan.count("try_cast") <= plan.count("regexp_extract")  # not the same texts for each bound
        assert plan.count("regexp_extract") <= 3


def test_cards_are_parsed_in_one_stage(spark):
    html = ('<article id="a"><h2>Calle Ñ 5</h2><b class="price">U$S 1.500</b><p class="expenses">+ $ 120 expensas</p>'
            '<ul class="features"><li>3 amb.</li><li>40 m²</li></ul></article><article id=b><h2>x</h2></article>')
    out = card_rows(spark.createDataFrame([(html,), (None,)], "html string"))
    assert sorted(map(tuple, out.collect()), key=str) == [
        ("a", 1500.0, "USD", 120.0, "Calle Ñ", "5", 3, 40.0), ("b", None, None, None, "x", "", None, None)]
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "card-fields" not in plan and plan.count("\nArrowEvalPython") + plan.count("- ArrowEvalPython") == 2
    assert plan.count("aggregate(") == 0


def test_end_of_an_element_by_its_tags():
    toks = H._TOKEN.findall("<div><DIV a='</div>'>x</div><br>y</div>z")
    assert ["".join(e) for e in H._elements(toks, H.Selector(tag="div"))] == ["<div><DIV a='</div>'>x</div><br>y</div>"]
