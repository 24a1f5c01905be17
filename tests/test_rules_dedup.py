"""Hand-built frames for the cleaning rules, dedup and trims (the reference has no tests for these)."""

import datetime as dt

from pyspark.sql import functions as F

from listing_yield import constants as K
from listing_yield.functions import measures as M
from listing_yield.operators import dedup, quantiles, rules
from listing_yield.plans import cleaning

COLS = ("row_id string, id_aviso string, url string, fecha_scraping timestamp, operacion string, "
        "tipo_propiedad string, precio_valor double, precio_moneda string, expensas_valor double, "
        "expensas_moneda string, direccion string, sup_total_m2 double, sup_cubierta_m2 double, ambientes int, "
        "dormitorios int, antiguedad_anios int, es_a_estrenar int, barrio string")

T0 = dt.datetime(2024, 1, 1)
T1 = dt.datetime(2024, 2, 1)


def row(rid, **kw):
    base = dict(row_id=rid, id_aviso=rid, url="u" + rid, fecha_scraping=T0, operacion="venta",
                tipo_propiedad="departamento_estandar", precio_valor=100000.0, precio_moneda="USD",
                expensas_valor=None, expensas_moneda=None, direccion=None, sup_total_m2=50.0,
                sup_cubierta_m2=45.0, ambientes=2, dormitorios=1, antiguedad_anios=10, es_a_estrenar=0,
                barrio="palermo")
    base.update(kw)
    return tuple(base[c.split()[0]] for c in COLS.split(", "))


def frame(spark, rows):
    return spark.createDataFrame(rows, COLS)


def reasons(df):
    return {r["row_id"]: r[rules.REASON] for r in df.select("row_id", rules.REASON).collect()}


def test_rule_order_and_nulls(spark):
    df = frame(spark, [
        row("a"),
        row("b", tipo_propiedad="oficina"),
        row("c", tipo_propiedad=None),
        row("d", precio_valor=None),
        row("e", precio_valor=0.0, sup_total_m2=5.0),   # two rules: the earlier wins
        row("f", sup_total_m2=None),
        row("g", sup_total_m2=3000.0),
        row("h", antiguedad_anios=-3, ambientes=20, dormitorios=13),
    ])
    t = cleaning.tag_until(df, 4, cut=False)
    r = reasons(t)
    assert r == {"a": None, "b": "no_residencial", "c": "no_residencial", "d": "precio_ausente_o_cero",
                 "e": "precio_ausente_o_cero", "f": "superficie_menor_a_10m2", "g": "superficie_mayor_a_2000m2",
                 "h": None}
    h = t.filter("row_id = 'h'").collect()[0]
    assert (h["antiguedad_anios"], h["es_a_estrenar"], h["ambientes"], h["dormitorios"]) == (None, None, None, None)
    # invariants: kept + excluded = input, one reason per excluded row
    kept, excl = rules.split(t)
    assert kept.count() + excl.count() == df.count()


def test_dedup_cascade(spark):
    df = frame(spark, [
        row("1", url="U", fecha_scraping=T0),
        row("2", url="U", fecha_scraping=T1),          # newer with the same url wins
        row("3", url=None, id_aviso="n1"),
        row("4", url=None, id_aviso="n2"),             # NULL urls are one group, like pandas
        row("5", id_aviso="X", fecha_scraping=T0),
        row("6", id_aviso="X", fecha_scraping=T0),     # equal dates: larger row id wins (total order)
        row("7", direccion="Calle 1", fecha_scraping=T0),
        row("8", direccion="Calle 1", fecha_scraping=T1),
        row("9", direccion=None), row("10", direccion=None),   # NULL address never dedups at level 3
        row("11", url="V", fecha_scraping=None), row("12", url="V", fecha_scraping=T0),  # NULL date loses
    ])
    r = reasons(dedup.dedup_cascade(rules.start(df)))
    assert r["1"] == "duplicado_url" and r["2"] is None
    assert r["3"] == "duplicado_url" and r["4"] is None
    assert r["5"] == "duplicado_id" and r["6"] is None
    assert r["7"] == "duplicado_mismo_inmueble" and r["8"] is None
    assert r["9"] is None and r["10"] is None
    assert r["11"] == "duplicado_url" and r["12"] is None


def test_dedup_hot_key_is_combined_map_side(spark):
    # one url holding most rows: the aggregation keeps one winner and the plan has a partial aggregate
    rows = [row(f"{i:05d}", url="HOT", fecha_scraping=T0 + dt.timedelta(days=i)) for i in range(300)]
    df = frame(spark, rows)
    s = dedup.survivors(df.select("row_id", "fecha_scraping", "url"), ["url"])
    assert [r["row_id"] for r in s.collect()] == ["00299"]
    plan = s._jdf.queryExecution().executedPlan().toString()
    assert "partial_max" in plan


def test_first_seen_and_merge(spark):
    df = frame(spark, [row("1", url="U", fecha_scraping=T1), row("2", url="U", fecha_scraping=T0),
                       row("3", url=None, id_aviso=None)])
    assert [r["row_id"] for r in dedup.first_seen(df).collect()] == ["2"]
    df2 = frame(spark, [row("1", url="U", fecha_scraping=T0), row("2", url="U", fecha_scraping=T1)])
    assert sorted(r["row_id"] for r in dedup.snapshot_merge(df2.withColumn("portal", F.lit("p"))).collect()) == ["2"]


def test_currency_and_units(spark):
    df = frame(spark, [row("a", precio_moneda="ARS", precio_valor=1500000.0),
                       row("b", precio_moneda=None, precio_valor=200.0, operacion=None),
                       row("c", operacion="alquiler", precio_valor=500.0)])
    t = cleaning.currency_step(rules.start(df), 1500)
    r = {x["row_id"]: x for x in t.collect()}
    assert r["a"]["precio_usd"] == 1000.0 and r["a"]["venta_usd"] == 1000.0
    assert r["b"]["precio_usd"] == 200.0 and r["b"]["alquiler_usd_mes"] == 200.0 and r["b"]["venta_usd"] is None
    assert r["c"]["alquiler_m2_usd_mes"] == 10.0


def test_bins(ev):
    vals = [0.0, 35.0, 35.1, 2000.0, 2001.0, -0.05, None]
    got = ev(lambda c: M.right_closed_bins(c, K.AREA_BINS, K.AREA_LABELS), vals, "double")
    assert got == [None, "hasta 35", "36-55", "120+", None, None, None]
    got = ev(lambda c: M.right_closed_bins(c, K.AGE_BINS, K.AGE_LABELS), [0.0, -0.05, 5.0], "double")
    assert got == ["a estrenar", "a estrenar", "1-5"]


def test_trim_min_group(spark):
    small = [row(f"s{i}", operacion="alquiler", precio_valor=float(100 + i)) for i in range(99)]
    big = [row(f"b{i}", precio_valor=float(100000 + 1000 * i)) for i in range(100)]
    t = cleaning.currency_step(rules.start(frame(spark, small + big)), 1500)
    out = quantiles.quantile_trim(t, "moderado")
    r = reasons(out)
    assert all(r[f"s{i}"] is None for i in range(99))          # 99 values: skipped
    assert r["b0"] == "outlier_precio_m2_venta" and r["b99"] == "outlier_precio_m2_venta"
    assert sum(v is not None for v in r.values()) == 2


def test_yield_rounding_order(spark):
    df = spark.createDataFrame([(1000.0, 150000.0)], "alquiler_est_usd_mes double, venta_usd double")
    from listing_yield.operators import yields
    r = yields.yield_kpis(df).collect()[0]
    assert r["rent_bruta_pct"] == 8.0
    assert r["rent_neta_pct"] == round(8.0 * 0.92 * 0.88, 2)
    assert r["meses_repago"] == 150.0
