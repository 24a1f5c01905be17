"""Only rows that share a key with another alive row go through the dedup cascade, with the results of the whole one."""

from datetime import date

from pyspark.sql import functions as F

from listing_yield.operators import dedup
from listing_yield.plans import cleaning

KINDS = ("row_id string, url string, id_aviso string, direccion string, sup_total_m2 double, precio_valor double, "
         "operacion string, fecha_scraping date, tipo_propiedad string, precio_moneda string, ambientes int, dormitorios int, "
         "antiguedad_anios int, _copia long")


def made(spark):
    """Rows 0-299 stand alone; then one pair for each level, null urls, null ids, no address, -0.0, a non-residential twin."""
    day, home = date(2026, 1, 1), "casa"
    row = lambda k, **kw: {**dict(
        row_id=f"r{k}", url=f"u{k}", id_aviso=f"i{k}", direccion=f"d{k}", sup_total_m2=50.0, precio_valor=9e4,
        operacion="venta", fecha_scraping=day, tipo_propiedad=home, precio_moneda="USD", ambientes=2, dormitorios=1,
        antiguedad_anios=3, _copia=k), **kw}
    rows = [row(k) for k in range(300)]
    odd = [dict(url="same"), dict(url="same"), dict(id_aviso="same"), dict(id_aviso="same"),
           dict(direccion="same", sup_total_m2=0.0), dict(direccion="same", sup_total_m2=-0.0),
           dict(direccion="half", sup_total_m2=None), dict(direccion="half", sup_total_m2=None),
           dict(url=None), dict(url=None, fecha_scraping=date(2026, 2, 1)), dict(url=None, fecha_scraping=None),
           dict(id_aviso=None), dict(id_aviso=None), dict(row_id="twin", url="twin"), dict(row_id="twin", url="twin")]
    rows += [row(300 + i, **kw) for i, kw in enumerate(odd)]
    rows += [row(400, direccion=None), row(401, direccion=None), row(402, url="u7", tipo_propiedad="oficina")]
    columns = [x.split()[0] for x in KINDS.split(", ")]
    return spark.createDataFrame([tuple(r[c] for c in columns) for r in rows], KINDS), len(odd)


def stored(rows):
    """The rows under names that the view takes back, as a narrower stored form would be."""
    return rows.select("_copia", *[F.col(c).alias(f"l_{c}") for c in rows.columns if c != "_copia"])


def view(rows):
    own = [c for c in rows.columns if c.startswith("l_")]
    return rows.select(*[F.col(c).alias(c[2:]) for c in own], *[c for c in rows.columns if c not in own])


def test_rows_alone_skip_the_cascade(spark, tmp_path, monkeypatch):
    rows, n_odd = made(spark)
    stored(rows).write.parquet(str(tmp_path / "rows"))
    seen, whole = [], dedup.cascade_levels

    def counted(alive_rows, *args, **kw):
        seen.append(alive_rows.count())
        return whole(alive_rows, *args, **kw)

    want = cleaning.tag_until(rows.drop("_copia"), 3, cut=False)
    monkeypatch.setattr(dedup, "cascade_levels", counted)
    got = cleaning.tag_until(spark.read.parquet(str(tmp_path / "rows")), 3, view=view)
    plain = lambda df: sorted(map(str, df.select("row_id", "url", "id_aviso", "motivo_exclusion").collect()))
    assert plain(got) == plain(want)
    assert n_odd <= seen[0] < 30  # not the 300 rows that stand alone (by chance a few numbers may meet)
    reasons = {r.row_id: r.motivo_exclusion for r in got.collect()}
    assert reasons["r300"] == "duplicado_url" and reasons["r302"] == "duplicado_id" and reasons["r7"] is None
    assert reasons["r304"] == "duplicado_mismo_inmueble" and reasons["r400"] is None and reasons["r401"] is None


def test_every_bit_of_the_map_is_found(spark, tmp_path):
    """Of 4,000 keys seen twice none is missed, and most of 4,000 seen once are left out."""
    n = F.col("id")
    rows = spark.range(12_000).select(
        F.when(n < 8000, n % 4000).otherwise(n).cast("string").alias("url"), F.concat(F.lit("i"), n).alias("id_aviso"),
        F.lit(None).cast("string").alias("direccion"), F.lit(1.0).alias("sup_total_m2"), F.lit(1.0).alias("precio_valor"),
        F.lit("venta").alias("operacion"), n)
    dedup.repeated_keys(rows, 12_000).write.parquet(str(tmp_path / "map"))
    out = dedup.mark_repeated(rows, spark.read.parquet(str(tmp_path / "map")))
    flags = out.groupBy((n < 8000).alias("twice")).agg(F.count_if(dedup.MEETS[0]).alias("url"),
                                                       F.count_if(dedup.MEETS[1]).alias("id")).collect()
    found = {r.twice: r for r in flags}
    assert found[True].url == 8000 and found[False].url < 100
    assert found[True].id + found[False].id < 100


def test_verdicts_reach_their_rows_without_moving_them(spark, tmp_path, monkeypatch):
    """Every level at every place of a word, in numbers as far apart as Spark's partitions; broadcast or joined."""
    n = F.col("id")
    number = (F.shiftleft(n % 3, 33) + n * 5).alias(dedup.COPY)
    level = (n % 5).cast("tinyint")  # 4: not looked at
    rows = spark.range(40_000).select(number, n, F.lit(None).cast("string").alias("motivo_exclusion"),
                                      (level < 4).alias(dedup.MEETS[0]))
    levels = spark.range(40_000).select(number, level.alias(dedup.LEVEL)).filter(f"{dedup.LEVEL} in (1, 2, 3)")
    dedup.verdicts(rows, levels).write.parquet(str(tmp_path / "verdicts"))
    stored_verdicts = spark.read.parquet(str(tmp_path / "verdicts"))
    want = F.when(level == 0, None).when(level == 4, 3).otherwise(level)
    for limit in (dedup.VERDICT_ROWS, 0):
        monkeypatch.setattr(dedup, "VERDICT_ROWS", limit)
        out = dedup.with_levels(rows, stored_verdicts, 40_000)
        assert out.filter(~F.col(dedup.LEVEL).eqNullSafe(want)).count() == 0 and out.count() == 40_000
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert not limit or "Exchange hashpartitioning" not in plan
