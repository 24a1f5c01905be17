"""Registered queries: trims, bins, profiles, frequencies, correlation, lookups, coverage."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import constants as K
from ..functions import measures as M
from ..operators import dedup, lookups, profile, quantiles, stats, yields
from . import oracles as O
from .queries import _kept, _listings, _until, register

KEPT = O.KEPT


# --------------------------------------------------------------------------- F14, F15

def _trim_sql():
    parts = []
    for mode in ("moderado", "agresivo"):
        lo, hi = K.TRIM_MODES[mode]
        parts.append(f"""SELECT '{mode}' AS modo, operacion, count(v) AS n,
  {O.sround(f'quantile_cont(v, {lo})', 6)} AS lo, {O.sround(f'quantile_cont(v, {hi})', 6)} AS hi
FROM (SELECT operacion, CASE WHEN operacion = 'venta' THEN venta_m2_usd
                             WHEN operacion = 'alquiler' THEN alquiler_m2_usd_mes END AS v
      FROM tagged WHERE motivo_exclusion IS NULL AND operacion IN ('venta', 'alquiler'))
WHERE v IS NOT NULL GROUP BY operacion""")
    return O.with_clean("\nUNION ALL\n".join(parts), until=5)


@register("trim_quantile", _trim_sql())
def q_trim_quantile(spark, sf_dir):
    step5 = _until(spark, sf_dir, 5)
    out = None
    for mode in ("moderado", "agresivo"):
        b = quantiles.trim_bounds(step5, mode).select(
            F.lit(mode).alias("modo"), "operacion", "n", F.round("lo", 6).alias("lo"), F.round("hi", 6).alias("hi"))
        out = b if out is None else out.unionByName(b)
    return out


@register("trim_tukey", O.with_clean(f"""
, v AS (SELECT row_id, operacion, CASE WHEN operacion = 'venta' THEN venta_m2_usd
                                       WHEN operacion = 'alquiler' THEN alquiler_m2_usd_mes END AS x
        FROM {KEPT} k WHERE operacion IN ('venta', 'alquiler')),
f AS (SELECT operacion, quantile_cont(x, 0.25) AS q1, quantile_cont(x, 0.75) AS q3 FROM v
      WHERE x IS NOT NULL GROUP BY operacion)
SELECT row_id, v.operacion FROM v JOIN f ON v.operacion = f.operacion
WHERE x >= q1 - (q3 - q1) * 1.5 AND x <= q3 + (q3 - q1) * 1.5""".replace("\n, v AS", ", v AS", 1)))
def q_trim_tukey(spark, sf_dir):
    kept = _kept(spark, sf_dir).filter(F.col("operacion").isin("venta", "alquiler"))
    v = kept.select("row_id", "operacion", quantiles.trim_value().alias("x"))
    return quantiles.tukey_filter(v, "x", ["operacion"]).select("row_id", "operacion")


# --------------------------------------------------------------------------- H29-H31

@register("bands", O.with_clean(f"""
SELECT row_id, antiguedad_rango, superficie_rango,
       {O.bins_sql('sup_total_m2', K.SIZE_BINS, K.SIZE_LABELS)} AS segmento
FROM {KEPT} k"""))
def q_bands(spark, sf_dir):
    return _kept(spark, sf_dir).select(
        "row_id", "antiguedad_rango", "superficie_rango",
        M.right_closed_bins("sup_total_m2", K.SIZE_BINS, K.SIZE_LABELS).alias("segmento"))


@register("ratios", O.with_clean(f"SELECT row_id, ratio_cubierta, expensas_sobre_alquiler FROM {KEPT} k"))
def q_ratios(spark, sf_dir):
    return _kept(spark, sf_dir).select("row_id", "ratio_cubierta", "expensas_sobre_alquiler")


@register("type_family", O.with_clean(
    f"SELECT tipo_familia, count(*) AS n FROM {KEPT} k WHERE tipo_familia IS NOT NULL GROUP BY tipo_familia"))
def q_type_family(spark, sf_dir):
    return profile.frequency(_kept(spark, sf_dir), "tipo_familia")


# --------------------------------------------------------------------------- A4-A8, A10, A18, A19, O2

PROFILE_COLS = ["venta_usd", "alquiler_usd_mes", "sup_total_m2", "ambientes", "dormitorios", "banos",
                "antiguedad_anios", "barrio", "expensas_usd"]


@register("profile_completeness", O.with_clean("\nUNION ALL\n".join(
    f"SELECT '{c}' AS columna, count({c}) AS n_no_nulos, count(*) AS n_filas, "
    f"{O.sround(f'count({c}) * 100.0 / count(*)', 4)} AS pct_completo FROM {KEPT} k" for c in PROFILE_COLS)))
def q_profile_completeness(spark, sf_dir):
    return profile.completeness(_kept(spark, sf_dir), PROFILE_COLS)


@register("profile_numeric", O.with_listings("""
SELECT precio_moneda, count(precio_valor) AS n, median(precio_valor) AS mediana,
       min(precio_valor) AS minimo, max(precio_valor) AS maximo
FROM listings WHERE precio_moneda IS NOT NULL AND precio_valor IS NOT NULL GROUP BY precio_moneda"""))
def q_profile_numeric(spark, sf_dir):
    return profile.numeric_profile(_listings(spark, sf_dir))


@register("freq", O.with_listings("""
SELECT tipo_propiedad, count(*) AS n FROM listings WHERE tipo_propiedad IS NOT NULL
GROUP BY tipo_propiedad ORDER BY n DESC, tipo_propiedad"""))
def q_freq(spark, sf_dir):
    return profile.frequency(_listings(spark, sf_dir), "tipo_propiedad")


@register("freq_rows", O.with_listings("""
SELECT operacion, precio_moneda, tipo_propiedad, count(*) AS n FROM listings
WHERE operacion IS NOT NULL AND precio_moneda IS NOT NULL AND tipo_propiedad IS NOT NULL
GROUP BY ALL"""))
def q_freq_rows(spark, sf_dir):
    return profile.row_frequency(_listings(spark, sf_dir), ["operacion", "precio_moneda", "tipo_propiedad"])


@register("hist40", O.with_clean(f"""
, h AS (SELECT venta_m2_usd AS x FROM {KEPT} k WHERE operacion = 'venta' AND venta_m2_usd IS NOT NULL),
mm AS (SELECT min(x) AS mn, max(x) AS mx FROM h),
b AS (SELECT CASE WHEN mx - mn = 0 THEN 1
                  ELSE least(CAST(floor((x - mn) / (mx - mn) * {K.HIST_BINS}) AS INTEGER) + 1, {K.HIST_BINS}) END AS bin,
             mn, mx FROM h, mm)
SELECT bin, {O.sround(f'mn + (bin - 1) * ((mx - mn) / {K.HIST_BINS})', 6)} AS desde,
       {O.sround(f'mn + bin * ((mx - mn) / {K.HIST_BINS})', 6)} AS hasta, count(*) AS n
FROM b GROUP BY bin, mn, mx""".replace("\n, h AS", ", h AS", 1)))
def q_hist40(spark, sf_dir):
    sales = _kept(spark, sf_dir).filter(F.col("operacion") == "venta")
    return profile.histogram(sales, "venta_m2_usd")


@register("top_groups", O.with_clean(f"""
SELECT barrio, count(*) AS n FROM {KEPT} k WHERE barrio IS NOT NULL GROUP BY barrio
ORDER BY n DESC, barrio LIMIT {K.TOP_GROUPS}"""))
def q_top_groups(spark, sf_dir):
    return profile.top_groups(_kept(spark, sf_dir), "barrio")


@register("median_two_keys", O.with_listings("""
SELECT barrio, precio_moneda, median(precio_valor) AS mediana, count(*) AS n FROM listings
WHERE barrio IS NOT NULL AND precio_moneda IS NOT NULL GROUP BY barrio, precio_moneda"""))
def q_median_two_keys(spark, sf_dir):
    return profile.median_and_size(_listings(spark, sf_dir), ["barrio", "precio_moneda"], "precio_valor")


@register("quantiles", O.with_clean(f"""
SELECT {', '.join(f"{O.sround(f'quantile_cont(venta_usd, {p})', 6)} AS q{int(round(p * 100)):02d}" for p in (0.05, 0.25, 0.5, 0.75, 0.95))}
FROM {KEPT} k WHERE operacion = 'venta' AND venta_usd IS NOT NULL"""))
def q_quantiles(spark, sf_dir):
    sales = _kept(spark, sf_dir).filter(F.col("operacion") == "venta")
    qs = profile.quantile_summary(sales, "venta_usd")
    return qs.select(*[F.round(c, 6).alias(c) for c in qs.columns])


@register("distinct_sorted", O.with_clean(
    f"SELECT DISTINCT barrio FROM {KEPT} k WHERE operacion = 'alquiler' AND barrio IS NOT NULL ORDER BY barrio"))
def q_distinct_sorted(spark, sf_dir):
    return profile.distinct_sorted(_kept(spark, sf_dir).filter(F.col("operacion") == "alquiler"), "barrio")


# --------------------------------------------------------------------------- A15/A16

@register("spearman_price_yield", O.with_clean(f"""
, g AS (
  SELECT barrio,
         count(*) FILTER (WHERE operacion = 'alquiler') AS n_alq,
         count(*) FILTER (WHERE operacion = 'venta') AS n_vta,
         median(alquiler_usd_mes) FILTER (WHERE operacion = 'alquiler') AS m_alq,
         median(venta_usd) FILTER (WHERE operacion = 'venta') AS m_vta,
         median(venta_m2_usd) FILTER (WHERE operacion = 'venta') AS m2
  FROM {KEPT} k WHERE barrio IS NOT NULL GROUP BY barrio),
c AS (SELECT m2, {O.sround('m_alq * 12 / nullif(m_vta, 0) * 100', 2)} AS y FROM g
      WHERE n_alq >= {K.CONTROL_MIN_N} AND n_vta >= {K.CONTROL_MIN_N}),
c2 AS (SELECT * FROM c WHERE m2 IS NOT NULL AND y IS NOT NULL),
r AS (SELECT rank() OVER (ORDER BY m2) + (count(*) OVER (PARTITION BY m2) - 1) / 2.0 AS rx,
             rank() OVER (ORDER BY y) + (count(*) OVER (PARTITION BY y) - 1) / 2.0 AS ry FROM c2)
SELECT {O.sround('corr(rx, ry)', 6)} AS spearman, count(*) AS n_grupos,
       CASE WHEN {O.sround('corr(rx, ry)', 6)} < -0.5 THEN 'inversa_fuerte'
            WHEN {O.sround('corr(rx, ry)', 6)} < -0.2 THEN 'inversa_moderada'
            ELSE 'sin_relacion_inversa' END AS veredicto
FROM r""".replace("\n, g AS", ", g AS", 1)))
def q_spearman_price_yield(spark, sf_dir):
    kept = _kept(spark, sf_dir)
    ctrl = yields.control_yield_by_area(kept)
    m2 = (kept.filter((F.col("operacion") == "venta") & F.col("barrio").isNotNull())
          )
    m2 = quantiles.exact_quantiles(m2, "venta_m2_usd", [0.5], ["barrio"], ["venta_m2"]).select("barrio", "venta_m2")
    groups = ctrl.join(m2, "barrio")  # both one row per area
    return stats.spearman(groups, "venta_m2", "rent_bruta_pct")


@register("spearman_price_area", O.with_listings(f"""
, b AS (SELECT precio_valor AS x, sup_total_m2 AS y FROM listings WHERE precio_valor IS NOT NULL AND sup_total_m2 IS NOT NULL),
r AS (SELECT rank() OVER (ORDER BY x) + (count(*) OVER (PARTITION BY x) - 1) / 2.0 AS rx,
             rank() OVER (ORDER BY y) + (count(*) OVER (PARTITION BY y) - 1) / 2.0 AS ry FROM b)
SELECT {O.sround('corr(rx, ry)', 6)} AS spearman, count(*) AS n_grupos,
       CASE WHEN {O.sround('corr(rx, ry)', 6)} < -0.5 THEN 'inversa_fuerte'
            WHEN {O.sround('corr(rx, ry)', 6)} < -0.2 THEN 'inversa_moderada'
            ELSE 'sin_relacion_inversa' END AS veredicto
FROM r""".replace("\n, b AS", ", b AS", 1)))
def q_spearman_price_area(spark, sf_dir):
    """A15 and W5 over all listings' price and area (few distinct areas: long ties)."""
    return stats.spearman(_listings(spark, sf_dir), "precio_valor", "sup_total_m2")


# --------------------------------------------------------------------------- J2, J3, F18, A23

@register("lookup_coverage", O.with_clean(f"""
, cov AS (SELECT barrio, count(*) AS n FROM {KEPT} k WHERE operacion = 'alquiler' AND barrio IS NOT NULL GROUP BY barrio)
SELECT row_id, CAST(coalesce(cov.n, 0) AS BIGINT) AS n_alq_barrio,
       CASE WHEN coalesce(cov.n, 0) >= {K.MIN_RENTALS_PER_AREA} THEN 1 ELSE 0 END AS estimacion_confiable
FROM {KEPT} s LEFT JOIN cov ON s.barrio = cov.barrio WHERE s.operacion = 'venta'""".replace("\n, cov AS", ", cov AS", 1)))
def q_lookup_coverage(spark, sf_dir):
    kept = _kept(spark, sf_dir)
    cov = lookups.rental_coverage(kept)
    sales = kept.filter(F.col("operacion") == "venta")
    return lookups.with_coverage(sales, cov).select("row_id", "n_alq_barrio", "estimacion_confiable")


def _baseline_band_sql():
    seg = O.bins_sql("sup_total_m2", K.SIZE_BINS, K.SIZE_LABELS)
    return O.with_clean(f"""
, r AS (SELECT * FROM {KEPT} k WHERE operacion = 'alquiler' AND alquiler_usd_mes IS NOT NULL
        AND sup_total_m2 IS NOT NULL AND barrio IS NOT NULL),
m AS (SELECT barrio, median(alquiler_m2_usd_mes) AS med FROM r GROUP BY barrio),
e AS (SELECT {seg} AS segmento, abs(m.med * r.sup_total_m2 - r.alquiler_usd_mes) / r.alquiler_usd_mes AS err
      FROM r JOIN m ON r.barrio = m.barrio WHERE m.med IS NOT NULL),
es AS (SELECT segmento, median(err) AS err FROM e WHERE segmento IS NOT NULL GROUP BY segmento),
d AS (SELECT median(err) AS dflt FROM es)
SELECT s.row_id, {O.sround('coalesce(es.err, d.dflt)', 6)} AS error_estimacion
FROM {KEPT} s LEFT JOIN es ON ({seg.replace('sup_total_m2', 's.sup_total_m2')}) = es.segmento, d
WHERE s.operacion = 'venta'""".replace("\n, r AS", ", r AS", 1))


@register("lookup_default", _baseline_band_sql())
def q_lookup_default(spark, sf_dir):
    kept = _kept(spark, sf_dir)
    rentals = kept.filter((F.col("operacion") == "alquiler") & F.col("alquiler_usd_mes").isNotNull()
                          & F.col("sup_total_m2").isNotNull() & F.col("barrio").isNotNull())
    band_err = lookups.baseline_band_error(rentals)
    sales = kept.filter(F.col("operacion") == "venta")
    out = lookups.with_band_error(sales, band_err)
    return out.select("row_id", F.round("error_estimacion", 6).alias("error_estimacion"))


@register("stratum_coverage", O.with_clean(f"""
, r AS (SELECT * FROM {KEPT} k WHERE operacion = 'alquiler'),
s AS (SELECT * FROM {KEPT} k WHERE operacion = 'venta'),
c1 AS (SELECT barrio, ambientes FROM r WHERE barrio IS NOT NULL AND ambientes IS NOT NULL
       GROUP BY ALL HAVING count(*) >= {K.STRATUM_MIN_RENTALS}),
c2 AS (SELECT comuna, ambientes FROM r WHERE comuna IS NOT NULL AND ambientes IS NOT NULL
       GROUP BY ALL HAVING count(*) >= {K.STRATUM_MIN_RENTALS}),
c3 AS (SELECT barrio FROM r WHERE barrio IS NOT NULL GROUP BY ALL HAVING count(*) >= {K.STRATUM_MIN_RENTALS}),
x AS (SELECT count(*) AS n_ventas,
             count(*) FILTER (WHERE EXISTS (SELECT 1 FROM c1 WHERE c1.barrio = s.barrio AND c1.ambientes = s.ambientes)) AS a,
             count(*) FILTER (WHERE EXISTS (SELECT 1 FROM c2 WHERE c2.comuna = s.comuna AND c2.ambientes = s.ambientes)) AS b,
             count(*) FILTER (WHERE EXISTS (SELECT 1 FROM c3 WHERE c3.barrio = s.barrio)) AS c
      FROM s)
SELECT 'barrio_x_ambientes' AS estrato, n_ventas, a AS n_cubiertas, {O.sround('a * 100.0 / n_ventas', 4)} AS pct_cubierto FROM x
UNION ALL SELECT 'comuna_x_ambientes', n_ventas, b, {O.sround('b * 100.0 / n_ventas', 4)} FROM x
UNION ALL SELECT 'barrio', n_ventas, c, {O.sround('c * 100.0 / n_ventas', 4)} FROM x""".replace("\n, r AS", ", r AS", 1)))
def q_stratum_coverage(spark, sf_dir):
    return profile.stratum_coverage(_kept(spark, sf_dir))


# --------------------------------------------------------------------------- A22, A25

@register("merge_counts", O.with_listings("""
, m1 AS (SELECT * FROM listings QUALIFY row_number() OVER (PARTITION BY portal, id_aviso
          ORDER BY fecha_scraping DESC NULLS LAST, row_id DESC) = 1),
m2 AS (SELECT * FROM m1 QUALIFY row_number() OVER (PARTITION BY url ORDER BY fecha_scraping DESC NULLS LAST, row_id DESC) = 1)
SELECT (SELECT count(*) FROM listings) AS antes, (SELECT count(*) FROM m2) AS despues,
       (SELECT count(*) FROM listings) - (SELECT count(*) FROM m2) AS duplicados""".replace("\n, m1", ", m1", 1)))
def q_merge_counts(spark, sf_dir):
    raw = _listings(spark, sf_dir)
    merged = dedup.snapshot_merge(raw)
    before = raw.agg(F.count(F.lit(1)).alias("antes"))
    after = merged.agg(F.count(F.lit(1)).alias("despues"))
    return before.select("antes", after.select("despues").scalar().alias("despues")) \
        .withColumn("duplicados", F.col("antes") - F.col("despues"))


@register("run_summary", O.with_listings("""
SELECT portal, operacion, count(*) AS n, CAST(GROUPING(portal, operacion) AS INTEGER) AS nivel FROM listings
GROUP BY ROLLUP (portal, operacion)"""))
def q_run_summary(spark, sf_dir):
    df = _listings(spark, sf_dir)
    return df.rollup("portal", "operacion").agg(
        F.count(F.lit(1)).alias("n"), F.grouping_id("portal", "operacion").cast("int").alias("nivel"))
