"""Registered queries over the test tables, each with its DuckDB oracle.

Every query reads the given tables (through the listing adapter where it needs
listings) and runs over all rows; nothing is sampled or capped unless the
limit is the feature (top-k reports).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import constants as K
from ..functions import measures as M
from ..operators import dedup, quantiles, rules, yields
from ..sources import adapter
from . import cleaning
from ..session import keep_methods_short, materialize
from . import oracles as O

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn
    return deco


_LISTINGS: dict = {}
INPUTS = ("lineitem", "part", "supplier", "nation")


def input_identity(spark, sf_dir, tables=INPUTS) -> tuple:
    """Session, path, and the size and modification time of the tables' files: a changed input is read anew."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    seen = []
    for t in tables:
        path = jvm.org.apache.hadoop.fs.Path(f"{sf_dir.rstrip('/')}/{t}.parquet")
        fs = path.getFileSystem(conf)
        top = fs.getFileStatus(path)
        files = fs.listStatus(path) if top.isDirectory() else [top]
        seen += [(f.getPath().toString(), f.getLen(), f.getModificationTime()) for f in files]
    return (spark.sparkContext.applicationId, sf_dir, tuple(sorted(seen)))


def _numbered(spark, sf_dir):
    """The rows that the listing view is made of, numbered, written once per (session, input files)."""
    keep_methods_short(spark)  # the view and the cleaning over these rows are wide
    key = input_identity(spark, sf_dir)
    if key not in _LISTINGS:
        rows = adapter.base(spark, sf_dir).withColumn(dedup.COPY, F.monotonically_increasing_id())
        _LISTINGS[key] = materialize(rows, "listings")
    return _LISTINGS[key]


def _listings(spark, sf_dir):
    """The listing view over the written rows; each reader makes the columns it needs."""
    return adapter.view(_numbered(spark, sf_dir).drop(dedup.COPY))


_CLEANED: dict = {}


def _tagged(spark, sf_dir, **kw):
    """The tagged listings (steps 1-7), once per (session, input files, parameters).

    The rows with their reason after step 5 and the trim bounds are written; the trim and the other columns are a join
    with two rows and row-local expressions, which each reader computes for the columns it needs.
    """
    key = (*input_identity(spark, sf_dir), tuple(sorted(kw.items())))
    if key not in _CLEANED:
        _CLEANED[key] = cleaning.tag_listings(_numbered(spark, sf_dir), view=adapter.view, **kw)
    return _CLEANED[key]


def _kept(spark, sf_dir, **kw):
    return _tagged(spark, sf_dir, **kw).filter(rules.alive())


LATER_REASONS = {
    3: K.REASONS[4:],   # step 4 and step 6 reasons did not exist after step 3
    4: K.REASONS[7:],   # outlier reasons (step 6)
    5: K.REASONS[7:],
}


def _until(spark, sf_dir, step: int):
    """Reasons as they stood after steps 1..step (3, 4 or 5), read from the one cleaned table.

    Later steps only add reasons (and blank age/rooms/bedrooms, which the
    consumers of these states do not read), so rolling the later reasons back
    gives the earlier state without re-running the cleaning.
    """
    t = _tagged(spark, sf_dir)
    later = F.col(rules.REASON).isin(list(LATER_REASONS[step]))
    return t.withColumn(rules.REASON, F.when(later, F.lit(None).cast("string")).otherwise(F.col(rules.REASON)))


# --------------------------------------------------------------------------- A21 flagship

@register("yield_by_area", O.with_clean(f"""
SELECT barrio, n_alq, n_vta, {O.sround('m_alq', 4)} AS alq_usd, {O.sround('m_vta', 4)} AS venta_usd,
       {O.sround('m_alq * 12 / nullif(m_vta, 0) * 100', 2)} AS rent_bruta_pct
FROM (
  SELECT barrio,
         count(*) FILTER (WHERE operacion = 'alquiler') AS n_alq,
         count(*) FILTER (WHERE operacion = 'venta') AS n_vta,
         median(alquiler_usd_mes) FILTER (WHERE operacion = 'alquiler') AS m_alq,
         median(venta_usd) FILTER (WHERE operacion = 'venta') AS m_vta
  FROM {O.KEPT} k WHERE barrio IS NOT NULL GROUP BY barrio)
WHERE n_alq >= {K.CONTROL_MIN_N} AND n_vta >= {K.CONTROL_MIN_N}
ORDER BY rent_bruta_pct DESC, barrio"""))
def q_yield_by_area(spark, sf_dir):
    return yields.control_yield_by_area(_kept(spark, sf_dir))


# --------------------------------------------------------------------------- rules F1-F7, A20

@register("rule_tally", O.with_clean(f"""
SELECT motivo_exclusion, n, {O.sround('n * 100.0 / n_input', 4)} AS pct_input
FROM (SELECT motivo_exclusion, count(*) AS n, sum(count(*)) OVER () AS n_input FROM tagged GROUP BY motivo_exclusion)
WHERE motivo_exclusion IS NOT NULL"""))
def q_rule_tally(spark, sf_dir):
    return rules.tally(_tagged(spark, sf_dir))


KEPT_COLS = ["row_id", "operacion", "precio_usd", "expensas_usd", "venta_usd", "alquiler_usd_mes",
             "venta_m2_usd", "alquiler_m2_usd_mes", "precio_m2", "antiguedad_anios", "es_a_estrenar",
             "ambientes", "dormitorios", "antiguedad_rango", "superficie_rango", "ratio_cubierta",
             "expensas_sobre_alquiler", "tipo_familia"]


@register("kept_rows", O.with_clean(f"SELECT {', '.join(KEPT_COLS)} FROM {O.KEPT} k"))
def q_kept_rows(spark, sf_dir):
    return _kept(spark, sf_dir).select(*KEPT_COLS)


@register("excluded_rows", O.with_clean(
    "SELECT row_id, motivo_exclusion FROM tagged WHERE motivo_exclusion IS NOT NULL"))
def q_excluded_rows(spark, sf_dir):
    return _tagged(spark, sf_dir).filter(~rules.alive()).select("row_id", rules.REASON)


# Correction lists for the adapter's ids (parameters, like the original's fixed lists).
FIX_RENT = ["7-1", "101-2", "1000-1"]
FIX_ARS = ["35-1", "36-3", "1000-1", "2049-1"]
FIX_AREA = ["35-1", "3-2"]


@register("point_corrections", O.with_clean(
    "SELECT row_id, operacion, precio_moneda, sup_total_m2, precio_m2, motivo_exclusion FROM tagged",
    to_rent=FIX_RENT, to_ars=FIX_ARS, bad_area=FIX_AREA, until=4))
def q_point_corrections(spark, sf_dir):
    df = cleaning.tag_until(_numbered(spark, sf_dir), 4, to_rent=FIX_RENT, to_ars=FIX_ARS, bad_area=FIX_AREA,
                            view=adapter.view)
    return df.select("row_id", "operacion", "precio_moneda", "sup_total_m2", "precio_m2", rules.REASON)


# --------------------------------------------------------------------------- dedup W1-W3

@register("dedup_cascade", O.with_clean("SELECT row_id, motivo_exclusion FROM tagged", until=3))
def q_dedup_cascade(spark, sf_dir):
    return _until(spark, sf_dir, 3).select("row_id", rules.REASON)


@register("snapshot_merge", O.with_listings("""
, m1 AS (SELECT * FROM listings QUALIFY row_number() OVER (PARTITION BY portal, id_aviso
          ORDER BY fecha_scraping DESC NULLS LAST, row_id DESC) = 1)
SELECT row_id, portal, id_aviso, url FROM m1
QUALIFY row_number() OVER (PARTITION BY url ORDER BY fecha_scraping DESC NULLS LAST, row_id DESC) = 1""".replace(
    "\n, m1", ", m1", 1)))
def q_snapshot_merge(spark, sf_dir):
    return dedup.snapshot_merge(_listings(spark, sf_dir)).select("row_id", "portal", "id_aviso", "url")


@register("first_seen", O.with_listings("""
SELECT row_id, coalesce(url, id_aviso) AS clave FROM listings
WHERE coalesce(url, id_aviso) IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY coalesce(url, id_aviso)
        ORDER BY fecha_scraping ASC NULLS LAST, row_id ASC) = 1"""))
def q_first_seen(spark, sf_dir):
    df = dedup.first_seen(_listings(spark, sf_dir))
    return df.select("row_id", F.coalesce("url", "id_aviso").alias("clave"))


# --------------------------------------------------------------------------- money H27/H28, A9, J10

FX_COLS = ["row_id", "precio_usd", "expensas_usd", "venta_usd", "alquiler_usd_mes", "venta_m2_usd",
           "alquiler_m2_usd_mes", "precio_m2"]


@register("fx_normalize", O.with_clean(
    f"SELECT {', '.join(FX_COLS)} FROM tagged WHERE motivo_exclusion IS NULL", until=5))
def q_fx_normalize(spark, sf_dir):
    return _until(spark, sf_dir, 5).filter(rules.alive()).select(*FX_COLS)


@register("implied_fx", O.with_clean(f"""
SELECT CAST({K.DEFAULT_FX!r} AS DOUBLE) AS tc_usado, {O.sround('m_ars / nullif(m_usd, 0)', 6)} AS tc_implicito,
       {O.sround(f'({K.DEFAULT_FX!r} / nullif(m_ars / nullif(m_usd, 0), 0) - 1) * 100', 4)} AS desvio_pct,
       coalesce(abs({O.sround(f'({K.DEFAULT_FX!r} / nullif(m_ars / nullif(m_usd, 0), 0) - 1) * 100', 4)}) > {K.FX_WARN_PCT}, false) AS aviso
FROM (SELECT median(precio_valor / sup_total_m2) FILTER (WHERE precio_moneda = 'ARS') AS m_ars,
             median(precio_valor / sup_total_m2) FILTER (WHERE precio_moneda = 'USD') AS m_usd
      FROM tagged WHERE motivo_exclusion IS NULL AND operacion = 'alquiler' AND sup_total_m2 > 0)""", until=4))
def q_implied_fx(spark, sf_dir):
    return cleaning.implied_fx(_until(spark, sf_dir, 4).filter(rules.alive()))


FX_SCENARIOS = [(1200.0, 8.0, 12.0), (1500.0, 8.0, 12.0), (1800.0, 5.0, 10.0)]


def fx_scenarios(alive_rows: DataFrame, scenarios=FX_SCENARIOS) -> DataFrame:
    """The control yield per area under each (rate, vacancy, costs) scenario.

    The scenario list is a driver-side parameter of known length; rows are
    fanned out by ``explode`` of a literal array (k copies, k = len(scenarios)),
    not by a join, then aggregated per (scenario, area) in one shuffle.
    """
    sc = F.explode(F.array(*[F.struct(F.lit(float(t)).alias("tc"), F.lit(float(v)).alias("vacancia"),
                                      F.lit(float(g)).alias("gastos")) for t, v, g in scenarios]))
    df = (alive_rows.filter(F.col("barrio").isNotNull())
          .select("barrio", "operacion", "precio_valor", "precio_moneda", sc.alias("s"))
          .select("barrio", "operacion", "s.*", M.to_usd("precio_valor", "precio_moneda", F.col("s.tc")).alias("usd")))
    keys = ["tc", "vacancia", "gastos", "barrio"]
    rent, sale = F.col("operacion") == "alquiler", F.col("operacion") == "venta"
    g = df.groupBy(*keys).agg(F.count(F.when(rent, 1)).alias("n_alq"), F.count(F.when(sale, 1)).alias("n_vta"))
    g = g.join(quantiles.medians(df, {"_alq": F.when(rent, F.col("usd")), "_vta": F.when(sale, F.col("usd"))}, keys),
               keys, "left")
    g = g.filter((F.col("n_alq") >= K.CONTROL_MIN_N) & (F.col("n_vta") >= K.CONTROL_MIN_N))
    g = g.withColumn("rent_bruta_pct", M.gross_yield("_alq", "_vta"))
    return g.select("tc", "vacancia", "gastos", "barrio", "n_alq", "n_vta", "rent_bruta_pct",
                    F.round(F.col("rent_bruta_pct") * (1 - F.col("vacancia") / 100)
                            * (1 - F.col("gastos") / 100), 2).alias("rent_neta_pct"))


def _fx_scen_sql():
    vals = ", ".join(f"({t!r}::DOUBLE, {v!r}::DOUBLE, {g!r}::DOUBLE)" for t, v, g in FX_SCENARIOS)
    gross = O.sround("m_alq * 12 / nullif(m_vta, 0) * 100", 2)
    return O.with_clean(f"""
, sc(tc, vacancia, gastos) AS (VALUES {vals}),
x AS (SELECT sc.*, t.barrio, t.operacion,
             CASE WHEN t.precio_moneda = 'ARS' THEN t.precio_valor / sc.tc ELSE t.precio_valor END AS usd
      FROM tagged t, sc WHERE t.motivo_exclusion IS NULL AND t.barrio IS NOT NULL),
g AS (SELECT tc, vacancia, gastos, barrio,
             count(*) FILTER (WHERE operacion = 'alquiler') AS n_alq,
             count(*) FILTER (WHERE operacion = 'venta') AS n_vta,
             median(usd) FILTER (WHERE operacion = 'alquiler') AS m_alq,
             median(usd) FILTER (WHERE operacion = 'venta') AS m_vta
      FROM x GROUP BY ALL)
SELECT tc, vacancia, gastos, barrio, n_alq, n_vta, {gross} AS rent_bruta_pct,
       {O.sround(f'{gross} * (1 - vacancia / 100) * (1 - gastos / 100)', 2)} AS rent_neta_pct
FROM g WHERE n_alq >= {K.CONTROL_MIN_N} AND n_vta >= {K.CONTROL_MIN_N}""".replace("\n, sc", ", sc", 1), until=4)


@register("fx_scenarios", _fx_scen_sql())
def q_fx_scenarios(spark, sf_dir):
    return fx_scenarios(_until(spark, sf_dir, 4).filter(rules.alive()))

