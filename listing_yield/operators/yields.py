"""Yield operators: control yield by area (A21), KPIs (H33/H34), area ranking (M9)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import constants as K
from ..functions import measures as M
from .quantiles import medians


def control_yield_by_area(kept: DataFrame, min_n: int = K.CONTROL_MIN_N) -> DataFrame:
    """A21 (+J1, F19, O1): median rent x 12 / median sale x 100 per area, both sides with >= min_n rows.

    The reference joins two separate group-bys; here one pass of conditional
    aggregates does both sides (one shuffle on ``barrio``), and the having
    filter implies the inner-join semantics.  Rows without an area are skipped.
    """
    rent = F.col("operacion") == "alquiler"
    sale = F.col("operacion") == "venta"
    rows = kept.filter(F.col("barrio").isNotNull()).select("barrio", "operacion", "alquiler_usd_mes", "venta_usd")
    g = rows.groupBy("barrio").agg(F.count(F.when(rent, F.lit(1))).alias("n_alq"),
                                   F.count(F.when(sale, F.lit(1))).alias("n_vta"))
    g = g.join(medians(rows, {"_alq": F.when(rent, F.col("alquiler_usd_mes")),
                              "_vta": F.when(sale, F.col("venta_usd"))}, ["barrio"]), "barrio", "left")
    return (g.filter((F.col("n_alq") >= min_n) & (F.col("n_vta") >= min_n))
            .select("barrio", "n_alq", "n_vta",
                    F.round("_alq", 4).alias("alq_usd"),
                    F.round("_vta", 4).alias("venta_usd"),
                    M.gross_yield("_alq", "_vta").alias("rent_bruta_pct"))
            .orderBy(F.col("rent_bruta_pct").desc_nulls_last(), F.col("barrio")))


def yield_kpis(scored: DataFrame, vacancy_pct: float = K.VACANCY_PCT,
               costs_pct: float = K.OWNER_COSTS_PCT, rent: str = "alquiler_est_usd_mes",
               price: str = "venta_usd") -> DataFrame:
    """Gross yield, net yield (from the rounded gross), payback months."""
    out = scored.withColumn("rent_bruta_pct", M.gross_yield(rent, price))
    return out.withColumns({
        "rent_neta_pct": M.net_yield("rent_bruta_pct", vacancy_pct, costs_pct),
        "meses_repago": M.payback_months(price, rent),
    })


def yield_band(df: DataFrame, error: str = "error_estimacion") -> DataFrame:
    """Gross x (1 -/+ error), rounded to 2."""
    return df.withColumns({
        "rent_bruta_min": M.yield_band("rent_bruta_pct", error, -1),
        "rent_bruta_max": M.yield_band("rent_bruta_pct", error, +1),
    })


def area_ranking(scored: DataFrame, min_sales: int = K.RANKING_MIN_SALES) -> DataFrame:
    """M9 (A2, F19, O1): reliable estimates only, areas with >= min_sales, by median gross yield."""
    ok = scored.filter(F.col("estimacion_confiable") == 1).filter(F.col("barrio").isNotNull())
    middle = medians(ok, {"venta_med": F.col("venta_usd"), "venta_m2": F.col("venta_m2_usd"),
                          "alq_est": F.col("alquiler_est_usd_mes"), "rent_bruta": F.col("rent_bruta_pct"),
                          "rent_neta": F.col("rent_neta_pct")}, ["barrio"])
    g = ok.groupBy("barrio").agg(F.count(F.lit(1)).alias("n_ventas")).join(middle, "barrio", "left")
    return g.filter(F.col("n_ventas") >= min_sales).orderBy(F.col("rent_bruta").desc_nulls_last(), "barrio")
