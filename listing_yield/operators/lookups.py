"""Lookups joined back to rows.

Join strategy: a side with a *fixed* bound (five size bands, two operations)
is broadcast explicitly; a side whose size depends on the data (per-area
statistics) is left to Spark: adaptive execution measures the finished
aggregate and turns the join into a broadcast join when it is small, or keeps
a shuffle join (with skew splitting) when it is not.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import constants as K
from ..functions import measures as M
from .quantiles import exact_quantiles


def rental_coverage(kept: DataFrame) -> DataFrame:
    """Rentals per area: (barrio, n)."""
    return (kept.filter((F.col("operacion") == "alquiler") & F.col("barrio").isNotNull())
            .groupBy("barrio").agg(F.count(F.lit(1)).alias("_n_cov")))


def with_coverage(rows: DataFrame, coverage: DataFrame, min_n: int = K.MIN_RENTALS_PER_AREA) -> DataFrame:
    """J2 + F18: rentals in the row's area (missing -> 0) and the reliability flag (n >= min_n)."""
    j = rows.join(coverage, "barrio", "left")
    n = F.coalesce(F.col("_n_cov"), F.lit(0)).cast("long")
    return (j.withColumn("n_alq_barrio", n)
            .withColumn("estimacion_confiable", (F.col("n_alq_barrio") >= min_n).cast("int"))
            .drop("_n_cov"))


def area_median(df: DataFrame, value: str, by: str = "barrio", name: str = "_med") -> DataFrame:
    """J8/W4 as aggregate-then-join (a partition-wide window would put a hot area in one task)."""
    return exact_quantiles(df.filter(F.col(by).isNotNull()), value, [0.5], [by], [name]).select(by, name)


def baseline_band_error(rentals: DataFrame) -> DataFrame:
    """M7 by size band: median |area median rent/m2 x m2 - rent| / rent per band (in-sample)."""
    med = area_median(rentals, "alquiler_m2_usd_mes")
    j = rentals.join(med, "barrio").filter(F.col("_med").isNotNull())
    err = F.abs(F.col("_med") * F.col("sup_total_m2") - F.col("alquiler_usd_mes")) / F.col("alquiler_usd_mes")
    seg = M.right_closed_bins("sup_total_m2", K.SIZE_BINS, K.SIZE_LABELS)
    rows = j.select(seg.alias("segmento"), err.alias("_err")).filter(F.col("segmento").isNotNull())
    return exact_quantiles(rows, "_err", [0.5], ["segmento"], ["error_segmento"]).drop("n")


def with_band_error(rows: DataFrame, band_err: DataFrame, area: str = "sup_total_m2") -> DataFrame:
    """The row's size-band error; a row outside every band gets the median of the band errors.

    The band table has at most five rows (fixed bins), so it is broadcast; the
    default is a scalar subquery over it, not a cross join.
    """
    dflt = band_err.agg(F.median("error_segmento")).scalar()
    seg = M.right_closed_bins(area, K.SIZE_BINS, K.SIZE_LABELS)
    j = rows.withColumn("_seg", seg).join(
        F.broadcast(band_err.withColumnRenamed("segmento", "_seg")), "_seg", "left")
    return j.withColumn("error_estimacion", F.coalesce(F.col("error_segmento"), dflt)).drop("_seg", "error_segmento")


def detail_join(listing: DataFrame, detail: DataFrame, key: str = "slug") -> DataFrame:
    """Enrich listings with detail records, one per key.

    Of several details of a key the newest building (the least age, NULL last) counts, then the greatest row by
    content, so a listing is never doubled and the choice doesn't depend on the order of the records. On a match, bedrooms / parking / age / new-flag are overwritten even by NULL;
    description and details only when the detail value is non-empty; the area
    only when the listing has none.  Unmatched rows keep their values.
    """
    rest = [c for c in detail.columns if c != key]
    first = [(-F.col("antiguedad_anios")).alias("_young")] if "antiguedad_anios" in rest else []
    best = F.max(F.struct(*first, *rest)).alias("_b")  # combines on the map side
    d = detail.groupBy(key).agg(best).select(
        F.col(key), F.lit(True).alias("_hit"), *[F.col(f"_b.{c}").alias(f"_d_{c}") for c in rest])
    j = listing.join(d, key, "left")
    hit = F.coalesce(F.col("_hit"), F.lit(False))
    out = j
    for c in ("dormitorios", "cocheras", "antiguedad_anios", "es_a_estrenar"):
        if f"_d_{c}" in j.columns:
            out = out.withColumn(c, F.when(hit, F.col(f"_d_{c}")).otherwise(F.col(c)))
    for c in ("descripcion", "detalles"):
        if f"_d_{c}" in j.columns:
            dv = F.col(f"_d_{c}")
            out = out.withColumn(c, F.when(hit & dv.isNotNull() & (dv != ""), dv).otherwise(F.col(c)))
    if "_d_barrio" in j.columns:
        cur = F.col("barrio")
        out = out.withColumn("barrio", F.when(hit & (cur.isNull() | (cur == "")), F.col("_d_barrio")).otherwise(cur))
    return out.drop(*[c for c in out.columns if c.startswith("_d_") or c == "_hit"])
