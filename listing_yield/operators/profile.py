"""Profiles, frequencies, histograms, top-k and coverage.

Every statistic is one aggregation over the distributed table; only the
aggregated result (bounded by the number of groups/bins/columns) is small.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import constants as K
from .quantiles import exact_quantiles, group_quantiles


def median_and_size(df: DataFrame, by: Sequence[str], value: str) -> DataFrame:
    """A1: median of ``value`` and group size (size counts rows with a NULL value too; NULL keys dropped)."""
    rows = df.filter(_all_not_null(by))
    median = exact_quantiles(rows, value, [0.5], by, ["mediana"]).drop("n")
    return rows.groupBy(*by).agg(F.count(F.lit(1)).alias("n")).join(median, list(by), "left").select(
        *by, "mediana", "n")


def _all_not_null(cols):
    cond = F.lit(True)
    for c in cols:
        cond = cond & F.col(c).isNotNull()
    return cond


def frequency(df: DataFrame, column: str) -> DataFrame:
    """A4: value counts, NULL dropped, most frequent first (ties by value)."""
    return (df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n"))
            .orderBy(F.col("n").desc(), F.col(column)))


def row_frequency(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """A5: frequency of whole rows over ``columns`` (rows with any NULL dropped)."""
    return df.select(*columns).na.drop().groupBy(*columns).agg(F.count(F.lit(1)).alias("n"))


def top_groups(df: DataFrame, column: str, k: int = K.TOP_GROUPS) -> DataFrame:
    """O2: the k most frequent values (TakeOrderedAndProject: a per-partition top-k, then a merge)."""
    return frequency(df, column).limit(k)


def completeness(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Per column, non-NULL count and share (%), from one aggregation, unpivoted."""
    columns = list(columns or df.columns)
    agg = df.agg(F.count(F.lit(1)).alias("_n"), *[F.count(F.col(c)).alias(c) for c in columns])
    long = agg.unpivot(["_n"], columns, "columna", "n_no_nulos")
    return long.select("columna", "n_no_nulos", F.col("_n").alias("n_filas"),
                       F.round(F.try_divide(F.col("n_no_nulos") * 100.0, F.col("_n")), 4).alias("pct_completo"))


def numeric_profile(df: DataFrame, value: str = "precio_valor", by: str = "precio_moneda") -> DataFrame:
    """N, median, min, max of ``value`` per ``by`` (NULL keys and values skipped)."""
    rows = df.filter(F.col(by).isNotNull() & F.col(value).isNotNull())
    median = exact_quantiles(rows, value, [0.5], [by], ["mediana"]).drop("n")
    ends = rows.groupBy(by).agg(F.count(value).alias("n"), F.min(value).alias("minimo"), F.max(value).alias("maximo"))
    return ends.join(median, by).select(by, "n", "mediana", "minimo", "maximo")


def quantile_summary(df: DataFrame, value: str, probs: Sequence[float] = (0.05, 0.25, 0.5, 0.75, 0.95),
                     by: Sequence[str] = ()) -> DataFrame:
    """A10: several quantiles of one column in one pass (exact, linear interpolation)."""
    return group_quantiles(df.filter(F.col(value).isNotNull()), value, list(probs), by)


def histogram(df: DataFrame, value: str, bins: int = K.HIST_BINS) -> DataFrame:
    """Equal-width bins between min and max (last bin closed), as a count table.

    min/max come from a scalar subquery (one tiny aggregate), so the binning
    stays a map-side expression followed by a partial count per bin.
    """
    v = F.col(value)
    base = df.filter(v.isNotNull())
    stats = base.agg(F.min(value).alias("mn"), F.max(value).alias("mx"))
    mn, mx = stats.select("mn").scalar(), stats.select("mx").scalar()
    width = mx - mn
    idx = F.when(width == 0, F.lit(1)).otherwise(
        F.least(F.floor((v - mn) / width * bins).cast("int") + 1, F.lit(bins)))
    counted = base.select(idx.alias("bin"), mn.alias("mn"), mx.alias("mx")) \
        .groupBy("bin", "mn", "mx").agg(F.count(F.lit(1)).alias("n"))
    w = (F.col("mx") - F.col("mn")) / bins
    return counted.select("bin", F.round(F.col("mn") + (F.col("bin") - 1) * w, 6).alias("desde"),
                          F.round(F.col("mn") + F.col("bin") * w, 6).alias("hasta"), "n")


def head(df: DataFrame, n: int, order: Sequence[str]) -> DataFrame:
    """The first ``n`` rows in a stated order (a top-n per partition, then a merge)."""
    return df.orderBy(*order).limit(n)


def distinct_sorted(df: DataFrame, column: str) -> DataFrame:
    """A19."""
    return df.select(column).filter(F.col(column).isNotNull()).distinct().orderBy(column)


def share(df: DataFrame, cond) -> DataFrame:
    """Share (%) of rows meeting a condition."""
    return df.agg(F.round(F.avg(F.coalesce(cond, F.lit(False)).cast("double")) * 100, 4).alias("pct"))


STRATA = {
    "barrio_x_ambientes": ["barrio", "ambientes"],
    "comuna_x_ambientes": ["comuna", "ambientes"],
    "barrio": ["barrio"],
}


def stratum_coverage(kept: DataFrame, min_rentals: int = K.STRATUM_MIN_RENTALS) -> DataFrame:
    """Share of sales whose stratum holds >= min_rentals rentals, for three stratifications.

    Rental counts for all three stratifications come from one GROUPING SETS
    aggregation; adaptive execution broadcasts the per-stratum counts where their
    measured size allows.
    """
    keys = ["barrio", "comuna", "ambientes"]
    rentals = kept.filter(F.col("operacion") == "alquiler")
    sets = [[F.col(c) for c in cols] for cols in STRATA.values()]
    counts = (rentals.groupingSets(sets, *keys).agg(F.count(F.lit(1)).alias("n_alq"),
                                                    F.grouping_id().alias("gid")))
    j = kept.filter(F.col("operacion") == "venta").select(*keys)
    for i, (name, cols) in enumerate(STRATA.items()):
        gid = sum(1 << (len(keys) - 1 - k) for k, c in enumerate(keys) if c not in cols)
        side = counts.filter((F.col("gid") == gid) & (F.col("n_alq") >= min_rentals) & _all_not_null(cols))
        j = j.join(side.select(*cols, F.lit(1).alias(f"_ok{i}")), cols, "left")
    totals = j.agg(F.count(F.lit(1)).alias("n_ventas"),
                   *[F.count(f"_ok{i}").alias(name) for i, name in enumerate(STRATA)])
    long = totals.unpivot(["n_ventas"], list(STRATA), "estrato", "n_cubiertas")
    return long.withColumn("pct_cubierto", F.round(F.try_divide(F.col("n_cubiertas") * 100.0, F.col("n_ventas")), 4))
