"""Correlation and error metrics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import materialize
from .quantiles import exact_quantiles


SMALL_TABLE = 10_000  # rows that one task may rank


def average_rank(value: str) -> Column:
    """Rank with ties averaged (pandas ``rank(method='average')``), over the whole input, which one task sorts: only
    for tables of at most ``SMALL_TABLE`` rows, as ``with_average_ranks`` checks."""
    w_all = Window.orderBy(F.col(value).asc_nulls_last())
    w_tie = Window.partitionBy(F.col(value))
    return F.rank().over(w_all) + (F.count(F.lit(1)).over(w_tie) - 1) / 2.0


def value_ranks(df: DataFrame, value: str, out: str) -> DataFrame:
    """value, out: the average rank of each distinct value, with no task that sees them all.

    Distinct values with their counts (combined map-side, so ties shrink first) are dealt into ranges of values and
    summed within their range; the ranges' totals, one row each, are summed up and added.
    """
    counts = df.filter(F.col(value).isNotNull()).groupBy(F.col(value).alias("_v")).agg(F.count(F.lit(1)).alias("_c"))
    ranges = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = materialize(counts.repartitionByRange(ranges, "_v").withColumn("_p", F.spark_partition_id()), "rank-ranges")
    totals = dealt.groupBy("_p").agg(F.sum("_c").alias("_t"))  # a row for each range
    before = Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("_p", F.coalesce(F.sum("_t").over(before), F.lit(0)).alias("_off"))
    local = F.sum("_c").over(Window.partitionBy("_p").orderBy("_v").rowsBetween(Window.unboundedPreceding, -1))
    ranked = dealt.withColumn("_below", F.coalesce(local, F.lit(0))).join(F.broadcast(offsets), "_p")
    return ranked.select(F.col("_v").alias(value), (F.col("_off") + F.col("_below") + (F.col("_c") + 1) / 2.0).alias(out))


def with_average_ranks(df: DataFrame, ranks: dict[str, str]) -> DataFrame:
    """``df`` (written once) with the average rank of each column named in ``ranks`` (column -> rank's name). Small
    tables are ranked in one task, others by ``value_ranks``, whose table is joined back on the value; adaptive execution
    splits the partition of a value that very many rows share."""
    df = materialize(df, "to-rank")
    if df.limit(SMALL_TABLE + 1).count() <= SMALL_TABLE:
        return df.select("*", *[F.when(F.col(c).isNotNull(), average_rank(c)).alias(r) for c, r in ranks.items()])
    for c, r in ranks.items():
        df = df.join(materialize(value_ranks(df, c, r), "ranks"), c, "left")
    return df


def spearman(groups: DataFrame, x: str, y: str) -> DataFrame:
    """A15 + A16: Spearman rho between two columns of a table of any size, and its verdict."""
    both = groups.select(x, y).filter(F.col(x).isNotNull() & F.col(y).isNotNull())
    ranked = with_average_ranks(both, {x: "_rx", y: "_ry"})
    rho = F.corr("_rx", "_ry")
    out = ranked.agg(F.round(rho, 6).alias("spearman"), F.count(F.lit(1)).alias("n_grupos"))
    verdict = (F.when(F.col("spearman") < -0.5, F.lit("inversa_fuerte"))
               .when(F.col("spearman") < -0.2, F.lit("inversa_moderada"))
               .otherwise(F.lit("sin_relacion_inversa")))
    return out.withColumn("veredicto", verdict)


def regression_metrics(df: DataFrame, y_log: str, pred_log: str, real: str, est: str) -> DataFrame:
    """R2 on the log scale and relative-error summary of the back-transformed estimate.

    R2 = 1 - SS_res / SS_tot with SS_tot = n * var_pop(y): both from one aggregation.
    """
    err = F.abs(F.col(est) - F.col(real)) / F.col(real)
    median = exact_quantiles(df, err, [0.5], names=["m"]).select("m").scalar()
    one = df.agg(
        F.count(F.lit(1)).alias("n"),
        F.round(1 - F.sum((F.col(y_log) - F.col(pred_log)) ** 2)
                / (F.count(F.lit(1)) * F.var_pop(y_log)), 6).alias("r2_log"),
        F.round(F.avg(err) * 100, 4).alias("err_medio_pct"),
        F.round(F.avg((err < 0.10).cast("double")) * 100, 4).alias("pct_err_lt_10"),
        F.round(F.avg((err < 0.20).cast("double")) * 100, 4).alias("pct_err_lt_20"),
        F.round(F.avg((err > 0.50).cast("double")) * 100, 4).alias("pct_err_gt_50"),
    )
    return one.select("n", "r2_log", F.round(median * 100, 4).alias("err_mediano_pct"), "err_medio_pct",
                      "pct_err_lt_10", "pct_err_lt_20", "pct_err_gt_50")
