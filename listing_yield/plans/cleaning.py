"""The cleaning plan (eight ordered steps) as one lazily-built, tagged DataFrame.

Order is semantic: corrections first, dedup before the price rules, currency
before the outlier trim.  Row-local steps fuse into the scan's codegen stage;
the dedup cascade and the quantile trim are the only shuffles.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import constants as K
from ..functions import measures as M
from ..operators import dedup, quantiles, rules
from ..session import materialize

DERIVED_CURRENCY = ["precio_usd", "expensas_usd", "venta_usd", "alquiler_usd_mes",
                    "venta_m2_usd", "alquiler_m2_usd_mes"]


def apply_corrections(df: DataFrame, to_rent: Sequence[str] = K.FIX_TO_RENT_IDS,
                      to_ars: Sequence[str] = K.FIX_TO_ARS_IDS,
                      bad_area: Sequence[str] = K.FIX_BAD_AREA_IDS) -> DataFrame:
    """Point fixes by id (operation, currency, area -> NULL); price/m2 blanked on touched rows.

    The id lists are driver-side parameters of known length, so membership is an
    in-set test compiled into the scan stage (no join, no shuffle).
    """
    idc = F.col("id_aviso")
    in_rent = F.coalesce(idc.isin(list(to_rent)), F.lit(False)) if to_rent else F.lit(False)
    in_ars = F.coalesce(idc.isin(list(to_ars)), F.lit(False)) if to_ars else F.lit(False)
    in_area = F.coalesce(idc.isin(list(bad_area)), F.lit(False)) if bad_area else F.lit(False)
    touched = in_rent | in_ars | in_area
    out = df.withColumns({
        "operacion": F.when(in_rent, F.lit("alquiler")).otherwise(F.col("operacion")),
        "precio_moneda": F.when(in_ars, F.lit("ARS")).otherwise(F.col("precio_moneda")),
        "sup_total_m2": F.when(in_area, F.lit(None).cast("double")).otherwise(F.col("sup_total_m2")),
    })
    if "sup_cubierta_m2" in df.columns:
        out = out.withColumn("sup_cubierta_m2", F.when(in_area, F.lit(None).cast("double"))
                             .otherwise(F.col("sup_cubierta_m2")))
    if "precio_m2" in df.columns:
        out = out.withColumn("precio_m2", F.when(touched, F.lit(None).cast("double")).otherwise(F.col("precio_m2")))
    return out


def currency_step(df: DataFrame, fx: float = K.DEFAULT_FX) -> DataFrame:
    """H27/H28 on the alive rows: USD amounts and unit-explicit sale/rent columns."""
    a = rules.alive()
    usd = M.to_usd("precio_valor", "precio_moneda", fx)
    sale = M.is_sale("operacion")
    df = df.withColumns({
        "precio_usd": F.when(a, usd),
        "expensas_usd": F.when(a, M.to_usd("expensas_valor", "expensas_moneda", fx)),
    })
    df = df.withColumns({
        "venta_usd": F.when(a & sale, F.col("precio_usd")),
        "alquiler_usd_mes": F.when(a & ~sale, F.col("precio_usd")),
    })
    df = df.withColumns({
        "venta_m2_usd": F.when(a, M.price_per_m2("venta_usd", "sup_total_m2")),
        "alquiler_m2_usd_mes": F.when(a, M.price_per_m2("alquiler_usd_mes", "sup_total_m2")),
        "precio_m2": F.when(a, M.price_per_m2("precio_valor", "sup_total_m2")).otherwise(
            F.col("precio_m2") if "precio_m2" in df.columns else F.lit(None).cast("double")),
    })
    return df


def derived_step(df: DataFrame) -> DataFrame:
    """H29-H31 on the alive rows."""
    a = rules.alive()
    return df.withColumns({
        "antiguedad_rango": F.when(a, M.right_closed_bins("antiguedad_anios", K.AGE_BINS, K.AGE_LABELS)),
        "superficie_rango": F.when(a, M.right_closed_bins("sup_total_m2", K.AREA_BINS, K.AREA_LABELS)),
        "ratio_cubierta": F.when(a, M.covered_ratio()),
        "expensas_sobre_alquiler": F.when(a, M.expenses_ratio()),
        "tipo_familia": F.when(a, M.type_family()),
    })


def tag_until(listings: DataFrame, step: int = 5, fx: float = K.DEFAULT_FX,
              to_rent: Sequence[str] = K.FIX_TO_RENT_IDS, to_ars: Sequence[str] = K.FIX_TO_ARS_IDS,
              bad_area: Sequence[str] = K.FIX_BAD_AREA_IDS, cut: bool = True,
              view: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """Steps 1..step (step >= 3).  With ``cut``, rows without numbers (``_copia``) are numbered and written before the
    dedup cascade, and the result after the last step is written too, so later passes read files instead of the lineage.

    ``view`` makes listings, row by row, of ``listings`` that are stored in a narrower form (numbered rows). Then these
    rows and their reason are written, and the columns of the steps are made anew, from that reason, by each reader for
    the columns it needs. Only rows that share a key with another alive row go through the cascade; the others meet
    none at any level, so they survive all three. What the cascade finds comes back as two bits for each row number, so
    stored rows are never shuffled."""
    def corrected(df: DataFrame) -> DataFrame:
        if "precio_m2" not in df.columns:
            df = df.withColumn("precio_m2", M.price_per_m2_guarded("precio_valor", "sup_total_m2"))
        return apply_corrections(dedup.with_row_id(rules.start(df)), to_rent, to_ars, bad_area)  # 1

    if view:
        columns = [c for c in listings.columns if c != dedup.COPY]

        def first_two(rows: DataFrame) -> DataFrame:
            """Steps 1 and 2 over stored rows, whose columns are kept beside under names of their own."""
            return rules.residential_rule(corrected(view(rows.select("*", *[F.col(c).alias(f"_{c}") for c in columns]))))

        alive_keys = first_two(listings).filter(rules.alive())
        n_rows = listings.count()
        repeated = materialize(dedup.repeated_keys(alive_keys, n_rows), "repeated")
        marked = dedup.mark_repeated(first_two(listings), repeated)
        levels = dedup.cascade_levels(dedup.only_meeting(marked))
        verdicts = materialize(dedup.verdicts(marked, levels), "verdicts")
        judged = dedup.tag_levels(dedup.with_levels(first_two(listings), verdicts, n_rows))  # 3
        if step >= 4:
            judged = rules.impossible_values_tags(judged)        # 4
        judged = judged.select(*[F.col(f"_{c}").alias(c) for c in columns], rules.REASON)
        df = corrected(view(materialize(judged, f"step{step}")))
        df = rules.impossible_values_blanks(df) if step >= 4 else df
        return currency_step(df, fx) if step >= 5 else df
    df = corrected(listings)
    if dedup.COPY not in df.columns:
        df = df.withColumn(dedup.COPY, F.monotonically_increasing_id())
        if cut:
            df = materialize(df, "numbered")                     # fixes the numbers
    df = dedup.dedup_cascade(rules.residential_rule(df)).drop(dedup.COPY)  # 2, 3
    if step >= 4:
        df = rules.impossible_values_rules(df)                   # 4
    if step >= 5:
        df = currency_step(df, fx)                               # 5
    return materialize(df, f"step{step}") if cut else df


def tag_listings(listings: DataFrame, fx: float = K.DEFAULT_FX, mode: str = "moderado",
                 to_rent: Sequence[str] = K.FIX_TO_RENT_IDS, to_ars: Sequence[str] = K.FIX_TO_ARS_IDS,
                 bad_area: Sequence[str] = K.FIX_BAD_AREA_IDS, accuracy: int | None = None,
                 cut: bool = True, view: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """Steps 1-7: every input row, with ``motivo_exclusion`` (NULL = kept) and the derived columns."""
    df = tag_until(listings, 5, fx, to_rent, to_ars, bad_area, cut, view)
    df = quantiles.quantile_trim(df, mode, accuracy=accuracy)    # 6
    return derived_step(df)                                      # 7


def clean(listings: DataFrame, **kw) -> tuple[DataFrame, DataFrame]:
    """(kept, excluded).  Kept rows lose the reason and the step-8 columns."""
    tagged = tag_listings(listings, **kw)
    kept, excluded = rules.split(tagged)
    return rules.drop_columns(kept), excluded


def implied_fx(listings_alive: DataFrame, fx: float = K.DEFAULT_FX) -> DataFrame:
    """median(ARS price/m2) / median(USD price/m2) over rentals with area > 0, in one pass.

    Returns (tc_usado, tc_implicito, desvio_pct, aviso).
    """
    rent = listings_alive.filter((F.col("operacion") == "alquiler") & (F.col("sup_total_m2") > 0))
    pm2 = F.col("precio_valor") / F.col("sup_total_m2")
    med = quantiles.medians(rent, {"m_ars": F.when(F.col("precio_moneda") == "ARS", pm2),
                                   "m_usd": F.when(F.col("precio_moneda") == "USD", pm2)})
    implied = F.try_divide(F.col("m_ars"), F.when(F.col("m_usd") != 0, F.col("m_usd")))
    gap = (F.try_divide(F.lit(fx), F.when(F.col("tc_implicito") != 0, F.col("tc_implicito"))) - 1) * 100
    return (med.select(F.lit(float(fx)).alias("tc_usado"), F.round(implied, 6).alias("tc_implicito"))
            .withColumn("desvio_pct", F.round(gap, 4))
            .withColumn("aviso", F.coalesce(F.abs(F.col("desvio_pct")) > K.FX_WARN_PCT, F.lit(False))))
