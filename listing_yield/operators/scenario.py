"""What-if scoring of a table of properties (M10) and parameter scenarios.

The model bundle is a handful of small tables (coefficients, band errors,
coverage, area medians); a properties table of any size is scored by one
projection with those small tables broadcast.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import constants as K
from ..functions import measures as M
from . import model


def what_if(props: DataFrame, bundle: dict, vacancy_pct: float = K.VACANCY_PCT,
            costs_pct: float = K.OWNER_COSTS_PCT, market_median: float | None = None) -> DataFrame:
    """Columns in: barrio, m2, ambientes, dormitorios, banos, antiguedad, tipo, venta (optional), flags.

    Rows whose area the model does not know get no estimate and the reason ``barrio_desconocido`` in
    ``motivo_rechazo`` (NULL elsewhere).
    The market median gross yield is computed from the scored sales unless given.
    """
    layout, fits = bundle["layout"], bundle["fits"]
    known = layout.categories["barrio"]
    reject = F.when(~F.coalesce(F.col("barrio").isin(known), F.lit(False)), F.lit("barrio_desconocido"))
    d = props.withColumn("motivo_rechazo", reject)
    d = d.withColumns({
        "log_sup": F.when(F.col("m2") > 0, F.log("m2")),
        "antiguedad_anios": F.col("antiguedad"),
        "tipo_familia": F.coalesce(F.col("tipo"), F.lit("departamento")),
    })
    for c in K.MODEL_FLAGS:
        d = d.withColumn(c, F.coalesce(F.col(c).cast("int"), F.lit(0)))
    rent = F.exp(model.full_prediction(layout, fits)) * F.lit(bundle["smear"])
    rent = F.when(F.col("motivo_rechazo").isNull(), rent)
    d = d.withColumn("alquiler", rent).withColumn("alquiler_m2", F.try_divide(F.col("alquiler"), F.col("m2")))
    band = bundle["band"]
    dflt = band.agg(F.median("error_segmento")).scalar()
    d = d.withColumn("segmento", M.right_closed_bins("m2", K.SIZE_BINS, K.SIZE_LABELS))
    d = d.join(F.broadcast(band.select("segmento", "error_segmento")), "segmento", "left")  # <= 5 rows
    d = d.withColumn("error", F.coalesce("error_segmento", dflt)).drop("error_segmento")
    d = d.withColumns({"min": F.col("alquiler") * (1 - F.col("error")),
                       "max": F.col("alquiler") * (1 + F.col("error"))})
    d = d.join(bundle["med_m2"], "barrio", "left")
    d = d.withColumn("referencia_barrio", F.when(F.col("_med") != 0, F.col("_med") * F.col("m2"))).drop("_med")
    d = d.withColumn("dif_referencia_pct", (F.try_divide(F.col("alquiler"), F.col("referencia_barrio")) - 1) * 100)
    d = d.join(bundle["coverage"], "barrio", "left")
    d = d.withColumn("n_alq_barrio", F.coalesce("_n_cov", F.lit(0)).cast("long")).drop("_n_cov")
    d = d.withColumn("confiable", (F.col("n_alq_barrio") >= K.MIN_RENTALS_PER_AREA).cast("int"))
    if market_median is None:
        scored = bundle.get("market")
        market = scored if scored is not None else F.lit(K.MARKET_MEDIAN_GROSS_YIELD)
    else:
        market = F.lit(float(market_median))
    bruta = F.try_divide(F.col("alquiler") * 12, F.col("venta")) * 100
    d = d.withColumn("rent_bruta_pct", F.when(F.col("venta") > 0, bruta))
    d = d.withColumns({
        "rent_bruta_min": F.try_divide(F.col("min") * 12, F.when(F.col("venta") > 0, F.col("venta"))) * 100,
        "rent_bruta_max": F.try_divide(F.col("max") * 12, F.when(F.col("venta") > 0, F.col("venta"))) * 100,
        "rent_neta_pct": F.col("rent_bruta_pct") * (1 - vacancy_pct / 100) * (1 - costs_pct / 100),
        "meses_repago": F.try_divide(F.col("venta"), F.col("alquiler")),
        "veredicto": (F.when(F.col("rent_bruta_pct").isNull(), F.lit(None))
                      .when(F.col("rent_bruta_pct") > market * (1 + K.WHATIF_VERDICT_BAND), F.lit("por_encima"))
                      .when(F.col("rent_bruta_pct") < market * (1 - K.WHATIF_VERDICT_BAND), F.lit("por_debajo"))
                      .otherwise(F.lit("en_linea"))),
    })
    keep = ["barrio", "m2", "alquiler", "alquiler_m2", "segmento", "error", "min", "max", "referencia_barrio",
            "dif_referencia_pct", "n_alq_barrio", "confiable", "rent_bruta_pct", "rent_bruta_min", "rent_bruta_max",
            "rent_neta_pct", "meses_repago", "veredicto", "motivo_rechazo"]
    extra = [c for c in ("row_id",) if c in props.columns]
    return d.select(*extra, *keep)
