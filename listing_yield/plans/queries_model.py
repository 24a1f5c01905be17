"""Registered queries: rent model, validation metrics, scoring, yields, ranking, what-if.

The area-only regression (log rent on log area, fitted per fold complement)
is plain SQL aggregates, so its fit, out-of-fold metrics, smearing, band errors
and baseline are oracle-checked.  The full ridge model is checked on row
counts by the driver and against a closed-form NumPy fit in the unit tests.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .. import constants as K
from ..functions import measures as M
from ..operators import lookups, model, scenario, stats, yields
from ..session import materialize
from . import oracles as O
from ..operators.quantiles import exact_quantiles, medians
from .queries import _kept, input_identity, register

FOLD_SQL = "CAST(('0x' || substr(md5(row_id), 1, 7)) AS BIGINT) % 5"


def _rentals_sql():
    return f"""
, r AS (SELECT *, ln(alquiler_usd_mes) AS y, CASE WHEN sup_total_m2 > 0 THEN ln(sup_total_m2) END AS x,
               {FOLD_SQL} AS fold
        FROM {O.KEPT} k
        WHERE operacion = 'alquiler' AND alquiler_usd_mes IS NOT NULL AND sup_total_m2 IS NOT NULL
          AND barrio IS NOT NULL),
fk AS (SELECT f.k AS fold, count(*) AS n_train, regr_slope(r.y, r.x) AS b, regr_intercept(r.y, r.x) AS a
       FROM r, (VALUES (0), (1), (2), (3), (4)) f(k) WHERE r.fold <> f.k GROUP BY f.k),
o AS (SELECT r.*, fk.a + fk.b * r.x AS pred, exp(fk.a + fk.b * r.x) AS est,
             abs(exp(fk.a + fk.b * r.x) - r.alquiler_usd_mes) / r.alquiler_usd_mes AS err,
             {O.bins_sql('r.sup_total_m2', K.SIZE_BINS, K.SIZE_LABELS)} AS segmento
      FROM r JOIN fk ON r.fold = fk.fold)"""


# --------------------------------------------------------------------------- area-only model (M6, M11 first block)

def area_model(kept: DataFrame):
    """OLS of log rent on log area for each fold complement, from per-fold sums (one pass)."""
    r = model.rentals_for_model(kept).select("row_id", "fold", "y", F.col("log_sup").alias("x"),
                                              "alquiler_usd_mes", "sup_total_m2", "barrio", "alquiler_m2_usd_mes")
    per = r.groupBy("fold").agg(F.count("x").alias("n"), F.sum("x").alias("sx"), F.sum("y").alias("sy"),
                                F.sum(F.col("x") * F.col("y")).alias("sxy"), F.sum(F.col("x") * F.col("x")).alias("sxx"))
    w = Window.partitionBy()  # five rows
    comp = per.select("fold", *[(F.sum(c).over(w) - F.col(c)).alias(c) for c in ("n", "sx", "sy", "sxy", "sxx")])
    slope = (F.col("n") * F.col("sxy") - F.col("sx") * F.col("sy")) / (F.col("n") * F.col("sxx") - F.col("sx") ** 2)
    fit = comp.select("fold", F.col("n").alias("n_train"), slope.alias("b"),
                      ((F.col("sy") - slope * F.col("sx")) / F.col("n")).alias("a"))
    oof = (r.join(F.broadcast(fit), "fold")  # at most five rows
           .withColumn("pred_log", F.col("a") + F.col("b") * F.col("x"))
           .withColumn("est", F.exp("pred_log"))
           .withColumn("err_rel", F.abs(F.col("est") - F.col("alquiler_usd_mes")) / F.col("alquiler_usd_mes"))
           .withColumn("segmento", M.right_closed_bins("sup_total_m2", K.SIZE_BINS, K.SIZE_LABELS)))
    return fit, oof


@register("area_model_oof", O.with_clean(_rentals_sql() + f"""
SELECT fold, n_train, {O.sround('b', 6)} AS pendiente, {O.sround('a', 6)} AS ordenada FROM fk""".replace(
    "\n, r AS", ", r AS", 1)))
def q_area_model_oof(spark, sf_dir):
    fit, _ = area_model(kept_for_model(spark, sf_dir))
    return fit.select("fold", "n_train", F.round("b", 6).alias("pendiente"), F.round("a", 6).alias("ordenada"))


@register("smearing", O.with_clean(_rentals_sql() + f"""
SELECT count(*) AS n, {O.sround('avg(exp(y - pred))', 6)} AS smearing,
       {O.sround('1 - sum((y - pred) * (y - pred)) / (count(*) * var_pop(y))', 6)} AS r2_log,
       {O.sround('median(err) * 100', 4)} AS err_mediano_pct, {O.sround('avg(err) * 100', 4)} AS err_medio_pct,
       {O.sround('avg(CASE WHEN err < 0.10 THEN 1.0 ELSE 0.0 END) * 100', 4)} AS pct_err_lt_10,
       {O.sround('avg(CASE WHEN err < 0.20 THEN 1.0 ELSE 0.0 END) * 100', 4)} AS pct_err_lt_20,
       {O.sround('avg(CASE WHEN err > 0.50 THEN 1.0 ELSE 0.0 END) * 100', 4)} AS pct_err_gt_50
FROM o""".replace("\n, r AS", ", r AS", 1)))
def q_smearing(spark, sf_dir):
    _, oof = area_model(kept_for_model(spark, sf_dir))
    m = stats.regression_metrics(oof, "y", "pred_log", "alquiler_usd_mes", "est")
    sm = oof.agg(F.round(F.avg(F.exp(F.col("y") - F.col("pred_log"))), 6).alias("smearing"))
    return m.select("*", sm.select("smearing").scalar().alias("smearing"))


@register("band_error", O.with_clean(_rentals_sql() + f"""
SELECT segmento, {O.sround('median(err)', 6)} AS error_segmento, count(*) AS n FROM o
WHERE segmento IS NOT NULL GROUP BY segmento""".replace("\n, r AS", ", r AS", 1)))
def q_band_error(spark, sf_dir):
    _, oof = area_model(kept_for_model(spark, sf_dir))
    b = model.band_errors(oof)
    return b.select("segmento", F.round("error_segmento", 6).alias("error_segmento"), "n")


@register("baseline_error", O.with_clean(_rentals_sql() + f""",
m AS (SELECT barrio, median(alquiler_m2_usd_mes) AS med FROM r GROUP BY barrio),
bl AS (SELECT abs(m.med * r.sup_total_m2 - r.alquiler_usd_mes) / r.alquiler_usd_mes AS e
       FROM r JOIN m ON r.barrio = m.barrio WHERE m.med IS NOT NULL),
x AS (SELECT median(e) AS base FROM bl), y AS (SELECT median(err) AS mod FROM o)
SELECT {O.sround('base * 100', 4)} AS err_base_mediano_pct, {O.sround('mod * 100', 4)} AS err_modelo_mediano_pct,
       {O.sround('(base - mod) / base * 100', 4)} AS mejora_pct
FROM x, y""".replace("\n, r AS", ", r AS", 1)))
def q_baseline_error(spark, sf_dir):
    kept = kept_for_model(spark, sf_dir)
    fit, oof = area_model(kept)
    r = model.rentals_for_model(kept)
    med = lookups.area_median(r, "alquiler_m2_usd_mes")
    bl = (r.join(med, "barrio").filter(F.col("_med").isNotNull())
          .select((F.abs(F.col("_med") * F.col("sup_total_m2") - F.col("alquiler_usd_mes"))
                   / F.col("alquiler_usd_mes")).alias("e")))
    base = exact_quantiles(bl, "e", [0.5], names=["m"]).select("m").scalar()
    mod = exact_quantiles(oof, "err_rel", [0.5], names=["m"]).select("m").scalar()
    one = oof.agg(F.count(F.lit(1)).alias("_n"))
    return one.select(F.round(base * 100, 4).alias("err_base_mediano_pct"),
                      F.round(mod * 100, 4).alias("err_modelo_mediano_pct"),
                      F.round((base - mod) / base * 100, 4).alias("mejora_pct"))


# --------------------------------------------------------------------------- ridge model bundle (per session)

_BUNDLES: dict = {}


KEPT_COLS = list(dict.fromkeys([
    "row_id", "operacion", "barrio", "sup_total_m2", "venta_usd", "alquiler_usd_mes", "venta_m2_usd", "alquiler_m2_usd_mes",
    "antiguedad_anios", "banos", *[c for c in model.NUM if c != "log_sup"], *model.CAT, *model.FLAGS]))
_KEPT: dict = {}


def kept_for_model(spark, sf_dir):
    """The kept rows' columns that the models, their scores and what-if inputs read, written once per (session, input)."""
    key = input_identity(spark, sf_dir)
    if key not in _KEPT:
        _KEPT[key] = materialize(_kept(spark, sf_dir).select(*KEPT_COLS), "kept")
    return _KEPT[key]


RENTAL_COLS = [*model.MODEL_COLS, "row_id", "sup_total_m2", "alquiler_usd_mes", "alquiler_m2_usd_mes"]


def rentals_for_model(spark, sf_dir):
    """The models' rentals, written with the columns that fits, curves and errors read."""
    return materialize(model.rentals_for_model(kept_for_model(spark, sf_dir)).select(*RENTAL_COLS), "rentals")


def ridge_bundle(spark, sf_dir):
    """Fit once per (session, input) and keep the bundle (S13), like the saved model the
    what-if scorer loads; every row-level intermediate is a materialized table."""
    key = input_identity(spark, sf_dir)
    if key in _BUNDLES:
        return _BUNDLES[key]
    kept = kept_for_model(spark, sf_dir)
    rentals = rentals_for_model(spark, sf_dir)
    layout, fits = model.fit_all(rentals)
    model.choose_alphas(rentals, layout, fits)
    oof = materialize(model.with_oof(rentals, layout, fits).select(
        "y", "pred_log", "alquiler_usd_mes", "est", "err_rel", "segmento"), "oof")
    smear = float(oof.agg(F.avg(F.exp(F.col("y") - F.col("pred_log")))).collect()[0][0])
    band = model.band_errors(oof).collect()
    band_df = spark.createDataFrame([(r["segmento"], float(r["error_segmento"])) for r in band],
                                    "segmento string, error_segmento double")
    coverage = lookups.rental_coverage(kept)
    med_m2 = lookups.area_median(rentals, "alquiler_m2_usd_mes")
    b = dict(kept=kept, rentals=rentals, layout=layout, fits=fits, oof=oof, smear=smear,
             band=band_df, coverage=coverage, med_m2=med_m2)
    sales = model.sales_for_model(kept)
    scored = model.score_sales(sales, layout, fits, F.lit(smear), coverage, band_df)
    scored = materialize(scored.select(*SCORED_COLS, "sup_total_m2", "venta_m2_usd"), "scored")
    b["scored"] = scored
    # market median gross yield over reliable estimates (the original hard-codes it)
    b["market"] = exact_quantiles(scored.filter(F.col("estimacion_confiable") == 1), "rent_bruta_pct", [0.5],
                                  names=["m"]).select("m").scalar()
    _BUNDLES[key] = b
    return b


def scored_sales(spark, sf_dir):
    return ridge_bundle(spark, sf_dir)["scored"]


SCORED_COLS = ["row_id", "barrio", "venta_usd", "alquiler_est_usd_mes", "alquiler_est_m2", "n_alq_barrio",
               "estimacion_confiable", "rent_bruta_pct", "rent_neta_pct", "meses_repago", "error_estimacion",
               "rent_bruta_min", "rent_bruta_max"]


@register("ridge_scores")
def q_ridge_scores(spark, sf_dir):
    return scored_sales(spark, sf_dir).select(*SCORED_COLS)


@register("ridge_metrics")
def q_ridge_metrics(spark, sf_dir):
    b = ridge_bundle(spark, sf_dir)
    m = stats.regression_metrics(b["oof"], "y", "pred_log", "alquiler_usd_mes", "est")
    alphas = [(t, float(f.alpha)) for t, f in sorted(b["fits"].items())]
    return m.select("*", F.lit(round(b["smear"], 6)).alias("smearing"),
                    F.lit(alphas[0][1]).alias("alpha_final"),
                    F.array(*[F.lit(a) for t, a in alphas[1:]]).alias("alpha_por_fold"))


@register("ranking")
def q_ranking(spark, sf_dir):
    return yields.area_ranking(scored_sales(spark, sf_dir))


@register("ranking_spearman")
def q_ranking_spearman(spark, sf_dir):
    return stats.spearman(yields.area_ranking(scored_sales(spark, sf_dir)), "venta_m2", "rent_bruta")


@register("yield_summary")
def q_yield_summary(spark, sf_dir):
    """Reliable estimates: median, p25/p75 gross yield, median net, median payback; weighted error."""
    s = scored_sales(spark, sf_dir)
    ok = s.filter(F.col("estimacion_confiable") == 1)
    err = s.agg(F.avg("error_estimacion")).scalar()
    return yield_summary(ok).withColumn("error_ponderado_pct", F.round(err * 100, 4))


def yield_summary(ok):
    """Reliable estimates: their number, median and quartiles of the gross yield, medians of net yield and payback."""
    gross = exact_quantiles(ok, "rent_bruta_pct", [0.25, 0.5, 0.75], names=["p25", "p50", "p75"])
    rest = medians(ok, {"neta": F.col("rent_neta_pct"), "meses": F.col("meses_repago")})
    one = ok.agg(F.count(F.lit(1)).alias("n_confiables"))
    return one.select("n_confiables", gross.select("p50").scalar().alias("rent_bruta_mediana"),
                      gross.select("p25").scalar().alias("rent_bruta_p25"),
                      gross.select("p75").scalar().alias("rent_bruta_p75"),
                      rest.select("neta").scalar().alias("rent_neta_mediana"),
                      rest.select("meses").scalar().alias("meses_repago_mediana"))


@register("coef_effects")
def q_coef_effects(spark, sf_dir):
    """H35 + O3/O4: % effect per feature; top 18 non-area features by |effect|, top and bottom 8 areas."""
    b = ridge_bundle(spark, sf_dir)
    pdf = model.coefficient_table(b["fits"][model.FULL])
    df = spark.createDataFrame(pdf)
    areas_ = df.filter(F.col("variable").startswith("barrio_"))
    rest = df.filter(~F.col("variable").startswith("barrio_"))
    return top_effects(rest, areas_)


def top_effects(features, areas_):
    """O3: the features of the largest effects either way; O4: the areas that add and take away most."""
    def top(df, n, name, *order):
        return df.orderBy(*order, "variable").limit(n).withColumn("grupo", F.lit(name))
    return (top(features, K.TOP_EFFECTS, "caracteristica", F.abs("efecto_pct").desc())
            .unionByName(top(areas_, K.TOP_AREA_EFFECTS, "barrio_suma", F.col("efecto_pct").desc()))
            .unionByName(top(areas_, K.TOP_AREA_EFFECTS, "barrio_resta", F.col("efecto_pct").asc())))


def what_if_input(kept):
    """Every cleaned sale restated as a what-if input."""
    return model.sales_for_model(kept).select(
        "row_id", "barrio", F.col("sup_total_m2").alias("m2"), "ambientes", "dormitorios", "banos",
        F.col("antiguedad_anios").alias("antiguedad"), F.col("tipo_familia").alias("tipo"),
        F.col("venta_usd").alias("venta"), *K.MODEL_FLAGS)


@register("what_if")
def q_what_if(spark, sf_dir):
    """M10 over a table of properties (here: every cleaned sale restated as a what-if input)."""
    b = ridge_bundle(spark, sf_dir)
    return scenario.what_if(what_if_input(b["kept"]), b, market_median=None)


@register("nested_r2")
def q_nested_r2(spark, sf_dir):
    """Out-of-fold R2 (log) as feature blocks are added (area only -> all)."""
    b = ridge_bundle(spark, sf_dir)
    return model.nested_r2(spark, b["rentals"], b["layout"], b["fits"])


@register("learning_curve")
def q_learning_curve(spark, sf_dir):
    """Validation metrics as the training set grows (hash-ordered fractions)."""
    b = ridge_bundle(spark, sf_dir)
    return model.learning_curve(b["rentals"])


@register("net_yield_by_band")
def q_net_yield_by_band(spark, sf_dir):
    """Median net yield per size band over all scored sales."""
    return net_yield_by_band(scored_sales(spark, sf_dir))


def net_yield_by_band(scored):
    band = M.right_closed_bins("sup_total_m2", K.SIZE_BINS, K.SIZE_LABELS)
    rows = scored.select(band.alias("segmento"), "rent_neta_pct").filter(F.col("segmento").isNotNull())
    middle = exact_quantiles(rows, "rent_neta_pct", [0.5], ["segmento"], ["rent_neta_mediana"]).drop("n")
    return (rows.groupBy("segmento").agg(F.count(F.lit(1)).alias("n")).join(middle, "segmento", "left")
            .select("segmento", "n", "rent_neta_mediana"))


# --------------------------------------------------------------------------- M5, M6, M12, H35, O3, O4 in closed form

_ALPHAS = ", ".join(f"({i}, {a!r}::DOUBLE)" for i, a in enumerate(K.RIDGE_ALPHAS))
_LIMITS = ", ".join(f"({i}, {f!r}::DOUBLE, {int(round(f * 10000))})" for i, f in enumerate(model.LEARNING_FRACTIONS))


def _path_sql(select: str) -> str:
    """Ridge on the standardized log area alone: for each fraction and training set, the leave-one-out error of every
    penalty, the least one, and the out-of-fold predictions."""
    return O.with_clean(_rentals_sql().replace("\n, r AS", ", r AS", 1) + f""",
fr(i, f, lim) AS (VALUES {_LIMITS}), al(k, alpha) AS (VALUES {_ALPHAS}),
rh AS (SELECT r.*, CAST(('0x' || substr(md5(row_id), 8, 7)) AS BIGINT) % 10000 AS h FROM r),
m AS (SELECT fr.i, t.t, y, x FROM rh, fr, (VALUES (-1), (0), (1), (2), (3), (4)) t(t)
      WHERE h < lim AND (t.t = -1 OR fold <> t.t)),
st AS (SELECT i, t, count(*) AS n, avg(x) AS mx, stddev_pop(x) AS sx, avg(y) AS my, covar_pop(x, y) AS cxy
       FROM m GROUP BY i, t),
loo AS (SELECT i, t, k, alpha, avg(pow((y - my - n * cxy / sx / (n + alpha) * (x - mx) / sx)
               / (1 - 1.0 / n - pow((x - mx) / sx, 2) / (n + alpha)), 2)) AS e
        FROM m JOIN st USING (i, t), al GROUP BY i, t, k, alpha),
best AS (SELECT * FROM loo QUALIFY row_number() OVER (PARTITION BY i, t ORDER BY e, k) = 1),
oof AS (SELECT i, y, alquiler_usd_mes, my + n * cxy / sx / (n + alpha) * (x - mx) / sx AS p
        FROM rh JOIN fr ON h < lim JOIN best USING (i) JOIN st USING (i, t) WHERE t = fold)
""" + select)


def only_log_area(name: str) -> bool:
    return name == "log_sup"


@register("ridge_area_path", _path_sql(f"""
SELECT t AS conjunto, {O.sround('alpha', 6)} AS penalidad, {O.sround('e', 6)} AS error_loo FROM best WHERE i = 2"""))
def q_ridge_area_path(spark, sf_dir):
    """M5: the penalty chosen on the path for the full set and each fold's complement, one standardized column."""
    rentals = rentals_for_model(spark, sf_dir)
    layout, fits = model.fit_all(rentals)
    subs = {t: model._subset(f, only_log_area) for t, f in fits.items()}
    model.choose_alphas(rentals, layout, subs)
    rows = [(t, round(f.alpha, 6), float(f.loo[f.alpha])) for t, f in subs.items()]
    return spark.createDataFrame(rows, "conjunto int, penalidad double, error_loo double").withColumn(
        "error_loo", F.round("error_loo", 6))


@register("learning_curve_area", _path_sql(f"""
SELECT any_value(f) AS fraccion, count(*) AS n,
  {O.sround('1 - sum((y - p) * (y - p)) / (count(*) * var_pop(y))', 6)} AS r2_log_oof,
  {O.sround('median(abs(exp(p) - alquiler_usd_mes) / alquiler_usd_mes) * 100', 4)} AS err_mediano_pct
FROM oof JOIN fr USING (i) GROUP BY i"""))
def q_learning_curve_area(spark, sf_dir):
    """M12 on the log area alone."""
    rentals = rentals_for_model(spark, sf_dir)
    return model.learning_curve(rentals, keep=only_log_area)


EFFECT_PENALTY = 10.0


@register("area_effects", O.with_clean(_rentals_sql().replace("\n, r AS", ", r AS", 1) + f""",
c AS (SELECT 'barrio_' || CASE WHEN k >= {K.ONEHOT_MIN_FREQUENCY} THEN barrio ELSE 'infrequent_sklearn' END AS variable,
        count(*) AS n, avg(y) AS m
      FROM (SELECT *, count(*) OVER (PARTITION BY barrio) AS k FROM r) GROUP BY 1),
w AS (SELECT variable, n / (n + {EFFECT_PENALTY}) * (m - (SELECT sum(n / (n + {EFFECT_PENALTY}) * m)
        / sum(n / (n + {EFFECT_PENALTY})) FROM c)) AS coef FROM c),
e AS (SELECT variable, coef, (exp(coef) - 1) * 100 AS x FROM w),
g AS (SELECT *, 'caracteristica' AS grupo FROM e
      QUALIFY row_number() OVER (ORDER BY abs(x) DESC, variable) <= {K.TOP_EFFECTS}
  UNION ALL SELECT *, 'barrio_suma' FROM e QUALIFY row_number() OVER (ORDER BY x DESC, variable) <= {K.TOP_AREA_EFFECTS}
  UNION ALL SELECT *, 'barrio_resta' FROM e QUALIFY row_number() OVER (ORDER BY x, variable) <= {K.TOP_AREA_EFFECTS})
SELECT variable, {O.sround('coef', 6)} AS coef, {O.sround('x', 4)} AS efecto_pct, grupo FROM g"""))
def q_area_effects(spark, sf_dir):
    """H35, O3 and O4 for a ridge on the areas alone, whose coefficients have a closed form."""
    rentals = rentals_for_model(spark, sf_dir)
    layout, fits = model.fit_all(rentals)
    fit = model._subset(fits[model.FULL], lambda n: n.startswith("barrio_"))
    fit.w = fit.coef_path(EFFECT_PENALTY)
    df = spark.createDataFrame(model.coefficient_table(fit))
    return top_effects(df, df).select("variable", F.round("coef", 6).alias("coef"),
                                      F.round("efecto_pct", 4).alias("efecto_pct"), "grupo")
