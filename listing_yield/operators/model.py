"""Rent model: median imputation, scaling, one-hot with a minimum frequency, ridge with a
penalty path chosen by leave-one-out error, out-of-fold validation, smearing (M1-M8, M11).

Scale design (rows stay on executors; the driver only holds p x p matrices, p ~ 60):

* Every preprocessing step is a *linear map* of a raw design row
  ``z = [1, values (NULL -> 0), NULL indicators, one indicator per category, flags]``:
  imputation adds ``median x indicator``, scaling is affine, merging rare
  categories sums indicator columns.  So the Gram matrix of any training set
  is ``A^T (sum z z^T) A``.
* Pass 1 (two jobs): exact medians of the numeric columns for the full set and
  each fold's complement (one aggregation), and per-fold ``sum z z^T``,
  ``sum z y``, ``sum y^2``, ``n`` (``mapInPandas`` partial sums per partition, added
  up in a tree, fetched as blocks of bytes).  A fold complement is ``total - fold``.
* Driver: per training set, one eigendecomposition serves all 30 penalties.
* Pass 2: leave-one-out residuals ``e / (1 - h)`` per row and penalty
  (``mapInPandas``, numpy per Arrow batch), summed per (set, penalty); the
  lowest mean wins (first on ties).
* Pass 3: predictions are a linear expression of the row (category terms are
  literal map lookups), evaluated by Spark itself, no Python.

Folds come from the row id (``md5`` prefix mod 5), the same formula in SQL.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import constants as K
from ..functions import measures as M
from ..session import materialize
from .quantiles import exact_quantiles, medians
from .sums import PARTS, tree_sums

NUM = K.MODEL_NUMERIC
CAT = K.MODEL_CATEGORICAL
FLAGS = K.MODEL_FLAGS
FULL = -1  # training-set id of the full fit; 0..4 are fold complements


def fold_of(row_id: str | Column = "row_id", k: int = K.N_FOLDS) -> Column:
    rid = F.col(row_id) if isinstance(row_id, str) else row_id
    return F.pmod(F.conv(F.substring(F.md5(rid), 1, 7), 16, 10).cast("long"), F.lit(k)).cast("int")


def prepare(df: DataFrame) -> DataFrame:
    """``preparar``: log area (only when area > 0) and missing flag columns as 0."""
    out = df.withColumn("log_sup", F.when(F.col("sup_total_m2") > 0, F.log(F.col("sup_total_m2"))))
    for c in FLAGS:
        if c not in out.columns:
            out = out.withColumn(c, F.lit(0))
    return out


def rentals_for_model(kept: DataFrame) -> DataFrame:
    df = prepare(kept).filter((F.col("operacion") == "alquiler") & F.col("alquiler_usd_mes").isNotNull()
                              & F.col("sup_total_m2").isNotNull() & F.col("barrio").isNotNull())
    return df.withColumn("y", F.log(F.col("alquiler_usd_mes"))).withColumn("fold", fold_of())


def sales_for_model(kept: DataFrame) -> DataFrame:
    return prepare(kept).filter((F.col("operacion") == "venta") & F.col("venta_usd").isNotNull()
                                & F.col("sup_total_m2").isNotNull() & F.col("barrio").isNotNull())


# --------------------------------------------------------------------------- layout of z

@dataclass
class Layout:
    categories: dict[str, list[str]]

    @property
    def names(self) -> list[str]:
        out = ["1"] + [f"x:{c}" for c in NUM] + [f"na:{c}" for c in NUM]
        for f in CAT:
            out += [f"{f}={v}" for v in self.categories[f]]
        return out + [f"f:{c}" for c in FLAGS]

    @property
    def p(self) -> int:
        return len(self.names)

    def index(self) -> dict[str, int]:
        return {n: i for i, n in enumerate(self.names)}


def build_z(pdf: pd.DataFrame, layout: Layout) -> np.ndarray:
    n = len(pdf)
    z = np.zeros((n, layout.p))
    z[:, 0] = 1.0
    k = 1
    vals = pdf[NUM].to_numpy(dtype=float, na_value=np.nan)
    isn = np.isnan(vals)
    z[:, k:k + len(NUM)] = np.where(isn, 0.0, vals)
    z[:, k + len(NUM):k + 2 * len(NUM)] = isn
    k += 2 * len(NUM)
    for f in CAT:
        cats = layout.categories[f]
        pos = {v: i for i, v in enumerate(cats)}
        idx = pdf[f].map(pos)
        ok = idx.notna().to_numpy()
        rows = np.nonzero(ok)[0]
        z[rows, k + idx[ok].astype(int).to_numpy()] = 1.0
        k += len(cats)
    z[:, k:k + len(FLAGS)] = pdf[FLAGS].fillna(0).to_numpy(dtype=float)
    return z


# --------------------------------------------------------------------------- pass 1

MAX_COLUMNS = 2000

MODEL_COLS = ["fold", "y"] + NUM + CAT + FLAGS


def category_layout(rentals: DataFrame) -> Layout:
    """Distinct category values, sorted like the encoder; more than ``MAX_COLUMNS`` of a feature are an error before
    they are fetched."""
    cats = {}
    for f in CAT:
        own = rentals.select(f).filter(F.col(f).isNotNull()).distinct().limit(MAX_COLUMNS + 1)
        cats[f] = sorted(r[0] for r in own.collect())
        if len(cats[f]) > MAX_COLUMNS:
            raise ValueError(f"{f} has more than {MAX_COLUMNS} values")
    return Layout(cats)


def training_medians(rentals: DataFrame, sets: dict[int, Column]) -> dict[int, dict[str, float]]:
    """Exact medians of the numeric columns for each training set (named by a number, told by a condition), all in one
    pair of aggregates."""
    values = {f"{c}@{t}": F.when(own, F.col(c)) for t, own in sets.items() for c in NUM}
    rows = medians(rentals, values).collect()
    row = rows[0].asDict() if rows else dict.fromkeys(values)
    out: dict[int, dict[str, float]] = {}
    for key, v in row.items():
        c, t = key.split("@")
        out.setdefault(int(t), {})[c] = v
    return out


def fold_medians(rentals: DataFrame, k: int = K.N_FOLDS) -> dict[int, dict[str, float]]:
    """Exact training medians for the full set and each fold complement."""
    return training_medians(rentals, {FULL: F.lit(True)} | {j: F.col("fold") != j for j in range(k)})


GRAM_ROWS = 256  # rows of a Gram matrix that make a block


def _gram_partials(layout: Layout):
    p = layout.p

    def fn(batches):
        from pyspark import TaskContext

        acc: dict[int, np.ndarray] = {}
        for pdf in batches:
            if pdf.empty:
                continue
            zy = np.column_stack([build_z(pdf, layout), pdf["y"].to_numpy(dtype=float)])
            keys = pdf["_key"].to_numpy()
            for j in np.unique(keys):
                own = zy[keys == j]
                acc[int(j)] = acc.get(int(j), 0.0) + own.T @ own
        task = TaskContext.get().partitionId()
        for j, m in acc.items():
            for b, at in enumerate(range(0, p + 1, GRAM_ROWS)):
                yield pd.DataFrame({"clave": [j], "bloque": [b], "tarea": [task],
                                    "datos": [m[at:at + GRAM_ROWS].tobytes()]})
    return fn


def gram_sums(rentals: DataFrame, layout: Layout, key: Column, keys: int):
    """For each key 0..keys-1 of the rows: ``(sum z z^T, sum z y, sum y^2, n)``, from one pass.

    The driver holds ``keys`` matrices of p x p (32 MB each for the 2,000 columns of ``MAX_COLUMNS``; with five folds,
    the eigenvectors and transforms of six training sets, about 0.7 GB in all)."""
    p = layout.p
    if p > MAX_COLUMNS:
        raise ValueError(f"{p} design columns; the normal equations are solved on the driver for {MAX_COLUMNS} at most")
    rows = rentals.select(key.cast("int").alias("_key"), "y", *NUM, *CAT, *FLAGS)
    found = tree_sums(rows.mapInPandas(_gram_partials(layout), PARTS), rows.rdd.getNumPartitions())
    res = {}
    for j in range(keys):
        blocks = [found[j, b] for b in range(-(-(p + 1) // GRAM_ROWS)) if (j, b) in found]
        m = np.concatenate(blocks).reshape(p + 1, p + 1) if blocks else np.zeros((p + 1, p + 1))
        res[j] = (m[:p, :p], m[:p, p], m[p, p], m[0, 0])
    return res


def gram_by_fold(rentals: DataFrame, layout: Layout, k: int = K.N_FOLDS):
    return gram_sums(rentals, layout, F.col("fold"), k)


# --------------------------------------------------------------------------- driver-side algebra (p x p)

@dataclass
class Fit:
    names: list[str]            # transformed feature names
    A: np.ndarray               # raw z -> transformed x (p_raw x p_t), plus offset row 0
    mu: np.ndarray
    ybar: float
    n: float
    V: np.ndarray
    s: np.ndarray
    Xty: np.ndarray
    alpha: float = float("nan")
    w: np.ndarray | None = None
    loo: dict[float, float] = field(default_factory=dict)

    def coef_path(self, alpha: float) -> np.ndarray:
        return self.V @ ((self.V.T @ self.Xty) / (self.s + alpha))

    def raw_coefficients(self) -> np.ndarray:
        """Coefficients over raw z (intercept folded into position 0)."""
        beta = self.A @ self.w
        beta[0] += self.ybar - float(self.mu @ self.w)
        return beta


def transform_matrix(layout: Layout, G: np.ndarray, n: float, med: dict[str, float],
                     min_freq: int = K.ONEHOT_MIN_FREQUENCY):
    idx = layout.index()
    cols, names = [], []
    p = layout.p
    for c in NUM:
        ix, ina = idx[f"x:{c}"], idx[f"na:{c}"]
        m = med.get(c)
        m = 0.0 if m is None else float(m)
        nnull = G[0, ina]
        s1 = G[0, ix] + m * nnull
        s2 = G[ix, ix] + m * m * nnull
        mean = s1 / n
        var = max(s2 / n - mean * mean, 0.0)
        sd = math.sqrt(var)
        if sd < 1e-12 * max(1.0, abs(mean)):
            sd = 1.0
        a = np.zeros(p)
        a[0] = -mean / sd
        a[ix] = 1.0 / sd
        a[ina] = m / sd
        cols.append(a)
        names.append(c)
    for f in CAT:
        infrequent = np.zeros(p)
        any_inf = False
        for v in layout.categories[f]:
            i = idx[f"{f}={v}"]
            cnt = G[0, i]
            if cnt >= min_freq:
                a = np.zeros(p)
                a[i] = 1.0
                cols.append(a)
                names.append(f"{f}_{v}")
            elif cnt >= 1:
                infrequent[i] = 1.0
                any_inf = True
        if any_inf:
            cols.append(infrequent)
            names.append(f"{f}_infrequent_sklearn")
    for c in FLAGS:
        a = np.zeros(p)
        a[idx[f"f:{c}"]] = 1.0
        cols.append(a)
        names.append(c)
    return np.column_stack(cols), names


def fit_set(layout: Layout, G: np.ndarray, b: np.ndarray, n: float, med: dict[str, float]) -> Fit:
    A, names = transform_matrix(layout, G, n, med)
    mu = A.T @ G[0] / n
    ybar = b[0] / n
    XtX = A.T @ G @ A - n * np.outer(mu, mu)
    Xty = A.T @ b - n * mu * ybar
    s, V = np.linalg.eigh((XtX + XtX.T) / 2)
    s = np.clip(s, 0.0, None)
    return Fit(names, A, mu, ybar, n, V, s, Xty)


def fit_all(rentals: DataFrame, k: int = K.N_FOLDS):
    """Pass 1 + driver algebra: fits for the full set and each fold complement."""
    layout = category_layout(rentals)
    return layout, fits_of(layout, gram_by_fold(rentals, layout, k), fold_medians(rentals, k))


def fits_of(layout: Layout, by_fold: dict[int, tuple], meds: dict[int, dict[str, float]]) -> dict[int, Fit]:
    """The fits of the full set and of each fold's complement from the folds' sums."""
    Gt = sum(v[0] for v in by_fold.values())
    bt = sum(v[1] for v in by_fold.values())
    nt = sum(v[3] for v in by_fold.values())
    fits = {FULL: fit_set(layout, Gt, bt, nt, meds[FULL])}
    for j, (G, b, _, n) in by_fold.items():
        fits[j] = fit_set(layout, Gt - G, bt - b, nt - n, meds[j])
    return fits


# --------------------------------------------------------------------------- pass 2: leave-one-out

def _loo_partials(layout: Layout, fits: dict[int, Fit], alphas: list[float], member):
    alph = np.asarray(alphas)

    def fn(batches):
        acc = {t: np.zeros(len(alph)) for t in fits}
        # raw z -> coordinates in the eigenvectors, in one step for each set
        axes = {t: (fit.A @ fit.V, fit.mu @ fit.V) for t, fit in fits.items()}
        for pdf in batches:
            if pdf.empty:
                continue
            z = build_z(pdf, layout)
            y = pdf["y"].to_numpy(dtype=float)
            for t, fit in fits.items():
                m = member(t, pdf)
                if not m.any():
                    continue
                to, shift = axes[t]
                q = z[m] @ to - shift               # rows x p_t
                c = fit.V.T @ fit.Xty              # p_t
                inv = 1.0 / (fit.s[None, :] + alph[:, None])     # a x p_t
                yhat = fit.ybar + q @ (inv * c).T                # rows x a
                h = 1.0 / fit.n + (q * q) @ inv.T                # rows x a
                e = (y[m][:, None] - yhat) / (1.0 - h)
                acc[t] += (e * e).sum(axis=0)
        rows = [{"t": t, "a": i, "v": float(v)} for t, arr in acc.items() for i, v in enumerate(arr)]
        yield pd.DataFrame(rows, columns=["t", "a", "v"])
    return fn


def in_fold_complement(t: int, pdf: pd.DataFrame) -> np.ndarray:
    """The rows of a training set: all for ``FULL``, else those outside the fold."""
    return np.ones(len(pdf), bool) if t == FULL else pdf["fold"].to_numpy() != t


def choose_alphas(rentals: DataFrame, layout: Layout, fits: dict[int, Fit],
                  alphas: list[float] = K.RIDGE_ALPHAS, member=in_fold_complement, extra: tuple[str, ...] = ()) -> None:
    """Give each fit the penalty of its least leave-one-out error; ``member(t, rows)`` tells a training set's rows (by
    fold and the ``extra`` columns)."""
    part = rentals.select(*MODEL_COLS, *extra).mapInPandas(
        _loo_partials(layout, fits, alphas, member), "t int, a int, v double")
    sums = part.groupBy("t", "a").agg(F.sum("v").alias("v")).collect()   # sets x 30 numbers
    table: dict[int, dict[int, float]] = {}
    for r in sums:
        table.setdefault(r["t"], {})[r["a"]] = r["v"]
    for t, fit in fits.items():
        errs = [table[t][i] / fit.n for i in range(len(alphas))]
        best = int(np.argmin(errs))
        fit.alpha = alphas[best]
        fit.loo = dict(zip(alphas, errs))
        fit.w = fit.coef_path(fit.alpha)


# --------------------------------------------------------------------------- pass 3: predictions as expressions

def linear_expr(layout: Layout, beta: np.ndarray) -> Column:
    idx = layout.index()
    expr = F.lit(float(beta[0]))
    for c in NUM:
        x = F.col(c)
        expr = expr + F.when(x.isNull(), F.lit(float(beta[idx[f"na:{c}"]]))).otherwise(
            x.cast("double") * F.lit(float(beta[idx[f"x:{c}"]])))
    for f in CAT:
        pairs = []
        for v in layout.categories[f]:
            pairs += [F.lit(v), F.lit(float(beta[idx[f"{f}={v}"]]))]
        m = F.create_map(*pairs) if pairs else None
        if m is not None:
            expr = expr + F.coalesce(F.try_element_at(m, F.col(f)), F.lit(0.0))
    for c in FLAGS:
        expr = expr + F.coalesce(F.col(c).cast("double"), F.lit(0.0)) * F.lit(float(beta[idx[f"f:{c}"]]))
    return expr


def oof_prediction(layout: Layout, fits: dict[int, Fit], k: int = K.N_FOLDS) -> Column:
    expr = None
    for j in range(k):
        e = linear_expr(layout, fits[j].raw_coefficients())
        expr = F.when(F.col("fold") == j, e) if expr is None else expr.when(F.col("fold") == j, e)
    return expr


def full_prediction(layout: Layout, fits: dict[int, Fit]) -> Column:
    return linear_expr(layout, fits[FULL].raw_coefficients())


# --------------------------------------------------------------------------- metrics, bands, smearing, scoring

def with_oof(rentals: DataFrame, layout: Layout, fits: dict[int, Fit]) -> DataFrame:
    d = rentals.withColumn("pred_log", oof_prediction(layout, fits))
    return (d.withColumn("est", F.exp("pred_log"))
            .withColumn("err_rel", F.abs(F.col("est") - F.col("alquiler_usd_mes")) / F.col("alquiler_usd_mes"))
            .withColumn("segmento", M.right_closed_bins("sup_total_m2", K.SIZE_BINS, K.SIZE_LABELS)))


def smearing(oof: DataFrame) -> Column:
    """A14 over out-of-fold residuals (a scalar subquery)."""
    return oof.agg(F.avg(F.exp(F.col("y") - F.col("pred_log")))).scalar()


def band_errors(oof: DataFrame) -> DataFrame:
    """Median relative error and n per size band (at most five rows)."""
    rows = oof.filter(F.col("segmento").isNotNull())
    return exact_quantiles(rows, "err_rel", [0.5], ["segmento"], ["error_segmento"]).select(
        "segmento", "error_segmento", "n")


def score_sales(sales: DataFrame, layout: Layout, fits: dict[int, Fit], smear: Column,
                coverage: DataFrame, band_err: DataFrame) -> DataFrame:
    """M8 + J2/F18 + H33/H34 + J3: expected rent, reliability, yields and the uncertainty band."""
    from . import lookups, yields

    d = sales.withColumn("alquiler_est_usd_mes", F.round(F.exp(full_prediction(layout, fits)) * smear, 2))
    d = d.withColumn("alquiler_est_m2", F.round(F.try_divide(F.col("alquiler_est_usd_mes"), F.col("sup_total_m2")), 2))
    d = lookups.with_coverage(d, coverage)
    d = yields.yield_kpis(d)
    d = lookups.with_band_error(d, band_err.select("segmento", "error_segmento"))
    return yields.yield_band(d)


@dataclass
class StoredFit:
    """A fit as read back from its table: the coefficients over z, which is all that scoring needs."""
    beta: np.ndarray
    alpha: float

    def raw_coefficients(self) -> np.ndarray:
        return self.beta


def bundle_tables(spark, layout: Layout, fits: dict[int, Fit], smear: float, band: DataFrame, coverage: DataFrame,
                  med_m2: DataFrame) -> dict[str, DataFrame]:
    """The model as tables: coefficients by training set and design column, scalars, and the lookups."""
    rows = [(t, i, name, float(b), float(f.alpha)) for t, f in fits.items()
            for i, (name, b) in enumerate(zip(layout.names, f.raw_coefficients()))]
    categories = [(f, i, v) for f in CAT for i, v in enumerate(layout.categories[f])]
    return {"coefficients": spark.createDataFrame(rows, "t int, pos int, name string, beta double, alpha double"),
            "categories": spark.createDataFrame(categories, "feature string, pos int, value string"),
            "scalars": spark.createDataFrame([("smear", float(smear))], "name string, value double"),
            "band": band, "coverage": coverage, "med_m2": med_m2}


def bundle_from_tables(tables: dict[str, DataFrame]) -> dict:
    """What ``bundle_tables`` stored, as scoring takes it: layout, fits, smear and the lookup tables."""
    cats: dict[str, list[str]] = {f: [] for f in CAT}
    for r in tables["categories"].orderBy("feature", "pos").collect():  # MAX_COLUMNS at most
        cats[r["feature"]].append(r["value"])
    betas: dict[int, list] = {}
    for r in tables["coefficients"].orderBy("t", "pos").collect():
        betas.setdefault(r["t"], []).append((r["beta"], r["alpha"]))
    fits = {t: StoredFit(np.array([b for b, _ in v]), v[0][1]) for t, v in betas.items()}
    scalars = {r["name"]: r["value"] for r in tables["scalars"].collect()}
    return dict(layout=Layout(cats), fits=fits, smear=scalars["smear"], band=tables["band"],
                coverage=tables["coverage"], med_m2=tables["med_m2"])


def coefficient_table(fit: Fit) -> pd.DataFrame:
    """H35 source: transformed-feature coefficients of a fit and their % effect."""
    eff = (np.exp(fit.w) - 1) * 100
    return pd.DataFrame({"variable": fit.names, "coef": fit.w, "efecto_pct": eff})


# --------------------------------------------------------------------------- M11: nested feature blocks

BLOCKS = [
    ("solo_superficie", lambda n: n == "log_sup"),
    ("numericas", lambda n: n in NUM),
    ("numericas_barrio", lambda n: n in NUM or n.startswith("barrio_")),
    ("numericas_barrio_tipo", lambda n: n in NUM or n.startswith("barrio_") or n.startswith("tipo_familia_")),
    ("todas", lambda n: True),
]


def _subset(fit: Fit, keep) -> Fit:
    cols = [i for i, n in enumerate(fit.names) if keep(n)]
    A = fit.A[:, cols]
    # rebuild the centered Gram of the subset from the full one: X^T X restricted to cols
    XtX = (fit.V * fit.s) @ fit.V.T
    sub = XtX[np.ix_(cols, cols)]
    s, V = np.linalg.eigh((sub + sub.T) / 2)
    return Fit([fit.names[i] for i in cols], A, fit.mu[cols], fit.ybar, fit.n, V, np.clip(s, 0, None),
               fit.Xty[cols])


def nested_r2(spark, rentals: DataFrame, layout: Layout, fits: dict[int, Fit], k: int = K.N_FOLDS) -> DataFrame:
    """Out-of-fold R2 (log) per feature block, each block with its own LOO-chosen penalty.

    The blocks' sums are parts of the full fits' sums, so nothing is summed anew.  One LOO pass and one metrics pass serve
    all blocks (the pandas function loops over the small per-block matrices)."""
    subs = {}
    for bi, (_, keep) in enumerate(BLOCKS):
        for t, f in fits.items():
            subs[bi * 10 + (t + 1)] = _subset(f, keep)
    choose_alphas(rentals, layout, subs, member=lambda c, pdf: in_fold_complement(c % 10 - 1, pdf))
    exprs = []
    for bi, (name, _) in enumerate(BLOCKS):
        per = {j: subs[bi * 10 + j + 1] for j in range(k)}
        pred = oof_prediction(layout, per, k)
        exprs.append(F.struct(F.lit(name).alias("bloque"), F.lit(bi).alias("orden"),
                              F.lit(len(per[0].names)).alias("n_columnas"), pred.alias("p")))
    long = rentals.select("y", F.explode(F.array(*exprs)).alias("e")).select("y", "e.*")
    return (long.groupBy("bloque", "orden", "n_columnas")
            .agg(F.round(1 - F.sum((F.col("y") - F.col("p")) ** 2) / (F.count(F.lit(1)) * F.var_pop("y")), 6)
                 .alias("r2_log_oof"))
            .orderBy("orden"))


# --------------------------------------------------------------------------- M12: learning curve

LEARNING_FRACTIONS = (0.15, 0.5, 1.0)


def learning_curve(rentals: DataFrame, fractions=LEARNING_FRACTIONS, k: int = K.N_FOLDS, keep=None) -> DataFrame:
    """Out-of-fold R2 (log) and median relative error when training on growing, hash-ordered fractions of the
    rentals (a fixed order, so each fraction contains the previous one), with the full fold / penalty-path fit of each.
    ``keep`` (of a feature's name) restricts the design.

    One pass sums the Gram matrices by (slice between two fractions, fold); a fraction's are running sums of them. A
    fraction's medians come from one pair of aggregates, all leave-one-out errors from one pass, all metrics from one
    more."""
    fractions = sorted(fractions)
    rows = rentals.withColumn("_h", hash_order())
    piece = F.lit(None).cast("int")
    for i, f in reversed(list(enumerate(fractions))):
        piece = F.when(F.col("_h") < int(round(f * 10000)), i).otherwise(piece)
    rows = rows.withColumn("slice", piece).drop("_h").filter(F.col("slice").isNotNull())
    layout = category_layout(rows)
    sums = gram_sums(rows, layout, F.col("slice") * k + F.col("fold"), len(fractions) * k)
    meds: dict[int, dict[str, float]] = {}
    for i in range(len(fractions)):
        part = rows.filter(F.col("slice") <= i)
        meds |= training_medians(part, {_code(i, t, k): F.lit(True) if t == FULL else F.col("fold") != t
                                        for t in (FULL, *range(k))})
    every: dict[int, Fit] = {}
    for i in range(len(fractions)):
        by_fold = {j: tuple(sum(sums[s * k + j][x] for s in range(i + 1)) for x in range(4)) for j in range(k)}
        for t, fit in fits_of(layout, by_fold, {t: meds[_code(i, t, k)] for t in (FULL, *range(k))}).items():
            every[_code(i, t, k)] = fit if keep is None else _subset(fit, keep)

    def member(code: int, pdf: pd.DataFrame) -> np.ndarray:
        return (pdf["slice"].to_numpy() <= code // (k + 1)) & in_fold_complement(code % (k + 1) - 1, pdf)

    choose_alphas(rows, layout, every, member=member, extra=("slice",))
    preds = [F.when(F.col("slice") <= i, F.struct(
        F.lit(float(f)).alias("fraccion"),
        oof_prediction(layout, {t: every[_code(i, t, k)] for t in range(k)}, k).alias("pred_log")))
        for i, f in enumerate(fractions)]
    long = rows.select("y", "alquiler_usd_mes", F.explode(F.filter(F.array(*preds), lambda x: x.isNotNull())).alias("_x"))
    error = F.abs(F.exp("pred_log") - F.col("alquiler_usd_mes")) / F.col("alquiler_usd_mes")
    long = materialize(long.select("y", "alquiler_usd_mes", "_x.*").withColumn("err_rel", error), "learning")
    middle = exact_quantiles(long, "err_rel", [0.5], ["fraccion"], ["m"]).select("fraccion", "m")
    out = long.groupBy("fraccion").agg(
        F.count(F.lit(1)).alias("n"),
        F.round(1 - F.sum((F.col("y") - F.col("pred_log")) ** 2) / (F.count(F.lit(1)) * F.var_pop("y")), 6)
        .alias("r2_log_oof"))
    return out.join(middle, "fraccion").select("fraccion", "n", "r2_log_oof", F.round(F.col("m") * 100, 4).alias("err_mediano_pct"))


def _code(i: int, t: int, k: int) -> int:
    return i * (k + 1) + t + 1


def hash_order(row_id: str = "row_id") -> Column:
    """0..9999 from the row id, independent of its fold; the same formula in SQL."""
    return F.pmod(F.conv(F.substring(F.md5(F.col(row_id)), 8, 7), 16, 10).cast("long"), F.lit(10000)).cast("int")
