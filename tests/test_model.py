"""Distributed ridge vs a NumPy closed form of the same pipeline."""

import numpy as np
import pandas as pd

from listing_yield import constants as K
from listing_yield.operators import model


def _frame(n=400, seed=7):
    rng = np.random.default_rng(seed)
    area = rng.uniform(25, 150, n)
    df = pd.DataFrame({
        "row_id": [f"r{i:04d}" for i in range(n)],
        "log_sup": np.log(area),
        "ambientes": rng.integers(1, 6, n).astype(float),
        "banos": rng.integers(1, 3, n).astype(float),
        "dormitorios": rng.integers(0, 4, n).astype(float),
        "antiguedad_anios": rng.integers(0, 80, n).astype(float),
        "barrio": rng.choice(["a", "b", "c", "d", "e", "rare1", "rare2"], n, p=[.3, .25, .2, .15, .08, .01, .01]),
        "tipo_familia": rng.choice(["departamento", "casa", "ph"], n),
    })
    df.loc[rng.random(n) < 0.1, "antiguedad_anios"] = np.nan
    for j, f in enumerate(K.MODEL_FLAGS):
        df[f] = (rng.random(n) < 0.3).astype(int)
    df["y"] = 0.8 * df["log_sup"] + 0.1 * df["banos"] + (df["barrio"] == "a") * 0.2 + rng.normal(0, 0.1, n) + 2
    df["alquiler_usd_mes"] = np.exp(df["y"])
    df["sup_total_m2"] = area
    return df


def _numpy_pipeline(tr: pd.DataFrame, te: pd.DataFrame, alpha: float):
    Xs, Xt = [], []
    for c in K.MODEL_NUMERIC:
        med = tr[c].median()
        a, b = tr[c].fillna(med), te[c].fillna(med)
        mu, sd = a.mean(), a.std(ddof=0) or 1.0
        Xs.append((a - mu) / sd)
        Xt.append((b - mu) / sd)
    for f in K.MODEL_CATEGORICAL:
        cnt = tr[f].value_counts()
        freq = sorted(cnt[cnt >= 5].index)
        infreq = set(cnt[cnt < 5].index)
        for v in freq:
            Xs.append((tr[f] == v).astype(float))
            Xt.append((te[f] == v).astype(float))
        if infreq:
            Xs.append(tr[f].isin(infreq).astype(float))
            Xt.append(te[f].isin(infreq).astype(float))
    for c in K.MODEL_FLAGS:
        Xs.append(tr[c].astype(float))
        Xt.append(te[c].astype(float))
    X, Z = np.column_stack(Xs), np.column_stack(Xt)
    y = tr["y"].to_numpy()
    xm, ym = X.mean(0), y.mean()
    Xc = X - xm
    Ainv = np.linalg.inv(Xc.T @ Xc + alpha * np.eye(X.shape[1]))
    w = Ainv @ (Xc.T @ (y - ym))
    # leave-one-out error for this alpha from the hat diagonal (intercept unpenalized)
    h = 1.0 / len(y) + np.einsum("ij,jk,ik->i", Xc, Ainv, Xc)
    e = (y - (ym + Xc @ w)) / (1 - h)
    return ym + (Z - xm) @ w, float(np.mean(e ** 2))


def test_ridge_matches_closed_form(spark):
    pdf = _frame()
    sdf = spark.createDataFrame(pdf).withColumn("fold", model.fold_of("row_id"))
    layout, fits = model.fit_all(sdf)
    model.choose_alphas(sdf, layout, fits)
    folds = pd.Series([r["fold"] for r in sdf.select("fold").collect()])
    # full fit: LOO curve and chosen alpha agree with brute force
    full = fits[model.FULL]
    for a in (K.RIDGE_ALPHAS[0], K.RIDGE_ALPHAS[10], K.RIDGE_ALPHAS[29]):
        _, loo = _numpy_pipeline(pdf, pdf, a)
        assert abs(full.loo[a] - loo) < 1e-9 * max(1, loo)
    brute = [(_numpy_pipeline(pdf, pdf, a)[1], i) for i, a in enumerate(K.RIDGE_ALPHAS)]
    assert full.alpha == K.RIDGE_ALPHAS[min(brute)[1]]
    # out-of-fold predictions equal the per-fold closed form
    oof = model.with_oof(sdf, layout, fits).select("row_id", "pred_log").toPandas().set_index("row_id")
    for k in range(K.N_FOLDS):
        tr, te = pdf[folds != k], pdf[folds == k]
        pred, _ = _numpy_pipeline(tr, te, fits[k].alpha)
        got = oof.loc[te["row_id"], "pred_log"].to_numpy()
        assert np.allclose(got, pred, atol=1e-8)


def test_learning_curve_equals_refits(spark):
    """One pass over the rentals gives what a complete refit of each fraction gives."""
    sdf = spark.createDataFrame(_frame(700, 11)).withColumn("fold", model.fold_of("row_id")).repartition(5)
    fractions = (0.3, 0.6, 0.9)
    got = {r.fraccion: r for r in model.learning_curve(sdf, fractions).collect()}
    for f in fractions:
        sub = sdf.filter(model.hash_order() < int(round(f * 10000)))
        layout, fits = model.fit_all(sub)
        model.choose_alphas(sub, layout, fits)
        oof = model.with_oof(sub, layout, fits).select("y", "pred_log", "err_rel").toPandas()
        r2 = 1 - ((oof.y - oof.pred_log) ** 2).sum() / ((oof.y - oof.y.mean()) ** 2).sum()
        assert got[f].n == len(oof)
        assert abs(got[f].r2_log_oof - r2) < 2e-6 and abs(got[f].err_mediano_pct - 100 * oof.err_rel.median()) < 2e-4


def test_gram_sums_in_a_tree(spark, monkeypatch):
    """Blocks and levels don't change the sums; every fit of the nested blocks uses its own training rows."""
    from listing_yield.operators import sums

    pdf = _frame(300, 5)
    sdf = spark.createDataFrame(pdf).withColumn("fold", model.fold_of("row_id")).repartition(9)
    layout = model.category_layout(sdf)
    whole = model.gram_by_fold(sdf, layout)
    monkeypatch.setattr(sums, "FAN", 2)
    monkeypatch.setattr(model, "GRAM_ROWS", 7)
    cut = model.gram_by_fold(sdf, layout)
    folds = np.array([r.fold for r in sdf.select("row_id", "fold").orderBy("row_id").collect()])
    z = np.column_stack([model.build_z(pdf, layout), pdf["y"]])
    for j in range(5):
        own = z[folds == j]
        for got in (whole[j], cut[j]):
            assert np.allclose(got[0], own[:, :-1].T @ own[:, :-1]) and np.allclose(got[1], own[:, :-1].T @ own[:, -1])
            assert np.isclose(got[2], own[:, -1] @ own[:, -1]) and got[3] == len(own)
    blocks = {r.bloque: r for r in model.nested_r2(spark, sdf, *model.fit_all(sdf)).collect()}
    assert list(blocks) == [name for name, _ in model.BLOCKS] and blocks["todas"].r2_log_oof > 0.5
