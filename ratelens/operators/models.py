"""Models on top of the sweep: Lasso over all controls with cross-validated
alpha (G17) and the next-move direction classifier (G18).

Lasso: the data never leaves Spark as rows.  Per model, features are
standardised with window aggregates (population std), rows are assigned to
contiguous folds (the unshuffled k-fold layout), and one aggregate produces
the Gram matrix X'X, X'y, sums and counts per (model, fold).  The
cross-validation path -- coordinate descent on training moments (total minus
the fold), held-out MSE from the fold's own moments, refit on all rows -- runs
per model in ``applyInPandas`` on those few moment rows; the solver is an
accelerated proximal gradient vectorised over the whole alpha path
(coordinate descent ``lasso_cd`` is kept as the reference solver).
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..constants import MIN_TRAIN_ROWS

N_ALPHAS = 100
EPS = 1e-3
MAX_FOLDS = 5


def fold_of(rn0, n, k):
    """Contiguous k-fold assignment of 0-based row ``rn0`` among ``n``: the
    first n % k folds hold one extra row (unshuffled k-fold layout)."""
    size = (n / k).cast("int")
    big = n % k
    boundary = big * (size + 1)
    return F.when(rn0 < boundary, (rn0 / (size + 1)).cast("int")) \
        .otherwise(big + ((rn0 - boundary) / size).cast("int"))


def _scale(std: Column) -> Column:
    """A constant feature has no spread: it is centred and left at scale 1."""
    return F.when(std > 0, std).otherwise(F.lit(1.0))


def fold_moments(obs: DataFrame, keys: Sequence[str], features: Sequence[str], target: str,
                 order: str = "month") -> DataFrame:
    """Standardise features per model, assign folds, aggregate the Gram
    matrix per (model, fold)."""
    keys = list(keys)
    whole = Window.partitionBy(*keys)
    ordered = Window.partitionBy(*keys).orderBy(order)
    n = F.count(F.lit(1)).over(whole)
    std = obs.select(*keys, order, F.col(target).alias("y"), n.alias("_n"),
                     *[((F.col(f) - F.avg(f).over(whole)) / _scale(F.stddev_pop(f).over(whole))).alias(f"s{i}")
                       for i, f in enumerate(features)],
                     (F.row_number().over(ordered) - 1).alias("_rn"))
    k = F.greatest(F.lit(2), F.least(F.lit(MAX_FOLDS), (F.col("_n") / 10).cast("int")))
    std = std.withColumn("_k", k).withColumn("fold", fold_of(F.col("_rn"), F.col("_n"), F.col("_k")))
    p = len(features)
    aggs = [F.count(F.lit(1)).alias("n"), F.sum("y").alias("sy"), F.sum(F.col("y") * F.col("y")).alias("syy")]
    aggs += [F.sum(f"s{i}").alias(f"sx{i}") for i in range(p)]
    aggs += [F.sum(F.col(f"s{i}") * F.col("y")).alias(f"sxy{i}") for i in range(p)]
    aggs += [F.sum(F.col(f"s{i}") * F.col(f"s{j}")).alias(f"sxx{i}_{j}")
             for i in range(p) for j in range(i, p)]
    return std.groupBy(*keys, "fold").agg(*aggs)


def _unpack(row: pd.Series, p: int):
    xx = np.empty((p, p))
    for i in range(p):
        for j in range(i, p):
            xx[i, j] = xx[j, i] = row[f"sxx{i}_{j}"]
    xy = np.array([row[f"sxy{i}"] for i in range(p)])
    sx = np.array([row[f"sx{i}"] for i in range(p)])
    return float(row["n"]), sx, float(row["sy"]), xx, xy, float(row["syy"])


def lasso_cd(n, sx, sy, xx, xy, alpha, beta0=None, tol=1e-10, max_iter=10000):
    """Coordinate descent for (1/2n)||y - b0 - Xb||^2 + alpha |b|_1 on
    moments (intercept handled by centring with the training means)."""
    mx, my = sx / n, sy / n
    g = xx - n * np.outer(mx, mx)           # centred X'X
    c = xy - n * mx * my                   # centred X'y
    b = np.zeros(len(sx)) if beta0 is None else beta0.copy()
    diag = np.diag(g)
    for _ in range(max_iter):
        delta = 0.0
        for j in range(len(b)):
            if diag[j] <= 0:
                continue
            rho = c[j] - g[j] @ b + diag[j] * b[j]
            new = np.sign(rho) * max(abs(rho) - n * alpha, 0.0) / diag[j]
            delta = max(delta, abs(new - b[j]))
            b[j] = new
        if delta < tol:
            break
    return my - mx @ b, b


def lasso_path(n, sx, sy, xx, xy, alphas, max_iter=20000, tol=1e-11):
    """Lasso solutions for every alpha at once from moments: accelerated
    proximal gradient (FISTA with adaptive restart), vectorised over the
    alpha path.  Returns (intercepts, coefficients[p, n_alphas])."""
    mx, my = sx / n, sy / n
    g = (xx - n * np.outer(mx, mx)) / n
    c = (xy - n * mx * my) / n
    p, m = len(sx), len(alphas)
    lip = float(np.linalg.eigvalsh(g)[-1]) if p else 0.0
    b = np.zeros((p, m))
    if lip <= 0:
        return my - mx @ b, b
    z, t = b.copy(), np.ones(m)
    thr = np.asarray(alphas)[None, :] / lip
    for _ in range(max_iter):
        u = z - (g @ z - c[:, None]) / lip
        bn = np.sign(u) * np.maximum(np.abs(u) - thr, 0.0)
        restart = np.sum((z - bn) * (bn - b), axis=0) > 0
        tn = np.where(restart, 1.0, (1 + np.sqrt(1 + 4 * t * t)) / 2)
        step = np.where(restart, 0.0, (t - 1) / tn)
        z = bn + step[None, :] * (bn - b)
        done = np.max(np.abs(bn - b)) < tol
        b, t = bn, tn
        if done:
            break
    return my - mx @ b, b


def lasso_path_cv(pdf: pd.DataFrame, p: int) -> tuple[float, np.ndarray]:
    folds = [_unpack(r, p) for _, r in pdf.iterrows()]
    tot = [sum(f[i] for f in folds) for i in range(6)]
    n, sx, sy, xx, xy, syy = tot
    mx, my = sx / n, sy / n
    alpha_max = np.max(np.abs(xy - n * mx * my)) / n
    if not np.isfinite(alpha_max) or alpha_max <= 0:
        return 0.0, np.zeros(p)
    alphas = np.logspace(np.log10(alpha_max * EPS), np.log10(alpha_max), N_ALPHAS)[::-1]
    mse = np.zeros(len(alphas))
    for f in folds:
        tr = [tot[i] - f[i] for i in range(6)]
        if tr[0] <= 0:          # one fold holds every row: nothing to train on
            continue
        b0, b = lasso_path(tr[0], tr[1], tr[2], tr[3], tr[4], alphas)
        fn, fsx, fsy, fxx, fxy, fyy = f
        sse = (fyy - 2 * b0 * fsy - 2 * (fxy @ b) + fn * b0 * b0 + 2 * b0 * (fsx @ b)
               + np.einsum("ia,ij,ja->a", b, fxx, b))
        mse += sse / fn / len(folds)
    best = alphas[int(np.argmin(mse))]
    _, coef = lasso_path(n, sx, sy, xx, xy, np.array([best]))
    return float(best), coef[:, 0]


def lasso_cv(obs: DataFrame, keys: Sequence[str], features: Sequence[str], target: str) -> DataFrame:
    """Per model, standardised Lasso coefficients at the alpha with the
    lowest contiguous-k-fold CV error; long format (feature, coef)."""
    keys = list(keys)
    mom = fold_moments(obs, keys, features, target)
    p = len(features)
    key_fields = [f for f in mom.schema.fields if f.name in keys]
    schema = T.StructType(key_fields + [T.StructField("alpha", T.DoubleType()),
                                        T.StructField("feature", T.StringType()),
                                        T.StructField("coef", T.DoubleType())])

    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        alpha, coef = lasso_path_cv(pdf, p)
        base = {k: pdf[k].iloc[0] for k in keys}
        return pd.DataFrame([{**base, "alpha": alpha, "feature": f, "coef": float(c)}
                             for f, c in zip(features, coef)])
    return mom.groupBy(*keys).applyInPandas(fit, schema)


def direction_classifier(train: DataFrame, test: DataFrame, features: Sequence[str],
                         label: str, min_rows: int = MIN_TRAIN_ROWS) -> DataFrame | None:
    """Logistic regression 'next move is a rise' on the given features
    (L2, C = 1 in the usual formulation: regParam = 1 / n_train, no feature
    standardisation).  Returns every test row with ``prediction``, null where a
    feature is missing, or None when both sets together have fewer than ``min_rows``
    rows.  Training rows with a missing feature or label are not learned from."""
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import VectorAssembler
    whole = F.lit(True)
    for name in features:
        whole = whole & F.col(name).isNotNull() & ~F.isnan(F.col(name).cast("double"))
    train = train.where(whole & F.col(label).isNotNull())
    n_train = train.count()
    if n_train == 0 or n_train + test.count() < min_rows:
        return None
    va = VectorAssembler(inputCols=list(features), outputCol="features")
    lr = LogisticRegression(featuresCol="features", labelCol=label, regParam=1.0 / n_train,
                            elasticNetParam=0.0, standardization=False, maxIter=200, tol=1e-8)
    model = lr.fit(va.transform(train.withColumn(label, F.col(label).cast("double"))))
    known = test.withColumn(label, F.col(label).cast("int"))
    pred = model.transform(va.transform(known.where(whole))).withColumn("prediction", F.col("prediction").cast("int"))
    return pred.drop("features", "rawPrediction", "probability").unionByName(
        known.where(~whole).withColumn("prediction", F.lit(None).cast("int")))
