import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.operators import paths as P
from tessera.operators.evaluate import roc_auc

POINTS = [(p, c) for p in ("l1", "l2") for c in (0.01, 0.1, 1.0, 10.0)]


def solve(x, y, penalty, C, steps=20_000):
    """The penalised fit by accelerated proximal gradient in numpy (intercept penalised, features standardised)."""
    z = np.concatenate([np.ones((len(x), 1)), (x - x.mean(0)) / x.std(0)], axis=1)
    rate = 1 / (np.linalg.eigvalsh(z.T @ z).max() / 4 + (1 / C if penalty == "l2" else 0))
    b = v = np.zeros(z.shape[1])
    for i in range(steps):
        g = z.T @ (1 / (1 + np.exp(-z @ v)) - y) + (v / C if penalty == "l2" else 0)
        new = v - rate * g
        if penalty == "l1":
            new = np.sign(new) * np.maximum(np.abs(new) - rate / C, 0)
        if (v - new) @ (new - b) > 0:
            v, b = new, new
        else:
            v, b = new + i / (i + 3) * (new - b), new
    return b


def data(seed=0, n=400, d=5):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, d)) * [1, 10, 0.1, 3, 1] + [0, 5, 1, -3, 0]
    y = (x[:, 0] - 0.2 * x[:, 1] + rng.normal(size=n) * 1.5 > -1).astype(float)
    return x, y


def frame(spark, x, y):
    cols = [f"c{i}" for i in range(x.shape[1])]
    return spark.createDataFrame([(*map(float, r), float(t), i % 4) for i, (r, t) in enumerate(zip(x, y))],
                                 ", ".join(f"{c} double" for c in cols) + ", y double, fold int").repartition(3), cols


def test_coefficients_equal_a_numpy_solver(spark):
    x, y = data()
    df, cols = frame(spark, x, y)
    found = P.logistic_paths(df, cols, "y", POINTS, "fold", 4)
    for m, (p, c) in zip(found.points, POINTS):
        assert np.abs(np.r_[m.intercept, m.coef] - solve(x, y, p, c)).max() < 1e-6, (p, c)
    assert (found.points[0].coef == 0).any()  # the strong L1 penalty leaves features out
    assert found.passes <= 25  # 8 points x (4 folds + all rows) = 40 models share the scans


def test_held_out_scores_equal_fits_without_the_fold(spark):
    x, y = data(3)
    df, cols = frame(spark, x, y)
    points = [("l1", 0.1), ("l2", 1.0)]
    found = P.logistic_paths(df, cols, "y", points, "fold", 4)
    want = []
    for p, c in points:
        per = []
        for f in range(4):
            out = np.arange(len(y)) % 4 == f
            b = solve(x[~out], y[~out], p, c)
            s = np.c_[np.ones(out.sum()), (x[out] - x[~out].mean(0)) / x[~out].std(0)] @ b
            pos, neg = s[y[out] == 1], s[y[out] == 0]
            per.append(((pos[:, None] > neg).sum() + (pos[:, None] == neg).sum() / 2) / (len(pos) * len(neg)))
        want.append(np.mean(per))
    assert np.allclose(found.scores(), want, atol=1e-9)
    best = found.best()
    assert (best.penalty, best.C) == points[int(np.argmax(want))]
    scored = best.transform(df)
    assert roc_auc(scored, "y", "p").first()[0] > 0.8 and scored.where("prediction <> (case when p >= 0.5 then 1 else 0 end)").isEmpty()


def test_no_folds_constant_and_null_columns(spark):
    x, y = data(5, 120)
    df, cols = frame(spark, x, y)
    df = df.withColumn("same", F.lit(3.0))
    extra = df.limit(3).withColumn("y", F.lit(None).cast("double"))
    found = P.logistic_paths(df.unionByName(extra), [*cols, "same"], "y", [("l2", 1.0)])
    assert abs(found.points[0].coef[-1]) < 1e-9
    assert np.abs(np.r_[found.points[0].intercept, found.points[0].coef[:-1]] - solve(x, y, "l2", 1.0)).max() < 1e-6
    with pytest.raises(ValueError):
        found.held_out()
    free = P.logistic_paths(df, cols, "y", [("l2", 1e-3)], penalize_intercept=False)
    assert abs(free.points[0].intercept - np.log(y.mean() / (1 - y.mean()))) < 0.05


def test_linear_cv_equals_separate_fits(spark):
    x, y = data(7)
    y = x @ [1.0, 0.5, 2.0, 0.0, -1.0] + y
    df, cols = frame(spark, x, y)
    got = {r.fold: (r.n, r.r2) for r in P.linear_cv(df, cols, "y", "fold").collect()}
    for f in range(4):
        out = np.arange(len(y)) % 4 == f
        a = np.c_[np.ones(len(y)), x]
        b = np.linalg.lstsq(a[~out], y[~out], rcond=None)[0]
        r2 = 1 - ((y[out] - a[out] @ b) ** 2).sum() / ((y[out] - y[out].mean()) ** 2).sum()
        assert got[f][0] == out.sum() and abs(got[f][1] - r2) < 1e-9
    assert P.linear_cv(df.where("y is null"), cols, "y", "fold").collect() == []
