import numpy as np
import pytest
from pyspark.ml import Pipeline
from pyspark.ml.classification import LinearSVC
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from tessera.operators import hinge as H
from tessera.operators import models as M


def rows(spark, n=600, d=4, seed=0):
    rng = np.random.default_rng(seed)
    x = np.c_[rng.normal(0, 1, (n, d - 1)), np.zeros(n)]  # the last column is constant
    y = ((x[:, 0] * x[:, 1] + x[:, 2] + rng.normal(0, 0.7, n)) > 0).astype(float)
    df = spark.createDataFrame([(i, float(t), i % 3, *map(float, a)) for i, (a, t) in enumerate(zip(x, y))],
                               "id int, label double, fold int, " + ", ".join(f"x{j} double" for j in range(d))).repartition(2)
    return VectorAssembler(inputCols=[f"x{j}" for j in range(d)], outputCol="features").transform(df).cache()


@pytest.mark.parametrize("kind", ["rbf", "poly"])
def test_models_are_those_of_linear_svc(spark, kind):
    """Joint fits of all folds and the whole equal Spark's LinearSVC on the mapped rows."""
    df = rows(spark).drop("features")
    # constant without fold 1, where alone it varies
    df = VectorAssembler(inputCols=["x0", "x1", "x2", "x3"], outputCol="features").transform(
        df.withColumn("x3", F.when((F.col("fold") == 1) & (F.col("id") % 2 == 0), -2.1).otherwise(0.3)))
    reg = M.reg_param(1.0, 400)
    stage, svm = (M.RandomFourierFeatures("features", "z", 4, 64, 0.3), M.svm_rbf(4, 1.0, 400, 0.3, 64)) if kind == "rbf" else \
        (M.CubicFeatures("features", "z", 4, 0.25), M.svm_poly(4, 1.0, 400))
    svm.max_iter = 12
    found = svm.fits(df, "fold", 3)
    for t in (1, 3):
        want = Pipeline(stages=[stage, LinearSVC(featuresCol="z", regParam=reg, maxIter=12, tol=1e-4)]).fit(df.where(F.col("fold") != t)).stages[-1]
        got, bias = found.models[t][0]
        assert np.allclose(got, want.coefficients.toArray(), rtol=1e-6, atol=1e-8) and abs(bias - want.intercept) < 1e-6
    assert found.passes < 70  # four models, one scan for all: alone each needs nearly as many
    held = found.held_out().collect()
    assert sorted(r.fold for r in held) == sorted(i % 3 for i in range(600))


def test_search_scores_are_those_of_the_cross_validator(spark):
    df = rows(spark, seed=3)
    regs, gammas = [M.reg_param(c, 400) for c in (0.1, 10)], [0.05, 0.5]
    found = M.svm_search(df, 4, regs, gammas, "fold", 3, n_features=32, max_iter=8)
    rff, svc = M.RandomFourierFeatures("features", "z", 4, 32), LinearSVC(featuresCol="z", maxIter=8, tol=1e-4)
    want = M.grid_search(Pipeline(stages=[rff, svc]), df, {svc.regParam: regs, rff.gamma: gammas}, "fold", 3)
    assert np.allclose(found.avgMetrics, want.avgMetrics, atol=1e-9)
    assert found.points == [(r, g) for r in regs for g in gammas] and found.best == int(np.argmax(want.avgMetrics))
    platt = found.platt().transform(df).select("prediction", "probability").collect()
    assert len(platt) == 600 and all((r.probability[1] >= 0) and r.prediction in (0.0, 1.0) for r in platt)


def test_scans_do_not_grow_with_points_or_folds(spark, monkeypatch):
    """Nine points in three folds cost about the scans of the slowest model, not of all."""
    calls = []
    monkeypatch.setattr(H, "reduced", lambda *a, real=H.reduced: (calls.append(1), real(*a))[1])
    df = rows(spark, 200)
    M.svm_search(df, 4, [0.1, 0.01, 0.001], [0.05, 0.5, 5.0], "fold", 3, n_features=16, whole=False, max_iter=8)
    assert len(calls) < 50


def test_maps_equal_the_stages_and_bad_rows_are_refused(spark):
    x = np.random.default_rng(1).normal(0, 1, (50, 5))
    cubic = M.CubicMap(5, 0.2)
    assert np.allclose(cubic(x) @ cubic(x[:3]).T, (0.2 * x @ x[:3].T) ** 3)
    fourier = M.FourierMap(5, 4096, 0.1)
    assert np.allclose(fourier(x) @ fourier(x).T, np.exp(-0.1 * ((x[:, None] - x[None]) ** 2).sum(-1)), atol=0.1)
    df = rows(spark, 60)
    for bad in (df.withColumn("label", F.col("label") * 2), df.withColumn("label", F.when(F.col("id") > 3, F.col("label")))):
        with pytest.raises(ValueError):
            M.svm_poly(4).fit(bad)


def test_cross_validation_takes_joint_folds_and_keeps_their_order(spark):
    df, fits = rows(spark, 300), []

    class Counted(H.MappedSVM):
        def fits(self, *a, **kw):
            fits.append(1)
            return super().fits(*a, **kw)

    svm = Counted(M.CubicMap(4, 0.25), 0.01, max_iter=6)
    scores = M.cv_scores(svm, df, "fold", 3).orderBy("fold").collect()
    assert len(fits) == 1 and [r.fold for r in scores] == [0, 1, 2]
    for r in scores:
        alone = H.MappedSVM(M.CubicMap(4, 0.25), 0.01, max_iter=6).fit(df.where(F.col("fold") != r.fold)).transform(df.where(F.col("fold") == r.fold))
        assert r.score == pytest.approx(alone.where("prediction = label").count() / 100)


def test_network_loss_in_pieces_is_that_of_the_block():
    from tessera.operators import network as N

    rng = np.random.default_rng(0)
    x, y, theta = rng.normal(size=(5000, 3)), rng.integers(0, 2, 5000), rng.normal(size=3 * 100 + 100 + 200 + 2)
    assert np.allclose(N.pieces_loss(x, y, theta, (3, 100, 2)), N.block_loss(x, y, theta, (3, 100, 2)))
