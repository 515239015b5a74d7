import glob
import os

import numpy as np
from pyspark.ml import Pipeline
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from tessera.operators import models as M
from tessera.plans import model_queries as Q


def newton(m, y):
    """The smoothed sigmoid fit in numpy."""
    pos, neg = (y == 1).sum(), (y != 1).sum()
    t = np.where(y == 1, (pos + 1) / (pos + 2), 1 / (neg + 2))
    v = np.array([0.0, np.log((neg + 1) / (pos + 1))])
    x = np.stack([m, np.ones_like(m)], 1)

    def loss(v):
        z = x @ v
        return (np.logaddexp(0, z) - (1 - t) * z).sum()

    for _ in range(200):
        p = 1 / (1 + np.exp(x @ v))
        g = x.T @ (t - p)
        d = -np.linalg.solve(x.T @ (x * (p * (1 - p))[:, None]) + 1e-12 * np.eye(2), g)
        s = 1.0
        while s > 1e-12 and loss(v + s * d) > loss(v) + 1e-4 * s * (g @ d):
            s /= 2
        v = v + s * d
        if np.abs(g).max() < 1e-12 * len(y):
            break
    return v


def test_sigmoid_equals_numpy(spark):
    for seed, gap in ((0, 1.0), (1, 8.0)):  # the second is separable: only the smoothed targets keep it finite
        rng = np.random.default_rng(seed)
        y = rng.integers(0, 2, 300).astype(float)
        m = (y - 0.4) * gap + rng.uniform(-1, 1, 300)
        df = spark.createDataFrame([(float(a), float(b)) for a, b in zip(m, y)], "m double, y double").repartition(3)
        assert np.allclose(M.fit_sigmoid(df, "m", "y"), newton(m, y), atol=1e-8, rtol=1e-8)
    assert M.fit_sigmoid(df.where("y > 5"), "m", "y") == (0.0, 0.0)


def test_flow_encodes_and_predicts_the_unlabelled(spark, monkeypatch, tmpdir_path):
    data, cols = Q._flow_table(spark, "/root/testdata/sf0.001")
    assert [c for c in cols if c.startswith("day_")] and {c for c in cols if c not in data.columns} == set()
    unlabelled = {r[0] for r in data.where("label is null").select("event_id").collect()}
    assert unlabelled == {r[0] for r in data.where("event_id % 9 = 0").select("event_id").collect()}
    assert set(Q._flow_models(cols, 10)) == {"RandomForest", "SVC_poly", "Boosted", "MLP"}
    both = {name: Pipeline(stages=[VectorAssembler(inputCols=used, outputCol="features"), LogisticRegression(labelCol="label")])
            for name, used in (("a", cols), ("b", [f"{c}_s" for c in cols]))}
    monkeypatch.setattr(Q, "_flow_models", lambda cols, n: both)
    out = Q.compare_models(spark, "/root/testdata/sf0.001").collect()
    assert {(r.model, r.event_id) for r in out} == {(m, i) for m in "ab" for i in unlabelled} and len(out) == 2 * len(unlabelled)
    scores = {(r.model, r.fold): r.score for r in Q.cv_models(spark, "/root/testdata/sf0.001").collect()}
    assert set(scores) == {(m, f) for m in "ab" for f in (-2, -1, 0, 1, 2, 3, 4)}
    assert abs(scores["a", -1] - np.mean([scores["a", f] for f in range(5)])) < 1e-12
    path = os.path.join(tmpdir_path, "files")
    train, rest = data.where("label is not null"), data.where("label is null")
    M.compare_models(both, train, rest, "event_id", out_path=path)
    assert sorted(os.path.basename(p) for p in glob.glob(path + "/model=*")) == ["model=a", "model=b"]
    assert spark.read.option("header", True).csv(path).where(F.col("model") == "a").count() == len(unlabelled)
