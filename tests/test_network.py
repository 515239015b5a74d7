import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from tessera.operators import network as N
from tessera.operators.blocks import array, pack, reduced
from tessera.operators.models import mlp
from tessera.operators.network import PerceptronNetwork, block_loss, lbfgs


def test_gradient_by_finite_differences():
    rng = np.random.default_rng(2)
    for sizes in [(3, 4, 2), (5, 7, 6, 3), (2, 3)]:
        x, y = rng.normal(size=(9, sizes[0])), rng.integers(0, sizes[-1], 9)
        theta = rng.normal(size=sum(a * b + b for a, b in zip(sizes, sizes[1:]))) * 0.5
        got = block_loss(x, y, theta, sizes)
        assert got[1] == 9
        for i in range(len(theta)):
            e = np.zeros(len(theta))
            e[i] = 1e-6
            slope = (block_loss(x, y, theta + e, sizes)[0] - block_loss(x, y, theta - e, sizes)[0]) / 2e-6
            assert abs(slope - got[2 + i]) < 1e-5 * max(1, abs(slope))


def test_lbfgs_on_known_functions():
    a = np.diag(np.logspace(0, 3, 12))
    x, values = lbfgs(lambda v: (0.5 * v @ a @ v - v.sum(), a @ v - 1), np.zeros(12), 200, 1e-9)
    assert np.allclose(x, 1 / np.diag(a), atol=1e-7) and all(p >= q for p, q in zip(values, values[1:]))

    def banana(v):
        return ((1 - v[0]) ** 2 + 100 * (v[1] - v[0] ** 2) ** 2,
                np.array([-2 * (1 - v[0]) - 400 * v[0] * (v[1] - v[0] ** 2), 200 * (v[1] - v[0] ** 2)]))

    assert np.allclose(lbfgs(banana, np.array([-1.2, 1.0]), 200, 1e-8)[0], [1, 1], atol=1e-5)


def test_blocks_hold_all_rows(spark):
    df = spark.range(1000).select(F.array(F.col("id").cast("double"), F.lit(2.0)).alias("f"), F.col("id").alias("y")).repartition(7)
    blocks = pack(df, F.col("f"), ["y"], rows=64)
    total = reduced(blocks, lambda r: np.array([r["n"], array(r["x"], r["n"])[:, 0].sum(), array(r["y"], r["n"]).sum()]))
    assert list(total) == [1000, 499500, 499500]
    assert reduced(pack(df.where("y < 0"), F.col("f"), ["y"]), lambda r: np.ones(1)) is None
    assert reduced(blocks.repartition(70), lambda r: np.ones(1))[0] == blocks.count()


def rings(spark, n=1500):
    rng = np.random.default_rng(0)
    r, t = rng.integers(0, 3, n), rng.uniform(0, 6.28, n)
    x = np.stack([(r + 1) * np.cos(t), (r + 1) * np.sin(t)], 1) + rng.normal(size=(n, 2)) * 0.15
    df = spark.createDataFrame([(float(a), float(b), float(c), i % 4 == 0) for i, (a, b, c) in enumerate(zip(x[:, 0], x[:, 1], r))],
                               "x double, y double, label double, test boolean")
    return VectorAssembler(inputCols=["x", "y"], outputCol="features").transform(df)


def test_accuracy_not_below_sparks_network(spark):
    data = rings(spark)
    train, test = data.where("not test"), data.where("test")

    def accuracy(model):
        return model.transform(test).where("prediction = label").count() / test.count()

    ours = PerceptronNetwork((30, 30), max_iter=60).fit(train)
    assert accuracy(ours) >= max(0.95, accuracy(mlp(2, (30, 30), 3, maxIter=60).fit(train)))
    out = ours.transform(test).select("probability").first()[0]
    assert abs(sum(out) - 1) < 1e-9 and ours.history == sorted(ours.history, reverse=True)


def test_penalty_labels_and_errors(spark):
    data = rings(spark, 300).withColumn("label", F.concat(F.lit("c"), F.col("label").cast("int").cast("string")))
    free = PerceptronNetwork((8,), alpha=0.0, max_iter=15).fit(data)
    bound = PerceptronNetwork((8,), alpha=100.0, max_iter=15).fit(data.unionByName(data.limit(5).withColumn("label", F.lit(None).cast("string"))))
    assert free.classes == bound.classes == ["c0", "c1", "c2"]
    assert np.abs(bound.theta).sum() < np.abs(free.theta).sum()
    assert {r[0] for r in free.transform(data).select("prediction").distinct().collect()} <= set(free.classes)
    with pytest.raises(ValueError):
        PerceptronNetwork((8,)).fit(data.where("label = 'c0'"))


def test_pieces_share_their_memory_and_give_the_plain_sums():
    rng = np.random.default_rng(3)
    x, y = rng.normal(size=(5000, 4)), rng.integers(0, 3, 5000)
    for sizes in ((4, 60, 3), (4, 60, 50, 3)):
        theta = rng.normal(size=sum(a * b + b for a, b in zip(sizes, sizes[1:])))
        whole, x0 = N.block_loss(x, y, theta, sizes), x.copy()
        assert np.allclose(N.pieces_loss(x, y, theta, sizes), whole, rtol=1e-9, atol=1e-9) and np.array_equal(x, x0)
        p = N._forward(x, N._layers(theta, sizes))[-1]
        assert np.isclose(whole[0], -np.log(p[np.arange(5000), y]).sum()) and np.allclose(p.sum(1), 1)
