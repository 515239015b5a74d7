import numpy as np

from tessera.operators import cluster as C
from tessera.sources.generators import blobs
from pyspark.ml.feature import VectorAssembler


def frame(spark):
    df = blobs(spark, 500, centers=5, std=0.6, seed=1)
    return VectorAssembler(inputCols=["x0", "x1"], outputCol="features").transform(df).repartition(3)


def plain(x, c, max_iter, tol=1e-4):
    for n in range(1, max_iter + 1):
        own = ((x[:, None] - c[None]) ** 2).sum(2).argmin(1)
        new = np.array([x[own == j].mean(0) if (own == j).any() else c[j] for j in range(len(c))])
        moved, c = np.sqrt(((new - c) ** 2).sum(1)).max(), new
        if moved <= tol:
            break
    return c, ((x[:, None] - c[None]) ** 2).sum(2).min(1).sum(), n


def test_all_k_equal_separate_runs(spark):
    df = frame(spark)
    x = np.array([list(r.features) for r in df.collect()])
    ks = list(range(1, 11))
    starts = C.seeds(df, ks, seed=3)
    together = C.lloyd(df, starts)
    for (c, inertia, n), s in zip(together, starts):
        want = plain(x, s, 300)
        assert np.allclose(c, want[0], atol=1e-9) and abs(inertia - want[1]) < 1e-8 * want[1] and n == want[2]
    alone = C.lloyd(df, [starts[4]])[0]
    assert np.allclose(alone[0], together[4][0]) and alone[2] == together[4][2]
    curve = [r.inertia for r in C.elbow(df, ks, seed=3).collect()]
    assert abs(curve[0] - C.kmeans_cost_one(df)) < 1e-6 and all(a >= b - 1e-9 for a, b in zip(curve, curve[1:4]))
    assert curve[4] < 0.2 * curve[0]


def test_limits(spark):
    df = frame(spark)
    assert C.lloyd(df, [np.array([[0.0, 0.0], [1e6, 1e6]])], maxIter=1)[0][2] == 1
    far = C.lloyd(df, [np.array([[0.0, 0.0], [1e6, 1e6]])])[0][0]
    assert list(far[1]) == [1e6, 1e6]  # without rows it stays
    assert [r.inertia for r in C.elbow(df.where("id < 0"), [1, 2]).collect()] == [0.0, 0.0]


def test_a_scan_adds_up_only_what_it_needs(spark, monkeypatch):
    """Rows are not added one by one to their centres (``np.add.at``)."""
    df = frame(spark)
    starts = C.seeds(df, [3], seed=2)
    x = np.array([r[0].toArray() for r in df.select("features").collect()])
    want = plain(x, starts[0], 50)
    (centres, inertia, rounds), = C.lloyd(df, starts, maxIter=50)
    assert np.allclose(centres, want[0]) and np.isclose(inertia, want[1]) and rounds == want[2]
    assert "add.at" not in __import__("inspect").getsource(C.lloyd)
