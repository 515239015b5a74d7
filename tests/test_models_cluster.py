import random

import numpy as np
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from tessera.operators import cluster as C
from tessera.operators import models as M
from tessera.operators.trees import BestFirstTree, BoostedTrees
from tessera.sources.generators import blobs


def _numpy_gd(X, y, alpha, eps, max_iter):
    m, n = X.shape
    b, w = 0.0, np.zeros((1, n))
    y = y.reshape(m, 1)
    hist, it = [-1], 0
    while True:
        h = b + X @ w.T
        db, dw = np.sum(h - y) / m, ((h - y).T @ X) / m
        b, w = b - alpha * db, w - alpha * dw
        hist.append(np.sum((b + X @ w.T - y) ** 2) / (2 * m))
        if max_iter and it > max_iter:
            break
        elif abs(hist[it - 1] - hist[it]) < eps:
            break
        it += 1
    return b, w.ravel(), hist


def test_gradient_descent_matches_plain_loop(spark):
    rng = np.random.default_rng(2021)
    X = rng.normal(size=(200, 2))
    y = 3 + X @ np.array([1.5, -2.0]) + rng.normal(scale=0.1, size=200)
    df = spark.createDataFrame([(float(a), float(b), float(t)) for (a, b), t in zip(X, y)], "x1 double, x2 double, y double")
    for max_iter, eps in [(5, 1e-12), (10000, 1e-8)]:
        mdl = M.LinearRegressionGD(["x1", "x2"], "y", alpha=0.1, eps=eps, max_iter=max_iter).fit(df)
        b, w, hist = _numpy_gd(X, y, 0.1, eps, max_iter)
        assert len(mdl.history) == len(hist)
        assert abs(mdl.intercept - b) < 1e-9 and np.allclose(mdl.coef, w, atol=1e-9)
        assert np.allclose(mdl.history[1:], hist[1:], rtol=1e-9)
    assert len(M.LinearRegressionGD(["x1"], "y", alpha=0.1, eps=-1, max_iter=5).fit(df).history) == 1 + 7


def test_trees_and_boosting(spark):
    rng = np.random.default_rng(1)
    X = rng.normal(size=(600, 3))
    y = ((X[:, 0] > 0.2) & (X[:, 1] < 0.5)).astype(int)
    df = spark.createDataFrame([(float(a), float(b), float(c), int(t)) for (a, b, c), t in zip(X, y)],
                               "a double, b double, c double, y int")
    t = BestFirstTree(["a", "b", "c"], "y", maxLeaves=6, maxDepth=6).fit(df)
    assert 2 <= t.n_leaves() <= 6
    acc = t.transform(df).select(F.avg((F.col("prediction") == F.col("y")).cast("double"))).first()[0]
    assert acc > 0.95
    bt = BoostedTrees(["a", "b", "c"], "y", "logistic", numRounds=8, eta=0.5, maxDepth=3).fit(df)
    acc2 = bt.transform(df).select(F.avg((F.col("prediction") == F.col("y")).cast("double"))).first()[0]
    assert acc2 > 0.95


def test_svm_maps_and_platt(spark):
    rng = np.random.default_rng(4)
    X = rng.normal(size=(300, 2))
    y = (X[:, 0] ** 2 + X[:, 1] ** 2 < 1.0).astype(float)
    df = spark.createDataFrame([(float(a), float(b), float(t), i % 3) for i, ((a, b), t) in enumerate(zip(X, y))],
                               "a double, b double, label double, fold int")
    df = VectorAssembler(inputCols=["a", "b"], outputCol="features").transform(df)
    cub = M.CubicFeatures("features", "z", 2, 1.0)
    assert len(cub.idx) == 4
    rbf = M.svm_rbf(2, C=10.0, n=300, gamma=1.0, n_features=128).fit(df)
    acc = rbf.transform(df).select(F.avg((F.col("prediction") == F.col("label")).cast("double"))).first()[0]
    assert acc > 0.85
    pm = M.PlattScaler(M.svm_rbf(2, C=10.0, n=200, gamma=1.0, n_features=64), "fold", k=3).fit(df)
    probs = [r.p for r in M.predict_proba(pm, df).select("p").collect()]
    assert all(0.0 <= p <= 1.0 for p in probs)


def _union_find(nodes, edges):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in edges:
        ra, rb = find(a), find(b)
        if ra != rb:
            parent[max(ra, rb)] = min(ra, rb)
    comp = {}
    for n in nodes:
        comp.setdefault(find(n), []).append(n)
    return {n: min(v) for v in comp.values() for n in v}


def test_components_match_union_find(spark):
    random.seed(2)
    nodes = list(range(300))
    edges = [(random.choice(nodes), random.choice(nodes)) for _ in range(220)]
    exp = _union_find(nodes, edges)
    got = {r.node: r.component for r in C.components(
        spark.createDataFrame(edges, "src long, dst long"),
        nodes=spark.createDataFrame([(n,) for n in nodes], "node long")).collect()}
    assert got == exp


def _textbook_dbscan(P, eps, min_samples):
    n = len(P)
    d2 = ((P[:, None, :] - P[None, :, :]) ** 2).sum(-1)
    nb = [np.nonzero(d2[i] <= eps * eps)[0] for i in range(n)]
    core = np.array([len(x) >= min_samples for x in nb])
    labels = -np.ones(n, dtype=int)
    k = 0
    for i in range(n):
        if labels[i] != -1 or not core[i]:
            continue
        labels[i] = k
        stack = [i]
        while stack:
            j = stack.pop()
            if not core[j]:
                continue
            for q in nb[j]:
                if labels[q] == -1:
                    labels[q] = k
                    stack.append(q)
        k += 1
    return labels, core


def test_dbscan_matches_textbook(spark):
    pts = blobs(spark, 150, centers=3, std=0.5, seed=3).orderBy("id").collect()
    P = np.array([[r.x0, r.x1] for r in pts])
    exp_labels, exp_core = _textbook_dbscan(P, 0.6, 6)
    df = spark.createDataFrame([(int(r.id), float(r.x0), float(r.x1)) for r in pts], "id long, x double, y double")
    got = {r.id: (r.label, r.is_core) for r in C.dbscan(df, "id", ["x", "y"], 0.6, 6).collect()}
    for i in range(len(P)):
        lab, core = got[i]
        assert core == bool(exp_core[i])
        if exp_core[i] or exp_labels[i] == -1:
            assert lab == exp_labels[i], i


def test_kmeans_cost_one(spark):
    rng = np.random.default_rng(0)
    X = rng.normal(size=(50, 3))
    df = spark.createDataFrame([(list(map(float, x)),) for x in X], "a array<double>")
    from pyspark.ml.functions import array_to_vector
    df = df.select(array_to_vector("a").alias("features"))
    assert abs(C.kmeans_cost_one(df) - ((X - X.mean(0)) ** 2).sum()) < 1e-9
    el = {r.k: r.inertia for r in C.elbow(df, [1, 2, 3]).collect()}
    assert el[1] >= el[2] >= el[3] * 0.999


def test_dbscan_dense_configurations(spark):
    for seed, n, std, eps, ms in [(7, 400, 0.3, 0.5, 10), (8, 400, 0.2, 0.4, 30), (9, 250, 1.0, 0.3, 3)]:
        pts = blobs(spark, n, centers=3, std=std, seed=seed).orderBy("id").collect()
        P = np.array([[r.x0, r.x1] for r in pts])
        exp_labels, exp_core = _textbook_dbscan(P, eps, ms)
        df = spark.createDataFrame([(int(r.id), float(r.x0), float(r.x1)) for r in pts], "id long, x double, y double")
        got = {r.id: (r.label, r.is_core) for r in C.dbscan(df, "id", ["x", "y"], eps, ms).collect()}
        for i in range(len(P)):
            lab, core = got[i]
            assert core == bool(exp_core[i]), (seed, i)
            if exp_core[i] or exp_labels[i] == -1:
                assert lab == exp_labels[i], (seed, i)
            else:  # border: lowest cluster among its core neighbours
                d2 = ((P - P[i]) ** 2).sum(1)
                nbr = [exp_labels[j] for j in np.nonzero(d2 <= eps * eps)[0] if exp_core[j]]
                assert lab == min(nbr), (seed, i)


def _kruskal_labels(P, k):
    n = len(P)
    d2 = ((P[:, None, :] - P[None, :, :]) ** 2).sum(-1)
    edges = sorted((d2[i, j], i, j) for i in range(n) for j in range(i + 1, n))
    parent = list(range(n))

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    comps = n
    for _, i, j in edges:
        if comps == k:
            break
        a, b = find(i), find(j)
        if a != b:
            parent[max(a, b)] = min(a, b)
            comps -= 1
    return [find(i) for i in range(n)]


def test_single_linkage_matches_kruskal(spark):
    pts = blobs(spark, 120, centers=4, std=0.8, seed=5).orderBy("id").collect()
    P = np.array([[r.x0, r.x1] for r in pts])
    df = spark.createDataFrame([(int(r.id), float(r.x0), float(r.x1)) for r in pts], "id long, x double, y double")
    for k in (4, 7):
        exp = _kruskal_labels(P, k)
        got = {r.id: r.label for r in C.single_linkage(df, "id", ["x", "y"], k).collect()}
        assert len(set(got.values())) == k
        # same partition: two points share a label exactly when they share a root
        pairs_exp = {(i, j) for i in range(len(P)) for j in range(i + 1, len(P)) if exp[i] == exp[j]}
        pairs_got = {(i, j) for i in range(len(P)) for j in range(i + 1, len(P)) if got[i] == got[j]}
        assert pairs_exp == pairs_got


def test_feature_maps_hold_few_rows_at_once(spark, monkeypatch):
    """A batch is mapped in pieces of bounded size, with the same values."""
    import pandas as pd

    xs = pd.Series([np.array([float(i), 1.0]) for i in range(1000)])
    sizes = [len(p) for p in M._parts(xs, M.MAP_VALUES // 100)]
    assert max(sizes) == 100 and sum(sizes) == 1000
    df = spark.createDataFrame([(i, [float(i), 2.0]) for i in range(50)], "id int, features array<double>").coalesce(1)
    plain = {r.id: r.z.toArray() for r in M.CubicFeatures("features", "z", 2).transform(df).collect()}
    monkeypatch.setattr(M, "MAP_VALUES", 8)
    small = {r.id: r.z.toArray() for r in M.CubicFeatures("features", "z", 2).transform(df).collect()}
    assert len(small) == 50 and all((plain[i] == small[i]).all() for i in plain)
    assert np.allclose(small[3], [27, 3 ** 0.5 * 18, 3 ** 0.5 * 12, 8])
