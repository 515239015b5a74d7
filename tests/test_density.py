import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.operators import density as D


def textbook(ids, x, eps, least):
    """Plain expansion in the order of the ids."""
    near = [[j for j in range(len(x)) if ((x[i] - x[j]) ** 2).sum() <= eps * eps] for i in range(len(x))]
    core = [len(n) >= least for n in near]
    label, k = [-1] * len(x), 0
    for i in np.argsort(ids):
        if core[i] and label[i] < 0:
            stack, label[i] = [i], k
            while stack:
                for j in near[stack.pop()]:
                    if core[j] and label[j] < 0:
                        label[j] = k
                        stack.append(j)
            k += 1
    for i in range(len(x)):
        if not core[i]:
            label[i] = min((label[j] for j in near[i] if core[j]), default=-1)
    return {(int(i), l, c) for i, l, c in zip(ids, label, core)}


def frame(spark, ids, x):
    return spark.createDataFrame([(int(i), [float(v) for v in r]) for i, r in zip(ids, x)], "id long, v array<double>").repartition(4)


@pytest.mark.parametrize("d,eps,leaf", [(2, 0.4, 30), (8, 1.6, 50), (64, 8.5, 80)])
def test_equals_textbook_expansion(spark, d, eps, leaf):
    rng = np.random.default_rng(d)
    centres = rng.normal(size=(4, d)) * 3
    x = np.concatenate([centres[rng.integers(0, 4, 220)] + rng.normal(size=(220, d)) * (0.3 if d < 64 else 0.8), rng.normal(size=(40, d)) * 4])
    ids = rng.permutation(260) * 5 + 1
    df = frame(spark, ids, x)
    want = textbook(ids, x, eps, 5)
    got = {tuple(r) for r in D.dbscan_nd(df, "id", F.col("v"), eps, 5, leaf).collect()}
    assert got == want and len({l for _, l, _ in want}) > 2
    assert D.replication(df, "id", F.col("v"), eps, leaf) > 1 and D.replication(df, "id", F.col("v"), eps, 10_000) == 1


def test_edge_rows(spark):
    df = spark.createDataFrame([(1, [0.0, 0.0]), (2, [0.0, 0.0]), (3, [None, 1.0]), (None, [0.0, 0.0]), (4, None), (5, [9.0, float("nan")]), (6, [5.0, 5.0])],
                               "id long, v array<double>")
    assert {tuple(r) for r in D.dbscan_nd(df, "id", F.col("v"), 0.5, 2).collect()} == {(1, 0, True), (2, 0, True), (6, -1, False)}
    assert D.dbscan_nd(df.where("id > 100"), "id", F.col("v"), 0.5, 2).collect() == []


def test_matrix_product_decides_as_the_plain_sum_does(spark):
    """No cube of differences: pairs are decided by one product, those at the limit by the plain sum."""
    rng = np.random.default_rng(4)
    x = rng.integers(0, 3, (300, 64)).astype(float) / 10 + 1000.0
    for limit in (0.0, D._square(x[0], x[1]), 1.15):
        assert (D._within(x[:100], x, limit) == (D._square(x[:100, None, :], x[None, :, :]) <= limit)).all()


def test_groups_are_bounded_where_all_points_are_near(spark):
    """No task holds more than two groups, also where eps reaches every point and no cut can part them."""
    rng = np.random.default_rng(7)
    x = np.concatenate([np.zeros((150, 64)), rng.normal(size=(150, 64)) * 0.01, rng.normal(size=(20, 64)) * 9])
    df = frame(spark, np.arange(320) * 3, x).withColumn("id", F.concat(F.lit("v"), F.lpad(F.col("id").cast("string"), 5, "0")))
    groups, many = D._groups(D._points(df, "id", F.col("v")), 40)
    held = groups.select("n", F.spark_partition_id().alias("p")).collect()
    assert max(r.n for r in held) <= 40 and len({r.p for r in held}) == len(held) == many >= 8
    want = {(f"v{i:05d}", l, c) for i, l, c in textbook(np.arange(320) * 3, x, 1.0, 200)}
    assert {tuple(r) for r in D.dbscan_nd(df, "id", F.col("v"), 1.0, 200, 40).collect()} == want
    assert sum(c for _, _, c in want) == 300


def test_tiles_decide_as_the_plain_sum_does():
    """Single precision settles only pairs clear of the limit."""
    rng = np.random.default_rng(5)
    x, y = rng.integers(0, 3, (300, 64)) / 10, rng.integers(0, 3, (2500, 64)) / 10
    for off, limit in ((0.0, float(D._square(x[0], y[0]))), (0.0, 0.8), (1e6, 1.15)):
        a, b = D._Side(x + off, limit), D._Side(y + off, limit)
        assert a.single == b.single == (off == 0)
        got = [np.stack(D._near(a, b, 0, j, limit)) for j in range(0, 2500, D.TILE[1])]
        want = np.nonzero(D._square((x + off)[:, None, :], (y + off)[None, :, :]) <= limit)
        assert set(map(tuple, np.concatenate(got, axis=1).T)) == set(zip(*want)) and len(want[0]) > 100


def test_pairs_handed_on_are_few():
    """A point that is not a sure core within a task has fewer than ``min_samples`` pairs there."""
    rng = np.random.default_rng(6)
    x = np.concatenate([rng.normal(size=(900, 8)) * 0.1, rng.normal(size=(300, 8)) * 3])
    count, root, pending = D._compare(x, None, np.ones(1200, int), np.arange(1200), 1.0, 5)
    near = D._square(x[:, None, :], x[None, :, :]) <= 1.0
    assert (count == near.sum(1)).all() and pending.shape[1] <= 4 * (count < 5).sum()
    assert (root[:900] == 0).all() and (root[count < 5] == np.flatnonzero(count < 5)).all()
