import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.operators import boosting as B


def brute_tree(x, g, h, depth, lam, min_child):
    """Exact greedy split over all values and both sides for the missing ones; prediction per row."""
    value = np.full(len(g), -g.sum() / (h.sum() + lam))
    if depth == 0:
        return value
    best = (1e-9, None)
    for f in range(x.shape[1]):
        v = x[:, f]
        for cut in [*np.unique(v[~np.isnan(v)])[1:], np.inf]:
            for missing_left in (False, True):
                left = np.where(np.isnan(v), missing_left, v < cut)
                if not left.any() or left.all() or h[left].sum() < min_child or h[~left].sum() < min_child:
                    continue
                gain = sum(g[s].sum() ** 2 / (h[s].sum() + lam) for s in (left, ~left)) - g.sum() ** 2 / (h.sum() + lam)
                if gain > best[0] + 1e-9:
                    best = (gain, left)
    if best[1] is None:
        return value
    for side in (best[1], ~best[1]):
        value[side] = brute_tree(x[side], g[side], h[side], depth - 1, lam, min_child)
    return value


def frame(spark, x, y, *more):
    names = [f"f{i}" for i in range(x.shape[1])]
    rows = [tuple(None if math.isnan(v) else float(v) for v in r) + (float(t), *m) for r, t, *m in zip(x, y, *more)]
    kinds = ", ".join(f"{n} double" for n in names) + ", y double" + "".join(f", m{i} {'boolean' if isinstance(m[0], bool) else 'double'}" for i, m in enumerate(more))
    return spark.createDataFrame(rows, kinds).repartition(4), names


@pytest.mark.parametrize("objective,seed", [("squared", 0), ("squared", 1), ("logistic", 2), ("logistic", 3)])
def test_splits_equal_brute_force(spark, objective, seed):
    rng = np.random.default_rng(seed)
    x = rng.integers(0, 12, (150, 3)).astype(float)
    x[rng.random(x.shape) < 0.2] = np.nan
    y = np.where(np.isnan(x[:, 0]), 2.0, x[:, 0] / 4) + rng.normal(size=150) * 0.3
    if objective == "logistic":
        y = (y > np.median(y)).astype(float)
    df, names = frame(spark, x, y)
    model = B.BoostedTrees(names, "y", objective, numRounds=2, eta=0.5, maxDepth=3).fit(df)
    margin = np.full(150, math.log(y.mean() / (1 - y.mean())) if objective == "logistic" else y.mean())
    for _ in range(2):
        p = 1 / (1 + np.exp(-margin))
        g, h = (p - y, p * (1 - p)) if objective == "logistic" else (margin - y, np.ones(150))
        margin = margin + 0.5 * brute_tree(x, g, h, 3, 1.0, 1.0)
    want = 1 / (1 + np.exp(-margin)) if objective == "logistic" else margin
    out = model.transform(df).select(*names, "y", F.col("p" if objective == "logistic" else "prediction").alias("s")).collect()
    key = lambda r: tuple(-1.0 if v is None or math.isnan(v) else v for v in r)
    got = {key(r[:4]): r["s"] for r in out}
    assert all(abs(got[key((*a, t))] - w) < 1e-9 for a, t, w in zip(x, y, want))


def test_missing_direction_is_learned(spark):
    x = np.array([[float(i)] if i % 3 else [np.nan] for i in range(60)])
    y = np.where(np.isnan(x[:, 0]), 1.0, (x[:, 0] >= 30) * 1.0)
    df, names = frame(spark, x, y)
    model = B.BoostedTrees(names, "y", "squared", numRounds=1, eta=1.0, maxDepth=1, reg_lambda=0.0).fit(df)
    assert model.trees[0].feature[0] == 0 and not model.trees[0].missing_left[0]  # with the large values
    assert model.transform(df).where(F.abs(F.col("prediction") - F.col("y")) > 1e-9).isEmpty()


def test_sketch_weights_and_merge():
    rng = np.random.default_rng(0)
    v, w = rng.normal(size=40_000), rng.uniform(0.1, 3, 40_000)
    parts = [B.weighted_sketch(v[i::8], w[i::8], 256).ravel() for i in range(8)]
    while len(parts) > 1:
        parts = [B.merge_sketches(a, b, 256) for a, b in zip(parts[::2], parts[1::2])]
    sketch = parts[0].reshape(2, 256)
    assert abs(sketch[1].sum() - w.sum()) < 1e-6 and list(sketch[0][sketch[1] > 0]) == sorted(sketch[0][sketch[1] > 0])
    order = np.argsort(v)
    share = np.cumsum(w[order]) / w.sum()
    cuts = B.cuts_of(sketch, 32)
    assert len(cuts) == 31
    at = share[np.searchsorted(v[order], cuts) - 1]
    assert np.abs(at - np.arange(1, 32) / 32).max() < 4 / 256 + 0.002
    few = B.weighted_sketch(np.array([3.0, np.nan, 1.0, 3.0]), np.ones(4), 8)
    assert list(few[0][:2]) == [1.0, 3.0] and list(few[1][:3]) == [1.0, 2.0, 0.0] and list(B.cuts_of(few, 4)) == [3.0]


def test_early_stop_weights_and_settled_margins(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(600, 4))
    y = ((x[:, 0] > 0) ^ (rng.random(600) < 0.15)).astype(float)
    df, names = frame(spark, x, y, [bool(i % 4 == 0) for i in range(600)], [1.0 + i % 2 for i in range(600)])
    args = dict(numRounds=60, eta=0.4, maxDepth=3, validationCol="m0", earlyStop=3, weightCol="m1")
    a = B.BoostedTrees(names, "y", "logistic", checkpointInterval=2, **args).fit(df)
    b = B.BoostedTrees(names, "y", "logistic", checkpointInterval=100, **args).fit(df)
    assert 0 < len(a.trees) < 60 and [t.feature for t in a.trees] == [t.feature for t in b.trees]
    losses = [v for _, _, v in a.history]
    assert len(a.trees) == int(np.argmin(losses)) + 1 and len(losses) == len(a.trees) + 3
    assert a.transform(df.where("m0")).where("prediction = y").count() > 0.75 * 150


def test_empty_and_null_labels(spark):
    df, names = frame(spark, np.array([[1.0], [2.0]]), [0.0, 1.0])
    empty = B.BoostedTrees(names, "y", "squared", numRounds=2).fit(df.where("y > 5"))
    assert [r.prediction for r in empty.transform(df).collect()] == [0.0, 0.0]
    null = B.BoostedTrees(names, "y", "squared", numRounds=2).fit(df.withColumn("y", F.when(F.col("y") > 0, F.col("y"))))
    assert {r.prediction for r in null.transform(df).collect()} == {1.0}
    with pytest.raises(ValueError):
        B.BoostedTrees(names, "y", "hinge")


@pytest.mark.parametrize("objective", ["squared", "logistic"])
def test_rows_in_equal_bins_are_one_row_of_the_blocks(spark, objective, monkeypatch):
    rng = np.random.default_rng(7)
    x = rng.integers(0, 4, (6000, 3)).astype(float)
    x[rng.random(x.shape) < 0.05] = np.nan
    y = np.nan_to_num(x[:, 0]) * np.nan_to_num(x[:, 1]) + rng.normal(size=6000)
    if objective == "logistic":
        y = (y > 2).astype(float)
    df, names = frame(spark, x, y, [bool(i % 5 == 0) for i in range(6000)], [1.0 + i % 3 for i in range(6000)])
    args = dict(numRounds=25, eta=0.3, maxDepth=3, validationCol="m0", earlyStop=3, weightCol="m1", checkpointInterval=4)
    a, b = B.BoostedTrees(names, "y", objective, **args), B.BoostedTrees(names, "y", objective, **args)
    held = a._prepare(df).agg(F.sum("n")).first()[0]
    assert held <= 5 ** 3 * 2 * (2 if objective == "logistic" else 1)  # before: a row for each of the 6,000
    a.fit(df)
    monkeypatch.setattr(B, "CELLS", 0)
    assert b._prepare(df).agg(F.sum("n")).first()[0] == 6000
    b.fit(df)
    assert [(t.feature, t.bin, t.missing_left) for t in a.trees] == [(t.feature, t.bin, t.missing_left) for t in b.trees]
    assert np.allclose([v for t in a.trees for v in t.value], [v for t in b.trees for v in t.value], rtol=1e-9, atol=1e-12)
    assert np.allclose([h[1:] for h in a.history], [h[1:] for h in b.history], rtol=1e-9)


def test_rows_are_merged_by_the_cells_that_occur(spark, monkeypatch):
    """Dummies of one column allow few of the combinations that their bins would; before: a row for each of the 20,000."""
    rng = np.random.default_rng(8)
    day, v = rng.integers(0, 12, 20_000), rng.integers(0, 30, 20_000)
    x = np.column_stack([v.astype(float), *[(day == i).astype(float) for i in range(1, 12)]])
    x[rng.random(20_000) < 0.05, 0] = np.nan
    y = (rng.random(20_000) < 1 / (1 + np.exp(1 - v / 15 - (day > 8)))).astype(float)
    df, names = frame(spark, x, y, [bool(i % 5 == 0) for i in range(20_000)])
    args = dict(numRounds=8, eta=0.3, maxDepth=3, validationCol="m0", checkpointInterval=3)
    a, b = B.BoostedTrees(names, "y", "logistic", **args), B.BoostedTrees(names, "y", "logistic", **args)
    held = a._prepare(df).select("n", "rows", "w").collect()
    assert sum(r.n for r in held) <= 31 * 12 * 2 and sum(np.frombuffer(r["rows"]).sum() for r in held) == 20_000
    a.fit(df)
    monkeypatch.setattr(B, "CELLS", 0)
    assert b._prepare(df).agg(F.sum("n")).first()[0] == 20_000
    b.fit(df)
    assert [(t.feature, t.bin, t.missing_left) for t in a.trees] == [(t.feature, t.bin, t.missing_left) for t in b.trees]
    assert np.allclose([v for t in a.trees for v in t.value], [v for t in b.trees for v in t.value], rtol=1e-9, atol=1e-12)
    assert np.allclose([h[1:] for h in a.history], [h[1:] for h in b.history], rtol=1e-9)


@pytest.mark.parametrize("cells", [1, 300, 50_000])
def test_sketch_counts_the_cells(cells):
    at = np.random.default_rng(cells).integers(0, cells, 120_000)
    bins = np.column_stack([at % 64, at // 64 % 64, at // 4096]).astype(np.uint16)
    parts = [B.cell_sketch(bins[i::3], at[i::3] % 2 == 0) for i in range(3)]
    assert abs(B.cells_of(np.maximum.reduce(parts)) / len(set(at)) - 1) < 0.08
