import math

import numpy as np
import pytest

from tessera.operators import linkage as L


def kruskal(ids, x):
    """All merges of a few points by the order (square, smaller id, larger id)."""
    edges = sorted((float(sum((a - b) * (a - b) for a, b in zip(x[i], x[j]))), *sorted((int(ids[i]), int(ids[j]))))
                   for i in range(len(ids)) for j in range(i))
    up = {int(i): int(i) for i in ids}

    def top(i):
        while up[i] != i:
            i = up[i]
        return i

    out = []
    for e in edges:
        a, b = top(e[1]), top(e[2])
        if a != b:
            up[b] = a
            out.append(e)
    return out


def frame(spark, ids, x):
    cols = [f"c{i}" for i in range(x.shape[1])]
    return spark.createDataFrame([(int(i), *map(float, r)) for i, r in zip(ids, x)], "id long, " + ", ".join(f"{c} double" for c in cols)) \
        .repartition(5), cols


def shapes(rng, n, d, kind):
    if kind == 0:
        return rng.normal(size=(n, d))
    if kind == 1:  # ties and repeated points
        return rng.integers(0, 4, (n, d)).astype(float)
    if kind == 2:  # two far groups of different density
        return np.concatenate([rng.normal(size=(n // 2, d)) * 0.1, rng.normal(size=(n - n // 2, d)) + 8])
    return np.stack([np.linspace(0, 5, n), *[np.round(rng.normal(size=n), 1)] * (d - 1)], 1)  # a long chain


def test_local_tree_equals_kruskal_on_200_sets():
    for seed in range(200):
        rng = np.random.default_rng(seed)
        x = shapes(rng, int(rng.integers(2, 40)), int(rng.integers(1, 4)), seed % 4)
        assert L.local_tree(x) == kruskal(range(len(x)), x)


def test_spanning_tree_of_200_sets(spark, monkeypatch):
    """200 seeded sets far from each other in one table: the tree holds the tree of each set, and
    fewer rounds than log2 of the points are taken."""
    ids, x, sets = [], [], []
    for seed in range(200):
        rng = np.random.default_rng(seed)
        part = shapes(rng, int(rng.integers(2, 24)), 2, seed % 4) + np.array([seed % 20, seed // 20]) * 1024.0
        own = np.arange(len(ids), len(ids) + len(part))
        ids, x = [*ids, *own], [*x, *part]
        sets.append((own, part))
    x, n = np.array(x), len(ids)
    ids = np.random.default_rng(1).permutation(n) * 3
    rounds = []
    inner = L.components
    monkeypatch.setattr(L, "components", lambda *a, **k: rounds.append(1) or inner(*a, **k))
    df, cols = frame(spark, ids, x)
    got = sorted((r.d2, r.a, r.b) for r in L.spanning_tree(df, "id", cols, leaf_points=256).collect())
    assert len(got) == n - 1 and 0 < len(rounds) <= math.log2(n)
    groups = {int(ids[i]): k for k, (own, _) in enumerate(sets) for i in own}
    inside = sorted(s for s, a, b in got if groups[a] == groups[b])
    assert inside == sorted(s for own, part in sets for s, _, _ in kruskal([ids[i] for i in own], x[own]))
    assert sum(groups[a] != groups[b] for _, a, b in got) == 199


@pytest.mark.parametrize("d,kind", [(3, 2), (8, 0)])
def test_cut_equals_kruskal(spark, d, kind):
    rng = np.random.default_rng(d)
    x = shapes(rng, 150, d, kind)
    ids = rng.permutation(150) + 7
    df, cols = frame(spark, ids, x)
    # edges of equal points may hang differently, all others are unique
    want = [e for e in kruskal(ids, x) if e[0] > 0]
    tree = [(r.d2, r.a, r.b) for r in L.spanning_tree(df, "id", cols, leaf_points=40).collect()]
    assert sorted(s for s, _, _ in tree if s > 0) == sorted(s for s, _, _ in want) and len(tree) == 149
    out = L.cut_tree(df, "id", cols, 4, leaf_points=40).collect()
    keep = sorted(tree)[:-3]
    up = {int(i): int(i) for i in ids}
    for _, a, b in keep:
        old, new = max(up[a], up[b]), min(up[a], up[b])
        up = {k: new if v == old else v for k, v in up.items()}
    names = sorted(set(up.values()))
    assert {(r.id, r.label) for r in out} == {(i, names.index(c)) for i, c in up.items()}
    assert {r.height for r in out} == {math.sqrt(keep[-1][0])}


def test_small_and_missing(spark):
    empty = spark.createDataFrame([], "id long, x double")
    assert L.spanning_tree(empty, "id", ["x"]).collect() == [] and L.cut_tree(empty, "id", ["x"], 3).collect() == []
    df = spark.createDataFrame([(1, 2.0), (2, 2.0), (3, None), (4, float("nan")), (None, 1.0), (5, 7.0)], "id long, x double")
    assert sorted(tuple(r) for r in L.merge_table(df, "id", ["x"]).collect()) == [(1, 2, 0.0), (1, 5, 5.0)]
    assert sorted(tuple(r) for r in L.cut_tree(df, "id", ["x"], 2).collect()) == [(1, 0, 0.0), (2, 0, 0.0), (5, 1, 0.0)]
    words = spark.createDataFrame([("b", 0.0), ("a", 1.0), ("c", 5.0)], "id string, x double")
    assert sorted(tuple(r) for r in L.merge_table(words, "id", ["x"]).collect()) == [("a", "b", 1.0), ("a", "c", 4.0)]


def greedy_complete(ids, x):
    """Heights (squared) and members of all merges by plain greedy merging."""
    far = {frozenset((i, j)): float(sum((a - b) * (a - b) for a, b in zip(x[i], x[j]))) for i in range(len(ids)) for j in range(i)}
    groups = {i: {int(ids[i])} for i in range(len(ids))}
    out = []
    while len(groups) > 1:
        d2, a, b = min((far[frozenset((i, j))], i, j) for i in groups for j in groups if i < j)
        for k in groups:
            if k not in (a, b):
                far[frozenset((a, k))] = max(far[frozenset((a, k))], far[frozenset((b, k))])
        out.append((d2, *sorted((min(groups[a]), min(groups[b])))))
        groups[a] |= groups.pop(b)
    return sorted(out)


def test_complete_merges_equal_greedy_on_60_sets(spark):
    """60 random sets of 40 points far from each other in one table, cut in many leaves."""
    ids, x, want = [], [], []
    for seed in range(60):
        part = np.random.default_rng(seed).normal(size=(40, 2)) + np.array([seed % 10, seed // 10]) * 1024.0
        ids, x = [*ids, *range(len(ids), len(ids) + 40)], [*x, *part]
    ids, x = np.random.default_rng(1).permutation(2400) * 3, np.array(x)
    for seed in range(60):
        want += greedy_complete(ids[40 * seed:40 * seed + 40], x[40 * seed:40 * seed + 40])
    df, cols = frame(spark, ids, x)
    got = sorted((r.d2, r.a, r.b) for r in L.complete_merges(df, "id", cols, leaf_clusters=150, max_height=500.0).collect())
    assert got == sorted(want)


@pytest.mark.parametrize("d,leaf", [(1, 12), (2, 12), (3, 25), (2, 2048)])
def test_complete_linkage_equals_greedy(spark, d, leaf):
    rng = np.random.default_rng(d + leaf)
    x, ids = rng.normal(size=(70, d)), rng.permutation(70) + 5
    df, cols = frame(spark, ids, x)
    want = greedy_complete(ids, x)
    assert sorted((r.d2, r.a, r.b) for r in L.complete_merges(df, "id", cols, leaf).collect()) == want
    if leaf == 2048:
        up = {int(i): int(i) for i in ids}
        for _, a, b in want[:-3]:
            old, new = max(up[a], up[b]), min(up[a], up[b])
            up = {k: new if v == old else v for k, v in up.items()}
        names = sorted(set(up.values()))
        out = L.complete_linkage(df, "id", cols, 4).collect()
        assert {(r.id, r.label, r.height) for r in out} == {(i, names.index(c), math.sqrt(want[-4][0])) for i, c in up.items()}


def test_extremes_hold_the_farthest_point():
    rng = np.random.default_rng(2)
    for n in (1, 2, 3, 50, 400):
        x = np.round(rng.normal(size=(n, 2)), 1)
        hull = L.extremes(x)
        for p in rng.normal(size=(20, 2)) * 3:
            assert L._square(hull, p).max() == L._square(x, p).max()
    assert len(L.extremes(rng.normal(size=(400, 2)))) < 40 and len(L.extremes(rng.normal(size=(9, 1)))) == 2


def test_cuts_lie_between_values():
    """Points that share a coordinate do not lie on the border of their leaf (their edges would all stay open)."""
    x = np.array([[i * 0.01, j * 0.4] for j in range(25) for i in range(10)])
    kd = L.KdLeaves(x, 8, 2)
    leaf = kd.leaf(x)
    border = np.minimum(x - kd.lo[leaf], kd.hi[leaf] - x).min(axis=1)
    assert len(kd.lo) == 8 and (border > 0).all()
