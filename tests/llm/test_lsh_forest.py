import random

import numpy as np
import pytest

from tessera.llm import lsh_forest as L

SCHEMA = "doc_id long, text string, rep string, component string, n long"


def frame(spark, pairs):
    return spark.createDataFrame([(i, t, "a", "b", 1) for i, t in pairs], SCHEMA).repartition(3)


def shingles(text):
    import re

    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(w[k:k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def brute(pairs, percent=85):
    sets = [(i, shingles(t)) for i, t in pairs]
    root = list(range(len(sets)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(sets)):
        for b in range(a):
            x, y = sets[a][1], sets[b][1]
            if x and y and 100 * len(x & y) >= percent * len(x | y):
                root[find(a)] = find(b)
    low = {}
    for k, (i, _) in enumerate(sets):
        low[find(k)] = min(low.get(find(k), i), i)
    return sorted((i, len(s), low[find(k)], low[find(k)] == i) for k, (i, s) in enumerate(sets))


def result(df):
    return sorted((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in df.collect())


def corpus(seed=1, bases=30, copies=12):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 6)))
    common, out = [word() for _ in range(60)], []
    for b in range(bases):
        base = [word() for _ in range(rng.randint(3, 160))] + (common if b % 2 else [])
        for _ in range(rng.randint(1, copies)):
            w = list(base)
            for _ in range(rng.randint(0, 3)):
                w[rng.randrange(len(w))] = word()
            out.append(rng.choice([" ", "\n", " \t"]).join(w) if rng.random() < 0.8 else " ".join(w).upper())
    rng.shuffle(out)
    return list(zip(rng.sample(range(10_000), len(out)), out, strict=True))


def test_equals_brute_force(spark):
    pairs = [*corpus(), (20_001, None), (20_002, ""), (20_003, " \n"), (20_004, "x"), (20_005, "X"), (20_006, "x y")]
    assert result(L.near_groups(frame(spark, pairs))) == brute(pairs)


@pytest.mark.parametrize("seed", [2, 3])
def test_one_large_group_of_near_copies(spark, seed, monkeypatch):
    pairs = corpus(seed, bases=2, copies=400)
    monkeypatch.setattr(L, "BLOCK", 3000)  # blocks of the confirmation
    assert result(L.near_groups(frame(spark, pairs))) == brute(pairs)


def test_adaptive_depth_splits_large_regions(spark, monkeypatch):
    pairs = corpus(4, bases=6, copies=40)
    monkeypatch.setattr(L, "REGION", 5)
    assert result(L.near_groups(frame(spark, pairs))) == brute(pairs)


def test_pairs_at_the_threshold_are_found_in_regions_of_any_size(spark, monkeypatch):
    rng, pairs = random.Random(9), []
    for k in range(300):  # 200 words, three of them changed far apart: 181 / 211 = 0.858
        base = [f"w{rng.randrange(10**9)}" for _ in range(200)]
        copy = [f"z{rng.randrange(10**9)}" if i in (40, 90, 150) else w for i, w in enumerate(base)]
        pairs += [(2 * k, " ".join(base)), (2 * k + 1, " ".join(copy))]
    monkeypatch.setattr(L, "REGION", 1)  # every region is a large one
    assert result(L.near_groups(frame(spark, pairs))) == brute(pairs)


@pytest.mark.parametrize("seed", [6, 7])
def test_large_regions_meet_in_parts(spark, seed, monkeypatch):
    pairs = corpus(seed, bases=4, copies=60)
    monkeypatch.setattr(L, "REGION", 3)
    monkeypatch.setattr(L, "PIVOT", 4)
    assert result(L.near_groups(frame(spark, pairs))) == brute(pairs)


def test_edge_rows(spark):
    assert L.near_groups(frame(spark, [])).collect() == []
    got = L.near_groups(frame(spark, [(None, "a b c"), (1, "a b c"), (1, "a b c"), (2, "long " * 30_000)])).collect()
    assert sorted(((r.doc_id or 0), r.component_id, r.kept) for r in got) == [(0, None, True), (1, 1, True), (1, 1, True),
                                                                         (2, 2, True)]


def test_drop_keeps_one_of_each_component(spark):
    pairs = corpus(5)
    got = L.drop_near_copies(frame(spark, pairs))
    assert got.columns == SCHEMA.replace(" long", "").replace(" string", "").split(", ")
    assert sorted(r.doc_id for r in got.collect()) == [r[0] for r in brute(pairs) if r[3]]


def test_trees_and_sketches_follow_the_threshold(spark):
    rng, pairs = random.Random(11), []
    for k in range(150):  # 100 words, two of them changed apart: 86 / 106 = 0.81
        base = [f"w{rng.randrange(10**9)}" for _ in range(100)]
        pairs += [(2 * k, " ".join(base)), (2 * k + 1, " ".join("z" if i in (30, 70) else w for i, w in enumerate(base)))]
    got = sorted(r.doc_id for r in L.drop_near_copies(frame(spark, pairs), percent=80).collect())
    assert got == [r[0] for r in brute(pairs, 80) if r[3]] == [2 * k for k in range(150)]
    assert (1 - 0.8 ** L.LEAST) ** L.trees(80) <= L.MISS and L.trees(85) == 12


def representatives(spark, values):
    """reps (rep, signature) of documents x trees x DEPTH values."""
    rows = [(i, np.array(v, "<u4").tobytes()) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "rep long, signature binary").repartition(5)


def test_neighbours_and_regions_equal_sorted_lists(spark):
    rng = random.Random(3)
    n, trees = 400, 3
    values = [[[rng.choice([1, 2, 2**31 + 5]) for _ in range(L.DEPTH)] for _ in range(trees)] for _ in range(n)]
    got = L.regions(representatives(spark, values), trees)
    plan = L.orders(representatives(spark, values), trees)._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning" in plan and "Sort [tree" in plan
    rows = got.collect()
    assert len(rows) == n * trees
    for t in range(trees):
        order = sorted((values[i][t], i) for i in range(n))
        shared = [0] + [next((d for d in range(L.DEPTH) if a[d] != b[d]), L.DEPTH) for (a, _), (b, _) in zip(order, order[1:])]
        mine = {r.rep: r for r in rows if r.tree == t}
        assert [mine[i].lcp for _, i in order] == shared  # across the partitions' borders too
        names = [mine[i].region for _, i in order]
        assert [a == b for a, b in zip(names, names[1:])] == [s >= L.LEAST for s in shared[1:]]
    assert len({(r.tree, r.region) for r in rows}) == len({r.region for r in rows})  # no region in two trees


def test_depth_adapts_to_density(spark, monkeypatch):
    """A dense region descends only as far as it must; equal values at every depth stay whole."""
    monkeypatch.setattr(L, "REGION", 10)
    values = [[[7, 7, 7, i % 2, i % 6, i, 0, 0]] for i in range(36)] + [[[9] * L.DEPTH] for _ in range(20)]
    reps = representatives(spark, values)
    large = L.regions(reps, 1)
    assert sorted(r["count"] for r in large.groupBy("region").count().collect()) == [20, 36]
    deep = {r.rep: r.region for r in L.deeper(large, reps, 1).collect()}
    assert set(deep) == set(range(36))  # 18 share four values, 6 share five
    groups = {}
    for i, r in deep.items():
        groups.setdefault(r, set()).add(i % 6)
    assert len(groups) == 6 and all(len(g) == 1 for g in groups.values())


def test_a_real_region_above_the_size(spark):
    """A star of edits near one base, each linked to the base only: every link counts, in a
    region larger than REGION, which the deeper runs leave open."""
    rng, n = random.Random(5), L.REGION + 800
    base = [f"w{i}" for i in range(60)]
    pairs = [(0, " ".join(base))]
    for k in range(1, n):  # one word near an end and one within change: 50 to 54 of 56 shingles are left
        w = list(base)
        w[rng.choice([0, 1, 58, 59])] = f"a{k}"
        pairs.append((k, " ".join(w)))
    got = L.near_groups(frame(spark, pairs))
    assert got.where("component_id = 0").count() == n and got.where("kept").count() == 1
