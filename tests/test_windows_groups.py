import random

import numpy as np
from pyspark.sql import functions as F

from tessera.operators import groups as G
from tessera.operators import joins as J
from tessera.operators import windows as W


def _sequential_basin(hs):
    best, bd = None, 0
    lb, cur = (0, hs[0]), 0
    for i in range(1, len(hs)):
        if hs[i] < lb[1]:
            cur = max(cur, lb[1] - hs[i])
        elif hs[i] > lb[1]:
            if cur > bd:
                bd, best = cur, (lb[0], i, cur)
            lb, cur = (i, hs[i]), 0
    rb, cur = (len(hs) - 1, hs[-1]), 0
    for i in range(len(hs) - 2, -1, -1):
        if hs[i] < rb[1]:
            cur = max(cur, rb[1] - hs[i])
        elif hs[i] > rb[1]:
            if cur > bd:
                bd, best = cur, (i, rb[0], cur)
            rb, cur = (i, hs[i]), 0
    return best


def test_deepest_basin_matches_sequential_scan(spark):
    random.seed(11)
    rows, exp = [], {}
    for s in range(200):
        n = random.randint(1, 40)
        hs = [random.randint(0, 9) for _ in range(n)]
        rows += [(s, i, float(h)) for i, h in enumerate(hs)]
        r = _sequential_basin(hs)
        if r:
            exp[s] = (r[0], r[1], float(r[2]))
    # one very long series, split across many chunks
    hs = [random.randint(0, 99) for _ in range(3000)]
    rows += [(999, i, float(h)) for i, h in enumerate(hs)]
    r = _sequential_basin(hs)
    exp[999] = (r[0], r[1], float(r[2]))
    df = spark.createDataFrame(rows, "s long, t long, h double")
    got = {r.s: (r.left_index, r.right_index, r.depth)
           for r in W.deepest_basin(df, ["s"], ["t"], "h", chunks=16).collect()}
    assert got == exp


def test_equal_banks_do_not_close():
    assert _sequential_basin([5, 1, 5]) is None


def test_prefix_scan_and_folds(spark):
    rng = np.random.default_rng(0)
    rows = [(int(g), int(i), float(v)) for i, (g, v) in enumerate(zip(rng.integers(0, 3, 500), rng.normal(size=500)))]
    df = spark.createDataFrame(rows, "g int, t int, v double")
    out = W.prefix_scan(df, ["g"], ["t"], {"cs": ("sum", F.col("v")), "mx": ("max", F.col("v"))}, chunks=7)
    got = {r.t: (r.cs, r.mx) for r in out.collect()}
    for g in range(3):
        sub = sorted((t, v) for gg, t, v in rows if gg == g)
        cs = np.cumsum([v for _, v in sub])
        mx = np.maximum.accumulate([v for _, v in sub])
        for (t, _), c, m in zip(sub, cs, mx):
            assert abs(got[t][0] - c) < 1e-9 and got[t][1] == m
    f = W.assign_folds(spark.createDataFrame([(i, i % 2) for i in range(14)], "k int, y int"), "y", 5, ["k"])
    sizes = {}
    for r in f.collect():
        sizes.setdefault(r.y, []).append(r.fold)
    assert sorted(np.bincount(sizes[0]).tolist(), reverse=True) == [2, 2, 1, 1, 1]


def test_nth_by_order(spark):
    df = spark.createDataFrame([(i, float(v) if v is not None else None) for i, v in
                                enumerate([3, None, 9, 9, 1])], "k int, v double")
    r = W.nth_by_order(df, "v", 1, desc=True, tiebreak=["k"]).first()
    assert r.k == 3 and r.position == 1


def test_riddle_chain_on_full_range(spark):
    rng = spark.createDataFrame([(2, 99)], "lo long, hi long")
    pairs = J.range_pairs(rng, "lo", "hi", "a", "b")
    assert pairs.count() == 4851
    out = G.eliminate_by_groups(pairs).collect()
    assert [(r.a, r.b) for r in out] == [(4, 13)]


def test_capacity_lookup_known_values_and_recurrence(spark):
    req = [(100, 2), (100, 3), (92, 3), (93, 3), (100, 1), (1, 4), (0, 2), (10 ** 12, 2)]
    got = [r.trials for r in G.capacity_lookup(spark.createDataFrame(req, "f long, k int"), "f", "k").collect()]
    assert got[:7] == [14, 9, 8, 9, 100, 1, 1]
    assert got[7] == 1414214
    # brute force: the recurrence table
    F_ = {}
    for n in range(0, 60):
        for k in range(1, 6):
            F_[n, k] = 0 if n == 0 else (n if k == 1 else F_[n - 1, k - 1] + F_[n - 1, k] + 1)
    reqs = [(f, k) for f in range(1, 300, 7) for k in range(1, 6)]
    exp = [min(n for n in range(1, 400) if (n if k == 1 else F_.get((n, k), 10 ** 9)) >= f) for f, k in reqs]
    got = [r.trials for r in G.capacity_lookup(spark.createDataFrame(reqs, "f long, k int"), "f", "k").collect()]
    assert got == exp


def test_capacity_without_ansi_mode(spark):
    prev = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        req = spark.createDataFrame([(100, 2), (10 ** 12, 2), (10 ** 18, 100)], "f long, k int")
        assert [r.trials for r in G.capacity_lookup(req, "f", "k").collect()] == [14, 1414214, 60]
    finally:
        spark.conf.set("spark.sql.ansi.enabled", prev)
