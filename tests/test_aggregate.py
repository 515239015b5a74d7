import numpy as np
from pyspark.sql import functions as F

from tessera.operators import aggregate as A


def test_exact_quantiles_match_numpy(spark):
    rng = np.random.default_rng(3)
    rows = []
    for g in range(4):
        n = [1, 2, 157, 1200][g]
        vals = np.round(rng.exponential(10, n), 2) if g != 2 else rng.integers(0, 5, n).astype(float)
        rows += [(g, float(v)) for v in vals]
    rows += [(1, None)]
    df = spark.createDataFrame(rows, "g int, v double")
    got = {r["g"]: (r["q0"], r["q1"], r["q2"]) for r in
           A.exact_quantiles(df, "v", [0.5, 0.25, 0.9], by=["g"], bins=4, max_exact=20).collect()}
    for g in range(4):
        vals = np.array([v for gg, v in rows if gg == g and v is not None])
        exp = [np.quantile(vals, q) for q in (0.5, 0.25, 0.9)]
        assert np.allclose(got[g], exp, rtol=0, atol=1e-9), (g, got[g], exp)
    whole = A.exact_quantiles(df, "v", [0.5], bins=8, max_exact=50).first()
    allv = np.array([v for _, v in rows if v is not None])
    assert abs(whole["q0"] - np.median(allv)) < 1e-9


def test_mode_tie_smallest_and_arg_max(spark):
    df = spark.createDataFrame([("S",), ("C",), ("C",), ("S",), (None,), (None,), (None,)], "e string")
    assert A.mode(df, "e", alias="m").first()["m"] == "C"
    t = spark.createDataFrame([(3, 5.0), (1, 5.0), (2, None), (4, 1.0)], "k int, v double")
    r = A.arg_max(t, "k", "v").first()
    assert r["k"] == 1 and r["v"] == 5.0


def test_row_mean_and_group_stats(spark):
    df = spark.createDataFrame([(1.0, None, 3.0), (None, None, None)], "a double, b double, c double")
    assert [r[0] for r in df.select(A.row_mean(["a", "b", "c"])).collect()] == [2.0, None]
    g = spark.createDataFrame([("x", 1.0), ("x", None), ("x", 3.0), (None, 5.0)], "k string, v double")
    r = A.group_stats(g, "k", "v").collect()
    assert len(r) == 1 and r[0]["size"] == 3 and r[0]["sum"] == 4.0 and abs(r[0]["std"] - 2 ** 0.5) < 1e-12


def test_describe_and_profile(spark):
    df = spark.createDataFrame([(float(i), i % 3) for i in range(1, 12)], "a double, b int")
    d = {r["column_name"]: r for r in A.describe(df).collect()}
    assert d["a"]["p25"] == 3.5 and d["a"]["p50"] == 6.0 and d["a"]["p75"] == 8.5 and d["a"]["count"] == 11
    p = {r["column_name"]: (r["non_null"], r["dtype"]) for r in A.profile(df).collect()}
    assert p == {"a": (11, "double"), "b": (11, "int")}
