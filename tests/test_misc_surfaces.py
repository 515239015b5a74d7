import pandas as pd
from pyspark.sql import functions as F

from tessera.functions.udf import metric_row, vectorized
from tessera.operators import aggregate as A
from tessera.operators import evaluate as E
from tessera.operators import joins as J
from tessera.operators import order as O


def test_order_operators(spark):
    df = spark.createDataFrame([(1, 2.0), (2, None), (3, -5.0), (4, 1.0)], "k int, v double")
    assert [r.k for r in O.sort_nulls_last(df, ["v"], desc=True, tiebreak=["k"]).collect()] == [1, 4, 3, 2]
    assert [r.k for r in O.sort_nulls_last(df, ["v"], desc=False, tiebreak=["k"]).collect()] == [3, 4, 1, 2]
    assert [r.k for r in O.top_k(df, "v", 2, desc=True, by_abs=True, tiebreak=["k"]).collect()] == [3, 1]
    assert O.head(df, 3).count() == 3
    assert O.random_rows(df, 2, df.columns, seed=1).count() == 2


def test_group_members_and_null_safe_join(spark):
    df = spark.createDataFrame([(52, 4, 13), (52, 2, 26), (7, 1, 7)], "p int, a int, b int")
    got = {r.p: [tuple(m) for m in r.members] for r in A.group_members(df, "p", ["a", "b"]).collect()}
    assert got == {52: [(2, 26), (4, 13)], 7: [(1, 7)]}
    a = spark.createDataFrame([(None, 1), ("x", 2)], "k string, va int")
    b = spark.createDataFrame([(None, 10), ("x", 20)], "k string, vb int")
    assert J.inner_join(a, b, "k").count() == 1
    assert J.inner_join(a, b, "k", null_safe=True).count() == 2


def test_udf_surfaces(spark):
    plus_one = vectorized(lambda s: s + 1.0, "double")
    df = spark.createDataFrame([(1, 1, 0.9), (0, 1, 0.6), (1, 0, 0.2), (0, 0, 0.1)], "y int, pred int, p double")
    assert [r.z for r in df.select(plus_one(F.col("p")).alias("z")).collect()] == [1.9, 1.6, 1.2, 1.1]
    row = metric_row(df, {"m": lambda d: E.prf(d, "y", "pred"), "roc": lambda d: E.roc_auc(d, "y", "p")}).first()
    assert row.m_accuracy == 0.5 and row.roc_auc == 0.75
