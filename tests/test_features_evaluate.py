import numpy as np
from pyspark.sql import functions as F

from tessera.operators import evaluate as E
from tessera.operators import features as X


def test_dummies_drop_first_and_unknown(spark):
    train = spark.createDataFrame([(1, "b"), (2, "a"), (3, "c")], "id int, s string")
    m = X.DummyEncoder(["s"]).fit(train)
    assert m.output_columns() == ["s_b", "s_c"]
    test = spark.createDataFrame([(4, "a"), (5, "z"), (6, None), (7, "c")], "id int, s string")
    got = {r.id: (r.s_b, r.s_c) for r in m.transform(test).collect()}
    assert got == {4: (0, 0), 5: (0, 0), 6: (0, 0), 7: (0, 1)}


def test_label_codes_sort_numbers_as_numbers(spark):
    df = spark.createDataFrame([(10,), (9,), (100,)], "v int")
    m = X.LabelEncoder("v", "code").fit(df)
    assert {r.v: r.code for r in m.transform(df).collect()} == {9: 0, 10: 1, 100: 2}


def test_standardizer_population_std(spark):
    df = spark.createDataFrame([(1.0, 5.0), (2.0, 5.0), (3.0, 5.0), (6.0, 5.0)], "a double, c double")
    out = X.Standardizer(["a", "c"]).fit(df).transform(df).collect()
    a = np.array([1.0, 2.0, 3.0, 6.0])
    assert np.allclose([r.a for r in out], (a - a.mean()) / a.std())
    assert all(r.c == 0.0 for r in out)


def test_hash_and_stratified_split(spark):
    df = spark.range(2000).select(F.col("id").alias("k"), (F.col("id") % 3 == 0).cast("int").alias("y"))
    a = X.hash_split(df, "k", 0.25, seed=1).where("is_test").count()
    b = X.hash_split(df.repartition(7), "k", 0.25, seed=1).where("is_test").count()
    assert a == b and 400 < a < 600
    s = X.stratified_split(df, "k", "y", 0.25, seed=1)
    per = {r.y: r.c for r in s.where("is_test").groupBy("y").agg(F.count("*").alias("c")).collect()}
    assert per == {0: int(np.ceil(0.25 * 1333)), 1: int(np.ceil(0.25 * 667))}


def test_impute_rules_fits_on_train(spark):
    tr = spark.createDataFrame([("a", 1.0, 10.0, "S"), ("a", 3.0, None, "C"), ("b", 7.0, 30.0, "C"),
                                ("b", None, 20.0, None)], "g string, age double, fare double, emb string")
    m = X.ImputeRules(group_median={"age": ["g"]}, median=["fare"], mode=["emb"]).fit(tr)
    te = spark.createDataFrame([("a", None, None, None), ("b", None, 1.0, "S")], "g string, age double, fare double, emb string")
    got = {r.g: (r.age, r.fare, r.emb) for r in m.transform(te).collect()}
    assert got == {"a": (2.0, 20.0, "C"), "b": (7.0, 1.0, "S")}


def _brute_auc(ys, ps):
    pos = [p for y, p in zip(ys, ps) if y == 1]
    neg = [p for y, p in zip(ys, ps) if y != 1]
    s = sum((1.0 if a > b else 0.5 if a == b else 0.0) for a in pos for b in neg)
    return s / (len(pos) * len(neg))


def test_auc_sweep_and_r2(spark):
    rng = np.random.default_rng(5)
    ys = rng.integers(0, 2, 400).tolist()
    ps = np.round(rng.uniform(0, 1, 400) * 0.5 + np.array(ys) * 0.3, 2).tolist()
    df = spark.createDataFrame(list(zip(ys, ps)), "y int, p double")
    assert abs(E.roc_auc(df, "y", "p").first()["auc"] - _brute_auc(ys, ps)) < 1e-12
    sw = {round(r.threshold, 2): r for r in E.threshold_sweep(df, "y", "p").collect()}
    assert len(sw) == 17
    for t in E.SWEEP:
        pred = [int(p >= t) for p in ps]
        tp = sum(1 for y, q in zip(ys, pred) if y == 1 and q == 1)
        fp = sum(1 for y, q in zip(ys, pred) if y != 1 and q == 1)
        fn = sum(1 for y, q in zip(ys, pred) if y == 1 and q != 1)
        r = sw[round(t, 2)]
        assert r.precision == (tp / (tp + fp) if tp + fp else 0.0)
        assert r.recall == (tp / (tp + fn) if tp + fn else 0.0)
    reg = spark.createDataFrame([(1.0, 1.5), (2.0, 1.5), (3.0, 3.5)], "y double, z double")
    y, z = np.array([1.0, 2.0, 3.0]), np.array([1.5, 1.5, 3.5])
    exp = 1 - ((y - z) ** 2).sum() / ((y - y.mean()) ** 2).sum()
    assert abs(E.r2(reg, "y", "z").first()["r2"] - exp) < 1e-12
    assert abs(E.half_mse(reg, "y", "z").first()["J"] - ((y - z) ** 2).sum() / 6) < 1e-12
