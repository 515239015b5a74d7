from pyspark.sql import functions as F

from tessera.functions import scalar as S
from tessera.operators import clean as P


def test_strip_parens_and_digits(spark):
    df = spark.createDataFrame([("Bolivia (Plurinational State of)",), ("Switzerland17",), ("Iran (Islamic) x",)], "c string")
    out = df.select(S.strip_parens("c").alias("t"), S.strip_parens("c", trim=False).alias("nt"),
                    S.strip_digits("c").alias("d")).collect()
    assert out[0]["t"] == "Bolivia" and out[0]["nt"] == "Bolivia "
    assert out[1]["d"] == "Switzerland"
    assert out[2]["t"] == "Iran  x"


def test_null_if_remap_and_safe_div(spark):
    df = spark.createDataFrame([("a", "..."), ("b", "12.5"), ("c", "x")], "k string, v string")
    out = P.null_if(df, ["v"]).orderBy("k").collect()
    assert [r["v"] for r in out] == [None, 12.5, None]
    keep = P.remap_keep(df, "k", {"a": "A"}).orderBy("v").collect()
    assert sorted(r["k"] for r in keep) == ["A", "b", "c"]
    nul = P.remap_null(df, "k", {"a": "A"}, out="m").orderBy("k").collect()
    assert [r["m"] for r in nul] == ["A", None, None]
    mdf = spark.createDataFrame([("b", "B")], "key string, value string")
    joined = P.remap_keep(df, "k", mdf).orderBy("k").collect()
    assert sorted(r["k"] for r in joined) == ["B", "a", "c"]
    z = spark.createDataFrame([(1.0, 0.0), (1.0, 2.0)], "a double, b double").select(S.safe_div("a", "b").alias("r"))
    assert [r["r"] for r in z.collect()] == [None, 0.5]


def test_select_numeric_drop_positions_fill(spark):
    df = spark.createDataFrame([(1, "x", 2.0, None)], "a int, b string, c double, d double")
    assert P.select_numeric(df).columns == ["a", "c", "d"]
    assert P.drop_positions(df, [0, 1]).columns == ["c", "d"]
    assert P.fill_null(df, {"d": 9.0}).first()["d"] == 9.0
    assert P.drop_columns(df, ["zzz", "a"]).columns == ["b", "c", "d"]


def test_dot_and_scale(spark):
    df = spark.createDataFrame([([1.0, 2.0, 3.0],)], "x array<double>")
    r = df.select(S.affine(0.5, [1.0, 0.0, -1.0], F.col("x")).alias("s"),
                  S.scale_array("x", 2).alias("h"), S.take_component("x", 2).alias("c")).first()
    assert r["s"] == -1.5 and r["h"] == [0.5, 1.0, 1.5] and r["c"] == 3.0
