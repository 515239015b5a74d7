"""Cases in which rows used to be lost, drawn unevenly or left unfinished."""

import os

import pytest
from pyspark.sql import functions as F

from tessera.functions.udf import metric_row
from tessera.operators import aggregate as A
from tessera.operators import cluster as C
from tessera.operators import features as X
from tessera.operators import order as O
from tessera.operators import windows as W
from tessera.sources import files as S


def write(folder, data: bytes) -> str:
    path = os.path.join(folder, "f.csv")
    with open(path, "wb") as f:
        f.write(data)
    return path


@pytest.mark.parametrize("end", [b"\n", b"\r\n"])
def test_blank_and_quoted_preamble_lines_count(spark, tmpdir_path, end):
    lines = [b"title", b"", b'"quoted, text"', b"", b"name,v", b'"a, b",1', b"c,2", b"d,3", b"", b"source"]
    path = write(tmpdir_path, end.join(lines) + end)
    df = S.read_csv_skip(spark, path, skip_rows=4, skip_footer=2)
    assert df.columns == ["name", "v"]
    assert sorted(tuple(r) for r in df.collect()) == [("a, b", "1"), ("c", "2"), ("d", "3")]
    assert [r.value for r in S.read_lines(spark, path).orderBy("line_no").collect()] == [x.decode() for x in lines]


@pytest.mark.parametrize("charset", ["utf-8", "iso-8859-1", "cp1251"])
def test_charsets(spark, tmpdir_path, charset):
    word = "Перу" if charset == "cp1251" else "Pérou"
    path = write(tmpdir_path, f"x\n\nname\n{word}\n".encode(charset))
    assert [r[0] for r in S.read_csv_skip(spark, path, 2, encoding=charset).collect()] == [word]


def test_random_rows_are_exact_in_number_and_spread_over_the_table(spark):
    df = spark.range(100_000).withColumnRenamed("id", "k")
    got = [r.k for r in O.random_rows(df, 400, ["k"], seed=5).collect()]
    assert len(got) == 400
    thirds = [sum(a <= k < a + 33_334 for k in got) for a in (0, 33_334, 66_668)]
    assert min(thirds) > 95
    assert O.random_rows(df.limit(0), 5, ["k"]).collect() == []
    assert len(O.random_rows(df.limit(2), 7, ["k"]).collect()) == 7


def test_components_of_a_long_chain(spark):
    edges = spark.range(300).select(F.col("id").alias("src"), (F.col("id") + 1).alias("dst"))
    got = C.components(edges).collect()
    assert len(got) == 301 and {r.component for r in got} == {0}


@pytest.mark.parametrize("chunks", [1, 8, 70])
def test_carries_survive_nulls_in_another_aggregate(spark, chunks):
    rows = [("a", i, None if i < 20 else float(i % 7), i % 5) for i in range(120)] + [("b", i, None, i) for i in range(30)]
    df = spark.createDataFrame(rows, "s string, t long, h double, n long")
    got = W.prefix_scan(df, ["s"], ["t"], {"top": ("max", F.col("h")), "low": ("min", F.col("n"))}, chunks=chunks).collect()
    assert len(got) == len(rows)
    for r in got:
        before = [x for x in rows if x[0] == r.s and x[1] <= r.t]
        heights = [x[2] for x in before if x[2] is not None]
        assert (r.top, r.low) == (max(heights) if heights else None, min(x[3] for x in before))


def test_a_point_without_height_is_no_bank(spark):
    df = spark.createDataFrame([(1, 0, None), (1, 1, 2.0), (1, 2, None), (1, 3, 1.0), (1, 4, 3.0)], "s int, t int, h double")
    got = {r.t: (r.pos, r.is_bank) for r in W.running_bank(df, ["s"], ["t"], "h", chunks=3).collect()}
    assert got == {0: (0, False), 1: (1, True), 2: (2, False), 3: (3, False), 4: (4, True)}


def test_deepest_basin_has_its_lowest_point(spark):
    df = spark.createDataFrame([(1, i, float(h)) for i, h in enumerate([5, 2, 3, 6, 1, 4])], "s int, t int, h double")
    r = W.deepest_basin(df, ["s"], ["t"], "h", chunks=3).first()
    assert (r.left_index, r.right_index, r.depth, r.lowest) == (0, 3, 3.0, 2.0)


def test_rows_with_a_null_feature_take_no_part_in_the_sums(spark):
    df = spark.createDataFrame([(1.0, 2.0, 3.0), (None, 5.0, 7.0), (2.0, None, 1.0), (4.0, 1.0, None)], "a double, b double, y double")
    row = A.gram_stats(df, ["a", "b"], "y")
    assert (row["m"], row["sy"], row["sx0"], row["sx1"]) == (1, 3.0, 1.0, 2.0)


def test_grouped_quantiles_put_the_ranks_on_the_small_side(spark):
    df = spark.range(5000).select((F.col("id") % 3).alias("g"), F.col("id").cast("double").alias("v"))
    plan = A.exact_quantiles(df, "v", [0.5], by=["g"])._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin [g" not in plan.split("Window")[-1]


def test_limits_are_errors(spark):
    df = spark.range(12).select(F.col("id").cast("string").alias("c"))
    with pytest.raises(ValueError, match="categories"):
        X._sorted_distinct(df, "c", limit=5)
    with pytest.raises(ValueError, match="more than one row"):
        metric_row(df, {"bad": lambda d: d})


def test_repeated_lookup_keys_give_the_smallest_row(spark):
    from tessera.operators import clean, joins

    mapping = spark.createDataFrame([(k, v, w) for k, v, w in [("a", 3, "x"), ("a", 2, "z"), ("a", 2, "y"), ("b", 9, "q")] * 40],
                                    "key string, value int, w string").repartition(9)
    df = spark.createDataFrame([("a",), ("b",), ("c",), (None,)], "k string")
    got = {r.k: (r.value, r.w) for r in joins.lookup_join(df, mapping, "k", "key").collect()}
    assert got == {"a": (2, "y"), "b": (9, "q"), "c": (None, None), None: (None, None)}
    assert {r.k: r.o for r in clean.remap_null(df, "k", mapping, out="o").collect()} == {"a": 2, "b": 9, "c": None, None: None}
