import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.operators import blocks
from tessera.operators.blocks import array, pack


def test_blocks_hold_every_row_and_nulls_as_nan(spark):
    df = spark.range(1000).select(F.array(F.col("id").cast("double"), F.when(F.col("id") % 3 > 0, F.col("id") * 2.0)).alias("x"),
                                  F.when(F.col("id") % 7 > 0, F.col("id")).alias("y"))
    rows = pack(df, F.col("x"), ["y"], rows=64).collect()
    assert max(r.n for r in rows) <= 64 and sum(r.n for r in rows) == 1000
    x = np.concatenate([array(r["x"], r.n) for r in rows])
    y = np.concatenate([array(r["y"], r.n) for r in rows])
    at = x[:, 0].astype(int)
    assert sorted(at) == list(range(1000))
    assert (np.isnan(x[:, 1]) == (at % 3 == 0)).all() and (np.isnan(y) == (at % 7 == 0)).all()
    assert np.array_equal(x[at % 3 > 0, 1], 2.0 * at[at % 3 > 0]) and np.array_equal(y[at % 7 > 0], at[at % 7 > 0])


def test_rows_of_different_length_are_refused(spark):
    df = spark.createDataFrame([([1.0],), ([1.0, 2.0, 3.0],)], "x array<double>").coalesce(1)
    with pytest.raises(Exception, match="number of features"):
        pack(df, F.col("x"), [])


def test_large_tables_have_few_partitions_of_bounded_size(spark, monkeypatch):
    df = spark.range(6000).select(F.array(F.col("id").cast("double"), F.lit(1.0)).alias("x"), F.col("id").alias("y"))
    count = lambda: pack(df, F.col("x"), ["y"]).rdd.getNumPartitions()
    slots = 2 * spark.sparkContext.defaultParallelism
    monkeypatch.setattr(blocks, "PART_ROWS", 1000)
    assert count() == 6  # as many as before where they are at most two a core
    monkeypatch.setattr(blocks, "PART_ROWS", 100)
    assert count() == slots  # before: 60
    monkeypatch.setattr(blocks, "PART_VALUES", 3 * 200)
    assert count() == 30
    y = np.concatenate([array(r["y"], r.n) for r in pack(df, F.col("x"), ["y"]).collect()])
    assert sorted(y) == list(range(6000))
