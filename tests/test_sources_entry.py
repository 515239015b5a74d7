import os

import duckdb
import pytest
from pyspark.sql import functions as F

from tessera.sources import files as S
from tessera.sources.generators import blobs, number_range, random_ints

SF_SMALL = "/root/testdata/sf0.001"


def test_read_csv_skip_header_and_footer(spark, tmpdir_path):
    p = os.path.join(tmpdir_path, "wb.csv")
    with open(p, "w") as f:
        f.write("note one\nnote two\nnote three\nnote four\n")
        f.write('Country Name,2006,2007\n"Korea, Rep.",1.5,2.5\nPeru,3,...\n')
        f.write("footer a\nfooter b\n")
    df = S.read_csv_skip(spark, p, skip_rows=4, skip_footer=2)
    assert df.columns == ["Country Name", "2006", "2007"]
    rows = sorted(tuple(r) for r in df.collect())
    assert rows == [("Korea, Rep.", "1.5", "2.5"), ("Peru", "3", "...")]
    typed = S.read_csv_skip(spark, p, 4, 2, schema="country string, y2006 double, y2007 string")
    assert sorted(r.y2006 for r in typed.collect()) == [1.5, 3.0]


def test_read_write_csv_roundtrip(spark, tmpdir_path):
    df = spark.createDataFrame([(1, "a, b", 0), (2, "c", 1)], "id int, name string, model int")
    out = os.path.join(tmpdir_path, "out")
    S.write_csv(df, out, partition_by=["model"])
    back = S.read_csv(spark, out, schema="id int, name string")
    assert sorted((r.id, r.name) for r in back.collect()) == [(1, "a, b"), (2, "c")]
    head, n, ncols = S.preview(df, 1)
    assert head.count() == 1 and n == 2 and ncols == 3


def test_generators(spark):
    b = blobs(spark, 500, centers=5, std=0.6, seed=0)
    assert b.count() == 500 and b.select("label").distinct().count() == 5
    r = random_ints(spark, 20, 0, 100, seed=1).collect()
    assert len(r) == 20 and all(0 <= x.h < 100 for x in r)
    g = [round(x.value, 10) for x in number_range(spark, 0.1, 0.95, 0.05).orderBy("i").collect()]
    assert len(g) == 17 and g[0] == 0.1 and g[-1] == 0.9


def test_load_arrays(spark, tmpdir_path):
    p = os.path.join(tmpdir_path, "img.parquet")
    spark.createDataFrame([(1, [[0, 255], [51, 102]], 3)], "id int, x array<array<int>>, y int").write.parquet(p)
    data, classes = S.load_arrays(spark, p, "x", "y", id_col="id")
    assert data.first().x == [0.0, 1.0, 0.2, 0.4] and classes.count() == 1


def test_stream_scoring(spark, tmpdir_path):
    from tessera.operators.features import Standardizer
    from tessera.streaming.score import read_parquet_stream, score_stream

    src = os.path.join(tmpdir_path, "in")
    base = spark.read.parquet(f"{SF_SMALL}/orders.parquet").select("o_orderkey", "o_totalprice")
    base.write.parquet(src)
    stage = Standardizer(["o_totalprice"], suffix="_z").fit(base)
    q = score_stream(read_parquet_stream(spark, src, base.schema), [stage], os.path.join(tmpdir_path, "out"),
                     checkpoint=os.path.join(tmpdir_path, "ck"))
    q.awaitTermination(120)
    out = spark.read.parquet(os.path.join(tmpdir_path, "out"))
    assert out.count() == base.count() and "o_totalprice_z" in out.columns


def test_entry_and_registry(spark):
    import __spark_entry__ as ent

    df = ent.entry(spark)
    assert df.count() > 0 and df.columns == ["zone", "size", "sum", "mean", "std"]
    qs, orc = ent.queries(), ent.oracle_sql()
    assert set(orc) <= set(qs) and len(qs) >= 60


@pytest.mark.parametrize("name", ["clean_join", "group_stats", "deepest_basin", "eliminate_by_groups",
                                  "capacity_lookup", "threshold_sweep", "auc", "stratified_split",
                                  "impute_rules", "describe", "dbscan", "components"])
def test_oracle_agreement_small(spark, name):
    import math

    import __spark_entry__ as ent

    con = duckdb.connect()
    for t in ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
              "embeddings", "pages", "benchmark", "labels", "conversations"]:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")

    def norm(v):
        return round(v, 6) if isinstance(v, float) and not math.isnan(v) else (int(v) if isinstance(v, bool) else v)

    df = ent.queries()[name](spark, SF_SMALL)
    cols = df.columns
    a = sorted(tuple(norm(r[c]) for c in sorted(cols)) for r in df.collect())
    res = con.execute(ent.oracle_sql()[name])
    dcols = [d[0] for d in res.description]
    idx = [dcols.index(c) for c in sorted(cols)]
    b = sorted(tuple(norm(r[i]) for i in idx) for r in res.fetchall())
    assert a == b
