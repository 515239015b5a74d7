"""Small Spark helpers shared by the operators of this subpackage."""

from __future__ import annotations

import os
import sys
import tempfile
import uuid
import zipfile

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.session import cut_lineage, ensure_checkpoint_dir, table

__all__ = ["cut_lineage", "table", "scratch", "prepare", "written", "size_bytes", "tasks", "components", "BASE_COLUMNS"]

BASE_COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder path below the shared checkpoint folder (never a machine-local one)."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


_shipped: set[str] = set()


def prepare(spark: SparkSession) -> None:
    """Checkpoint folder, and this package on the Python path of the tasks: where the
    environment does not name its folder, Spark distributes the package as a zip."""
    ensure_checkpoint_dir(spark)
    top = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    app = spark.sparkContext.applicationId
    if app in _shipped or top in os.environ.get("PYTHONPATH", "").split(os.pathsep):
        return
    _shipped.add(app)
    name = os.path.join(tempfile.mkdtemp(prefix="package-"), "package.zip")  # read by the driver only
    package = os.path.basename(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    with zipfile.ZipFile(name, "w") as z:
        for folder, _, files in os.walk(os.path.join(top, package)):
            for f in sorted(files):
                if f.endswith(".py"):
                    full = os.path.join(folder, f)
                    z.write(full, os.path.relpath(full, top))
    at = list(sys.path)
    spark.sparkContext.addPyFile(name)
    sys.path[:] = at  # the driver keeps importing from its own folder


def written(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared folder and read it again: cuts the lineage, and the
    planner knows the size of what is read."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def size_bytes(text: Column) -> Column:
    """UTF-8 bytes of a text, null counts as none."""
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long")


def tasks(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def running_offset(counts: DataFrame, keys: list[str], chunk: str, n: str, out: str) -> DataFrame:
    """Exclusive running sum of ``n`` over ``chunk`` within ``keys``: one row per (key,
    chunk), so the window sees as many rows as there are chunks, not as there are data."""
    w = Window.partitionBy(*keys).orderBy(chunk).rowsBetween(Window.unboundedPreceding, -1)
    return counts.withColumn(out, F.coalesce(F.sum(n).over(w), F.lit(0)).cast("long")).drop(n)


def components(edges: DataFrame) -> DataFrame:
    """(id, component) for every id on an edge (a, b); component = smallest id reachable.

    Alternating large-star / small-star steps until a step leaves the edges as they were
    (count and an order-free checksum), each step written to the shared folder.  Every
    step replaces edges by as many or fewer, so a hub never makes pairs; the minimum of
    each neighbourhood is aggregated before it is joined back.  An empty edge table gives
    an empty result; self-loops and null ends are ignored.
    """
    e = (edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
         .where("a is not null and b is not null and a <> b").distinct())
    e, seen = cut_lineage(e), None
    while True:
        both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = (both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .where("u <> v").distinct())
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u")
        e = cut_lineage(small.select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
                        .union(low.select("u", F.col("m").alias("v"))).distinct())
        now = e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == seen:
            break
        seen = now
    leaf = e.select(F.col("u").alias("id"), F.col("v").alias("component"))
    root = e.select(F.col("v").alias("id")).distinct().select("id", F.col("id").alias("component"))
    return leaf.union(root).distinct()
