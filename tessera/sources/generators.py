"""Generated tables (S7-S9), built with ``spark.range`` so they are partitioned from the start."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

__all__ = ["blobs", "random_ints", "number_range"]


def blobs(spark: SparkSession, n: int, centers: int = 5, std: float = 0.6, dim: int = 2, seed: int = 0,
          box: tuple[float, float] = (-10.0, 10.0), partitions: int | None = None) -> DataFrame:
    """Labelled Gaussian points; sample i belongs to centre ``i mod centers``.

    Centres are drawn uniformly in ``box`` (a fixed small parameter table, inlined as
    literals); coordinates are centre + std * N(0, 1).
    """
    rng = np.random.default_rng(seed)
    ctr = rng.uniform(box[0], box[1], size=(centers, dim))
    base = spark.range(0, n, 1, partitions).withColumn("label", (F.col("id") % centers).cast("int"))
    cols = []
    for j in range(dim):
        m = F.create_map(*[v for c in range(centers) for v in (F.lit(c), F.lit(float(ctr[c, j])))])
        cols.append((F.element_at(m, F.col("label")) + F.lit(std) * F.randn(seed * 1000 + j)).alias(f"x{j}"))
    return base.select("id", *cols, "label")


def random_ints(spark: SparkSession, n: int, lo: int, hi: int, seed: int = 0) -> DataFrame:
    """``n`` integers uniform in [lo, hi) with their position ``i``."""
    return spark.range(n).select(F.col("id").alias("i"),
                                 (F.floor(F.rand(seed) * (hi - lo)) + lo).cast("long").alias("h"))


def number_range(spark: SparkSession, lo: float, hi: float, step: float = 1.0, inclusive: bool = False) -> DataFrame:
    """Lo, lo+step, ... below hi (or up to hi); decimals are built from integers."""
    count = int(np.floor((hi - lo) / step + 1e-9)) + (1 if inclusive else 0)
    if not inclusive and lo + count * step < hi - 1e-12:
        count += 1
    return spark.range(count).select(F.col("id").alias("i"), (F.lit(lo) + F.lit(step) * F.col("id")).alias("value"))
