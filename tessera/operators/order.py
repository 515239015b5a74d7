"""Sorts, limits and top-k."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

__all__ = ["sort_nulls_last", "top_k", "head", "random_rows"]


def _key(c: str, desc: bool, by_abs: bool = False):
    e = F.abs(F.col(c)) if by_abs else F.col(c)
    return e.desc_nulls_last() if desc else e.asc_nulls_last()


def sort_nulls_last(df: DataFrame, cols: Sequence[str], desc: bool = False,
                    tiebreak: Sequence[str] = ()) -> DataFrame:
    """O1: NULLs last in both directions; ``tiebreak`` columns make the order total."""
    return df.orderBy(*[_key(c, desc) for c in cols], *[F.col(t).asc() for t in tiebreak])


def top_k(df: DataFrame, by: str, k: int, desc: bool = True, by_abs: bool = False,
          tiebreak: Sequence[str] = ()) -> DataFrame:
    """O2: ``orderBy(...).limit(k)`` plans as TakeOrderedAndProject: each task keeps k rows."""
    return df.orderBy(_key(by, desc, by_abs), *[F.col(t).asc() for t in tiebreak]).limit(k)


def head(df: DataFrame, n: int = 5) -> DataFrame:
    """O3."""
    return df.limit(n)


def random_rows(df: DataFrame, n: int, order: Sequence[str], seed: int = 0) -> DataFrame:
    """Exactly ``n`` rows drawn uniformly with replacement, with their ``draw`` number.

    Draw j takes the row at position ``md5(seed:j) mod total`` of the total order
    ``order``; positions come from the distributed ``ordinal``, so every row of the
    table is as likely as any other and the draw can be repeated in SQL.  An empty
    table gives no row.
    """
    from tessera.operators.windows import ordinal

    numbered = ordinal(df, [], list(order), "__pos")
    total = df.count()
    word = F.substring(F.md5(F.concat(F.lit(f"{seed}:"), F.col("draw").cast("string")).cast("binary")), 1, 12)
    draws = df.sparkSession.range(n if total else 0).select(F.col("id").alias("draw")).withColumn(
        "__pos", F.pmod(F.conv(word, 16, 10).cast("long"), F.lit(max(total, 1))))
    return numbered.join(draws, "__pos").drop("__pos")
