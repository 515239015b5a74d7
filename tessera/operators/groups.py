"""Group-rule filters and threshold lookups.

Each group rule is a grouped aggregate (partial phase, so hot keys are combined
map-side) followed by a ``left_semi`` join back onto the candidate rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.scalar import col_of, pair_product, pair_sum

__all__ = ["keep_ambiguous", "keep_unique", "keep_groups_all", "eliminate_by_groups",
           "capacity_reaches", "min_trials", "capacity_lookup"]


def _keyed(df: DataFrame, key) -> tuple[DataFrame, str]:
    if isinstance(key, str):
        return df, key
    return df.withColumn("__key", key), "__key"


def _count_filter(df: DataFrame, key, cond) -> DataFrame:
    d, k = _keyed(df, key)
    keys = d.groupBy(k).agg(F.count(F.lit(1)).alias("__n")).where(cond(F.col("__n"))).select(k)
    out = d.join(keys, k, "left_semi")
    return out.drop("__key") if k == "__key" else out


def keep_ambiguous(df: DataFrame, key) -> DataFrame:
    """Rows whose key (a column name or expression) occurs more than once."""
    return _count_filter(df, key, lambda n: n > 1)


def keep_unique(df: DataFrame, key) -> DataFrame:
    """Rows whose key occurs exactly once."""
    return _count_filter(df, key, lambda n: n == 1)


def keep_groups_all(df: DataFrame, key, pred: Column, within: DataFrame | None = None) -> DataFrame:
    """A10: rows of groups in which every row satisfies ``pred`` (NULL counts as false).

    ``within`` (default: ``df``) is the table whose groups are tested; ``df`` is filtered.
    """
    src = within if within is not None else df
    s, k = _keyed(src, key)
    good = (s.groupBy(k).agg(F.bool_and(F.coalesce(pred, F.lit(False))).alias("__ok"))
             .where(F.col("__ok")).select(k))
    d, k2 = _keyed(df, key)
    out = d.join(good.withColumnRenamed(k, k2), k2, "left_semi")
    return out.drop("__key") if k2 == "__key" else out


def eliminate_by_groups(df: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """The sum/product elimination chain over any table of candidate pairs.

    1. keep pairs whose product is shared by another pair (product is ambiguous);
    2. keep those whose sum's every pair (in the full candidate set) has an
       ambiguous product;
    3. keep pairs whose product is now unique;
    4. keep pairs whose sum is now unique.
    Candidates are taken as a set (duplicates removed first).
    """
    from tessera.session import cut_lineage

    # Every step reads its input twice (group counts + semi join), so the candidate
    # set and each step's (shrinking) output are checkpointed: the source table is
    # scanned once instead of once per branch of the chain.
    pairs = df.select(F.col(a).alias("a"), F.col(b).alias("b")).distinct()
    prod, tot = pair_product("a", "b"), pair_sum("a", "b")
    pairs = cut_lineage(pairs.withColumns({"prod": prod, "total": tot}))
    amb_prods = (pairs.groupBy("prod").agg(F.count(F.lit(1)).alias("__n")).where(F.col("__n") > 1)
                      .select("prod", F.lit(True).alias("__amb")))
    flagged = cut_lineage(pairs.join(amb_prods, "prod", "left"))
    amb = flagged.where(F.col("__amb")).drop("__amb")
    step2 = cut_lineage(keep_groups_all(amb, "total", F.col("__amb"), within=flagged))
    step3 = cut_lineage(keep_unique(step2, "prod"))
    step4 = keep_unique(step3, "total")
    return step4.select(F.col("a").alias(a), F.col("b").alias(b), "prod", "total")


# ----------------------------------------------------------------------------- capacity

_DEC = "decimal(38,0)"


def capacity_reaches(n: Column, k: Column, f: Column) -> Column:
    """True when ``F(n, k) >= f`` where F(n,k)=F(n-1,k-1)+F(n-1,k)+1, F(0,k)=0, F(n,1)=n.

    Uses the closed form F(n,k) = sum_{i=1..min(n,k)} C(n,i) in exact decimal
    arithmetic that stops as soon as the sum reaches ``f`` (so it never overflows).
    More than 64 terms are never needed: 64 terms already exceed any bigint target.
    """
    m = F.least(k.cast("long"), n.cast("long"), F.lit(64).cast("long"))
    zero = F.lit(0).cast(_DEC)
    init = F.struct(F.lit(1).cast(_DEC).alias("t"), zero.alias("s"))
    fd = f.cast(_DEC)
    nd = n.cast(_DEC)

    def step(acc, i):
        # a double estimate first: a term far beyond the target saturates the sum, so the
        # exact decimal product below stays under ~64 * 2 * f and cannot overflow
        est = acc["t"].cast("double") * (n.cast("double") - i + 1) / i
        t = ((acc["t"] * (nd - i.cast(_DEC) + F.lit(1).cast(_DEC))) / i.cast(_DEC)).cast(_DEC)
        return (F.when(acc["s"] >= fd, acc)
                 .when(est > f.cast("double") * 2 + 1, F.struct(acc["t"].alias("t"), fd.alias("s")))
                 .otherwise(F.struct(t.alias("t"), (acc["s"] + t).cast(_DEC).alias("s"))))

    total = F.aggregate(F.sequence(F.lit(1).cast("long"), F.greatest(m, F.lit(1).cast("long"))), init, step)["s"]
    return F.when(m < 1, zero >= fd).otherwise(total >= fd)


def min_trials(floors, glasses) -> Column:
    """Smallest n >= 1 with F(n, glasses) >= floors (bisection, 64 steps, per row).

    Pure per-row expression: no table, no join, no shuffle.  The answer is at
    most ``max(floors, 1)`` because F(n, k) >= n.
    """
    f = col_of(floors).cast("long")
    k = col_of(glasses).cast("long")
    init = F.struct(F.lit(1).cast("long").alias("lo"), F.greatest(f, F.lit(1).cast("long")).alias("hi"))

    def step(acc, _):
        mid = F.floor((acc["lo"] + acc["hi"]) / 2).cast("long")
        ok = capacity_reaches(mid, k, f)
        moved = F.when(ok, F.struct(acc["lo"].alias("lo"), mid.alias("hi"))) \
                 .otherwise(F.struct((mid + 1).alias("lo"), acc["hi"].alias("hi")))
        return F.when(acc["lo"] >= acc["hi"], acc).otherwise(moved)

    return F.aggregate(F.sequence(F.lit(1), F.lit(64)), init, step)["lo"]


def capacity_lookup(df: DataFrame, floors: str, glasses: str, out: str = "trials") -> DataFrame:
    """For each request row, the fewest trials that cover ``floors`` with ``glasses``."""
    return df.withColumn(out, F.when(F.col(glasses) >= 1, min_trials(floors, glasses)))
