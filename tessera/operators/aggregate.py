"""Aggregations.

Scale notes
-----------
* Every aggregate here is a hash aggregate with a partial (map-side) phase.
* Exact quantiles (median, quartiles) do not use Spark's ``percentile``: its
  buffer holds every distinct value of a group in one task.  ``exact_quantiles``
  instead narrows each wanted rank by histogram rounds (a bounded number of bins
  per group and wanted rank), then ranks only the few rows left in the final bin.
* ``mode`` is a two-level aggregate (count per value, then best per group), so a
  hot group is spread over all tasks by its values.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.scalar import col_of, safe_div

__all__ = [
    "group_stats", "col_max", "col_min", "arg_max", "row_mean", "corr", "exact_quantiles",
    "median", "group_median", "mode", "group_members", "class_counts", "describe", "profile",
    "distinct_values", "mean_std_pop", "gram_stats",
]


def group_stats(df: DataFrame, key: str, col: str) -> DataFrame:
    """A1: size (rows, NULL values included), sum, mean and sample std per key.

    NULL keys are dropped first, as a dict-style group index would drop them.
    """
    return (df.where(F.col(key).isNotNull()).groupBy(key)
              .agg(F.count(F.lit(1)).alias("size"), F.sum(col).alias("sum"),
                   F.avg(col).alias("mean"), F.stddev_samp(col).alias("std")))


def col_max(df: DataFrame, col: str) -> DataFrame:
    """A2."""
    return df.agg(F.max(col).alias(f"max_{col}"))


def col_min(df: DataFrame, col: str) -> DataFrame:
    """A2."""
    return df.agg(F.min(col).alias(f"min_{col}"))


def arg_max(df: DataFrame, label: str, value: str, order: str | None = None) -> DataFrame:
    """A3: the label with the largest value; ties go to the first label in ``order``.

    One partial aggregate: ``min_by(label, (-value, order))``.  NULL values are skipped.
    """
    order = order or label
    v = F.col(value)
    return (df.where(v.isNotNull())
              .agg(F.min_by(F.col(label), F.struct((-v).alias("nv"), F.col(order).alias("o"))).alias(label),
                   F.max(v).alias(value)))


def row_mean(cols: Sequence[str]) -> Column:
    """A4: mean across columns, NULLs skipped; NULL when all are NULL."""
    total = sum((F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in cols), F.lit(0.0))
    n = sum((F.col(c).isNotNull().cast("int") for c in cols), F.lit(0))
    return safe_div(total, n)


def corr(df: DataFrame, a: str, b: str, by: Sequence[str] = ()) -> DataFrame:
    """A5: Pearson correlation; pairs with a NULL are skipped."""
    agg = F.corr(a, b).alias("corr")
    return df.groupBy(*by).agg(agg) if by else df.agg(agg)


# ----------------------------------------------------------------------------- quantiles

def exact_quantiles(df: DataFrame, value: str, probs: Sequence[float], by: Sequence[str] = (),
                    bins: int = 1024, max_exact: int = 100_000, prefix: str = "q") -> DataFrame:
    """Exact continuous quantiles (linear interpolation between order statistics).

    Returns one row per group: ``by`` columns, ``n`` and ``{prefix}{i}`` for each prob.

    Each wanted order statistic is located by rounds of a histogram over its current
    value interval: ``groupBy(group, target, bin).agg(count, min, max)`` -- at most
    ``bins`` rows per (group, target) -- then a running count over those bins picks the
    bin holding the rank.  When an interval holds at most ``max_exact`` rows (or a single
    value) the rows in it are ranked with ``row_number`` inside that small partition.
    No group is ever gathered whole into one task.
    """
    user_by = list(by)
    probs = [float(p) for p in probs]
    v = F.col(value).cast("double")
    # ungrouped: one literal group; its target table then has exactly 2*len(probs) rows,
    # a proven bound, so it is broadcast and the data never shuffles for the join.
    by = user_by or ["__all"]
    small = not user_by
    data = df.select(*user_by, v.alias("__v")).where(F.col("__v").isNotNull() & ~F.isnan("__v"))
    if small:
        data = data.withColumn("__all", F.lit(0))
    stats = data.groupBy(*by).agg(F.count(F.lit(1)).alias("__n"), F.min("__v").alias("__lo"),
                                  F.max("__v").alias("__hi"))
    # wanted order statistics: (group, t, rank); t indexes (prob, low/high neighbour)
    wants = []
    for i, p in enumerate(probs):
        pos = (F.col("__n") - 1).cast("double") * F.lit(p)
        wants.append(F.struct(F.lit(2 * i).alias("t"), F.floor(pos).cast("long").alias("r")))
        wants.append(F.struct(F.lit(2 * i + 1).alias("t"), F.ceil(pos).cast("long").alias("r")))
    targets = (stats.select(*by, "__n", "__lo", "__hi", F.explode(F.array(*wants)).alias("w"))
                    .select(*by, "__n", F.col("w.t").alias("t"), F.col("w.r").alias("r"),
                            F.col("__lo").alias("lo"), F.col("__hi").alias("hi"),
                            F.lit(0).cast("long").alias("below"), F.col("__n").alias("cnt")))
    # narrow intervals until they are small
    refined = False
    while True:
        targets = _cut(targets)
        big = targets.where((F.col("cnt") > max_exact) & (F.col("lo") < F.col("hi")))
        if big.isEmpty():
            break
        refined = True
        side = big.select(*by, "t", "lo", "hi", "below", "r")
        joined = data.join(_small_side(side), by, "inner")
        joined = joined.where((F.col("__v") >= F.col("lo")) & (F.col("__v") <= F.col("hi")))
        width = (F.col("hi") - F.col("lo")) / F.lit(float(bins))
        hist = (joined.withColumn("b", F.least(F.lit(bins - 1),
                                               F.floor((F.col("__v") - F.col("lo")) / width).cast("int")))
                      .groupBy(*by, "t", "b", "below", "r")
                      .agg(F.count(F.lit(1)).alias("c"), F.min("__v").alias("blo"), F.max("__v").alias("bhi")))
        w = Window.partitionBy(*by, "t").orderBy("b").rowsBetween(Window.unboundedPreceding, -1)
        hist = hist.withColumn("before", F.col("below") + F.coalesce(F.sum("c").over(w), F.lit(0)))
        chosen = (hist.where((F.col("r") >= F.col("before")) & (F.col("r") < F.col("before") + F.col("c")))
                      .select(*by, "t", F.col("blo").alias("nlo"), F.col("bhi").alias("nhi"),
                              F.col("before").alias("nbelow"), F.col("c").alias("ncnt")))
        keys = by + ["t"]
        targets = (targets.join(chosen, keys, "left")
                          .select(*by, "__n", "t", "r",
                                  F.coalesce("nlo", "lo").alias("lo"), F.coalesce("nhi", "hi").alias("hi"),
                                  F.coalesce("nbelow", "below").alias("below"),
                                  F.coalesce("ncnt", "cnt").alias("cnt")))
    if refined:
        targets = _cut(targets)
    # finish: single-valued intervals are answered directly, the rest by ranking a few rows
    single = targets.where(F.col("lo") == F.col("hi")).select(*by, "t", F.col("lo").alias("val"))
    multi = targets.where(F.col("lo") < F.col("hi")).select(*by, "t", "lo", "hi", "below", "r")
    joined = data.join(_small_side(_cut(multi)), by, "inner")
    joined = joined.where((F.col("__v") >= F.col("lo")) & (F.col("__v") <= F.col("hi")))
    rn = F.row_number().over(Window.partitionBy(*by, "t").orderBy("__v")) - 1
    ranked = (joined.withColumn("__k", rn + F.col("below"))
                    .where(F.col("__k") == F.col("r")).select(*by, "t", F.col("__v").alias("val")))
    vals = single.unionByName(ranked)
    n_per = stats.select(*by, F.col("__n").alias("n"))
    wide = vals.groupBy(*by).pivot("t", list(range(2 * len(probs)))).agg(F.first("val"))
    out_cols = []
    for i, p in enumerate(probs):
        lo_v, hi_v = F.col(f"`{2 * i}`"), F.col(f"`{2 * i + 1}`")
        frac = (F.col("n") - 1).cast("double") * F.lit(p)
        frac = frac - F.floor(frac)
        out_cols.append((lo_v + frac * (hi_v - lo_v)).alias(f"{prefix}{i}"))
    res = n_per.join(wide, by, "left")
    return res.select(*user_by, "n", *out_cols)


def _small_side(side: DataFrame) -> DataFrame:
    """Broadcast the wanted ranks where their counted size is below the session's
    threshold (column names and type codes are); else the join shuffles and AQE splits
    a hot group."""
    limit = side.sparkSession.conf.get("spark.sql.autoBroadcastJoinThreshold")
    scale = {"b": 1, "k": 1 << 10, "m": 1 << 20, "g": 1 << 30}
    text = str(limit).lower().removesuffix("b") or "0"
    limit = int(text[:-1]) * scale[text[-1]] if text[-1] in scale else int(text)
    return F.broadcast(side) if side.count() * 16 * (len(side.columns) + 2) <= limit else side


def _cut(df: DataFrame) -> DataFrame:
    """Targets are tiny (groups x wanted ranks); cut their lineage each round."""
    from tessera.session import cut_lineage

    return cut_lineage(df)


def median(df: DataFrame, col: str, by: Sequence[str] = (), alias: str | None = None) -> DataFrame:
    """Exact median (midpoint of the two middle values for an even count)."""
    q = exact_quantiles(df, col, [0.5], by=by, prefix="__m")
    return q.select(*by, F.col("__m0").alias(alias or f"median_{col}"))


def group_median(df: DataFrame, col: str, by: Sequence[str], alias: str = "median") -> DataFrame:
    """Grouped exact median, one row per group."""
    return median(df, col, by=by, alias=alias)


def mode(df: DataFrame, col: str, by: Sequence[str] = (), alias: str | None = None) -> DataFrame:
    """Most frequent non-NULL value; the smallest value wins a tie.

    Two aggregates: counts per (group, value) with a partial phase, then
    ``min_by(value, (-count, value))`` per group.
    """
    by = list(by)
    counts = df.where(F.col(col).isNotNull()).groupBy(*by, col).agg(F.count(F.lit(1)).alias("__c"))
    pick = F.min_by(F.col(col), F.struct((-F.col("__c")).alias("nc"), F.col(col).alias("v")))
    alias = alias or f"mode_{col}"
    return counts.groupBy(*by).agg(pick.alias(alias)) if by else counts.agg(pick.alias(alias))


def group_members(df: DataFrame, key: str, members: Sequence[str]) -> DataFrame:
    """Members of each group as a sorted list.

    Builds one row per group, so use it where groups are known to be small
    (e.g. a final answer); counting and filtering use A9/A10 instead.
    """
    return df.groupBy(key).agg(F.sort_array(F.collect_list(F.struct(*members))).alias("members"))


def class_counts(df: DataFrame, col: str) -> DataFrame:
    """A11."""
    return df.groupBy(col).agg(F.count(F.lit(1)).alias("n"))


def describe(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Count, mean, sample std, min, exact quartiles and max per numeric column.

    Long form (one row per column).  The table is unpivoted once and every
    statistic is a grouped aggregate on the column name.
    """
    from pyspark.sql import types as T

    cols = list(cols or [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)])
    long = df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"),
                                                  F.col(c).cast("double").alias("value"))
                                         for c in cols])).alias("kv")).select("kv.*")
    basic = long.groupBy("column_name").agg(F.count("value").alias("count"), F.avg("value").alias("mean"),
                                       F.stddev_samp("value").alias("std"), F.min("value").alias("min"),
                                       F.max("value").alias("max"))
    qs = exact_quantiles(long, "value", [0.25, 0.5, 0.75], by=["column_name"], prefix="__q")
    return (basic.join(qs, "column_name", "left")
                 .select("column_name", "count", "mean", "std", "min", F.col("__q0").alias("p25"),
                         F.col("__q1").alias("p50"), F.col("__q2").alias("p75"), "max"))


def profile(df: DataFrame) -> DataFrame:
    """Non-NULL count and type per column (one scan, then an unpivot)."""
    counts = df.agg(*[F.count(F.col(f"`{c}`")).alias(c) for c in df.columns])
    types = dict(df.dtypes)
    return counts.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(f"`{c}`").alias("non_null"), F.lit(types[c]).alias("dtype"))
        for c in df.columns])).alias("r")).select("r.*")


def distinct_values(df: DataFrame, col: str) -> DataFrame:
    """A14."""
    return df.select(col).distinct()


def mean_std_pop(df: DataFrame, col: str, by: Sequence[str] = ()) -> DataFrame:
    """Mean and population std (divides by n)."""
    aggs = [F.avg(col).alias("mean"), F.stddev_pop(col).alias("std")]
    return df.groupBy(*by).agg(*aggs) if by else df.agg(*aggs)


def gram_stats(df: DataFrame, features: Sequence[str], label: str) -> dict:
    """Every sufficient statistic of a least-squares problem in ONE pass.

    Returns m, sums of x, y, y^2, x_i x_j and x_i y as Python numbers (model-sized:
    O(n_features^2) values regardless of the row count).  Rows with a NULL in any
    feature or in the label take no part in any of the sums.
    """
    xs = [F.col(c).cast("double") for c in features]
    y = F.col(label).cast("double")
    aggs = [F.count(F.lit(1)).alias("m"), F.sum(y).alias("sy"), F.sum(y * y).alias("syy")]
    aggs += [F.sum(x).alias(f"sx{i}") for i, x in enumerate(xs)]
    aggs += [F.sum(x * y).alias(f"sxy{i}") for i, x in enumerate(xs)]
    aggs += [F.sum(xs[i] * xs[j]).alias(f"sxx{i}_{j}") for i in range(len(xs)) for j in range(i, len(xs))]
    full = y.isNotNull()
    for x in xs:
        full = full & x.isNotNull()
    return df.where(full).agg(*aggs).first().asDict()
