"""Windows over ordered series (W1-W5) and the two-level prefix scan they share.

A plain ``Window.partitionBy(series).orderBy(...)`` puts each series in one task,
so a series holding a third of the table would run on one core.  ``prefix_scan``
splits the ordered rows into range chunks (boundaries from a bounded sample of the
key distribution, so a hot series is cut into many chunks), scans every chunk
locally, aggregates one summary row per (series, chunk), scans those few
summaries and joins the carry back: the standard parallel prefix-sum, JVM-side.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.session import cut_lineage

__all__ = ["prefix_scan", "fill_group_median", "running_bank", "nth_by_order", "deepest_basin",
           "assign_folds", "ordinal"]

_OPS = {"sum": F.sum, "max": F.max, "min": F.min}


def _combine(op: str, carry: Column, local: Column) -> Column:
    if op == "sum":
        return F.coalesce(carry, F.lit(0)) + F.coalesce(local, F.lit(0))
    if op == "max":
        return F.greatest(carry, local)
    return F.least(carry, local)


def chunked(df: DataFrame, part: Sequence[str], order: Sequence, chunks: int | None = None) -> DataFrame:
    """``df`` range-partitioned by (part, order) with the partition number as ``__chunk``.

    Spark's range partitioner samples the keys in the tasks; equal keys share a chunk and
    chunks follow the order of the keys.  The result is written out once (a reliable
    checkpoint), so every later branch sees the same chunks and the source is read once.
    """
    n = chunks or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = [F.col(p).asc() for p in part] + [(F.col(c) if isinstance(c, str) else c).asc() for c in order]
    if not keys or n <= 1:
        return cut_lineage(df.withColumn("__chunk", F.lit(0)))
    return cut_lineage(df.repartitionByRange(n, *keys).withColumn("__chunk", F.spark_partition_id()))


def prefix_scan(df: DataFrame, part: Sequence[str], order: Sequence, aggs: Mapping[str, tuple[str, Column]],
                inclusive: bool = True, reverse: bool = False, chunks: int | None = None,
                keep_chunks: bool = False) -> DataFrame:
    """Running aggregates per ``part`` in ``order`` (a total order), added as new columns.

    ``aggs`` maps output name -> (op, expression) with op in sum/max/min.
    ``inclusive`` includes the current row; ``reverse`` scans from the end.
    Sums over an empty prefix are 0, max/min are NULL.

    Rows are cut in range chunks by ``chunked`` (already done when ``df`` has a
    ``__chunk`` column; ``keep_chunks`` leaves it there, so scans over one order share
    one partitioning).  A chunk is scanned by itself, one summary row a (part, chunk) is
    scanned again, and the carry is joined back.
    """
    part = list(part)
    if "__chunk" not in df.columns:
        df = chunked(df, part, order, chunks)
    ocols = [F.col(c) if isinstance(c, str) else c for c in order]
    okeys = [c.desc() for c in ocols] if reverse else [c.asc() for c in ocols]
    tmp = {f"__x{i}": expr for i, (_, (_, expr)) in enumerate(aggs.items())}
    base = df.withColumns(tmp)
    frame = (Window.partitionBy(*part, "__chunk").orderBy(*okeys)
                   .rowsBetween(Window.unboundedPreceding, 0 if inclusive else -1))
    local = base.withColumns({f"__l{i}": _OPS[op](F.col(f"__x{i}")).over(frame)
                              for i, (_, (op, _)) in enumerate(aggs.items())})
    summary = base.groupBy(*part, "__chunk").agg(*[
        _OPS[op](F.col(f"__x{i}")).alias(f"__t{i}") for i, (_, (op, _)) in enumerate(aggs.items())])
    corder = F.col("__chunk").desc() if reverse else F.col("__chunk").asc()
    before = Window.partitionBy(*part).orderBy(corder).rowsBetween(Window.unboundedPreceding, -1)
    summary = summary.select(*[F.col(p).alias(f"__p_{p}") for p in part], F.col("__chunk").alias("__c"),
                             *[_OPS[op](F.col(f"__t{i}")).over(before).alias(f"__carry{i}")
                               for i, (_, (op, _)) in enumerate(aggs.items())])
    # Only the series that runs on from the previous chunk has a carry, so at most
    # (chunks - 1) summary rows are non-empty: a proven bound, broadcast safely.
    # A carry counts if any of the aggregates has one (another may be NULL so far).
    some = F.lit(False)
    for i in range(len(aggs)):
        some = some | F.col(f"__carry{i}").isNotNull()
    summary = summary.where(some)
    cond = F.col("__chunk") == F.col("__c")
    for p in part:
        cond = cond & F.col(p).eqNullSafe(F.col(f"__p_{p}"))
    joined = local.join(F.broadcast(summary), cond, "left")
    out = joined.withColumns({name: _combine(op, F.col(f"__carry{i}"), F.col(f"__l{i}"))
                              for i, (name, (op, _)) in enumerate(aggs.items())})
    drop = [*([] if keep_chunks else ["__chunk"]), "__c", *[f"__p_{p}" for p in part]]
    for i in range(len(aggs)):
        drop += [f"__x{i}", f"__l{i}", f"__carry{i}"]
    return out.drop(*drop)


def ordinal(df: DataFrame, part: Sequence[str], order: Sequence, name: str = "pos",
            chunks: int | None = None) -> DataFrame:
    """0-based position of each row inside its partition (a distributed row_number() - 1)."""
    return prefix_scan(df, part, order, {name: ("sum", F.lit(1).cast("long"))}, inclusive=False, chunks=chunks)


def fill_group_median(df: DataFrame, col: str, keys: Sequence[str]) -> DataFrame:
    """NULLs of ``col`` take the exact median of their group.

    Grouped exact median (``aggregate.exact_quantiles``) joined back on the keys --
    the same result as ``coalesce(c, median(c) over (partition by keys))`` without
    a per-group window task.
    """
    from tessera.operators.aggregate import group_median
    from tessera.operators.joins import attach_group_stat

    med = group_median(df, col, keys, alias="__med")
    return (attach_group_stat(df, keys, med)
              .withColumn(col, F.coalesce(F.col(col), F.col("__med"))).drop("__med"))


def running_bank(df: DataFrame, series: Sequence[str], order: Sequence[str], h: str,
                 reverse: bool = False, chunks: int | None = None, keep_chunks: bool = False) -> DataFrame:
    """Position, previous running maximum and bank flag of each point.

    A point is a bank when it is strictly higher than every earlier point (in scan
    direction); ``bank`` is the height of the last bank before the point.  A point
    without a height keeps its position and is never a bank.
    """
    sc = prefix_scan(df, series, order, {"pos": ("sum", F.lit(1).cast("long")), "bank": ("max", F.col(h))},
                     inclusive=False, reverse=reverse, chunks=chunks, keep_chunks=keep_chunks)
    if reverse:
        sc = sc.drop("pos")
    return sc.withColumn("is_bank", F.col(h).isNotNull() & (F.col("bank").isNull() | (F.col(h) > F.col("bank"))))


def nth_by_order(df: DataFrame, order: str, n: int, desc: bool = True, tiebreak: Sequence[str] = ()) -> DataFrame:
    """The row at 0-based position ``n`` of a sort (NULLs last).

    Top-(n+1) first (each task keeps n+1 rows), so no global window over all rows.
    """
    from tessera.operators.order import top_k

    top = top_k(df, order, n + 1, desc=desc, tiebreak=tiebreak)
    key = F.col(order).desc_nulls_last() if desc else F.col(order).asc_nulls_last()
    w = Window.orderBy(key, *[F.col(t).asc() for t in tiebreak])
    return top.withColumn("position", F.row_number().over(w) - 1).where(F.col("position") == n)


def deepest_basin(df: DataFrame, series: Sequence[str], order: Sequence[str], h: str,
                  chunks: int | None = None) -> DataFrame:
    """The deepest basin of each series -> series, left_index, right_index, depth, lowest.

    Rule: scanning left to right the bank is the last point strictly higher than all
    before it; lower points deepen the basin; a strictly higher point closes it; an
    equal point does neither.  Then right to left likewise.  The winner is the
    deepest; ties keep the first found (left-to-right basins in closing order, then
    right-to-left ones).  Series without a basin of positive depth give no row.

    Every point between two banks has the earlier bank's height as its running
    maximum, so the basin under a bank is a grouped ``min`` keyed by (series, bank
    height): three prefix scans and grouped aggregates, no per-series task.
    """
    series = list(series)
    hc = F.col(h)
    # one range partitioning for all three scans; each scan's output is checkpointed
    # because the next one reads it twice (rows, summaries)
    src = chunked(df.select(*series, *order, h), series, order, chunks)
    a = cut_lineage(running_bank(src, series, order, h, keep_chunks=True))          # pos, bank, is_bank
    b = prefix_scan(a, series, order,
                    {"rbank": ("max", hc),
                     "next_bank": ("min", F.when(F.col("is_bank"), F.col("pos")))},
                    inclusive=False, reverse=True, keep_chunks=True)
    b = cut_lineage(b.withColumn("is_rbank", hc.isNotNull() & (F.col("rbank").isNull() | (hc > F.col("rbank")))))
    c = prefix_scan(b, series, order, {"prev_rbank": ("max", F.when(F.col("is_rbank"), F.col("pos")))},
                    inclusive=False)
    c = cut_lineage(c)
    fwd = _basins(c, series, h, bank_flag="is_bank", bank_of="bank", other="next_bank", direction=0)
    rev = _basins(c, series, h, bank_flag="is_rbank", bank_of="rbank", other="prev_rbank", direction=1)
    cand = fwd.unionByName(rev).where(F.col("depth") > 0)
    rank = F.struct((-F.col("depth")).alias("d"), F.col("dir"),
                    F.when(F.col("dir") == 0, F.col("right_index")).otherwise(-F.col("left_index")).alias("o"))
    best = cand.groupBy(*series).agg(F.min_by(F.struct("left_index", "right_index", "depth", "lowest"), rank).alias("b"))
    return best.select(*series, "b.left_index", "b.right_index", "b.depth", "b.lowest")


def _basins(c: DataFrame, series: list[str], h: str, bank_flag: str, bank_of: str, other: str,
            direction: int) -> DataFrame:
    """Closed basins of one scan direction: bank rows joined to the lowest point under them."""
    low = (c.where(~F.col(bank_flag)).groupBy(*series, F.col(bank_of).alias("__b"))
             .agg(F.min(h).alias("__low")))
    low = low.select(*[F.col(s).alias(f"__s_{s}") for s in series], "__b", "__low")
    banks = c.where(F.col(bank_flag) & F.col(other).isNotNull()).select(*series, "pos", other, h)
    cond = F.col(h) == F.col("__b")
    for s in series:
        cond = cond & F.col(s).eqNullSafe(F.col(f"__s_{s}"))
    j = banks.join(low, cond)
    left, right = (F.col("pos"), F.col(other)) if direction == 0 else (F.col(other), F.col("pos"))
    return j.select(*series, F.lit(direction).alias("dir"), left.alias("left_index"),
                    right.alias("right_index"), (F.col(h) - F.col("__low")).alias("depth"), F.col("__low").alias("lowest"))


def assign_folds(df: DataFrame, label: str | None, k: int, order: Sequence[str], name: str = "fold",
                 chunks: int | None = None) -> DataFrame:
    """Contiguous (stratified when ``label`` is given) folds 0..k-1.

    Same sizes as ``ntile(k)`` per class: the first ``n mod k`` folds get one extra
    row.  Position comes from the distributed ``ordinal`` and the class size from
    a grouped count, so no class is processed in one task.
    """
    part = [label] if label else []
    pos = ordinal(df, part, order, "__o", chunks=chunks)
    if part:
        sizes = df.groupBy(*part).agg(F.count(F.lit(1)).alias("__n"))
        pos = pos.join(sizes, part, "left")
    else:
        pos = pos.withColumn("__n", F.lit(df.count()))
    q = F.floor(F.col("__n") / k)
    r = F.col("__n") - q * k
    big = r * (q + 1)
    fold = F.when(F.col("__o") < big, F.floor(F.col("__o") / (q + 1))) \
            .otherwise(r + F.floor((F.col("__o") - big) / q))
    return pos.withColumn(name, fold.cast("int")).drop("__o", "__n")
