"""DBSCAN in any number of dimensions over pairs of groups of points.

The points are dealt to k-d leaves and packed in groups of bounded size, and every pair of groups whose boxes
lie within eps is one task: all pairs of points, decided tile by tile by one matrix product.  That is
quadratic where no box can be ruled out (in many dimensions hardly any can), but a task holds
two groups and one tile, however large the table is, and nothing is shuffled but the groups once.

A first pass compares the points of each group: neighbour counts, and the points that have enough of
them there (sure cores) joined to their parts.  A second one compares the groups with each other and
joins parts.  A pair with a point that is not a sure core within its task is handed on as
it is: such a point has fewer than ``min_samples`` neighbours there, so these pairs are few.  When all
counts are added up, they turn out to be edges between cores, borders or nothing, and
components over all edges are the clusters.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.operators.cluster import components
from tessera.operators.linkage import MAX_LEAVES, SAMPLE, KdLeaves, _gap, _square
from tessera.operators.windows import ordinal
from tessera.session import cut_lineage

__all__ = ["dbscan_nd", "replication"]

GROUP_POINTS, GROUP_VALUES = 16_384, 1 << 20  # at most so many points and numbers (8 MB) in a group
GROUPS = 16  # a small table is cut in about as many groups, so that there are tasks enough
TILE = (512, 2048)  # points of the two groups that are compared at once
PENDING, JOINED, COUNT = 0, 1, 2  # kinds of rows that the passes return


def _points(df: DataFrame, id_col: str, features: Column) -> DataFrame:
    ok = F.col("id").isNotNull() & F.col("x").isNotNull() & ~F.exists("x", lambda v: v.isNull() | F.isnan(v))
    return cut_lineage(df.select(F.col(id_col).alias("id"), features.cast("array<double>").alias("x")).where(ok))


def _matrix(b: pa.RecordBatch) -> np.ndarray:
    return b.column("x").flatten().to_numpy(zero_copy_only=False).reshape(b.num_rows, -1)


def _groups(pts: DataFrame, leaf_points: int | None) -> tuple[DataFrame, int]:
    """(g, n, ids, x: the bytes of a matrix), a group a partition, and their number."""
    n = pts.count()
    kind = pts.schema["id"].dataType.simpleString()
    bucket = max(1, math.ceil(2 * n / SAMPLE))
    sample = pts.where(F.pmod(F.xxhash64("id"), F.lit(bucket)) == 0).select("x").limit(SAMPLE).toPandas()["x"]
    x = np.array([list(v) for v in sample], float)
    d = x.shape[1] if len(x) else len(pts.first()["x"]) if n else 1
    most = max(1, min(leaf_points or min(GROUP_POINTS, max(1024, n // GROUPS)), GROUP_VALUES // max(d, 1)))
    kd = KdLeaves(x.reshape(-1, d), min(MAX_LEAVES, math.ceil(n / most)), d)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                leaf = pa.array(kd.leaf(_matrix(b)).astype(np.int32))
                yield pa.RecordBatch.from_arrays([leaf, b.column("id"), b.column("x")], ["leaf", "id", "x"])

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0

        def group() -> pa.RecordBatch:
            ids = pa.concat_arrays([h[0] for h in held])
            return pa.RecordBatch.from_arrays([pa.array([n], pa.int32()), pa.ListArray.from_arrays(pa.array([0, n], pa.int32()), ids),
                                               pa.array([np.concatenate([h[1] for h in held]).tobytes()], pa.binary())], ["n", "ids", "x"])

        for b in batches:
            at = 0
            while at < b.num_rows:
                part = b.slice(at, most - n)
                held.append((part.column("id"), _matrix(part)))
                n, at = n + part.num_rows, at + part.num_rows
                if n == most:
                    yield group()
                    held, n = [], 0
        if n:
            yield group()

    parts = max(1, min(math.ceil(n / most), math.ceil(n / 65_536)))
    dealt = pts.mapInArrow(deal, f"leaf int, id {kind}, x array<double>").repartitionByRange(parts, "leaf").sortWithinPartitions("leaf")
    found = cut_lineage(dealt.mapInArrow(packed, f"n int, ids array<{kind}>, x binary").withColumn("key", F.monotonically_increasing_id()))
    keys = sorted(r[0] for r in found.select("key").collect())
    number = pts.sparkSession.createDataFrame([(k, i) for i, k in enumerate(keys)], "key long, g long")  # a row a group
    many = max(1, len(keys))
    return cut_lineage(found.join(F.broadcast(number), "key").drop("key").repartitionById(many, F.col("g").cast("int"))), many


def _array(cell: bytes, n: int) -> np.ndarray:
    return np.frombuffer(cell).reshape(n, -1)


def replication(df: DataFrame, id_col: str, features: Column, eps: float, leaf_points: int | None = None) -> float:
    """Groups that a point is compared with by ``dbscan_nd`` (its own is one), on average."""
    def boxes(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for n, x in zip(b["n"], b["x"]):
                yield pd.DataFrame({"n": [n], "lo": [_array(x, n).min(0)], "hi": [_array(x, n).max(0)]})

    got = _groups(_points(df, id_col, features), leaf_points)[0].mapInPandas(boxes, "n int, lo array<double>, hi array<double>").toPandas()
    if not len(got):
        return 0.0
    n, lo, hi = got["n"].to_numpy(), np.stack(got["lo"].to_numpy()), np.stack(got["hi"].to_numpy())
    return float(sum(n[i] * (_gap(lo[i], hi[i], lo, hi) <= eps * eps).sum() for i in range(len(n))) / n.sum())


def _within(x: np.ndarray, y: np.ndarray, limit: float) -> np.ndarray:
    """``_square(x, y) <= limit`` for all pairs: one matrix product decides all but the pairs too close to
    the limit for its rounding, which are looked at one by one."""
    size = (x * x).sum(axis=1)[:, None] + (y * y).sum(axis=1)[None, :]
    slack = (4 * x.shape[1] + 32) * 2.3e-16 * size
    gap = size - 2.0 * (x @ y.T) - limit
    near = gap < -slack
    i, j = np.nonzero(np.abs(gap) <= slack)
    for at in range(0, len(i), 1 << 16):
        p, q = i[at:at + (1 << 16)], j[at:at + (1 << 16)]
        near[p, q] = _square(x[p], y[q]) <= limit
    return near


class _Side:
    """Points as one side of tiles; in single precision where that settles all but few pairs."""

    def __init__(self, x: np.ndarray, limit: float):
        self.x, self.size = x, (x * x).sum(axis=1)
        self.most = float(self.size.max(initial=0.0))
        # rounding to single precision and summing in it, with room to spare
        self.slack = (4 * x.shape[1] + 32) * 1.2e-7 * (self.most + limit)
        self.single = limit > 1e-20 and self.most < 1e30 and self.slack < 0.01 * limit
        if self.single:
            one = np.ones(len(x))
            self.left = np.column_stack([x, (limit - self.size) / 2, one]).astype("f4")
            self.right = np.ascontiguousarray(np.column_stack([x, one, -self.size / 2]).astype("f4").T)


def _near(a: _Side, b: _Side, i: int, j: int, limit: float) -> tuple[np.ndarray, np.ndarray]:
    """(points of a, points of b) within the limit, of the tile that begins at (i, j)."""
    if not (a.single and b.single):
        p, q = np.nonzero(_within(a.x[i:i + TILE[0]], b.x[j:j + TILE[1]], limit))
        return p + i, q + j
    half = a.left[i:i + TILE[0]] @ b.right[:, j:j + TILE[1]]  # half the distance to the limit
    slack, width = a.slack + b.slack, half.shape[1]
    flat = half.ravel()
    at = np.flatnonzero(flat >= -slack)
    sure, (p, q) = flat[at] > slack, np.divmod(at, width)
    p, q = p + i, q + j
    close = np.flatnonzero(~sure)
    for k in range(0, len(close), 1 << 16):
        c = close[k:k + (1 << 16)]
        sure[c] = _square(a.x[p[c]], b.x[q[c]]) <= limit
    return p[sure], q[sure]


def _join(root: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Points named by the smallest of their part, with the parts of a and b joined."""
    while True:
        ra, rb = root[a], root[b]
        apart = ra != rb
        if not apart.any():
            return root
        a, b, ra, rb = a[apart], b[apart], ra[apart], rb[apart]
        np.minimum.at(root, np.maximum(ra, rb), np.minimum(ra, rb))
        while (root[root] != root).any():
            root = root[root]


def _compare(x: np.ndarray, y: np.ndarray | None, count: np.ndarray, root: np.ndarray, limit: float, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All pairs of the points x (with each other, or with y, which are numbered after them): (counts,
    roots, pending pairs).  ``count`` and ``root`` are what is known before; points with ``least`` are sure cores."""
    count, root = count.copy(), root.copy()
    a = _Side(x, limit)
    b, shift = (a, 0) if y is None else (_Side(y, limit), len(x))
    pending = []
    for i in range(0, len(x), TILE[0]):
        for j in range(0 if y is not None else i // TILE[1] * TILE[1], len(b.x), TILE[1]):
            p, q = _near(a, b, i, j, limit)
            if y is None:
                once = p < q
                p, q = p[once], q[once]
            if not len(p):
                continue
            q = q + shift
            count += np.bincount(p, minlength=len(count)) + np.bincount(q, minlength=len(count))
            sure = (count[p] >= least) & (count[q] >= least)
            if not sure.all():
                pending.append(np.stack([p[~sure], q[~sure]]))
            root = _join(root, p[sure], q[sure])
    left = np.concatenate(pending, axis=1) if pending else np.empty((2, 0), int)
    sure = (count[left] >= least).all(axis=0)
    return count, _join(root, *left[:, sure]), left[:, ~sure]


def dbscan_nd(df: DataFrame, id_col: str, features: Column, eps: float, min_samples: int, leaf_points: int | None = None) -> DataFrame:
    """(id, label, is_core) like ``cluster.dbscan``: a neighbourhood holds the point itself and those at
    ``distance <= eps``; clusters are numbered by their smallest core id, a border point joins the
    lowest-numbered cluster among its core neighbours, noise is -1.

    ``features`` is an array column of equal lengths, ids are unique; rows with a null id or a null or NaN entry are left out.
    """
    pts = _points(df, id_col, features)
    kind, limit = pts.schema["id"].dataType.simpleString(), eps * eps
    groups, many = _groups(pts, leaf_points)
    made = f"t int, a long, b long, ia {kind}, ib {kind}, counts binary, root binary, ids array<{kind}>"

    def rows(t: int, numbers: np.ndarray, at: np.ndarray, ids: pa.Array, schema: pa.Schema) -> pa.RecordBatch:
        """Pairs (columns of ``at``) with the numbers and ids of their points."""
        n = at.shape[1]
        return pa.RecordBatch.from_arrays([pa.array(np.full(n, t, np.int32)), *(pa.array(numbers[v]) for v in at), *(ids.take(pa.array(v)) for v in at),
                                           *(pa.nulls(n, schema.field(c).type) for c in ("counts", "root", "ids"))], schema=schema)

    def outcome(ids: pa.Array, numbers: np.ndarray, before: np.ndarray, root: np.ndarray, pending: np.ndarray) -> Iterator[pa.RecordBatch]:
        schema = schema_of(ids)
        moved = np.flatnonzero((root != before) & (before == np.arange(len(before))))
        yield rows(JOINED, numbers, np.stack([moved, root[moved]]), ids, schema)
        yield rows(PENDING, numbers, pending, ids, schema)

    def schema_of(ids: pa.Array) -> pa.Schema:
        return pa.schema([("t", pa.int32()), ("a", pa.int64()), ("b", pa.int64()), ("ia", ids.type), ("ib", ids.type),
                          ("counts", pa.binary()), ("root", pa.binary()), ("ids", pa.list_(ids.type))])

    def counted(g: int, count: np.ndarray, ids: pa.Array, root: np.ndarray | None = None) -> pa.RecordBatch:
        schema = schema_of(ids)
        return pa.RecordBatch.from_arrays([pa.array([COUNT], pa.int32()), pa.array([g], pa.int64()), *(pa.nulls(1, schema.field(c).type) for c in ("b", "ia", "ib")),
                                           pa.array([count.astype(np.int64).tobytes()], pa.binary()), pa.array([None if root is None else root.astype(np.int64).tobytes()], pa.binary()),
                                           pa.nulls(1, schema.field("ids").type) if root is None else pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids)], schema=schema)

    def cells(b: pa.RecordBatch, i: int, end: str = "") -> tuple[int, int, np.ndarray, pa.Array]:
        n = b.column("n" + end)[i].as_py()
        return b.column("g" + end)[i].as_py(), n, np.frombuffer(b.column("x" + end)[i].as_buffer()).reshape(n, -1), b.column("ids" + end)[i].values

    def inside(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                g, n, x, ids = cells(b, i)
                own = np.isfinite(x).all(axis=1).astype(int)
                count, root, pending = _compare(x, None, own, np.arange(n), limit, min_samples)
                yield counted(g, count, ids, root)
                yield from outcome(ids, g * GROUP_VALUES + np.arange(n), np.arange(n), root, pending)

    def between(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                (g, n, x, ids), (h, m, y, ids2) = cells(b, i), cells(b, i, "2")
                if _gap(x.min(0), x.max(0), y.min(0), y.max(0)) > limit:
                    continue
                before, root = (np.concatenate([np.frombuffer(b.column(c)[i].as_buffer(), np.int64), np.frombuffer(b.column(c + "2")[i].as_buffer(), np.int64) + s])
                                for c, s in (("counts", 0), ("root", n)))
                count, new, pending = _compare(x, y, before, root, limit, min_samples)
                found = count - before
                if found.any():
                    ids = pa.concat_arrays([ids, ids2])
                    yield counted(g, found[:n], ids)
                    yield counted(h, found[n:], ids)
                    yield from outcome(ids, np.concatenate([g * GROUP_VALUES + np.arange(n), h * GROUP_VALUES + np.arange(m)]), root, new, pending)

    first = cut_lineage(groups.mapInArrow(inside, made))
    all_ = first
    if many > 1:
        known = cut_lineage(groups.join(first.where(F.col("t") == COUNT).select(F.col("a").alias("g"), "counts", "root"), "g")
                            .repartitionById(many, F.col("g").cast("int")))
        other = known.select(*[F.col(c).alias(f"{c}2") for c in known.columns])
        # a task a pair of groups: both are read as they lie, so nothing is copied to a shuffle
        met = known.join(other.hint("shuffle_replicate_nl"), F.col("g") < F.col("g2"))
        all_ = first.unionByName(cut_lineage(met.mapInArrow(between, made)))

    def summed(pdf: pd.DataFrame) -> pd.DataFrame:
        total = sum(np.frombuffer(c, np.int64) for c in pdf["counts"])
        ids = next(v for v in pdf["ids"] if v is not None)
        return pd.DataFrame({"num": pdf["a"].iloc[0] * GROUP_VALUES + np.arange(len(total)), "id": ids, "is_core": total >= min_samples})

    core = cut_lineage(all_.where(F.col("t") == COUNT).select("a", "counts", "ids").groupBy("a").applyInPandas(summed, f"num long, id {kind}, is_core boolean"))
    joined = all_.where(F.col("t") == JOINED).select(F.lit(True).alias("is_core"), F.col("ia").alias("id"), F.col("ib").alias("core"))
    flag = core.select("num", "is_core")
    open_ = all_.where(F.col("t") == PENDING).select("a", "b", "ia", "ib") \
        .join(flag.select(F.col("num").alias("a"), F.col("is_core").alias("ca")), "a") \
        .join(flag.select(F.col("num").alias("b"), F.col("is_core").alias("cb")), "b").where(F.col("ca") | F.col("cb"))
    open_ = open_.select((F.col("ca") & F.col("cb")).alias("is_core"), F.when(F.col("ca") & ~F.col("cb"), F.col("ib")).otherwise(F.col("ia")).alias("id"),
                         F.when(F.col("ca") & ~F.col("cb"), F.col("ia")).otherwise(F.col("ib")).alias("core"))
    named = cut_lineage(joined.unionByName(open_).distinct())
    edges = named.where("is_core")
    found = components(edges, "id", "core", nodes=core.where("is_core").select(F.col("id").alias("node")))
    # a component's name is its smallest core id: ranked without a single task
    labels = ordinal(found.select("component").distinct(), [], ["component"], "label").select("component", F.col("label").cast("int").alias("label"))
    of_core = cut_lineage(found.join(labels, "component").select(F.col("node").alias("core"), "label"))
    border = named.where("not is_core").join(of_core, "core").groupBy("id").agg(F.min("label").alias("label"))
    label = of_core.withColumnRenamed("core", "id").unionByName(border)
    return core.join(label, "id", "left").select(F.col("id").alias(id_col), F.coalesce("label", F.lit(-1)).alias("label"), "is_core")
