"""Clustering (C3-C6) and connected components (G1).

* ``components``: large-star / small-star rounds (Kiveris et al., 2014), each a
  grouped ``min`` plus a join; O(log n) rounds; the edge table is checkpointed
  (reliably) every round, so lineage stays short and survives executor loss.
* ``dbscan``: grid cells of side eps/sqrt(d) with sub-cells.  Points of one cell
  are always within eps, so they are counted and their cores linked without pairs;
  across cells, whole sub-cells are counted or linked by distance bounds and only
  boundary sub-cell pairs are checked point by point.  Suits 2-3 dimensions.
* ``kmeans``: MLlib k-means (k-means||); ``elbow``: every k in one loop of scans (``lloyd``).
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Sequence

import numpy as np
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.operators.blocks import array, pack, reduced
from tessera.operators.windows import ordinal
from tessera.session import cut_lineage, spread

__all__ = ["components", "dbscan", "single_linkage", "kmeans", "elbow", "lloyd", "seeds", "kmeans_cost_one"]


def _sym(e: DataFrame) -> DataFrame:
    return e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b"))).where(
        F.col("a") != F.col("b")).distinct()


def components(edges: DataFrame, src: str = "src", dst: str = "dst", nodes: DataFrame | None = None,
               node: str = "node") -> DataFrame:
    """G1: (node, component) where component is the smallest node id of its component.

    ``nodes`` (optional, column ``node``) adds isolated nodes.
    """
    e = _sym(edges.select(F.col(src).alias("a"), F.col(dst).alias("b")))
    e = cut_lineage(e)
    while True:  # until a round leaves the edges as they are
        # large star: every neighbour above u points to the smallest of u's neighbourhood
        m = e.groupBy("a").agg(F.min("b").alias("mb")).select("a", F.least("a", "mb").alias("m"))
        large = e.join(m, "a").where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = _sym(large).persist()  # read twice below; the round's output is checkpointed
        # small star: u and its smaller neighbours point to the smallest of them
        low = large.where(F.col("b") <= F.col("a"))
        m2 = low.groupBy("a").agg(F.min("b").alias("mb")).select("a", F.least("a", "mb").alias("m"))
        small = (low.join(m2, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
                    .unionByName(m2.select("a", F.col("m").alias("b"))))
        small = cut_lineage(_sym(small))
        large.unpersist()
        # one job: any edge present on one side only means the edge set still moves
        diff = (small.withColumn("__s", F.lit(1)).join(e.withColumn("__e", F.lit(1)), ["a", "b"], "full_outer")
                     .where(F.col("__s").isNull() | F.col("__e").isNull()))
        changed = not diff.isEmpty()
        e = small
        if not changed:
            break
    labels = e.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("component")).withColumnRenamed("a", node)
    if nodes is not None:
        iso = nodes.select(F.col(node)).distinct().join(labels, node, "left_anti").withColumn("component",
                                                                                              F.col(node))
        labels = labels.unionByName(iso)
    return labels


def _offsets(d: int) -> list[tuple[int, ...]]:
    """Cell offsets whose cells can hold a point within eps (cell side eps/sqrt(d))."""
    r = math.ceil(math.sqrt(d))
    out = []
    for o in itertools.product(range(-r, r + 1), repeat=d):
        gap = math.sqrt(sum(max(abs(v) - 1, 0) ** 2 for v in o)) / math.sqrt(d)  # in units of eps
        if gap <= 1.0 + 1e-12 and any(o):
            out.append(o)
    return out


def dbscan(df: DataFrame, id_col: str, cols: Sequence[str], eps: float, min_samples: int,
           sub: int = 4) -> DataFrame:
    """(id, label, is_core).  Neighbourhoods include the point itself and use
    ``distance <= eps``.  Clusters are numbered 0, 1, ... in order of their smallest
    core id; a border point joins the lowest-numbered cluster among its core
    neighbours; noise is -1.

    Grid cells have side eps/sqrt(d), so all points of one cell are neighbours: a
    cell holding ``min_samples`` points makes them all core, and the cores of a cell
    are one node of the cluster graph -- no pairs inside a cell.  Each cell is cut
    into ``sub``^d sub-cells.  Across cells, work is done on occupied sub-cells:
    a (point or sub-cell, sub-cell) pair whose farthest distance is within eps counts
    or links without looking at points, one whose nearest distance is beyond eps is
    dropped, and only the boundary pairs left are checked point by point.  The
    bounds use a relative margin of 1e-9 on eps, so the result stays exact.
    """
    cols = list(cols)
    d = len(cols)
    side = eps / math.sqrt(d) * (1 - 1e-12)  # strictly inside eps even after rounding
    t = side / sub
    lo2, hi2 = (eps * (1 - 1e-9)) ** 2, (eps * (1 + 1e-9)) ** 2
    X = [f"__x{i}" for i in range(d)]
    S = [f"__s{i}" for i in range(d)]
    CC = [f"__c{i}" for i in range(d)]
    pts = df.select(F.col(id_col).alias("id"), *[F.col(c).cast("double").alias(x) for c, x in zip(cols, X)])
    pts = pts.select("id", *X, *[F.floor(F.col(x) / t).cast("long").alias(sx) for x, sx in zip(X, S)])
    pts = pts.select("id", *X, *S, *[F.floor(F.col(sx) / sub).cast("long").alias(c) for sx, c in zip(S, CC)])
    pts = spread(pts)
    counts = pts.groupBy(*CC).agg(F.count(F.lit(1)).alias("__cnt"))
    pts = cut_lineage(pts.join(counts, CC))
    off_arr = F.array(*[F.array(*[F.lit(v) for v in o]) for o in _offsets(d)])

    def near_subcells(left: DataFrame, keep: list[str], occ: DataFrame, occ_cols: list[str]) -> DataFrame:
        """Rows of ``left`` x occupied sub-cells ``occ`` lying in the neighbouring cells."""
        lp = left.select(*keep, *CC, F.explode(off_arr).alias("__o"))
        lp = lp.select(*keep, *CC, *[(F.col(c) + F.get(F.col("__o"), i)).alias(f"__n{i}") for i, c in enumerate(CC)])
        rp = occ.select(*[F.col(c).alias(f"__n{i}") for i, c in enumerate(CC)],
                        *[F.col(sx).alias(f"__t{i}") for i, sx in enumerate(S)], *occ_cols)
        return lp.join(rp, [f"__n{i}" for i in range(d)])

    def point_box(x: str, b: str):
        lo, hi = F.col(b) * t, (F.col(b) + 1) * t
        near = F.greatest(lo - F.col(x), F.lit(0.0), F.col(x) - hi)
        far = F.greatest(F.abs(F.col(x) - lo), F.abs(F.col(x) - hi))
        return near * near, far * far

    def point_box_bounds():
        near2, far2 = F.lit(0.0), F.lit(0.0)
        for i in range(d):
            n2, f2 = point_box(X[i], f"__t{i}")
            near2, far2 = near2 + n2, far2 + f2
        return near2, far2

    def exact_within(a: list[str], b: list[str]):
        diffs = [F.col(p) - F.col(q) for p, q in zip(a, b)]
        return sum((z * z for z in diffs), F.lit(0.0)) <= F.lit(eps * eps)

    def members(frame: DataFrame, prefix: str, extra: list[str]) -> DataFrame:
        """Points of a sub-cell, keyed by the probe columns __t*."""
        return frame.select(F.col("id").alias(f"{prefix}id"), *[F.col(x).alias(f"{prefix}{x}") for x in X],
                            *[F.col(sx).alias(f"__t{i}") for i, sx in enumerate(S)], *extra)

    # ---- core test: own cell count + whole neighbour sub-cells + boundary points
    occ = pts.groupBy(*S, *CC).agg(F.count(F.lit(1)).alias("__occ"))
    sparse = pts.where(F.col("__cnt") < min_samples)
    cand = near_subcells(sparse, ["id", *X], occ, ["__occ"])
    near2, far2 = point_box_bounds()
    cand = cand.withColumns({"__near2": near2, "__far2": far2}).where(F.col("__near2") <= hi2)
    cand = cand.persist()
    whole = cand.where(F.col("__far2") <= lo2).groupBy("id").agg(F.sum("__occ").alias("__w"))
    edge = cand.where(F.col("__far2") > lo2).select("id", *X, *[f"__t{i}" for i in range(d)])
    q = members(pts, "q_", [])
    hits = (edge.join(q, [f"__t{i}" for i in range(d)]).where(exact_within(X, [f"q_{x}" for x in X]))
                .groupBy("id").agg(F.count(F.lit(1)).alias("__e")))
    core = (pts.join(whole, "id", "left").join(hits, "id", "left")
               .withColumn("is_core", (F.col("__cnt") + F.coalesce("__w", F.lit(0)) + F.coalesce("__e", F.lit(0)))
                           >= min_samples)
               .select("id", *X, *S, *CC, "is_core"))
    core = cut_lineage(core)
    cores = core.where("is_core")
    # ---- cluster graph on cells: link neighbouring cells through their core sub-cells
    cocc = cores.groupBy(*S, *CC).agg(F.count(F.lit(1)).alias("__k"))
    sp = near_subcells(cocc.select(*S, *CC), [*S], cocc, [])
    gaps = [F.abs(F.col(sx) - F.col(f"__t{i}")) for i, sx in enumerate(S)]
    sp_near2 = sum(((F.greatest(g - 1, F.lit(0)) * t) ** 2 for g in gaps), F.lit(0.0))
    sp_far2 = sum((((g + 1) * t) ** 2 for g in gaps), F.lit(0.0))
    cell_a = F.struct(*[F.col(c).alias(f"k{i}") for i, c in enumerate(CC)])
    cell_b = F.struct(*[F.col(f"__n{i}").alias(f"k{i}") for i in range(d)])
    sp = (sp.withColumns({"__near2": sp_near2, "__far2": sp_far2, "src": cell_a, "dst": cell_b})
            .where(F.col("__near2") <= hi2))
    sp = sp.persist()
    linked = sp.where(F.col("__far2") <= lo2).select("src", "dst").distinct()
    todo = sp.where(F.col("__far2") > lo2).join(linked, ["src", "dst"], "left_anti")
    a_pts = cores.select(F.col("id").alias("a_id"), *[F.col(x).alias(f"a_{x}") for x in X],
                         *[F.col(sx).alias(sx) for sx in S])
    b_pts = members(cores, "b_", [])
    found = (todo.select("src", "dst", *S, *[f"__t{i}" for i in range(d)])
                 .join(a_pts, S).join(b_pts, [f"__t{i}" for i in range(d)])
                 .where(exact_within([f"a_{x}" for x in X], [f"b_{x}" for x in X]))
                 .select("src", "dst").distinct())
    cell_edges = linked.unionByName(found)
    core_cells = cores.select(cell_a.alias("node")).distinct()
    comp = components(cell_edges, nodes=core_cells)
    core_comp = cores.select("id", cell_a.alias("node")).join(comp, "node")
    # number clusters by their smallest core id (a distributed rank: there may be as many clusters as points)
    first = core_comp.groupBy("component").agg(F.min("id").alias("__first"))
    ranked = ordinal(first, [], ["__first"], "label").withColumn("label", F.col("label").cast("int"))
    cell_lab = cut_lineage(core_comp.join(ranked, "component").groupBy("node").agg(F.min("label").alias("label")))
    core_lab = cores.select("id", cell_a.alias("node")).join(cell_lab, "node").select("id", "label")
    # ---- border points: lowest label among core neighbours (own cell, whole sub-cells, boundary points)
    non_core = core.where(~F.col("is_core"))
    own = non_core.select("id", cell_a.alias("node")).join(cell_lab, "node").select("id", "label")
    lab_occ = cocc.select(*S, *CC, cell_a.alias("node")).join(cell_lab, "node").drop("node")
    bc = near_subcells(non_core, ["id", *X], lab_occ, ["label"])
    bnear2, bfar2 = point_box_bounds()
    bc = bc.withColumns({"__near2": bnear2, "__far2": bfar2}).where(F.col("__near2") <= hi2)
    bc = bc.persist()
    b_whole = bc.where(F.col("__far2") <= lo2).select("id", "label")
    c_pts = members(cores.join(core_lab, "id"), "c_", ["label"])
    b_edge = (bc.where(F.col("__far2") > lo2).select("id", *X, *[f"__t{i}" for i in range(d)])
                .join(c_pts, [f"__t{i}" for i in range(d)])
                .where(exact_within(X, [f"c_{x}" for x in X])).select("id", "label"))
    border = own.unionByName(b_whole).unionByName(b_edge).groupBy("id").agg(F.min("label").alias("label"))
    labels = core_lab.unionByName(border)
    out = cut_lineage(core.select("id", "is_core").join(labels, "id", "left")
                      .select(F.col("id").alias(id_col),
                              F.coalesce(F.col("label"), F.lit(-1)).cast("int").alias("label"), "is_core"))
    for tmp in (cand, sp, bc):
        tmp.unpersist()
    return out


def single_linkage(df: DataFrame, id_col: str, cols: Sequence[str], k: int) -> DataFrame:
    """Single-linkage clustering cut at ``k`` clusters -> (id, label, height); see ``linkage.cut_tree``."""
    from tessera.operators.linkage import cut_tree

    return cut_tree(df, id_col, cols, k)


def kmeans(df: DataFrame, k: int, featuresCol: str = "features", seed: int = 0, maxIter: int = 300):
    """K-means|| initialisation; returns the fitted model (``summary.trainingCost`` = inertia)."""
    return KMeans(k=k, featuresCol=featuresCol, seed=seed, maxIter=maxIter, initMode="k-means||").fit(df)


def kmeans_cost_one(df: DataFrame, featuresCol: str = "features") -> float:
    """Inertia of one cluster: sum |x|^2 - |sum x|^2 / n (one aggregate)."""
    arr = vector_to_array(F.col(featuresCol))
    row = df.select(arr.alias("x")).select(
        F.aggregate("x", F.lit(0.0), lambda a, v: a + v * v).alias("sq"), "x").agg(
        F.sum("sq").alias("sq"), F.count(F.lit(1)).alias("n"),
        F.array(*[F.sum(F.get("x", i)) for i in range(_dim(df, featuresCol))]).alias("s")).first()
    s = row["s"]
    return float(row["sq"] - sum(v * v for v in s) / row["n"])


def _dim(df: DataFrame, featuresCol: str) -> int:
    return len(df.select(featuresCol).first()[0])


def lloyd(df: DataFrame, starts: Sequence[np.ndarray], featuresCol: str = "features", maxIter: int = 300,
          tol: float = 1e-4) -> list[tuple[np.ndarray, float, int]]:
    """(centres, inertia, iterations) for every set of starting centres, all sets in one loop: an iteration is
    one scan that assigns each row in each set that still moves.  A set stops when none of its
    centres moved by more than ``tol``; a centre without rows stays where it is.  Inertia is that of the centres returned.
    """
    arr = F.col(featuresCol) if df.schema[featuresCol].dataType.typeName() == "array" else vector_to_array(F.col(featuresCol))
    blocks = pack(df, arr.cast("array<double>"), [])
    centres = [np.asarray(c, float).copy() for c in starts]
    rounds, inertia = [0] * len(centres), [0.0] * len(centres)
    moving, settled = set(range(len(centres))), set()
    while moving or settled:
        active = sorted(moving | settled)

        def make(r) -> np.ndarray:
            x = array(r["x"], r["n"]).reshape(r["n"], -1)
            out = []
            for i in active:
                c = centres[i]
                own = ((c * c).sum(1)[None, :] - 2 * (x @ c.T)).argmin(axis=1)
                n = np.bincount(own, minlength=len(c))
                sums, square = np.zeros_like(c), 0.0
                if i in moving:  # rows side by side by centre: each centre's sum is one reduction
                    has = np.flatnonzero(n)
                    first = (np.cumsum(n) - n)[has]
                    sums[has] = np.add.reduceat(x[np.argsort(own, kind="stable")], first, axis=0)
                else:  # its last scan: the inertia alone
                    off = x - c[own]
                    square = (off * off).sum()
                out += [sums.ravel(), n.astype(float), [square]]
            return np.concatenate(out)

        total = reduced(blocks, make)
        if total is None:
            return [(c, 0.0, 0) for c in centres]
        at, new = 0, {}
        for i in active:
            k, d = centres[i].shape
            sums, n = total[at:at + k * d].reshape(k, d), total[at + k * d:at + k * d + k]
            inertia[i] = float(total[at + k * d + k])
            at += k * d + k + 1
            new[i] = np.where(n[:, None] > 0, sums / np.maximum(n, 1)[:, None], centres[i])
        settled_now = set()
        for i in sorted(moving):
            moved = float(np.sqrt(((new[i] - centres[i]) ** 2).sum(1)).max())
            centres[i], rounds[i] = new[i], rounds[i] + 1
            if moved <= tol or rounds[i] >= maxIter:
                settled_now.add(i)  # one more scan gives the inertia of the final centres
        moving -= settled_now
        settled = settled_now
    return list(zip(centres, inertia, rounds))


SEED_ROWS = 10_000  # rows that starting centres are drawn from


def seeds(df: DataFrame, ks: Sequence[int], featuresCol: str = "features", seed: int = 0) -> list[np.ndarray]:
    """Starting centres for every k by k-means++ on a bounded random sample (``SEED_ROWS`` rows); the
    first k - 1 centres of a larger k are those of the smaller."""
    arr = F.col(featuresCol) if df.schema[featuresCol].dataType.typeName() == "array" else vector_to_array(F.col(featuresCol))
    x = np.array([r["x"] for r in df.select(arr.alias("x"), F.xxhash64(arr, F.lit(seed)).alias("h")).orderBy("h").limit(SEED_ROWS).collect()], float)
    rng, chosen = np.random.default_rng(seed), []
    if not len(x):
        return [np.zeros((k, 1)) for k in ks]
    least = None
    for _ in range(max(ks)):
        p = None if least is None or not least.sum() > 0 else least / least.sum()
        c = x[rng.choice(len(x), p=p)]
        chosen.append(c)
        d2 = ((x - c) ** 2).sum(1)
        least = d2 if least is None else np.minimum(least, d2)
    return [np.array(chosen[:k]) for k in ks]


def elbow(df: DataFrame, ks: Sequence[int], featuresCol: str = "features", seed: int = 0,
          maxIter: int = 300) -> DataFrame:
    """(k, inertia) for each k; all k share the scans of ``lloyd``."""
    ks = [int(k) for k in ks]
    found = lloyd(df, seeds(df, ks, featuresCol, seed), featuresCol, maxIter)
    return df.sparkSession.createDataFrame([(k, inertia) for k, (_, inertia, _) in zip(ks, found)], "k int, inertia double")
