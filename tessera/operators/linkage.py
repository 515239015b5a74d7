"""Single linkage (C2) from an exact minimum spanning tree, and complete linkage (C1) by local merging.

Single linkage
--------------

The tree is grown by Borůvka rounds: every component takes its shortest edge to a foreign
component.  Edges are ordered by (squared length, smaller id, larger id), a total order, so
equal lengths never close a circle and the tree is unique.

1. Equal points are one node (edges of length 0 join their ids to the smallest).
2. A k-d tree cut from a bounded sample deals the points to leaves.  Each leaf builds the
   tree of its own points; an edge is final at once when one of its sides lies
   strictly nearer to the edge's other end than to its region's border, since no
   other leaf can offer a shorter way out.  The parts of a leaf that final edges join are
   its fragments; the leaf's other tree edges stay as candidates (no edge between two
   points of a leaf that is not in the leaf's tree can be in the whole tree).
3. A round works on fragments, not points.  A component's bound is its best candidate, or the
   distance between typical points of leaves that follow each other.  Leaves nearer than the bound
   that hold foreign points are searched: first the nearest one, which tightens the bound,
   then those still within it.  Only points within the bound of a leaf's box are sent to it,
   in parts of bounded size.

A leaf is one task's work (quadratic in its points, ``leaf_points`` of them as long as the
table has at most ``MAX_LEAVES * leaf_points`` different points, more beyond); the table of
leaf boxes has at most ``MAX_LEAVES`` rows and is the only thing that every task sees.

Complete linkage
----------------
Two clusters are as far apart as their farthest points.  The method is reducible: pairs that are
each other's nearest may be merged in any order, with the result of the greedy order (ties go
by the smaller ids).  A cluster carries a typical point and its extreme points (in one or two
dimensions the corners of its hull, else all its points), which give the distance to any other cluster.

A stage deals the clusters by their typical points to k-d leaves.  A cluster of another leaf has
its typical point beyond the border, so it is at least as far as the border from every point: pairs
that are nearest to each other and nearer than that are merged inside the leaf, again and
again, on a distance matrix of the leaf's clusters.  The next stage deals what is left by other cuts.
A stage that merges less than a tenth doubles the leaves' capacity, so the last stage is one leaf;
it holds the clusters that no cut could separate, few unless all points are equally spaced.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.operators.cluster import components
from tessera.session import cut_lineage

__all__ = ["spanning_tree", "merge_table", "cut_tree", "complete_merges", "complete_linkage"]

MAX_LEAVES = 8192      # rows of the leaf table, which is broadcast
SAMPLE = 65_536        # points the k-d cuts are chosen from
LEAF_POINTS = 4096
PART = 131_072         # points sent to a leaf that one task compares
BLOCK = 512


class KdLeaves:
    """Axis-parallel cuts beside sample medians, halfway to the next smaller value; ``lo``/``hi`` are the regions of the leaves."""

    def __init__(self, sample: np.ndarray, leaves: int, d: int, shift: float = 0.0):
        self.dim, self.cut, self.kids = [], [], []
        lo, hi = [], []

        def grow(points: np.ndarray, n: int, a: np.ndarray, b: np.ndarray) -> int:
            """Index of the cut, or ~leaf."""
            width = np.ptp(points, axis=0) if len(points) else np.zeros(d)
            axis = int(np.argmax(width)) if d else 0
            if n < 2 or len(points) < 2 or not width[axis] > 0:
                lo.append(a)
                hi.append(b)
                return ~(len(lo) - 1)
            x = points[:, axis]
            at = float(np.quantile(x, min(max((n // 2) / n + shift, 0.05), 0.95), method="lower"))
            if at <= x.min():
                at = float(x[x > x.min()].min())
            # between two values, not on one: a value that many points share would lie on the border
            below = float(x[x < at].max())
            middle = below + (at - below) / 2
            at = middle if middle > below else at
            me = len(self.dim)
            self.dim.append(axis)
            self.cut.append(at)
            self.kids.append((0, 0))
            b2, a2 = b.copy(), a.copy()
            b2[axis] = a2[axis] = at
            left = grow(points[x < at], n // 2, a, b2)
            self.kids[me] = (left, grow(points[x >= at], n - n // 2, a2, b))
            return me

        self.root = grow(sample, leaves, np.full(d, -np.inf), np.full(d, np.inf))
        self.lo, self.hi = np.array(lo).reshape(-1, d), np.array(hi).reshape(-1, d)

    def leaf(self, x: np.ndarray) -> np.ndarray:
        """Leaf of each row of x."""
        at = np.full(len(x), self.root)
        dim, cut, kids = np.array(self.dim, int), np.array(self.cut), np.array(self.kids, int).reshape(-1, 2)
        while (open_ := np.flatnonzero(at >= 0)).size:
            node = at[open_]
            at[open_] = kids[node, (x[open_, dim[node]] >= cut[node]).astype(int)]
        return ~at


def _square(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared distances, summed over the dimensions in order (the same bits wherever a pair meets)."""
    out = 0.0
    for i in range(a.shape[-1]):
        out = out + (a[..., i] - b[..., i]) ** 2
    return out


def _gap(alo: np.ndarray, ahi: np.ndarray, blo: np.ndarray, bhi: np.ndarray) -> np.ndarray:
    """Squared distance between boxes, a little below the true one."""
    out = 0.0
    for i in range(alo.shape[-1]):
        g = np.maximum(np.maximum(alo[..., i] - bhi[..., i], blo[..., i] - ahi[..., i]), 0.0)
        out = out + g * g
    return out * (1 - 1e-9)


def local_tree(x: np.ndarray) -> list[tuple[float, int, int]]:
    """The tree of a few points under the order (square, i, j), ascending: Prim's method."""
    n = len(x)
    d2, low, high = np.full(n, np.inf), np.zeros(n, int), np.zeros(n, int)
    left, tree, at = np.arange(1, n), [], 0
    while len(left):
        s = _square(x[left], x[at])
        lo, hi = np.minimum(left, at), np.maximum(left, at)
        old = d2[left]
        better = (s < old) | ((s == old) & ((lo < low[left]) | ((lo == low[left]) & (hi < high[left]))))
        w = left[better]
        d2[w], low[w], high[w] = s[better], lo[better], hi[better]
        ties = left[d2[left] == d2[left].min()]
        at = int(ties[np.lexsort((high[ties], low[ties]))[0]])
        tree.append((float(d2[at]), int(low[at]), int(high[at])))
        left = left[left != at]
    return sorted(tree)


def fragments(x: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, list, list]:
    """(fragment of each point, final edges, candidate edges) of a leaf with region lo..hi.
    A fragment is named by its smallest point."""
    border = np.minimum(x - lo, hi - x).min(axis=1) if len(x) else np.zeros(0)
    border = np.where(border > 0, border, 0.0) ** 2 * (1 - 1e-9)
    up, stuck = np.arange(len(x)), np.zeros(len(x), bool)

    def top(i: int) -> int:
        while up[i] != i:
            up[i] = up[up[i]]
            i = up[i]
        return i

    final, open_ = [], []
    for e in local_tree(x):
        a, b = top(e[1]), top(e[2])
        if (not stuck[a] and border[a] > e[0]) or (not stuck[b] and border[b] > e[0]):
            a, b = min(a, b), max(a, b)
            up[b], border[a], stuck[a] = a, min(border[a], border[b]), stuck[a] or stuck[b]
            final.append(e)
        else:
            stuck[a] = stuck[b] = True  # their shortest way out is not proven: the rounds decide it
            open_.append(e)
    return np.array([top(i) for i in range(len(x))], int), final, open_


def _nearest(own: pd.DataFrame, asked: pd.DataFrame) -> list[tuple]:
    """For each component among ``asked`` its shortest edge (comp, other, d2, a, b) to foreign points in ``own``."""
    own = own.sort_values("id", kind="stable")
    ids, comps, x = own["id"].to_numpy(), own["comp"].to_numpy(), np.stack(own["x"].to_numpy())
    best: dict = {}
    q_ids, q_comps, q_x = asked["id"].to_numpy(), asked["comp"].to_numpy(), np.stack(asked["x"].to_numpy())
    for i in range(0, len(q_ids), BLOCK):
        s = _square(q_x[i:i + BLOCK, None, :], x[None, :, :])
        s[q_comps[i:i + BLOCK, None] == comps[None, :]] = np.inf
        at = s.argmin(axis=1)  # the smallest id among equals
        for j, p in enumerate(at):
            if np.isfinite(s[j, p]):
                q, c = q_ids[i + j], q_comps[i + j]
                edge = (float(s[j, p]), min(q, ids[p]), max(q, ids[p]), comps[p])
                if c not in best or edge[:3] < best[c][:3]:
                    best[c] = edge
    return [(c, e[3], e[0], e[1], e[2]) for c, e in best.items()]


def spanning_tree(df: DataFrame, id_col: str, cols: Sequence[str], leaf_points: int = LEAF_POINTS) -> DataFrame:
    """Edges (a, b, d2) of the minimum spanning tree, a < b, d2 the squared distance.

    ``id_col`` must be unique; rows with a null id or a null or NaN coordinate are left out.
    """
    d, kind = len(cols), df.schema[id_col].dataType.simpleString()
    spark = df.sparkSession
    pts = cut_lineage(_clean(df, id_col, cols))
    nodes = cut_lineage(pts.groupBy("x").agg(F.min("id").alias("id"), F.count(F.lit(1)).alias("n")))
    again = pts.join(nodes.where("n > 1").select("x", F.col("id").alias("a")), "x").where("id <> a") \
        .select("a", F.col("id").alias("b"), F.lit(0.0).alias("d2"))
    n = nodes.count()
    if n < 2:
        return again
    # a hash sample of bounded size; the cuts only decide the balance of the leaves, not the result
    bucket = max(1, math.ceil(2 * n / SAMPLE))
    sample = nodes.where(F.pmod(F.xxhash64("id"), F.lit(bucket)) == 0).select("x").limit(SAMPLE).toPandas()["x"]
    kd = KdLeaves(np.array(sample.tolist(), float).reshape(-1, d), min(MAX_LEAVES, math.ceil(n / leaf_points)), d)

    def deal(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            if len(b):
                yield b.assign(leaf=kd.leaf(np.stack(b["x"].to_numpy())).astype(np.int32))

    def build(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("id", kind="stable")
        leaf, ids, x = int(pdf["leaf"].iloc[0]), pdf["id"].to_numpy(), np.stack(pdf["x"].to_numpy())
        frag, final, open_ = fragments(x, kd.lo[leaf], kd.hi[leaf])
        rows = [("point", leaf, i, ids[f], None, None, None, p) for i, f, p in zip(ids, frag, x)]
        rows += [("tree", leaf, ids[i], ids[j], s, None, None, None) for s, i, j in final]
        rows += [("open", leaf, ids[i], ids[j], s, ids[frag[i]], ids[frag[j]], None) for s, i, j in open_]
        return pd.DataFrame(rows, columns=["kind", "leaf", "a", "b", "d2", "fa", "fb", "x"])

    dealt = nodes.select("id", "x").mapInPandas(deal, f"id {kind}, x array<double>, leaf int")
    built = cut_lineage(dealt.groupBy("leaf").applyInPandas(
        build, f"kind string, leaf int, a {kind}, b {kind}, d2 double, fa {kind}, fb {kind}, x array<double>"))
    tree = built.where("kind = 'tree'").select("a", "b", "d2")
    point = built.where("kind = 'point'").select("leaf", F.col("a").alias("id"), F.col("b").alias("frag"), "x")
    open_ = built.where("kind = 'open'").select("a", "b", "d2", "fa", "fb")

    def box(i: int):
        return F.col("x")[i]

    state = cut_lineage(point.groupBy("leaf", "frag").agg(
        F.array(*[F.min(box(i)) for i in range(d)]).alias("lo"), F.array(*[F.max(box(i)) for i in range(d)]).alias("hi"),
        F.count(F.lit(1)).alias("n")).withColumn("comp", F.col("frag")))
    # one row a leaf: its tight box and a typical point (at most MAX_LEAVES rows)
    leaves = state.groupBy("leaf").agg(
        F.array(*[F.min(F.col("lo")[i]) for i in range(d)]).alias("lo"), F.array(*[F.max(F.col("hi")[i]) for i in range(d)]).alias("hi")) \
        .join(point.groupBy("leaf").agg(F.min_by(F.struct("id", "frag", "x"), "id").alias("p")), "leaf").orderBy("leaf").collect()
    number = [r["leaf"] for r in leaves]
    blo, bhi = np.array([r["lo"] for r in leaves]), np.array([r["hi"] for r in leaves])
    best_edge = "comp {0}, other {0}, d2 double, a {0}, b {0}".format(kind)

    def least(edges: DataFrame) -> DataFrame:
        return edges.groupBy("comp").agg(F.min(F.struct("d2", "a", "b", "other")).alias("e")) \
            .select("comp", "e.other", "e.d2", "e.a", "e.b")

    def search(pairs: DataFrame, state: DataFrame) -> DataFrame:
        """The exact least edge of each component over (target, leaf, frag, comp, n, d2) pairs."""
        parts = pairs.groupBy("target").agg(F.ceil(F.sum("n") / PART).cast("int").alias("parts"))
        lo, hi = F.col("tlo"), F.col("thi")
        gap = sum((F.pow(F.greatest(lo[i] - box(i), box(i) - hi[i], F.lit(0.0)), 2) for i in range(d)), F.lit(0.0))
        asked = pairs.join(point, ["leaf", "frag"]).where(gap * (1 - 1e-9) <= F.col("d2")).join(parts, "target") \
            .select("target", F.pmod(F.xxhash64("id"), F.col("parts")).cast("int").alias("part"), "id", "comp", "x", F.lit(True).alias("asks"))
        own = point.join(state.select("leaf", "frag", "comp"), ["leaf", "frag"]).join(parts.withColumnRenamed("target", "leaf"), "leaf") \
            .select(F.col("leaf").alias("target"), F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), "id", "comp", "x",
                    F.lit(False).alias("asks"))

        def meet(pdf: pd.DataFrame) -> pd.DataFrame:
            asks = pdf["asks"].to_numpy()
            found = _nearest(pdf[~asks], pdf[asks]) if asks.any() and not asks.all() else []
            return pd.DataFrame(found, columns=["comp", "other", "d2", "a", "b"])

        return asked.union(own).groupBy("target", "part").applyInPandas(meet, best_edge)

    while True:
        inside = {r["leaf"]: r for r in state.groupBy("leaf").agg(
            F.min("comp").alias("one"), F.max("comp").alias("most"), F.min_by("comp", "frag").alias("first")).collect()}
        pure = [r["one"] if r["one"] == r["most"] else None for r in (inside[v] for v in number)]  # the component that fills a leaf
        if all(c is not None and c == pure[0] for c in pure):
            break
        comp = state.select("frag", "comp")
        both = open_.join(comp.select(F.col("frag").alias("fa"), F.col("comp").alias("ca")), "fa") \
            .join(comp.select(F.col("frag").alias("fb"), F.col("comp").alias("cb")), "fb").where("ca <> cb")
        known = both.select(F.col("ca").alias("comp"), F.col("cb").alias("other"), "d2", "a", "b").union(
            both.select("cb", "ca", "d2", "a", "b"))
        # typical points of leaves that follow each other bound the components that fill whole leaves
        steps = []
        for p, q in zip(leaves, leaves[1:]):
            c, o, p, q = inside[p["leaf"]]["first"], inside[q["leaf"]]["first"], p["p"], q["p"]
            if c != o:
                s = float(_square(np.array(p["x"]), np.array(q["x"])))
                ends = (s, min(p["id"], q["id"]), max(p["id"], q["id"]))
                steps += [(c, o, *ends), (o, c, *ends)]
        if steps:
            known = known.union(spark.createDataFrame(steps, best_edge))
        known = cut_lineage(least(known))

        def near(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            whole = np.array(pure, object)
            for b in batches:
                out = []
                for leaf, frag, c, m, lo, hi, d2 in zip(b["leaf"], b["frag"], b["comp"], b["n"], b["lo"], b["hi"], b["d2"]):
                    g = _gap(np.asarray(lo)[None], np.asarray(hi)[None], blo, bhi)
                    for t in np.flatnonzero((g <= d2) & (whole != c)):
                        if number[t] != leaf:
                            out.append((number[t], leaf, frag, c, m, float(g[t]), blo[t], bhi[t]))
                if out:
                    yield pd.DataFrame(out, columns=["target", "leaf", "frag", "comp", "n", "gap", "tlo", "thi"])

        pairs = cut_lineage(state.join(known.select("comp", "d2"), "comp").select("leaf", "frag", "comp", "n", "lo", "hi", "d2").mapInPandas(
            near, f"target int, leaf int, frag {kind}, comp {kind}, n long, gap double, tlo array<double>, thi array<double>"))
        first = pairs.groupBy("comp").agg(F.min_by(F.struct("target", "leaf", "frag", "n", "tlo", "thi"), "gap").alias("p")) \
            .select("comp", "p.*").join(known.select("comp", "d2"), "comp")
        known = cut_lineage(least(known.union(search(first, state))))
        rest = cut_lineage(pairs.join(known.select("comp", "d2"), "comp").where("gap <= d2"))
        if not rest.isEmpty():
            known = cut_lineage(least(known.union(search(rest, state))))
        tree = tree.union(known.select("a", "b", "d2").distinct())
        joined = components(known, "comp", "other").select(F.col("node").alias("comp"), F.col("component").alias("to"))
        state = cut_lineage(state.join(joined, "comp").drop("comp").withColumnRenamed("to", "comp"))
    return tree.union(again)


def merge_table(df: DataFrame, id_col: str, cols: Sequence[str], leaf_points: int = LEAF_POINTS) -> DataFrame:
    """The merges of single linkage: (a, b, height); n points give n - 1 merges.  Clusters at
    height h are what the merges with height <= h join."""
    return spanning_tree(df, id_col, cols, leaf_points).select("a", "b", F.sqrt("d2").alias("height"))


def _clean(df: DataFrame, id_col: str, cols: Sequence[str]) -> DataFrame:
    """(id, x) of the rows with an id and all coordinates."""
    at = [F.col(c).cast("double") for c in cols]
    ok = F.col(id_col).isNotNull()
    for c in at:
        ok = ok & c.isNotNull() & ~F.isnan(c)
    return df.where(ok).select(F.col(id_col).alias("id"), F.array(*at).alias("x"))


def _cut(points: DataFrame, merges: DataFrame, id_col: str, k: int) -> DataFrame:
    """The k clusters left without the k - 1 highest merges (by height, then ids)."""
    longest = merges.orderBy(F.desc("d2"), F.desc("a"), F.desc("b")).limit(max(int(k), 1) - 1)  # k - 1 rows
    kept = cut_lineage(merges.join(longest.select("a", "b"), ["a", "b"], "left_anti"))
    found = components(kept, "a", "b", nodes=points.select(F.col("id").alias("node")))
    names = sorted(r[0] for r in found.select("component").distinct().collect())  # k of them
    height = kept.agg(F.max("d2")).first()[0]
    kind = found.schema["component"].dataType.simpleString()
    label = points.sparkSession.createDataFrame([(c, i) for i, c in enumerate(names)], f"component {kind}, label int")
    return found.join(F.broadcast(label), "component").select(
        F.col("node").alias(id_col), "label", F.lit(math.sqrt(height) if height else 0.0).alias("height"))


def cut_tree(df: DataFrame, id_col: str, cols: Sequence[str], k: int, leaf_points: int = LEAF_POINTS) -> DataFrame:
    """(id, label, height): the k clusters left without the k - 1 longest merges (by height, then
    ids); labels follow the smallest member id; height is that of the last merge kept."""
    return _cut(_clean(df, id_col, cols), cut_lineage(spanning_tree(df, id_col, cols, leaf_points)), id_col, k)


# ---- complete linkage

LEAF_CLUSTERS = 2048   # clusters of a leaf: its distance matrix takes 32 MB


def extremes(x: np.ndarray) -> np.ndarray:
    """Points that hold the farthest point of a cluster from anywhere: hull corners in one or two
    dimensions, all points in more."""
    x = np.unique(x, axis=0)
    if x.shape[1] == 1:
        return x[[0, -1]] if len(x) > 1 else x
    if x.shape[1] > 2 or len(x) < 4:
        return x

    def half(points: np.ndarray) -> list:
        out: list = []
        for p in points:
            while len(out) > 1 and (out[-1][0] - out[-2][0]) * (p[1] - out[-2][1]) - (out[-1][1] - out[-2][1]) * (p[0] - out[-2][0]) < 0:
                out.pop()
            out.append(p)
        return out

    return np.unique(np.array(half(x) + half(x[::-1])), axis=0)


def merge_local(ids: np.ndarray, points: list[np.ndarray], lo: np.ndarray, hi: np.ndarray) -> tuple[list[list[int]], list[tuple[float, int, int]]]:
    """(members of each cluster left, merges (square, i, j)) of the clusters of a leaf; ids ascend."""
    n = len(ids)
    flat = np.concatenate(points)
    start = np.cumsum([0, *map(len, points[:-1])])
    far = np.empty((n, n))
    for i in range(n):
        s = _square(points[i][:, None, :], flat[None, :, :]).max(axis=0)
        far[i] = np.maximum.reduceat(s, start)
    np.fill_diagonal(far, np.inf)
    border = np.array([np.maximum(np.minimum(p - lo, hi - p).min(axis=1), 0.0).max() for p in points]) ** 2 * (1 - 1e-9)
    members, alive, merges = [[i] for i in range(n)], np.ones(n, bool), []
    while alive.sum() > 1:
        live = np.flatnonzero(alive)
        sub = far[np.ix_(live, live)]
        least = sub.min(axis=1)
        # of equally near ones the smaller pair of ids: for a row that is the first column
        mate = sub.argmin(axis=1)
        found = False
        for p in np.flatnonzero(mate[mate] == np.arange(len(live))):
            q = mate[p]
            a, b = int(live[p]), int(live[q])
            if p < q and least[p] < border[a] and least[p] < border[b]:
                merges.append((float(least[p]), a, b))
                far[a] = np.maximum(far[a], far[b])
                far[:, a] = far[a]
                far[a, a] = np.inf
                far[b, :] = far[:, b] = np.inf
                alive[b] = False
                border[a] = max(border[a], border[b])
                members[a] += members[b]
                found = True
        if not found:
            break
    return [members[i] for i in np.flatnonzero(alive)], merges


def complete_merges(df: DataFrame, id_col: str, cols: Sequence[str], leaf_clusters: int = LEAF_CLUSTERS,
                    max_height: float = math.inf) -> DataFrame:
    """The merges (a, b, d2) of complete linkage, d2 the squared height; a and b are the smallest ids of
    the clusters merged.  ``max_height`` leaves out merges above it.

    ``id_col`` must be unique; rows with a null id or a null or NaN coordinate are left out.
    """
    d, kind = len(cols), df.schema[id_col].dataType.simpleString()
    spark = df.sparkSession
    pts = cut_lineage(_clean(df, id_col, cols))
    nodes = cut_lineage(pts.groupBy("x").agg(F.min("id").alias("id"), F.count(F.lit(1)).alias("n")))
    merges = pts.join(nodes.where("n > 1").select("x", F.col("id").alias("a")), "x").where("id <> a") \
        .select("a", F.col("id").alias("b"), F.lit(0.0).alias("d2"))
    # a cluster: smallest id, typical point, extreme points one after the other
    state = nodes.select("id", "x", F.col("x").alias("points"))
    left, capacity, stage = nodes.count(), leaf_clusters, 0
    limit = max_height ** 2
    while left > 1:
        leaves = min(MAX_LEAVES, math.ceil(left / capacity))
        bucket = max(1, math.ceil(2 * left / SAMPLE))
        sample = state.where(F.pmod(F.xxhash64("id"), F.lit(bucket)) == 0).select("x").limit(SAMPLE).toPandas()["x"] if leaves > 1 else []
        kd = KdLeaves(np.array([list(v) for v in sample], float).reshape(-1, d), leaves, d, (0.0, 0.11, -0.17, 0.23)[stage % 4])

        def deal(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for b in batches:
                if len(b):
                    yield b.assign(leaf=kd.leaf(np.stack(b["x"].to_numpy())).astype(np.int32))

        def merge(pdf: pd.DataFrame) -> pd.DataFrame:
            pdf = pdf.sort_values("id", kind="stable")
            leaf, ids = int(pdf["leaf"].iloc[0]), pdf["id"].to_numpy()
            x, points = list(pdf["x"]), [np.asarray(p, float).reshape(-1, d) for p in pdf["points"]]
            groups, found = merge_local(ids, points, kd.lo[leaf], kd.hi[leaf])
            rows = [(ids[g[0]], None, None, x[g[0]], points[g[0]].ravel() if len(g) == 1 else extremes(np.concatenate([points[i] for i in g])).ravel())
                    for g in groups]
            rows += [(ids[a], ids[b], s, None, None) for s, a, b in found]
            return pd.DataFrame(rows, columns=["id", "b", "d2", "x", "points"])

        out = cut_lineage(state.mapInPandas(deal, f"id {kind}, x array<double>, points array<double>, leaf int").groupBy("leaf").applyInPandas(
            merge, f"id {kind}, b {kind}, d2 double, x array<double>, points array<double>"))
        merges = merges.union(out.where("b is not null").where(F.col("d2") <= limit).select(F.col("id").alias("a"), "b", "d2"))
        # merges only rise, so clusters made above the limit make no merge below it
        state = out.where("b is null").select("id", "x", "points")
        now = state.count()
        if leaves == 1:
            break
        if now > 0.9 * left:
            capacity *= 2
        left, stage = now, stage + 1
    return merges


def complete_linkage(df: DataFrame, id_col: str, cols: Sequence[str], k: int, leaf_clusters: int = LEAF_CLUSTERS) -> DataFrame:
    """(id, label, height): complete linkage cut at ``k`` clusters; labels follow the smallest member id, height is
    that of the last merge kept."""
    return _cut(_clean(df, id_col, cols), cut_lineage(complete_merges(df, id_col, cols, leaf_clusters)), id_col, k)
