"""Histogram tree grower (H1): best-first classification trees with a leaf limit
(M8).  Second-order boosted trees (M11, M12) are in ``boosting``.

Every feature is cut once into quantile bins (``Bucketizer``, JVM binary search).
Growing a tree is then a few rounds of
``groupBy(node, feature, bin).agg(counts)`` -- a partial aggregate
whose result has at most nodes x features x bins rows, whatever the row count --
and the split choice on those numbers at the driver (PLANET, 2009).  The current tree is applied as a
CASE expression on the bins, so rows are never re-shuffled to nodes.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Sequence

import numpy as np
from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.operators.boosting import BoostedTrees
from tessera.session import cut_lineage, spread

__all__ = ["Binner", "BestFirstTree", "BoostedTrees"]


MAX_CLASSES = 1000


class Binner:
    """Quantile bin edges per feature (approximate quantiles, fitted once)."""

    def __init__(self, featuresCols: Sequence[str], maxBins: int = 32, relErr: float = 0.001):
        self.featuresCols, self.maxBins, self.relErr = list(featuresCols), maxBins, relErr
        self.splits: list[list[float]] = []

    def fit(self, df: DataFrame) -> "Binner":
        probs = [i / self.maxBins for i in range(1, self.maxBins)]
        qs = df.approxQuantile(self.featuresCols, probs, self.relErr)
        self.splits = [[-math.inf, *sorted({float(v) for v in q}), math.inf] for q in qs]
        return self

    def transform(self, df: DataFrame, out: str = "__bins") -> DataFrame:
        outs = [f"__b{i}" for i in range(len(self.featuresCols))]
        bz = Bucketizer(splitsArray=self.splits, inputCols=self.featuresCols, outputCols=outs,
                        handleInvalid="keep")
        t = bz.transform(df)
        return t.withColumn(out, F.array(*[F.col(o).cast("int") for o in outs])).drop(*outs)

    def threshold(self, f: int, b: int) -> float:
        """Rows with bin <= b have feature value below this edge."""
        return self.splits[f][b + 1]


class _Node:
    __slots__ = ("id", "depth", "feature", "bin", "left", "right", "value", "stats")

    def __init__(self, id_, depth):
        self.id, self.depth = id_, depth
        self.feature = self.bin = self.left = self.right = None
        self.value = None
        self.stats = None


def _route(nodes: dict, bins: Column, root: int = 0) -> Column:
    """CASE expression giving the leaf id of each row."""

    def walk(n: _Node) -> Column:
        if n.feature is None:
            return F.lit(n.id)
        return F.when(F.get(bins, n.feature) <= n.bin, walk(nodes[n.left])).otherwise(walk(nodes[n.right]))

    return walk(nodes[root])


def _leaf_values(nodes: dict, bins: Column, default=None) -> Column:
    """CASE expression giving the leaf value of each row."""

    def walk(n: _Node) -> Column:
        if n.feature is None:
            return F.lit(n.value)
        return F.when(F.get(bins, n.feature) <= n.bin, walk(nodes[n.left])).otherwise(walk(nodes[n.right]))

    return walk(nodes[0])


def _entropy(counts: np.ndarray) -> float:
    n = counts.sum()
    if n <= 0:
        return 0.0
    p = counts[counts > 0] / n
    return float(-(p * np.log2(p)).sum())


class BestFirstTree:
    """M8 with the leaf limit: entropy splits, leaves expanded best-gain first.

    A leaf is expanded when its best split lowers the weighted entropy; growth
    stops at ``maxLeaves`` leaves or ``maxDepth``.  Prediction is the majority
    class (smallest class on ties); ``probability`` holds the class shares.
    """

    def __init__(self, featuresCols: Sequence[str], labelCol: str, maxLeaves: int = 6, maxDepth: int = 6,
                 maxBins: int = 32, minInstances: int = 1):
        self.featuresCols, self.labelCol = list(featuresCols), labelCol
        self.maxLeaves, self.maxDepth, self.maxBins, self.minInstances = maxLeaves, maxDepth, maxBins, minInstances
        self.nodes: dict[int, _Node] = {}
        self.classes: list = []
        self.binner: Binner | None = None

    def _hist(self, data: DataFrame, leaves: list[int]) -> dict:
        routed = data.withColumn("__node", _route(self.nodes, F.col("__bins"))).where(F.col("__node").isin(leaves))
        h = (routed.select("__node", self.labelCol, F.posexplode("__bins").alias("f", "b"))
                   .groupBy("__node", "f", "b", self.labelCol).agg(F.count(F.lit(1)).alias("n")).collect())
        k = len(self.classes)
        cidx = {c: i for i, c in enumerate(self.classes)}
        out: dict = {}
        for r in h:
            arr = out.setdefault(r["__node"], np.zeros((len(self.featuresCols), self.maxBins + 2, k)))
            arr[r["f"], r["b"], cidx[r[self.labelCol]]] += r["n"]
        return out

    def _best_split(self, hist: np.ndarray):
        total = hist[0].sum(axis=0)
        n = total.sum()
        parent = n * _entropy(total)
        best = (0.0, None, None, None, None)
        for f in range(hist.shape[0]):
            cum = np.cumsum(hist[f], axis=0)
            for b in range(hist.shape[1] - 1):
                left = cum[b]
                nl = left.sum()
                if nl < self.minInstances or n - nl < self.minInstances:
                    continue
                right = total - left
                gain = parent - nl * _entropy(left) - (n - nl) * _entropy(right)
                if gain > best[0] + 1e-12:
                    best = (gain, f, b, left, right)
        return best

    def fit(self, df: DataFrame) -> "BestFirstTree":
        self.binner = Binner(self.featuresCols, self.maxBins).fit(df)
        self.classes = sorted(r[0] for r in df.select(self.labelCol).distinct().limit(MAX_CLASSES + 1).collect())
        if len(self.classes) > MAX_CLASSES:
            raise ValueError(f"a classification tree takes at most {MAX_CLASSES} classes")
        data = cut_lineage(spread(self.binner.transform(df.select(*self.featuresCols, self.labelCol))
                                  .select("__bins", self.labelCol)))
        root = _Node(0, 0)
        self.nodes = {0: root}
        hist = self._hist(data, [0])
        root.stats = hist[0][0].sum(axis=0)
        heap, next_id, leaves = [], 1, 1
        cand = self._best_split(hist[0])
        if cand[1] is not None:
            heapq.heappush(heap, (-cand[0], 0, cand))
        while heap and leaves < self.maxLeaves:
            _, nid, (gain, f, b, left, right) = heapq.heappop(heap)
            node = self.nodes[nid]
            if node.depth >= self.maxDepth:
                continue
            l, r = _Node(next_id, node.depth + 1), _Node(next_id + 1, node.depth + 1)
            next_id += 2
            l.stats, r.stats = left, right
            node.feature, node.bin, node.left, node.right = f, b, l.id, r.id
            self.nodes[l.id], self.nodes[r.id] = l, r
            leaves += 1
            if leaves >= self.maxLeaves:
                break
            hs = self._hist(data, [l.id, r.id])
            for child in (l, r):
                if child.depth < self.maxDepth and child.id in hs:
                    c = self._best_split(hs[child.id])
                    if c[1] is not None:
                        heapq.heappush(heap, (-c[0], child.id, c))
        for n in self.nodes.values():
            if n.feature is None:
                st = n.stats
                n.value = self.classes[int(np.argmax(st))]
        return self

    def n_leaves(self) -> int:
        return sum(1 for n in self.nodes.values() if n.feature is None)

    def transform(self, df: DataFrame, predictionCol: str = "prediction") -> DataFrame:
        t = self.binner.transform(df)
        return t.withColumn(predictionCol, _leaf_values(self.nodes, F.col("__bins"))).drop("__bins")

    def describe(self) -> list[str]:
        out = []
        for n in sorted(self.nodes.values(), key=lambda x: x.id):
            if n.feature is None:
                out.append(f"leaf {n.id}: {n.value} {list(map(int, n.stats))}")
            else:
                out.append(f"node {n.id}: {self.featuresCols[n.feature]} < "
                           f"{self.binner.threshold(n.feature, n.bin):.6g} -> {n.left}, {n.right}")
        return out
