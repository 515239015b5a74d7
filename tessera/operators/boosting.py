"""Second-order gradient boosting on histograms with learned directions for missing values.

* **Cuts** come from a hessian-weighted quantile sketch: every partition summarises each feature
  by ``SKETCH`` points of equal weight, summaries are merged pairwise; a feature with at most
  ``SKETCH`` different values keeps them all.
* **Histograms.**  Rows are packed once as matrices of bin numbers (``blocks.pack``); a level of a
  tree is one pass that sums gradient, hessian and count per (node, feature, bin) in numpy, one
  array a partition.  Of two siblings only the one with fewer rows is summed, the other is
  the parent's histogram less it.
* **Equal rows.**  Rows in the same bins have the same margin in every round, and gradients and losses are
  linear in the label (but for the squares left over).  With few features there are at most bins **
  features such cells, whatever the number of rows, and fewer where features go together (the
  dummies of a column); the occupied ones are counted by a sketch.  Where they are few, a row of the
  blocks is a cell with its weight, weighted mean label and the squares left over, and a pass costs
  what the cells cost.
* **Missing values** (NULL, NaN) have a bin of their own; a split tries them on both sides and
  keeps the better side, so the direction is learned per node.
* **Margins** are not rewritten every round: a pass adds the trees grown since the last reliable
  checkpoint (every ``checkpointInterval`` rounds) on the fly.  The first pass of a round also
  sums the losses of the round before, so a round costs as many jobs as the tree has levels.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.operators.blocks import BLOCK_ROWS, array, pack, reduced
from tessera.session import cut_lineage

__all__ = ["BoostedTrees", "Tree", "best_split", "weighted_sketch", "merge_sketches", "cuts_of"]

SKETCH = 1024
BLOCK = "n int, x binary, y binary, w binary, valid binary, margin binary, rows binary, rest binary"
CELLS = 1 << 20  # rows in equal bins are merged when at most this many combinations of bins are possible or occur
REGISTERS = 1 << 12  # of the sketch that counts them (about 1.6 % off)


def weighted_sketch(values: np.ndarray, weights: np.ndarray, size: int = SKETCH) -> np.ndarray:
    """(2, size): values in ascending order with their weights, at most ``size`` of them; empty
    places have weight 0.  Points are merged up to equal shares of the weight."""
    out = np.zeros((2, size))
    ok = ~np.isnan(values) & (weights > 0)
    v, at = np.unique(values[ok], return_inverse=True)
    w = np.bincount(at, weights[ok], len(v))
    if len(v) > size:
        share = np.minimum(((np.cumsum(w) - w / 2) / w.sum() * size).astype(int), size - 1)
        last = np.append(np.flatnonzero(np.diff(share)), len(v) - 1)
        v, w = v[last], np.diff(np.append(0.0, np.cumsum(w)[last]))
    out[0, :len(v)], out[1, :len(v)] = v, w
    return out


def merge_sketches(a: np.ndarray, b: np.ndarray, size: int = SKETCH) -> np.ndarray:
    """Two flat stacks of sketches, feature by feature."""
    a, b = a.reshape(-1, 2, size), b.reshape(-1, 2, size)
    return np.stack([weighted_sketch(np.append(x[0], y[0]), np.append(x[1], y[1]), size) for x, y in zip(a, b)]).ravel()


def cuts_of(sketch: np.ndarray, bins: int) -> np.ndarray:
    """At most ``bins - 1`` cuts at equal shares of the weight; a row is left of a cut when its value is smaller."""
    v, w = sketch[0][sketch[1] > 0], sketch[1][sketch[1] > 0]
    if len(v) <= bins:
        return v[1:]
    at = np.searchsorted(np.cumsum(w), w.sum() * np.arange(1, bins) / bins, "right")
    cuts = np.unique(v[np.minimum(at, len(v) - 1)])
    return cuts[cuts > v[0]]


class Tree:
    """Node arrays; a row goes left when its bin is at most ``bin``, missing ones by ``missing_left``."""

    def __init__(self):
        self.feature, self.bin, self.missing_left, self.left, self.right, self.value = [-1], [0], [False], [0], [0], [0.0]
        self.gain = [0.0]

    def split(self, node: int, gain: float, f: int, b: int, missing_left: bool) -> tuple[int, int]:
        left = len(self.feature)
        for name, v in (("feature", -1), ("bin", 0), ("missing_left", False), ("left", 0), ("right", 0), ("value", 0.0), ("gain", 0.0)):
            getattr(self, name).extend([v, v])
        self.feature[node], self.bin[node], self.missing_left[node], self.gain[node] = f, b, missing_left, gain
        self.left[node], self.right[node] = left, left + 1
        return left, left + 1

    def leaves(self, bins: np.ndarray, missing: int) -> np.ndarray:
        """Leaf of each row of bin numbers."""
        feature, cut, miss = np.array(self.feature), np.array(self.bin), np.array(self.missing_left)
        leaf, me = feature < 0, np.arange(len(feature))
        kids = np.stack([np.where(leaf, me, self.right), np.where(leaf, me, self.left)], axis=1).ravel()  # a leaf leads to itself
        feature = np.where(leaf, 0, feature)
        depth = np.zeros(len(feature), int)
        for node in np.flatnonzero(~leaf):  # children come after their parent
            depth[[self.left[node], self.right[node]]] = depth[node] + 1
        at, flat, start = np.zeros(len(bins), np.int64), np.ascontiguousarray(bins).ravel(), np.arange(len(bins)) * bins.shape[1]
        for _ in range(int(depth.max())):
            b = flat.take(start + feature.take(at))
            left = b <= cut.take(at)  # never true of a missing value
            if miss.any():
                left |= (b == missing) & miss.take(at)
            at = kids.take(2 * at + left)
        return at

    def add(self, margin: np.ndarray, bins: np.ndarray, missing: int) -> np.ndarray:
        return margin + np.array(self.value)[self.leaves(bins, missing)]


def best_split(hist: np.ndarray, reg_lambda: float, min_child: float) -> tuple[float, int, int, bool, np.ndarray] | None:
    """(gain, feature, bin, missing_left, left sums) of a node's histogram (features, bins + missing, 3);
    equal gains go to the first feature, bin and missing values to the right."""
    total = hist[0].sum(axis=0)
    left = np.cumsum(hist[:, :-1], axis=1)[:, :, None, :] + np.stack([np.zeros_like(hist[:, -1]), hist[:, -1]], 1)[:, None]
    right = total - left
    with np.errstate(divide="ignore", invalid="ignore"):  # empty sides are ruled out below
        gain = (left[..., 0] ** 2 / (left[..., 1] + reg_lambda) + right[..., 0] ** 2 / (right[..., 1] + reg_lambda)
                - total[0] ** 2 / (total[1] + reg_lambda))
    gain[(left[..., 1] < min_child) | (right[..., 1] < min_child) | (left[..., 2] < 0.5) | (right[..., 2] < 0.5)] = -np.inf
    i = int(np.argmax(gain))
    f, b, m = np.unravel_index(i, gain.shape)
    return (float(gain[f, b, m]), int(f), int(b), bool(m), left[f, b, m]) if gain[f, b, m] > 1e-9 else None


def cell_sketch(bins: np.ndarray, side: np.ndarray) -> np.ndarray:
    """Registers (largest rank by hash) that count the different rows of bin numbers on each side; merged by maximum."""
    with np.errstate(over="ignore"):
        h = np.where(side, np.uint64(0x9E3779B97F4A7C15), np.uint64(0x2545F4914F6CDD1D))
        for f in range(bins.shape[1]):
            h = (h ^ bins[:, f].astype(np.uint64)) * np.uint64(0xFF51AFD7ED558CCD)
            h ^= h >> np.uint64(32)
        h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        h ^= h >> np.uint64(32)
    rank = 41 - np.frexp((h >> np.uint64(24)).astype(float))[1]  # leading zeros of 40 bits, plus one
    out = np.zeros(REGISTERS)
    np.maximum.at(out, (h & np.uint64(REGISTERS - 1)).astype(int), rank)
    return out


def cells_of(sketch: np.ndarray) -> float:
    """About how many different rows a merged sketch has seen."""
    m, empty = len(sketch), (sketch == 0).sum()
    raw = 0.7213 / (1 + 1.079 / m) * m * m / (2.0 ** -sketch).sum()
    return float(m * math.log(m / empty) if raw <= 2.5 * m and empty else raw)


def _binned(x: np.ndarray, cuts: Sequence[np.ndarray], missing: int) -> np.ndarray:
    out = np.empty(x.shape, np.uint16)
    for f, c in enumerate(cuts):
        out[:, f] = np.where(np.isnan(x[:, f]), missing, np.searchsorted(c, x[:, f], "right"))
    return out


class _Rows:
    """What a task needs to know to read a block (small: it travels with every job)."""

    def __init__(self, objective: str, missing: int):
        self.objective, self.missing = objective, missing

    def merged(self, x: np.ndarray, y: np.ndarray, w: np.ndarray, valid: np.ndarray, n: np.ndarray, rest: np.ndarray) -> tuple[np.ndarray, ...]:
        """The same columns with one row for all rows in equal bins (``x``) on one side of ``valid``: sums of
        weight, count and squares left over (0 unless ``squared``), mean label."""
        key = np.column_stack([x, valid > 0]).astype(np.uint16)
        at = np.ascontiguousarray(key).view(np.dtype((np.void, key.shape[1] * 2))).ravel()
        _, first, at = np.unique(at, return_index=True, return_inverse=True)
        ws, k = np.bincount(at, w), len(first)
        mean = np.divide(np.bincount(at, w * y), ws, out=y[first].copy(), where=ws != 0)
        over = w * (y - mean[at]) ** 2 if self.objective == "squared" else 0.0
        return x[first], mean, ws, valid[first], np.bincount(at, n, k), np.bincount(at, rest + over, k)

    def grad(self, m: np.ndarray, y: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Gradient, hessian and loss of each row."""
        if self.objective == "logistic":
            p = 1.0 / (1.0 + np.exp(-m))
            return w * (p - y), w * p * (1 - p), w * (np.logaddexp(0.0, m) - y * m)
        return w * (m - y), w, w * (m - y) ** 2

    def open(self, r, pending: Sequence[Tree]) -> tuple[np.ndarray, ...]:
        """(bins, margin, y, w, valid, rows, rest) of a block, with the trees ``pending`` added to the margin."""
        bins = array(r["x"], r["n"], "u2").reshape(r["n"], -1)
        margin = array(r["margin"], r["n"])
        for t in pending:
            margin = t.add(margin, bins, self.missing)
        rows, rest = (array(r[c], r["n"]) if len(r[c]) else np.full(r["n"], v) for c, v in (("rows", 1.0), ("rest", 0.0)))
        return bins, margin, array(r["y"], r["n"]), array(r["w"], r["n"]), array(r["valid"], r["n"]) > 0, rows, rest

    def losses(self, m: np.ndarray, y: np.ndarray, w: np.ndarray, valid: np.ndarray, rows: np.ndarray, rest: np.ndarray) -> np.ndarray:
        """Summed loss and weight of the training rows, then of the validation rows."""
        loss = self.grad(m, y, w)[2] + rest
        return np.array([loss[~valid].sum(), w[~valid].sum(), loss[valid].sum(), w[valid].sum()])


class BoostedTrees:
    """Boosted trees; ``objective`` is ``logistic`` (labels 0/1) or ``squared``.

    Split gain ``G_L^2/(H_L+lambda) + G_R^2/(H_R+lambda) - G^2/(H+lambda)``, leaf weight ``-G/(H+lambda)``
    times the rate.  With ``validationCol`` training stops after ``earlyStop`` rounds without a lower
    validation loss and keeps the rounds up to the best.  ``weightCol`` weights rows (gradient, hessian, losses).
    Rows with a null label are left out.
    """

    def __init__(self, featuresCols: Sequence[str], labelCol: str, objective: str = "logistic",
                 numRounds: int = 100, eta: float = 0.3, maxDepth: int = 6, reg_lambda: float = 1.0,
                 minChildWeight: float = 1.0, maxBins: int = 64, validationCol: str | None = None,
                 earlyStop: int = 10, checkpointInterval: int = 10, weightCol: str | None = None):
        if objective not in ("logistic", "squared"):
            raise ValueError(f"unknown objective {objective}")
        if not 2 <= maxBins <= SKETCH:
            raise ValueError(f"maxBins must be 2 to {SKETCH}")
        self.featuresCols, self.labelCol, self.objective = list(featuresCols), labelCol, objective
        self.numRounds, self.eta, self.maxDepth, self.reg_lambda = numRounds, eta, maxDepth, reg_lambda
        self.minChildWeight, self.maxBins = minChildWeight, maxBins
        self.validationCol, self.earlyStop, self.checkpointInterval = validationCol, earlyStop, checkpointInterval
        self.weightCol = weightCol
        self._rows = _Rows(objective, maxBins)
        self.trees: list[Tree] = []
        self.base = 0.0
        self.cuts: list[np.ndarray] = []
        self.history: list[tuple[int, float, float | None]] = []

    def _features(self) -> Column:
        return F.array(*[F.coalesce(F.col(c).cast("double"), F.lit(float("nan"))) for c in self.featuresCols])

    def _prepare(self, df: DataFrame) -> DataFrame:
        """Blocks (n, x: bin numbers, y, w, valid, margin, rows, rest); a row of a block is a row, or with few
        cells all ``rows`` of a cell with the summed weight, the mean label and the squares left over (``rest``)."""
        rows = df.where(F.col(self.labelCol).isNotNull()).withColumns({
            "__y": F.col(self.labelCol).cast("double"), "__w": F.col(self.weightCol).cast("double") if self.weightCol else F.lit(1.0),
            "__valid": F.coalesce(F.col(self.validationCol).cast("double"), F.lit(0.0)) if self.validationCol else F.lit(0.0)})
        raw = pack(rows, self._features(), ["__y", "__w", "__valid"])

        def means(r) -> np.ndarray:
            y, w, v = (array(r[c], r["n"]) for c in ("__y", "__w", "__valid"))
            return np.array([(w * y)[v == 0].sum(), w[v == 0].sum(), len(y)])

        sums = reduced(raw, means)
        mean = sums[0] / sums[1] if sums is not None and sums[1] > 0 else 0.0
        if self.objective == "logistic":
            mean = min(max(mean, 1e-6), 1 - 1e-6)
            self.base = math.log(mean / (1 - mean))
        else:
            self.base = float(mean)
        k, base, rows_ = len(self.featuresCols), self.base, self._rows

        def sketch(r) -> np.ndarray:
            x = array(r["x"], r["n"]).reshape(-1, k)
            y, w, v = (array(r[c], r["n"]) for c in ("__y", "__w", "__valid"))
            h = np.where(v == 0, rows_.grad(np.full(len(y), base), y, w)[1], 0.0)
            return np.stack([weighted_sketch(x[:, f], h) for f in range(k)]).ravel()

        found = reduced(raw, sketch, merge_sketches)
        self.cuts = [cuts_of(s, self.maxBins) for s in found.reshape(k, 2, SKETCH)] if found is not None else [np.zeros(0)] * k
        cuts, missing = self.cuts, self.maxBins
        cells = 2 * math.prod(len(c) + 2 for c in cuts)
        if sums is not None and cells <= CELLS and sums[2] > 4 * cells:
            return self._merge(raw, cells)
        if sums is not None and sums[2] > BLOCK_ROWS:
            def occupied(r) -> np.ndarray:
                n = r["n"]
                return cell_sketch(_binned(array(r["x"], n).reshape(-1, k), cuts, missing), array(r["__valid"], n) > 0)

            cells = math.ceil(cells_of(reduced(raw, occupied, np.maximum)))
            if cells <= CELLS and sums[2] > 2 * cells:
                return self._merge(raw, cells)

        def to_bins(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for b in batches:
                out = b.rename(columns={"__y": "y", "__w": "w", "__valid": "valid"})
                out["x"] = [_binned(array(x, n).reshape(-1, k), cuts, missing).tobytes() for x, n in zip(b["x"], b["n"])]
                out["margin"] = [np.full(n, base).tobytes() for n in b["n"]]
                yield out.assign(rows=b"", rest=b"")

        return cut_lineage(raw.mapInPandas(to_bins, BLOCK))

    def _merge(self, raw: DataFrame, cells: int) -> DataFrame:
        """``_prepare``'s blocks of merged rows: merged within each partition, then across them by bins."""
        k, cuts, missing, base, rows_ = len(self.featuresCols), self.cuts, self.maxBins, self.base, self._rows
        names = ["x", "y", "w", "valid", "rows", "rest"]

        def merged(parts: Iterator[tuple[np.ndarray, ...]]) -> Iterator[list[np.ndarray]]:
            """All parts as one, in pieces of at most ``BLOCK_ROWS`` rows."""
            held, n = [], 0
            for part in parts:
                held.append(part)
                n += len(part[0])
                if n > 2 * cells + BLOCK_ROWS:  # merged rows are at most about ``cells``
                    held = [rows_.merged(*map(np.concatenate, zip(*held)))]
                    n = len(held[0][0])
            if held:
                out = rows_.merged(*map(np.concatenate, zip(*held)))
                for i in range(0, len(out[0]), BLOCK_ROWS):
                    yield [c[i:i + BLOCK_ROWS] for c in out]

        def within(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            def parts():
                for b in batches:
                    for r in (b.iloc[i] for i in range(len(b))):
                        n = r["n"]
                        y, w, v = (array(r[c], n) for c in ("__y", "__w", "__valid"))
                        yield _binned(array(r["x"], n).reshape(-1, k), cuts, missing), y, w, v, np.ones(n), np.zeros(n)

            for x, *others in merged(parts()):
                yield pd.DataFrame({"x": [r.tobytes() for r in x], **dict(zip(names[1:], others))})

        def across(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            parts = ((np.frombuffer(b"".join(b["x"]), np.uint16).reshape(-1, k), *(b[c].to_numpy("f8") for c in names[1:]))
                     for b in batches if len(b))
            for out in merged(parts):
                n = len(out[0])
                yield pd.DataFrame([(n, *(np.ascontiguousarray(c).tobytes() for c in out[:4]), np.full(n, base).tobytes(),
                                     *(c.tobytes() for c in out[4:]))], columns=["n", *names[:4], "margin", *names[4:]])

        # partitions large enough that merging within them leaves few rows to move
        parts, cores = raw.rdd.getNumPartitions(), raw.sparkSession.sparkContext.defaultParallelism
        near = raw.coalesce(max(cores, parts * BLOCK_ROWS // (8 * cells)))
        few = near.mapInPandas(within, "x binary, y double, w double, valid double, rows double, rest double")
        return cut_lineage(few.repartition("x").mapInPandas(across, BLOCK))

    def _pass(self, blocks: DataFrame, pending: Sequence[Tree], tree: Tree, nodes: Sequence[int]) -> tuple[np.ndarray, np.ndarray]:
        """(losses of the margins, histograms (node, feature, bin, [g, h, rows]) of ``nodes``) in one job."""
        k, width, rows = len(self.featuresCols), self.maxBins + 1, self._rows

        def make(r) -> np.ndarray:
            bins, m, y, w, valid, count, rest = rows.open(r, pending)
            place = np.full(len(tree.feature), -1)
            place[list(nodes)] = np.arange(len(nodes))
            at = place[tree.leaves(bins, rows.missing)]
            use = np.flatnonzero((at >= 0) & ~valid)
            g, h, _ = rows.grad(m, y, w)
            out = np.zeros((len(nodes) * width, k, 3))
            for f in range(k):
                cell = at[use] * width + bins[use, f]
                for c, v in enumerate((g[use], h[use], count[use])):
                    out[:, f, c] = np.bincount(cell, v, len(out))
            return np.concatenate([rows.losses(m, y, w, valid, count, rest), out.ravel()])

        total = reduced(blocks, make)
        return total[:4], total[4:].reshape(len(nodes), width, k, 3).transpose(0, 2, 1, 3)

    def _grow(self, blocks: DataFrame, pending: Sequence[Tree]) -> tuple[np.ndarray, Tree]:
        """A tree on the margins with ``pending`` added, and those margins' losses."""
        tree = Tree()
        losses, first = self._pass(blocks, pending, tree, [0])
        hist, frontier = {0: first[0]}, [0]
        sums = {0: first[0][0].sum(axis=0)}
        for depth in range(self.maxDepth):
            pairs = []
            for node in frontier:
                found = best_split(hist[node], self.reg_lambda, self.minChildWeight)
                if found:
                    gain, f, b, m, left = found
                    kids = tree.split(node, gain, f, b, m)
                    sums[kids[0]], sums[kids[1]] = left, sums[node] - left
                    pairs.append((node, *kids))
            if not pairs or depth + 1 == self.maxDepth:
                break
            small = [a if sums[a][2] <= sums[b][2] else b for _, a, b in pairs]
            _, summed = self._pass(blocks, pending, tree, small)
            new = {}
            for (node, a, b), s, h in zip(pairs, small, summed):
                new[s], new[a + b - s] = h, hist[node] - h
            hist, frontier = new, [n for _, a, b in pairs for n in (a, b)]
        for node, (g, h, _) in sums.items():
            tree.value[node] = float(-g / (h + self.reg_lambda) * self.eta) if h + self.reg_lambda > 0 else 0.0
        return losses, tree

    def fit(self, df: DataFrame) -> "BoostedTrees":
        blocks, rows = self._prepare(df), self._rows
        self.trees, self.history, pending = [], [], []
        if blocks.isEmpty():
            return self
        best_loss, best_round = math.inf, 0

        def note(losses: np.ndarray) -> bool:
            """Keep the losses of the trees so far; True when training should stop."""
            nonlocal best_loss, best_round
            done = len(self.trees)
            train, valid = losses[0] / max(losses[1], 1e-300), losses[2] / losses[3] if losses[3] > 0 else None
            if done:
                self.history.append((done, float(train), valid if valid is None else float(valid)))
            if valid is not None and done:
                if valid < best_loss - 1e-12:
                    best_loss, best_round = valid, done
                return done - best_round >= self.earlyStop
            return False

        while len(self.trees) < self.numRounds:
            losses, tree = self._grow(blocks, pending)
            if note(losses):
                break
            self.trees.append(tree)
            pending.append(tree)
            if len(pending) == self.checkpointInterval:
                done = list(pending)

                def settle(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
                    for b in batches:
                        yield b.assign(margin=[rows.open(b.iloc[i], done)[1].tobytes() for i in range(len(b))])

                blocks, pending = cut_lineage(blocks.mapInPandas(settle, blocks.schema)), []
        else:
            note(reduced(blocks, lambda r: rows.losses(*rows.open(r, pending)[1:])))
        if best_round:
            self.trees = self.trees[:best_round]
        return self

    def transform(self, df: DataFrame, predictionCol: str = "prediction") -> DataFrame:
        cuts, missing, base, trees = self.cuts, self.maxBins, self.base, list(self.trees)

        @F.pandas_udf("double")
        def margin(x: pd.Series) -> pd.Series:
            if not len(x):
                return pd.Series([], dtype=float)
            bins = _binned(np.stack(x.to_numpy()), cuts, missing)
            m = np.full(len(x), base)
            for t in trees:
                m = t.add(m, bins, missing)
            return pd.Series(m)

        out = df.withColumn("__m", margin(self._features()))
        if self.objective == "logistic":
            out = out.withColumn("p", 1.0 / (1.0 + F.exp(-F.col("__m"))))
            out = out.withColumn(predictionCol, (F.col("p") >= 0.5).cast("int"))
        else:
            out = out.withColumn(predictionCol, F.col("__m"))
        return out.drop("__m")
