"""Linear SVMs on explicit feature maps, many of them in the same scans.

Rows are packed once as they are (``blocks.pack``); a pass maps a piece of a block in the task's memory
and gives hinge loss and gradient of every model that still moves, so mapped rows are neither
stored nor sent.  The models are points (map, penalty) fitted on all rows and, with folds, on the
rest of every fold: the whole grid costs as many scans as its slowest model has evaluations.

Each model takes the steps of Spark's ``LinearSVC`` (features divided by their standard deviation, shifted in
effect by their mean, L2 penalty on the scaled weights, orthant-wise L-BFGS with a backtracking search
and the same stopping rules), so its coefficients are those of ``LinearSVC`` up to rounding.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Generator, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.operators.blocks import array, pack, reduced

__all__ = ["HingePoint", "HingeModel", "MappedSVM", "hinge_fits", "orthant_steps"]

PIECE_VALUES = 1 << 17  # mapped values held at once (1 MB): a piece of a block stays in the processor's cache

Map = Callable[[np.ndarray], np.ndarray]


class _Failed(Exception):
    """A direction or a search that came to nothing."""


def _direction(g: np.ndarray, pairs: Sequence[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    d, kept = g.copy(), []
    if pairs and not pairs[0][0] @ pairs[0][1] >= 0:
        raise _Failed
    for s, y in pairs:
        rho = s @ y
        a = (s @ d) / rho if rho else math.nan
        if math.isnan(a):
            raise _Failed
        d -= a * y
        kept.append((a, rho))
    if pairs:
        s, y = pairs[0]
        d *= (s @ y) / (y @ y)
    for (s, y), (a, rho) in zip(reversed(pairs), reversed(kept)):
        d += (a - (y @ d) / rho) * s
    return np.where(d * g > 0, -d, 0.0)


def orthant_steps(x: np.ndarray, max_iter: int, tol: float, memory: int = 10) -> Generator[np.ndarray, tuple[float, np.ndarray], np.ndarray]:
    """Orthant-wise L-BFGS without an L1 term, as ``LinearSVC`` runs it: yields a point, is sent its
    (value, gradient), returns the last accepted point."""
    f, g = yield x
    first, recent, pairs, done, failed = abs(f), [math.inf], [], 0, False
    while not (done >= max_iter or len(recent) > 1 and abs(f - max(recent)) <= tol * first
               or np.linalg.norm(g) <= max(tol * f, 1e-8)):
        try:
            d = _direction(g, pairs)
            if not d.any():
                break
            slope, side = g @ d, np.where(x != 0, np.sign(x), np.sign(-g))
            step, shrink = (0.5 / np.linalg.norm(g), 0.1) if done < 1 else (1.0, 0.5)
            found, value, rise = None, f, 0.0  # the first step counts with the old value, so it is shrunk
            for _ in range(20):
                if value > f + step * slope * 1e-4:
                    step *= shrink
                elif rise < 0.9 * slope:
                    step *= 2.1
                elif rise > -0.9 * slope:
                    step *= shrink
                else:
                    break
                if not 1e-10 <= step <= 1e10:
                    raise _Failed
                last, at = found, x + step * d
                at = np.where(np.sign(at) == side, at, 0.0)
                value, g1 = yield at
                found, rise = (at, value, g1), g1 @ d
            else:
                found = last
        except _Failed:
            if failed:
                break
            pairs, failed = [], True
            continue
        at, f1, g1 = found
        pairs = [(at - x, g1 - g), *pairs][:memory]
        x, f, g, done, failed = at, f1, g1, done + 1, False
        recent = [*recent, f][-20:]
    return x


class HingePoint:
    """A point of a grid: feature map (number in a list of maps) and penalty (Spark's regParam)."""

    def __init__(self, mapped: int, reg: float):
        self.mapped, self.reg = mapped, reg


class HingeFits:
    """``models[t][p]``: (weights, bias) of point p without fold t; ``models[k]``: on all rows."""

    def __init__(self, models: list[list[tuple[np.ndarray, float]]], maps: Sequence[Map], points: Sequence[HingePoint], blocks: DataFrame, passes: int):
        self.models, self.maps, self.points, self.passes, self._blocks = models, maps, points, passes, blocks

    def held_out(self) -> DataFrame:
        """(fold, label, margins): every row of a fold under each point's model that has not seen the fold."""
        maps, points, models, k = self.maps, self.points, self.models, len(self.models) - 1

        def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for b in batches:
                for i in range(len(b)):
                    for x, y, f in _pieces(b.iloc[i], maps):
                        keep = (f >= 0) & (f < k)
                        x, y, f = x[keep], y[keep], f[keep]
                        m = np.empty((len(x), len(points)))
                        for j, z in enumerate(w(x) for w in maps):
                            for p in (p for p, at in enumerate(points) if at.mapped == j):
                                u, c = np.stack([models[t][p][0] for t in range(k)]), np.array([models[t][p][1] for t in range(k)])
                                m[:, p] = (z @ u.T + c)[np.arange(len(f)), f]
                        yield pd.DataFrame({"fold": f.astype(np.int32), "label": y, "margins": list(m)})

        return self._blocks.mapInPandas(score, "fold int, label double, margins array<double>")


def _pieces(r, maps: Sequence[Map]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(rows, labels, folds) of a block, few enough at a time for a mapped piece of ``PIECE_VALUES``."""
    n = r["n"]
    x, y, f = array(r["x"], n).reshape(n, -1), array(r["__y"], n), array(r["__f"], n).astype(int)
    rows = max(1, PIECE_VALUES // max(w.width for w in maps))
    for i in range(0, n, rows):
        yield x[i:i + rows], y[i:i + rows], f[i:i + rows]


def hinge_fits(df: DataFrame, features: Column, label: str, maps: Sequence[Map], points: Sequence[HingePoint], fold: str | None = None,
               k: int = 0, whole: bool = True, max_iter: int = 50, tol: float = 1e-4) -> HingeFits:
    """Fit the points without each fold (0 to k - 1) and, if ``whole``, on all rows.  Labels are 0 or 1; a map is a
    function of a matrix of rows with an attribute ``width``."""
    rows = df.select(features.alias("__a"), F.col(label).cast("double").alias("__y"), (F.col(fold).cast("double") if fold else F.lit(-1.0)).alias("__f"))
    blocks = pack(rows.withColumn("__f", F.coalesce("__f", F.lit(-1.0))), F.col("__a"), ["__y", "__f"])
    width = max(w.width for w in maps)

    def means(r) -> np.ndarray:
        """Counts of the folds (the last: rows of none), whether all is sound, sums of the mapped features by fold."""
        n, s, sound = np.zeros(k + 1), np.zeros((k + 1, len(maps), width)), 1.0
        for x, y, f in _pieces(r, maps):
            if not np.isin(y, (0.0, 1.0)).all() or np.isnan(x).any():
                sound = 0.0
            at = np.where((f >= 0) & (f < k), f, k)
            n += np.bincount(at, minlength=k + 1)
            for j, w in enumerate(maps):
                z = w(x)
                for i in np.unique(at):
                    s[i, j, :w.width] += z[at == i].sum(0)
        return np.concatenate([n, [1.0 - sound], s.ravel()])

    sums = reduced(blocks, means)
    if sums is None:
        raise ValueError("no rows to fit")
    if sums[k + 1]:
        raise ValueError("labels must be 0 or 1 and features numbers")
    n = sums[:k + 1]
    own = sums[k + 2:].reshape(k + 1, len(maps), width) / np.maximum(n, 1)[:, None, None]  # means of the folds

    def spreads(r) -> np.ndarray:
        out = np.zeros((k + 1, len(maps), width))
        for x, _, f in _pieces(r, maps):
            at = np.where((f >= 0) & (f < k), f, k)
            for j, w in enumerate(maps):
                z = w(x)
                for i in np.unique(at):
                    out[i, j, :w.width] += ((z[at == i] - own[i, j, :w.width]) ** 2).sum(0)
        return out.ravel()

    within = reduced(blocks, spreads).reshape(k + 1, len(maps), width)
    sets = [*range(k), *([k] if whole else [])]  # without fold t; k: all rows
    count, mean, inverse = {}, {}, {}
    for t in sets:
        part = n * (np.arange(k + 1) != t) if t < k else n
        count[t] = part.sum()
        part = part[:, None, None]
        mean[t] = (part * own).sum(0) / max(count[t], 1)
        var = (np.where(part > 0, within, 0.0) + part * (own - mean[t]) ** 2).sum(0) / max(count[t] - 1, 1)
        # a feature that is constant in a set, though not in the fold left out, is 0 there
        inverse[t] = np.where(var > 1e-26 * mean[t] ** 2, 1 / np.sqrt(np.where(var > 0, var, 1.0)), 0.0)
    who = [(t, p) for t in sets for p in range(len(points))]

    def raw(i: int, theta: np.ndarray) -> tuple[np.ndarray, float]:
        """Weights and bias on the mapped features as they are."""
        t, p = who[i]
        j = points[p].mapped
        u = theta[:-1] * inverse[t][j, :maps[j].width]
        return u, float(theta[-1] - u @ mean[t][j, :maps[j].width])

    def evaluate(at: dict[int, np.ndarray]) -> dict[int, tuple[float, np.ndarray]]:
        """Value and gradient of models at their points, in one scan."""
        groups = []
        for j, w in enumerate(maps):
            these = [i for i in at if points[who[i][1]].mapped == j]
            if these:
                us, cs = zip(*(raw(i, at[i]) for i in these))
                groups.append((w, these, np.stack(us), np.array(cs), np.array([who[i][0] if who[i][0] < k else -2 for i in these])))
        sent = [(w, us, cs, out) for w, _, us, cs, out in groups]

        def make(r) -> np.ndarray:
            got = [np.zeros((len(us), us.shape[1] + 2)) for _, us, _, _ in sent]
            for x, y, f in _pieces(r, [w for w, *_ in sent]):
                sign = 2 * y[:, None] - 1
                for (w, us, cs, out), g in zip(sent, got):
                    z = w(x)
                    loss = 1 - sign * (z @ us.T + cs)
                    wrong = (loss > 0) & (f[:, None] != out)
                    back = np.where(wrong, -sign, 0.0)
                    g[:, 0] += np.where(wrong, loss, 0.0).sum(0)
                    g[:, 1] += back.sum(0)
                    g[:, 2:] += back.T @ z
            return np.concatenate([g.ravel() for g in got])

        total, out, start = reduced(blocks, make), {}, 0
        for w, these, us, _, _ in groups:
            got = total[start:start + len(these) * (us.shape[1] + 2)].reshape(len(these), -1)
            start += got.size
            for i, g in zip(these, got):
                t, p = who[i]
                m, inv, weights = mean[t][points[p].mapped, :w.width], inverse[t][points[p].mapped, :w.width], at[i][:-1]
                grad = (g[2:] - g[1] * m) * inv / max(count[t], 1) + points[p].reg * weights
                out[i] = g[0] / max(count[t], 1) + points[p].reg / 2 * (weights @ weights), np.append(grad, g[1] / max(count[t], 1))
        return out

    running = {i: orthant_steps(np.zeros(maps[points[p].mapped].width + 1), max_iter, tol) for i, (t, p) in enumerate(who)}
    asked, fitted, passes = {i: next(s) for i, s in running.items()}, {}, 2
    while asked:
        answers, passes = evaluate(asked), passes + 1
        for i, answer in answers.items():
            try:
                asked[i] = running[i].send(answer)
            except StopIteration as end:
                fitted[i] = raw(i, end.value)
                del asked[i]
    models = [[fitted.get(who.index((t, p))) if t in sets else None for p in range(len(points))] for t in range(k + 1)]
    return HingeFits(models, maps, points, blocks, passes)


def _array(df: DataFrame, col: str) -> Column:
    return F.col(col).cast("array<double>") if isinstance(df.schema[col].dataType, T.ArrayType) else vector_to_array(F.col(col))


class MappedSVM(Estimator):
    """A two-class SVM on a feature map; ``fit_folds`` gives the models without each fold, from the same scans."""

    def __init__(self, mapped: Map, reg: float, featuresCol: str = "features", labelCol: str = "label", max_iter: int = 50, tol: float = 1e-4):
        super().__init__()
        self.mapped, self.reg, self.featuresCol, self.labelCol, self.max_iter, self.tol = mapped, reg, featuresCol, labelCol, max_iter, tol

    def fits(self, df: DataFrame, fold: str | None = None, k: int = 0, whole: bool = True) -> HingeFits:
        return hinge_fits(df, _array(df, self.featuresCol), self.labelCol, [self.mapped], [HingePoint(0, self.reg)], fold, k, whole, self.max_iter, self.tol)

    def model(self, found: HingeFits, t: int) -> "HingeModel":
        return HingeModel(self.mapped, *found.models[t][0], self.featuresCol)

    def _fit(self, df: DataFrame) -> "HingeModel":
        return self.model(self.fits(df), 0)

    def fit_folds(self, df: DataFrame, fold: str, k: int) -> list["HingeModel"]:
        found = self.fits(df, fold, k, whole=False)
        return [self.model(found, t) for t in range(k)]


class HingeModel(Model):
    """Adds rawPrediction and prediction, as ``LinearSVCModel`` does; a task sends back a number a row."""

    def __init__(self, mapped: Map, weights: np.ndarray, bias: float, featuresCol: str = "features"):
        super().__init__()
        self.mapped, self.weights, self.bias, self.featuresCol = mapped, weights, bias, featuresCol

    def _transform(self, df: DataFrame) -> DataFrame:
        mapped, weights, bias = self.mapped, self.weights, self.bias
        rows = max(1, PIECE_VALUES // mapped.width)

        @F.pandas_udf("double")
        def margin(xs: pd.Series) -> pd.Series:
            out = np.empty(len(xs))
            for i in range(0, len(xs), rows):
                out[i:i + rows] = mapped(np.stack(xs.iloc[i:i + rows].to_numpy())) @ weights + bias
            return pd.Series(out)

        m = F.col("__m")
        return df.withColumn("__m", margin(_array(df, self.featuresCol))) \
            .withColumn("rawPrediction", array_to_vector(F.array(-m, m))) \
            .withColumn("prediction", (m > 0).cast("double")).drop("__m")
