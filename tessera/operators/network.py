"""Perceptron network with rectifier units and a weight penalty, fitted by L-BFGS.

The loss is the mean cross-entropy plus ``alpha / (2 n)`` times the squared weights (not the
biases).  A loss and its gradient are one pass over packed blocks (``blocks.reduced``): each task runs
the layers forward and backward in numpy and hands on one array of the model's size.  The
driver keeps the parameters and the last ten steps (two-loop recursion) and searches along
a direction until the weak Wolfe conditions hold.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

import numpy as np
import pandas as pd
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.operators.blocks import array, pack, reduced

__all__ = ["lbfgs", "PerceptronNetwork", "PerceptronModel"]

PIECE_VALUES = 1 << 17


def lbfgs(fun: Callable[[np.ndarray], tuple[float, np.ndarray]], x: np.ndarray, max_iter: int = 200, tol: float = 1e-4,
          memory: int = 10) -> tuple[np.ndarray, list[float]]:
    """Minimise fun (value, gradient); (x, values of the accepted points).  Stops when the largest
    gradient entry is at most ``tol``, when a step no longer lowers the value, or after ``max_iter`` steps."""
    f, g = fun(x)
    history, pairs = [f], []
    for _ in range(max_iter):
        if np.abs(g).max() <= tol:
            break
        d, kept = -g, []
        for s, y, rho in reversed(pairs):
            a = rho * (s @ d)
            kept.append(a)
            d = d - a * y
        if pairs:
            s, y, _ = pairs[-1]
            d = d * (s @ y) / (y @ y)
        for (s, y, rho), a in zip(pairs, reversed(kept)):
            d = d + (a - rho * (y @ d)) * s
        slope = g @ d
        if not slope < 0:
            d, slope, pairs = -g, -(g @ g), []
        step, low, high = (1.0 if pairs else min(1.0, 1.0 / np.abs(g).sum())), 0.0, math.inf
        best = None
        for _ in range(30):
            at = x + step * d
            f1, g1 = fun(at)
            if not f1 <= f + 1e-4 * step * slope:  # also when not a number
                high = step
            else:
                best = (at, f1, g1)
                if g1 @ d >= 0.9 * slope:
                    break
                low = step
            step = (low + high) / 2 if high < math.inf else 2 * step
        if best is None:
            break
        at, f1, g1 = best
        s, y = at - x, g1 - g
        if s @ y > 1e-10 * (y @ y):
            pairs = [*pairs, (s, y, 1.0 / (s @ y))][-memory:]
        moved = f - f1
        x, f, g = at, f1, g1
        history.append(f)
        if moved <= 1e-12 * max(abs(f), 1.0):
            break
    return x, history


def _layers(theta: np.ndarray, sizes: Sequence[int]) -> list[tuple[np.ndarray, np.ndarray]]:
    out, at = [], 0
    for a, b in zip(sizes, sizes[1:]):
        w = theta[at:at + a * b].reshape(a, b)
        out.append((w, theta[at + a * b:at + a * b + b]))
        at += a * b + b
    return out


def _room(rows: int, sizes: Sequence[int]) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Memory for a piece, by layer: what goes forward, what goes back and which units are on.  Pieces share it,
    since memory that is asked for anew has to be cleared by the system for each of them."""
    return [(np.empty((rows, n)), np.empty((rows, n)), np.empty((rows, n), bool)) for n in sizes]


def _forward(x: np.ndarray, layers: list, room: list | None = None) -> list[np.ndarray]:
    """Activations of every layer; the last are class probabilities."""
    acts = [x]
    for i, (w, b) in enumerate(layers):
        z = np.matmul(acts[-1], w, out=room[i + 1][0][:len(x)] if room else None)
        z += b
        if i < len(layers) - 1:
            acts.append(np.maximum(z, 0.0, out=z))
        else:
            z -= z.max(axis=1, keepdims=True)
            np.exp(z, out=z)
            z /= z.sum(axis=1, keepdims=True)
            acts.append(z)
    return acts


def block_loss(x: np.ndarray, y: np.ndarray, theta: np.ndarray, sizes: Sequence[int], room: list | None = None) -> np.ndarray:
    """[summed cross-entropy, rows, gradient...] of a block; y holds class numbers."""
    layers, room, n = _layers(theta, sizes), room or _room(len(x), sizes), len(x)
    acts = _forward(x, layers, room)
    back = acts[-1]
    rows = np.arange(n)
    loss = -np.log(np.maximum(back[rows, y], 1e-300)).sum()
    back[rows, y] -= 1.0
    grads = []
    for i in range(len(layers) - 1, -1, -1):
        grads.append(np.concatenate([(acts[i].T @ back).ravel(), back.sum(axis=0)]))
        if i:
            _, out, on = room[i]
            back = np.matmul(back, layers[i][0].T, out=out[:n])
            back *= np.greater(acts[i], 0, out=on[:n])
    return np.concatenate([[loss, len(x)], *reversed(grads)])


def pieces_loss(x: np.ndarray, y: np.ndarray, theta: np.ndarray, sizes: Sequence[int]) -> np.ndarray:
    """``block_loss`` in pieces whose activations (``PIECE_VALUES`` a layer) stay in the processor's cache."""
    rows = max(1, PIECE_VALUES // max(sizes))
    room = _room(min(rows, len(x)), sizes)
    total = block_loss(x[:rows], y[:rows], theta, sizes, room)
    for i in range(rows, len(x), rows):
        total += block_loss(x[i:i + rows], y[i:i + rows], theta, sizes, room)
    return total


def _features(df: DataFrame, col: str) -> Column:
    return F.col(col).cast("array<double>") if isinstance(df.schema[col].dataType, T.ArrayType) else vector_to_array(F.col(col))


class PerceptronNetwork:
    """Hidden layers of rectifier units, softmax output, penalty ``alpha``, L-BFGS.

    Labels are any comparable values; classes are numbered in ascending order (at most ``MAX_CLASSES``
    of them).  Rows with a null label are left out; features must not be null.
    """

    MAX_CLASSES = 1000

    def __init__(self, hidden: Sequence[int] = (100, 100), alpha: float = 1e-4, max_iter: int = 200, tol: float = 1e-4,
                 featuresCol: str = "features", labelCol: str = "label", seed: int = 0):
        self.hidden, self.alpha, self.max_iter, self.tol = tuple(hidden), alpha, max_iter, tol
        self.featuresCol, self.labelCol, self.seed = featuresCol, labelCol, seed

    def _objective(self, blocks: DataFrame, sizes: Sequence[int]) -> Callable[[np.ndarray], tuple[float, np.ndarray]]:
        weight = np.concatenate([np.r_[np.ones(a * b), np.zeros(b)] for a, b in zip(sizes, sizes[1:])])

        def fun(theta: np.ndarray) -> tuple[float, np.ndarray]:
            total = reduced(blocks, lambda r: pieces_loss(array(r["x"], r["n"]).reshape(r["n"], -1),
                                                          array(r["y"], r["n"]).astype(int), theta, sizes))
            n = total[1]
            penalty = weight * theta
            return total[0] / n + self.alpha / (2 * n) * (penalty @ penalty), (total[2:] + self.alpha * penalty) / n

        return fun

    def fit(self, df: DataFrame) -> "PerceptronModel":
        rows = df.where(F.col(self.labelCol).isNotNull())
        classes = sorted(r[0] for r in rows.select(self.labelCol).distinct().limit(self.MAX_CLASSES + 1).collect())
        if not 1 < len(classes) <= self.MAX_CLASSES:
            raise ValueError(f"a network needs 2 to {self.MAX_CLASSES} classes, found {len(classes)} (at least)")
        number = F.array_position(F.array(*[F.lit(c) for c in classes]), F.col(self.labelCol)) - 1
        blocks = pack(rows.withColumn("y", number), _features(df, self.featuresCol), ["y"])
        width = len(rows.select(_features(df, self.featuresCol).alias("x")).first()["x"])
        sizes = (width, *self.hidden, len(classes))
        rng = np.random.default_rng(self.seed)
        start = np.concatenate([rng.uniform(-1, 1, a * b + b) * math.sqrt(6.0 / (a + b)) for a, b in zip(sizes, sizes[1:])])
        theta, history = lbfgs(self._objective(blocks, sizes), start, self.max_iter, self.tol)
        return PerceptronModel(theta, sizes, classes, self.featuresCol, history)


class PerceptronModel:
    """A fitted network: class probabilities and prediction."""

    def __init__(self, theta: np.ndarray, sizes: Sequence[int], classes: list, featuresCol: str, history: list[float]):
        self.theta, self.sizes, self.classes, self.featuresCol, self.history = theta, tuple(sizes), classes, featuresCol, history

    def transform(self, df: DataFrame) -> DataFrame:
        theta, sizes = self.theta, self.sizes

        @F.pandas_udf("array<double>")
        def score(x: pd.Series) -> pd.Series:
            if not len(x):
                return pd.Series([], dtype=object)
            return pd.Series(list(_forward(np.stack(x.to_numpy()).astype(float), _layers(theta, sizes))[-1]))

        out = df.withColumn("probability", score(_features(df, self.featuresCol)))
        best = F.array_position("probability", F.array_max("probability")).cast("int")
        return out.withColumn("prediction", F.element_at(F.array(*[F.lit(c) for c in self.classes]), best))
