"""Penalised logistic paths and joint cross-validation.

``logistic_paths`` fits every (penalty, C) point on all rows and on the rest of every fold at the
same time.  A pass over the packed rows gives, for each model that still moves, loss,
gradient and Hessian (a weighted Gram matrix) at its candidate; the driver solves the
penalised quadratic (coordinate descent for L1, a linear system for L2) and takes a step, halved
while the objective does not fall.  So the whole grid costs as many scans as its slowest model has
steps, about 15, whatever the number of points and folds.  The scaler of a training set comes
from per-fold sums by subtraction, and is applied to the sums, not to the rows.

The objective is the summed logistic loss plus ``1/C`` times ``|b|_1`` or ``|b|^2 / 2`` over the
coefficients of standardised features, the intercept penalised with them (``penalize_intercept``).

``linear_cv`` scores least squares by folds from one aggregate: a fold's training sums are the total less
the fold's own, and its held-out errors follow from the same sums.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.operators.blocks import array, pack, reduced

__all__ = ["LogisticPaths", "LogisticPoint", "logistic_paths", "linear_cv"]


class LogisticPoint:
    """A fitted model: ``coef`` and ``intercept`` on standardised features, and ``transform``."""

    def __init__(self, features: Sequence[str], beta: np.ndarray, mean: np.ndarray, std: np.ndarray, penalty: str, C: float):
        self.features, self.penalty, self.C = list(features), penalty, C
        self.intercept, self.coef = float(beta[0]), beta[1:]
        self.weights = beta[1:] / std
        self.bias = float(beta[0] - (self.weights * mean).sum())

    def transform(self, df: DataFrame) -> DataFrame:
        """Adds p (probability of label 1) and prediction."""
        z = sum((F.col(c).cast("double") * float(w) for c, w in zip(self.features, self.weights)), F.lit(self.bias))
        return df.withColumn("p", 1.0 / (1.0 + F.exp(-z))).withColumn("prediction", (F.col("p") >= 0.5).cast("double"))


class LogisticPaths:
    """Result of ``logistic_paths``: ``points`` (models on all rows), ``scores`` and ``passes`` over the rows."""

    def __init__(self, points: list[LogisticPoint], held_out: Callable[[], DataFrame] | None, passes: int):
        self.points, self._held_out, self.passes = points, held_out, passes

    def held_out(self) -> DataFrame:
        """(point, fold, label, p): every row scored by the models that have not seen its fold."""
        if self._held_out is None:
            raise ValueError("fitted without folds")
        return self._held_out()

    def scores(self) -> list[float]:
        """Mean over the folds of the exact held-out AUC, per point."""
        from tessera.operators.evaluate import roc_auc

        rows = roc_auc(self.held_out(), "label", "p", by=["point", "fold"]).groupBy("point").agg(F.avg("auc").alias("auc")).collect()
        found = {r["point"]: r["auc"] for r in rows}
        return [found.get(i) for i in range(len(self.points))]

    def best(self) -> LogisticPoint:
        scores = self.scores()
        return self.points[max(range(len(scores)), key=lambda i: (scores[i] is not None, scores[i] or 0.0, -i))]


def _penalty(beta: np.ndarray, lam: np.ndarray, l1: np.ndarray) -> np.ndarray:
    return np.where(l1, (lam * np.abs(beta)).sum(1), (lam * beta * beta).sum(1) / 2)


def _step(beta: np.ndarray, g: np.ndarray, h: np.ndarray, lam: np.ndarray, l1: np.ndarray) -> np.ndarray:
    """Minimiser d of g.d + d.H.d / 2 + penalty(beta + d), for all models at once."""
    d = np.zeros_like(beta)
    ridge = np.flatnonzero(~l1)
    for m in ridge:
        d[m] = np.linalg.solve(h[m] + np.diag(lam[m] + 1e-12), -(g[m] + lam[m] * beta[m]))
    m = np.flatnonzero(l1)
    if len(m):
        b, gm, hm, lm, dm = beta[m], g[m], h[m], lam[m], d[m]
        for _ in range(2000):  # cyclic coordinate descent on the quadratic: model-sized work
            largest = 0.0
            for j in range(b.shape[1]):
                curve = np.maximum(hm[:, j, j], 1e-12)
                u = b[:, j] + dm[:, j] - (gm[:, j] + (hm[:, j] * dm).sum(1)) / curve
                new = np.sign(u) * np.maximum(np.abs(u) - lm[:, j] / curve, 0.0) - b[:, j]
                largest = max(largest, float(np.abs(new - dm[:, j]).max()))
                dm[:, j] = new
            if largest < 1e-11:
                break
        d[m] = dm
    return d


def logistic_paths(df: DataFrame, features: Sequence[str], label: str, points: Sequence[tuple[str, float]], fold: str | None = None,
                   k: int = 0, penalize_intercept: bool = True, tol: float = 1e-9, max_passes: int = 100) -> LogisticPaths:
    """Fit the (penalty, C) ``points`` (penalty ``l1`` or ``l2``) on all rows and, with ``fold`` (0 to k - 1), without each fold.

    Rows with a null label or feature are left out; a constant feature is not scaled.
    """
    features, width = list(features), len(features) + 1
    rows = df.dropna(subset=[label, *features]).withColumns({"__y": F.col(label).cast("double"),
                                                             "__f": F.col(fold).cast("double") if fold else F.lit(-1.0)})
    blocks = pack(rows, F.array(*[F.col(c).cast("double") for c in features]), ["__y", "__f"])

    def open_(r) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        x = array(r["x"], r["n"]).reshape(r["n"], -1)
        return np.concatenate([np.ones((len(x), 1)), x], axis=1), array(r["__y"], r["n"]), array(r["__f"], r["n"]).astype(int)

    def moments(r) -> np.ndarray:
        x, _, f = open_(r)
        out = np.zeros((k + 1, 2, width))  # the last: rows of no fold
        for i in range(k + 1):
            part = x[(f == i) if i < k else (f < 0) | (f >= k)]
            out[i] = part.sum(0), (part * part).sum(0)
        return out.ravel()

    sums = reduced(blocks, moments)
    if sums is None:
        raise ValueError("no rows to fit")
    sums = sums.reshape(k + 1, 2, width)
    total = sums.sum(0)
    sets = [total - sums[i] for i in range(k)] + [total]  # training sets: without fold i; all rows
    n = np.array([s[0, 0] for s in sets])[:, None]
    mean = np.array([s[0, 1:] for s in sets]) / np.maximum(n, 1)
    var = np.maximum(np.array([s[1, 1:] for s in sets]) / np.maximum(n, 1) - mean * mean, 0.0)
    std = np.where(var > 1e-24 * np.maximum(mean * mean, 1e-300), np.sqrt(var), 1.0)
    scale = np.zeros((k + 1, width, width))  # standardised = scale @ raw
    scale[:, 0, 0] = 1.0
    for j in range(width - 1):
        scale[:, j + 1, 0], scale[:, j + 1, j + 1] = -mean[:, j] / std[:, j], 1 / std[:, j]

    models = [(t, p) for t in range(k + 1) for p in range(len(points))]
    of_set = np.array([t for t, _ in models])
    l1 = np.array([points[p][0] == "l1" for _, p in models])
    lam = np.array([[1.0 / points[p][1]] * width for _, p in models])
    if not penalize_intercept:
        lam[:, 0] = 0.0
    size = width * (width + 1) // 2
    upper = np.triu_indices(width)

    def evaluate(which: np.ndarray, beta: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Loss, gradient and Hessian of the models ``which`` at ``beta``, in one scan."""
        raw = np.einsum("mij,mi->mj", scale[of_set[which]], beta)
        left_out = of_set[which]

        def make(r) -> np.ndarray:
            x, y, f = open_(r)
            z = x @ raw.T
            use = f[:, None] != np.where(left_out < k, left_out, -2)[None, :]
            p = 1 / (1 + np.exp(-z))
            loss = (np.where(use, np.logaddexp(0.0, z) - y[:, None] * z, 0.0)).sum(0)
            g = (np.where(use, p - y[:, None], 0.0)).T @ x
            w = np.where(use, p * (1 - p), 0.0)
            h = np.stack([(x.T @ (x * w[:, [m]]))[upper] for m in range(len(raw))])
            return np.concatenate([loss[:, None], g, h], axis=1).ravel()

        out = reduced(blocks, make).reshape(len(which), 1 + width + size)
        h = np.zeros((len(which), width, width))
        h[:, upper[0], upper[1]] = out[:, 1 + width:]
        h[:, upper[1], upper[0]] = out[:, 1 + width:]
        s = scale[left_out]
        return out[:, 0], np.einsum("mij,mj->mi", s, out[:, 1:1 + width]), s @ h @ s.transpose(0, 2, 1)

    beta = np.zeros((len(models), width))
    moving = np.arange(len(models))
    value, g, h = evaluate(moving, beta)
    value = value + _penalty(beta, lam, l1)
    d = _step(beta, g, h, lam, l1)
    t, passes = np.ones(len(models)), 1
    while passes < max_passes:
        moving = moving[np.abs(d[moving]).max(axis=1) > tol]
        if not len(moving):
            break
        at = beta[moving] + t[moving, None] * d[moving]
        f, g1, h1 = evaluate(moving, at)
        passes += 1
        f = f + _penalty(at, lam[moving], l1[moving])
        fall = (g[moving] * d[moving]).sum(1) + _penalty(beta[moving] + d[moving], lam[moving], l1[moving]) - _penalty(beta[moving], lam[moving], l1[moving])
        ok = f <= value[moving] + 1e-4 * t[moving] * fall + 1e-12 * np.abs(value[moving])
        good, bad = moving[ok], moving[~ok]
        t[bad] /= 2
        d[bad[t[bad] < 1e-8]] = 0.0  # no lower value within rounding
        beta[good], value[good], g[good], h[good], t[good] = at[ok], f[ok], g1[ok], h1[ok], 1.0
        if len(good):
            d[good] = _step(beta[good], g[good], h[good], lam[good], l1[good])

    fitted = [LogisticPoint(features, beta[k * len(points) + i], mean[k], std[k], *p) for i, p in enumerate(points)]
    if not fold:
        return LogisticPaths(fitted, None, passes)
    raw = np.einsum("mij,mi->mj", scale[of_set], beta).reshape(k + 1, len(points), width)

    def held_out() -> DataFrame:
        def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for b in batches:
                for i in range(len(b)):
                    x, y, f = open_(b.iloc[i])
                    keep = (f >= 0) & (f < k)
                    x, y, f = x[keep], y[keep], f[keep]
                    z = np.einsum("nj,npj->np", x, raw[f])
                    yield pd.DataFrame({"point": np.tile(np.arange(len(points), dtype=np.int32), len(y)), "fold": np.repeat(f, len(points)).astype(np.int32),
                                        "label": np.repeat(y, len(points)), "p": (1 / (1 + np.exp(-z))).ravel()})

        return blocks.mapInPandas(score, "point int, fold int, label double, p double")

    return LogisticPaths(fitted, held_out, passes)


def linear_cv(df: DataFrame, features: Sequence[str], label: str, fold: str) -> DataFrame:
    """M16 for least squares: (fold, n, r2): the held-out R^2 of each fold from one grouped aggregate.

    Rows with a null feature, label or fold are left out.  The sums of a fold give its held-out error
    without reading the rows again: ``|y - Xb|^2 = y.y - 2 b.X'y + b.X'X b``.
    """
    cols = [F.lit(1.0), *[F.col(c).cast("double") for c in features], F.col(label).cast("double")]
    pairs = [(i, j) for i in range(len(cols)) for j in range(i, len(cols))]
    sums = df.dropna(subset=[*features, label, fold]).groupBy(F.col(fold).alias("fold")).agg(
        *[F.sum(cols[i] * cols[j]).alias(f"s{i}_{j}") for i, j in pairs]).orderBy("fold").collect()
    grams = {}
    for r in sums:  # one row a fold
        a = np.zeros((len(cols), len(cols)))
        for i, j in pairs:
            a[i, j] = a[j, i] = r[f"s{i}_{j}"]
        grams[r["fold"]] = a
    total, out = sum(grams.values()), []
    for f, own in grams.items():
        train = total - own
        b = np.linalg.lstsq(train[:-1, :-1], train[:-1, -1], rcond=None)[0]
        error = own[-1, -1] - 2 * b @ own[:-1, -1] + b @ own[:-1, :-1] @ b
        spread = own[-1, -1] - own[0, -1] ** 2 / own[0, 0]
        out.append((f, int(round(own[0, 0])), float(1 - error / spread) if spread > 0 else None))
    kind = df.schema[fold].dataType.simpleString()
    return df.sparkSession.createDataFrame(out, f"fold {kind}, n long, r2 double")
