"""Model training, tuning and prediction (M1-M19) on ``pyspark.ml``.

Rules kept from the survey:
* M1 gradient descent runs on sufficient statistics gathered in ONE scan
  (XᵀX, Xᵀy, yᵀy, Σx, Σy, m): every iterate equals batch descent on the rows,
  and the data is read once however many steps are taken.
* Regularisation strength C of the reference maps to ``regParam = 1 / (C * n)``.
* Kernel SVMs become explicit feature maps (random Fourier features for RBF,
  homogeneous cubic monomials for the polynomial kernel) + a linear SVM: two classes by
  ``hinge.MappedSVM``, which maps inside the scans, more by ``LinearSVC`` on Arrow-batched pandas UDFs.
* Margins become probabilities with Platt scaling fitted on out-of-fold margins.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Mapping, Sequence
from multiprocessing.pool import ThreadPool

import numpy as np
import pandas as pd
from pyspark import inheritable_thread_target
from pyspark.ml import Estimator, Model, Pipeline, Transformer
from pyspark.ml.classification import (GBTClassifier, LinearSVC, LogisticRegression,
                                       MultilayerPerceptronClassifier, OneVsRest, RandomForestClassifier,
                                       DecisionTreeClassifier)
from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.regression import GBTRegressor, LinearRegression
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.operators.aggregate import gram_stats
from tessera.operators.hinge import HingeFits, HingeModel, HingePoint, MappedSVM, _array, hinge_fits
from tessera.session import cut_lineage

__all__ = ["LinearRegressionGD", "LinearRegressionGDModel", "ols", "ols_columns", "logistic", "reg_param",
           "RandomFourierFeatures", "CubicFeatures", "FourierMap", "CubicMap", "svm_rbf", "svm_poly", "svm_search", "PlattScaler", "fit_sigmoid", "decision_tree",
           "random_forest", "gbt_classifier", "gbt_regressor", "mlp", "predict_proba", "grid_search", "best_point",
           "cv_scores", "compare_models", "coefficients", "cost_history"]


# ----------------------------------------------------------------------------- M1 / M19

class LinearRegressionGD(Estimator):
    """M1: batch gradient descent for ``h = b + x . w`` with ``J = sum((h-y)^2) / (2m)``.

    Starts at zero; the history starts with -1; the stop test compares history
    entries ``it-1`` and ``it`` after appending entry ``it+1`` (so it lags one
    step and at it=0 index -1 wraps to the newest entry); ``it > max_iter`` stops,
    which allows ``max_iter + 2`` steps.
    """

    def __init__(self, featuresCols: Sequence[str], labelCol: str, alpha: float = 0.01, eps: float = 1e-10,
                 max_iter: float | None = 1e5, predictionCol: str = "prediction"):
        super().__init__()
        self.featuresCols, self.labelCol = list(featuresCols), labelCol
        self.alpha, self.eps, self.max_iter, self.predictionCol = alpha, eps, max_iter, predictionCol

    def _fit(self, df: DataFrame) -> "LinearRegressionGDModel":
        n = len(self.featuresCols)
        st = gram_stats(df.select(*self.featuresCols, self.labelCol), self.featuresCols, self.labelCol)
        m = float(st["m"])
        sx = np.array([st[f"sx{i}"] for i in range(n)], dtype=float)
        sxy = np.array([st[f"sxy{i}"] for i in range(n)], dtype=float)
        xtx = np.zeros((n, n))
        for i in range(n):
            for j in range(i, n):
                xtx[i, j] = xtx[j, i] = st[f"sxx{i}_{j}"]
        sy, syy = float(st["sy"]), float(st["syy"])

        def cost(b, w):
            return (m * b * b + w @ xtx @ w + syy + 2 * b * (sx @ w) - 2 * b * sy - 2 * (w @ sxy)) / (2 * m)

        b, w = 0.0, np.zeros(n)
        hist = [-1.0]
        it = 0
        while True:
            db = (m * b + sx @ w - sy) / m
            dw = (b * sx + xtx @ w - sxy) / m
            b, w = b - self.alpha * db, w - self.alpha * dw
            hist.append(float(cost(b, w)))
            if self.max_iter and it > self.max_iter:
                break
            if abs(hist[it - 1] - hist[it]) < self.eps:
                break
            it += 1
        return LinearRegressionGDModel(self.featuresCols, float(b), [float(v) for v in w], hist,
                                       self.predictionCol)


class LinearRegressionGDModel(Model):
    def __init__(self, featuresCols, intercept, coef, history, predictionCol="prediction"):
        super().__init__()
        self.featuresCols, self.intercept, self.coef = featuresCols, intercept, coef
        self.history, self.predictionCol = history, predictionCol

    def _transform(self, df: DataFrame) -> DataFrame:
        h = F.lit(self.intercept)
        for c, w in zip(self.featuresCols, self.coef):
            h = h + F.col(c).cast("double") * F.lit(w)
        return df.withColumn(self.predictionCol, h)

    def history_frame(self, spark: SparkSession) -> DataFrame:
        """(iteration, J) rows, the leading -1 placeholder left out."""
        rows = [(i + 1, float(j)) for i, j in enumerate(self.history[1:])]
        return spark.createDataFrame(rows, "iteration int, J double")


def cost_history(model: LinearRegressionGDModel, spark: SparkSession) -> DataFrame:
    """M19."""
    return model.history_frame(spark)


def gd_path(df: DataFrame, featuresCols: Sequence[str], labelCol: str, alpha: float, steps: int) -> list[tuple]:
    """First ``steps`` iterates (iteration, b, w..., J) of M1 from one statistics scan."""
    n = len(featuresCols)
    st = gram_stats(df.select(*featuresCols, labelCol), featuresCols, labelCol)
    m = float(st["m"])
    sx = np.array([st[f"sx{i}"] for i in range(n)], dtype=float)
    sxy = np.array([st[f"sxy{i}"] for i in range(n)], dtype=float)
    xtx = np.array([[st[f"sxx{min(i, j)}_{max(i, j)}"] for j in range(n)] for i in range(n)], dtype=float)
    sy, syy = float(st["sy"]), float(st["syy"])
    b, w, out = 0.0, np.zeros(n), []
    for it in range(1, steps + 1):
        db = (m * b + sx @ w - sy) / m
        dw = (b * sx + xtx @ w - sxy) / m
        b, w = b - alpha * db, w - alpha * dw
        j = (m * b * b + w @ xtx @ w + syy + 2 * b * (sx @ w) - 2 * b * sy - 2 * (w @ sxy)) / (2 * m)
        out.append((it, float(b), *[float(v) for v in w], float(j)))
    return out


# ----------------------------------------------------------------------------- M2

def ols_columns(df: DataFrame, x: str, y: str, by: Sequence[str] = ()) -> DataFrame:
    """M2 (one feature): slope, intercept and R^2 as SQL aggregates."""
    aggs = [F.regr_slope(F.col(y), F.col(x)).alias("slope"), F.regr_intercept(F.col(y), F.col(x)).alias("intercept"),
            F.regr_r2(F.col(y), F.col(x)).alias("r2")]
    return df.groupBy(*by).agg(*aggs) if by else df.agg(*aggs)


def ols(df: DataFrame, featuresCol: str = "features", labelCol: str = "label"):
    """M2: ordinary least squares via the normal equations."""
    return LinearRegression(featuresCol=featuresCol, labelCol=labelCol, solver="normal", regParam=0.0).fit(df)


# ----------------------------------------------------------------------------- M3 / M4

def reg_param(C: float, n: int) -> float:
    """Inverse-C penalty of the reference mapped to Spark's per-row mean loss."""
    return 1.0 / (float(C) * max(int(n), 1))


def logistic(C: float = 1.0, n: int = 1, penalty: str = "l2", featuresCol: str = "features",
             labelCol: str = "label", maxIter: int = 100, tol: float = 1e-4) -> LogisticRegression:
    """M3/M4: logistic regression with an L1 or L2 penalty of strength 1/C (stopping tolerance 1e-4)."""
    return LogisticRegression(featuresCol=featuresCol, labelCol=labelCol, maxIter=maxIter, tol=tol,
                              regParam=reg_param(C, n), elasticNetParam=1.0 if penalty == "l1" else 0.0,
                              standardization=False)


# ----------------------------------------------------------------------------- M5 / M6 / M7

def _vec_in(df: DataFrame, col: str) -> DataFrame:
    dt = df.schema[col].dataType
    if isinstance(dt, T.ArrayType):
        return df.withColumn("__arr", F.col(col).cast("array<double>"))
    return df.withColumn("__arr", vector_to_array(F.col(col)))


CV_THREADS = 3  # folds fitted at the same time by an estimator that cannot fit them in the same scans
MAP_VALUES = 1 << 20  # values of a feature map held at once (8 MB), whatever the size of an Arrow batch


def _parts(xs: pd.Series, width: int) -> Iterator[pd.Series]:
    """Pieces of a batch whose mapped rows (``width`` values each) stay within ``MAP_VALUES``."""
    rows = max(1, MAP_VALUES // max(width, 1))
    for i in range(0, len(xs), rows):
        yield xs.iloc[i:i + rows]


class FourierMap:
    """z(x) = sqrt(2/D) cos(W x + b), W ~ N(0, 2*gamma), b ~ U(0, 2*pi), of a matrix of rows."""

    def __init__(self, dim_in: int, n_features: int, gamma: float, seed: int = 0):
        rng = np.random.default_rng(seed)
        self.W = rng.normal(0.0, math.sqrt(2.0 * gamma), size=(dim_in, n_features))
        self.b, self.scale, self.width = rng.uniform(0.0, 2 * math.pi, size=n_features), math.sqrt(2.0 / n_features), n_features

    def __call__(self, x: np.ndarray) -> np.ndarray:
        return self.scale * np.cos(x @ self.W + self.b)


class CubicMap:
    """Every monomial x_i x_j x_k (i <= j <= k), weighted by sqrt(multinomial) * gamma^(3/2), of a matrix of rows."""

    def __init__(self, dim_in: int, gamma: float = 1.0):
        idx, wts = [], []
        for i in range(dim_in):
            for j in range(i, dim_in):
                for k in range(j, dim_in):
                    idx.append((i, j, k))
                    wts.append(math.sqrt((1, 3, 6)[len({i, j, k}) - 1]) * gamma ** 1.5)
        self.idx, self.wts, self.width, self.dim_in = np.array(idx), np.array(wts), len(idx), dim_in

    def __call__(self, x: np.ndarray) -> np.ndarray:
        out, cols, at = np.empty((self.width, len(x))), np.ascontiguousarray(x.T), 0
        for i in range(self.dim_in):
            for j in range(i, self.dim_in):
                np.multiply(cols[j:], cols[i] * cols[j], out=out[at:at + self.dim_in - j])
                at += self.dim_in - j
        out *= self.wts[:, None]
        return out.T


class RandomFourierFeatures(Transformer):
    """M5: z(x) = sqrt(2/D) cos(W x + b), W ~ N(0, 2*gamma), b ~ U(0, 2*pi) (Rahimi & Recht 2007).

    The random matrix is a small fixed parameter (D x d) shipped with the UDF.
    """

    gamma = Param(Params._dummy(), "gamma", "kernel width exp(-gamma |x - y|^2)", TypeConverters.toFloat)
    seed = Param(Params._dummy(), "seed", "seed of the random matrix", TypeConverters.toInt)

    def __init__(self, inputCol: str, outputCol: str, dim_in: int, n_features: int = 256,
                 gamma: float = 0.1, seed: int = 0):
        super().__init__()
        self.inputCol, self.outputCol = inputCol, outputCol
        self.dim_in, self.n_features = dim_in, n_features
        self._set(gamma=gamma, seed=seed)

    def _transform(self, df: DataFrame) -> DataFrame:
        mapped = FourierMap(self.dim_in, self.n_features, self.getOrDefault("gamma"), self.getOrDefault("seed"))

        @F.pandas_udf(T.ArrayType(T.DoubleType()))
        def rff(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            for xs in batches:
                for part in _parts(xs, mapped.width):
                    yield pd.Series(list(mapped(np.stack(part.to_numpy()))))

        return _vec_in(df, self.inputCol).withColumn(self.outputCol, array_to_vector(rff("__arr"))).drop("__arr")


class CubicFeatures(Transformer):
    """M6: explicit map of the homogeneous cubic kernel (gamma * x.y)^3: every monomial
    x_i x_j x_k (i <= j <= k) weighted by sqrt(multinomial) * gamma^(3/2)."""

    def __init__(self, inputCol: str, outputCol: str, dim_in: int, gamma: float = 1.0):
        super().__init__()
        self.inputCol, self.outputCol = inputCol, outputCol
        self.mapped = CubicMap(dim_in, gamma)
        self.idx, self.wts = self.mapped.idx, self.mapped.wts

    def _transform(self, df: DataFrame) -> DataFrame:
        mapped = self.mapped

        @F.pandas_udf(T.ArrayType(T.DoubleType()))
        def cubic(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            for xs in batches:
                for part in _parts(xs, mapped.width):
                    yield pd.Series(list(np.ascontiguousarray(mapped(np.stack(part.to_numpy())))))

        return _vec_in(df, self.inputCol).withColumn(self.outputCol, array_to_vector(cubic("__arr"))).drop("__arr")


def svm_rbf(dim_in: int, C: float = 1.0, n: int = 1, gamma: float = 0.1, n_features: int = 256,
            featuresCol: str = "features", labelCol: str = "label", multiclass: bool = False,
            seed: int = 0) -> Estimator:
    """M5: RBF-kernel SVM approximated by random Fourier features + a linear SVM."""
    if not multiclass:
        return MappedSVM(FourierMap(dim_in, n_features, gamma, seed), reg_param(C, n), featuresCol, labelCol)
    rff = RandomFourierFeatures(featuresCol, "__rff", dim_in, n_features, gamma, seed)
    svc = LinearSVC(featuresCol="__rff", labelCol=labelCol, regParam=reg_param(C, n), maxIter=50, tol=1e-4)
    return Pipeline(stages=[rff, OneVsRest(classifier=svc, featuresCol="__rff", labelCol=labelCol, parallelism=4)])


def svm_poly(dim_in: int, C: float = 1.0, n: int = 1, gamma: float | None = None,
             featuresCol: str = "features", labelCol: str = "label") -> MappedSVM:
    """M6: cubic-kernel SVM (coef0 = 0) as explicit monomials + a linear SVM."""
    g = gamma if gamma is not None else 1.0 / max(dim_in, 1)
    return MappedSVM(CubicMap(dim_in, g), reg_param(C, n), featuresCol, labelCol)


class SVMSearch:
    """M15 for RBF SVMs: every (regParam, gamma) point, scored by its mean held-out AUC over the folds;
    ``best`` is the number of the best point."""

    def __init__(self, points: list[tuple[float, float]], found: HingeFits, k: int):
        self.points, self.found, self.k = points, found, k
        self.held = cut_lineage(found.held_out())  # fold, label, a margin a point
        ev = BinaryClassificationEvaluator(labelCol="label", rawPredictionCol="margin", metricName="areaUnderROC")

        def score(at: tuple[int, int]) -> float:
            return ev.evaluate(self.held.where(F.col("fold") == at[1]).select("label", F.get("margins", at[0]).alias("margin")))

        with ThreadPool(8) as pool:
            each = pool.map(inheritable_thread_target(self.held.sparkSession)(score), [(p, f) for p in range(len(points)) for f in range(k)])
        self.avgMetrics = [float(np.mean(each[p * k:(p + 1) * k])) for p in range(len(points))]
        self.best = int(np.argmax(self.avgMetrics))

    def platt(self, featuresCol: str = "features") -> "PlattModel":
        """The best point on all rows, its sigmoid from the held-out margins of the search."""
        margins = self.held.select("label", F.get("margins", self.best).alias("__margin"))
        model = HingeModel(self.found.maps[self.found.points[self.best].mapped], *self.found.models[self.k][self.best], featuresCol)
        return PlattModel(model, *fit_sigmoid(margins, "__margin", "label"))


def svm_search(df: DataFrame, dim_in: int, regs: Sequence[float], gammas: Sequence[float], foldCol: str, k: int, n_features: int = 256,
               featuresCol: str = "features", labelCol: str = "label", seed: int = 0, whole: bool = True, max_iter: int = 50) -> SVMSearch:
    """RBF SVMs over regParam x gamma, all folds and points in the same scans."""
    maps = [FourierMap(dim_in, n_features, g, seed) for g in gammas]
    grid = [(r, j) for r in regs for j in range(len(gammas))]
    found = hinge_fits(df, _array(df, featuresCol), labelCol, maps, [HingePoint(j, r) for r, j in grid], foldCol, k, whole, max_iter)
    return SVMSearch([(r, gammas[j]) for r, j in grid], found, k)


def fit_sigmoid(margins: DataFrame, margin: str, label: str, maxIter: int = 100) -> tuple[float, float]:
    """M7: (a, b) of p = 1 / (1 + exp(a * margin + b)) by Newton steps on smoothed targets
    ((N+ + 1) / (N+ + 2) for label 1, 1 / (N- + 2) otherwise); a step is one aggregate of six sums."""
    m, y = F.col(margin).cast("double"), F.col(label) == 1
    rows = cut_lineage(margins.where(m.isNotNull() & F.col(label).isNotNull()).groupBy(m.alias("m"), y.alias("y")).agg(F.count(F.lit(1)).alias("n")))
    counts = {r["y"]: r["n"] for r in rows.groupBy("y").agg(F.sum("n").alias("n")).collect()}
    pos, neg = counts.get(True, 0), counts.get(False, 0)
    t = F.when(F.col("y"), (pos + 1.0) / (pos + 2.0)).otherwise(1.0 / (neg + 2.0))

    def sums(a: float, b: float):
        z, n, x = F.lit(a) * F.col("m") + F.lit(b), F.col("n"), F.col("m")
        p = 1.0 / (1.0 + F.exp(z))
        # -t log p - (1 - t) log(1 - p), without overflow
        loss = F.greatest(z, F.lit(0.0)) + F.log1p(F.exp(-F.abs(z))) - (1 - t) * z
        w = p * (1 - p) * n
        return rows.agg(F.sum(n * loss), F.sum(n * (t - p) * x), F.sum(n * (t - p)), F.sum(w * x * x), F.sum(w * x), F.sum(w)).first()

    a, b = 0.0, math.log((neg + 1.0) / (pos + 1.0))
    if not pos + neg:
        return a, b
    now = sums(a, b)
    for _ in range(maxIter):
        f, ga, gb, haa, hab, hbb = (float(v) for v in now)
        if max(abs(ga), abs(gb)) < 1e-9 * (pos + neg):
            break
        haa, hbb = haa + 1e-12, hbb + 1e-12
        det = haa * hbb - hab * hab
        da, db = -(hbb * ga - hab * gb) / det, -(haa * gb - hab * ga) / det
        slope, step = ga * da + gb * db, 1.0
        while step > 1e-10:
            new = sums(a + step * da, b + step * db)
            if float(new[0]) <= f + 1e-4 * step * slope:
                a, b, now = a + step * da, b + step * db, new
                break
            step /= 2
        else:
            break
    return a, b


class PlattScaler(Estimator):
    """M7: probability from an SVM margin; the sigmoid is fitted on out-of-fold margins."""

    def __init__(self, base: Estimator, foldCol: str, labelCol: str = "label", k: int = 3):
        super().__init__()
        self.base, self.foldCol, self.labelCol, self.k = base, foldCol, labelCol, k

    def _fit(self, df: DataFrame) -> "PlattModel":
        if isinstance(self.base, MappedSVM):  # all folds and the whole in the same scans
            found = self.base.fits(df, self.foldCol, self.k)
            margins = found.held_out().select(F.col("label").alias(self.labelCol), F.get("margins", 0).alias("__margin"))
            return PlattModel(self.base.model(found, self.k), *fit_sigmoid(margins, "__margin", self.labelCol))
        parts = []
        for f in range(self.k):
            m = self.base.fit(df.where(F.col(self.foldCol) != f))
            parts.append(m.transform(df.where(F.col(self.foldCol) == f))
                          .select(self.labelCol, F.get(vector_to_array("rawPrediction"), 1).alias("__margin")))
        oof = parts[0]
        for p in parts[1:]:
            oof = oof.unionByName(p)
        return PlattModel(self.base.fit(df), *fit_sigmoid(oof, "__margin", self.labelCol))


class PlattModel(Model):
    def __init__(self, base_model, a: float, b: float):
        super().__init__()
        self.base_model, self.a, self.b = base_model, a, b

    def _transform(self, df: DataFrame) -> DataFrame:
        out = self.base_model.transform(df)
        p = 1.0 / (1.0 + F.exp(F.lit(self.a) * F.get(vector_to_array("rawPrediction"), 1) + F.lit(self.b)))
        return out.withColumn("__p", p).withColumn("probability", array_to_vector(F.array(1.0 - F.col("__p"), F.col("__p")))).drop("__p")


# ----------------------------------------------------------------------------- M8-M13

def decision_tree(maxDepth: int = 6, impurity: str = "entropy", featuresCol="features", labelCol="label",
                  seed: int = 20) -> DecisionTreeClassifier:
    """M8 (depth limit only; the leaf limit is ``trees.BestFirstTree``)."""
    return DecisionTreeClassifier(featuresCol=featuresCol, labelCol=labelCol, maxDepth=maxDepth,
                                  impurity=impurity, seed=seed)


def random_forest(numTrees: int = 200, maxDepth: int = 7, features_per_split: str = "10",
                  featuresCol="features", labelCol="label", seed: int = 20) -> RandomForestClassifier:
    """M9."""
    return RandomForestClassifier(featuresCol=featuresCol, labelCol=labelCol, numTrees=numTrees,
                                  maxDepth=maxDepth, featureSubsetStrategy=features_per_split,
                                  impurity="gini", seed=seed)


def gbt_classifier(maxIter: int = 100, stepSize: float = 1.0, maxDepth: int = 3, featuresCol="features",
                   labelCol="label", seed: int = 20, validationIndicatorCol: str | None = None) -> GBTClassifier:
    """M10/M11 (first-order boosting; early stopping through a validation flag column)."""
    g = GBTClassifier(featuresCol=featuresCol, labelCol=labelCol, maxIter=maxIter, stepSize=stepSize,
                      maxDepth=maxDepth, seed=seed)
    if validationIndicatorCol:
        g.setValidationIndicatorCol(validationIndicatorCol)
    return g


def gbt_regressor(maxIter: int = 500, stepSize: float = 0.15, maxDepth: int = 5, featuresCol="features",
                  labelCol="label", seed: int = 20) -> GBTRegressor:
    """M12 (first-order form; the second-order one is ``boosting.BoostedTrees``)."""
    return GBTRegressor(featuresCol=featuresCol, labelCol=labelCol, maxIter=maxIter, stepSize=stepSize,
                        maxDepth=maxDepth, seed=seed)


def mlp(n_in: int, hidden: Sequence[int] = (100,), n_out: int = 2, maxIter: int = 200, featuresCol="features",
        labelCol="label", seed: int = 0) -> MultilayerPerceptronClassifier:
    """Spark's L-BFGS network (sigmoid hidden units, no weight penalty); M13 as the source has it is ``network.PerceptronNetwork``."""
    return MultilayerPerceptronClassifier(featuresCol=featuresCol, labelCol=labelCol,
                                          layers=[n_in, *hidden, n_out], solver="l-bfgs", maxIter=maxIter,
                                          seed=seed)


# ----------------------------------------------------------------------------- M14-M18

def predict_proba(model, df: DataFrame, cls: int = 1, out: str = "p") -> DataFrame:
    """Prediction plus the probability of class ``cls``."""
    t = model.transform(df)
    return t.withColumn(out, F.get(vector_to_array("probability"), cls))


def grid_search(estimator, df: DataFrame, grid: Mapping, foldCol: str, numFolds: int, labelCol: str = "label",
                metric: str = "areaUnderROC", parallelism: int = 8):
    """Exhaustive grid, scored by cross-validated AUC (or any binary metric).

    ``grid`` maps Param objects to value lists; put scalers into ``estimator`` (a Pipeline)
    so they are fitted inside each fold.  Returns the fitted CrossValidatorModel
    (``bestModel`` refitted on all rows, ``avgMetrics``).
    """
    b = ParamGridBuilder()
    for p, vals in grid.items():
        b = b.addGrid(p, list(vals))
    ev = BinaryClassificationEvaluator(labelCol=labelCol, metricName=metric)
    cv = CrossValidator(estimator=estimator, estimatorParamMaps=b.build(), evaluator=ev, foldCol=foldCol,
                        numFolds=numFolds, parallelism=parallelism)
    return cv.fit(df)


def best_point(cvm) -> dict:
    """Parameters of the best grid point by name."""
    k = int(np.argmax(cvm.avgMetrics))
    return {p.name: v for p, v in cvm.getEstimatorParamMaps()[k].items()}


def grid_table(cvm, spark: SparkSession) -> DataFrame:
    """Scores of every grid point as rows (param settings as text, mean metric)."""
    rows = []
    for pm, score in zip(cvm.getEstimatorParamMaps(), cvm.avgMetrics):
        rows.append((", ".join(f"{p.name}={v}" for p, v in sorted(pm.items(), key=lambda kv: kv[0].name)),
                     float(score)))
    return spark.createDataFrame(rows, "params string, score double")


def cv_scores(estimator, df: DataFrame, foldCol: str, k: int, labelCol: str = "label",
              metric: str = "accuracy") -> DataFrame:
    """One accuracy per fold (fit on the other folds) -> rows (fold, score)."""
    spark = df.sparkSession
    ev = MulticlassClassificationEvaluator(labelCol=labelCol, metricName=metric)
    joint = estimator.fit_folds(df, foldCol, k) if hasattr(estimator, "fit_folds") else None

    def score(f: int) -> tuple[int, float]:
        m = joint[f] if joint else estimator.fit(df.where(F.col(foldCol) != f))
        out = m.transform(df.where(F.col(foldCol) == f)).withColumn("prediction", F.col("prediction").cast("double"))
        return f, float(ev.evaluate(out))

    with ThreadPool(CV_THREADS) as pool:  # the small jobs of some folds run while others wait for their slowest task
        rows = pool.map(inheritable_thread_target(spark)(score), range(k), chunksize=1)
    return spark.createDataFrame(rows, "fold int, score double")


def compare_models(models: Mapping[str, object], train: DataFrame, test: DataFrame, id_col: str,
                   out_path: str | None = None) -> DataFrame:
    """Fit each named estimator, predict the test rows, tag and union them.

    With ``out_path`` the union is written once as CSV partitioned by model.
    """
    preds = []
    for name, est in models.items():
        m = est.fit(train)
        preds.append(m.transform(test).select(F.lit(name).alias("model"), F.col(id_col),
                                              F.col("prediction").cast("int").alias("prediction")))
    out = preds[0]
    for p in preds[1:]:
        out = out.unionByName(p)
    if out_path:
        out.write.mode("overwrite").partitionBy("model").option("header", True).csv(out_path)
    return out


def coefficients(model, feature_names: Sequence[str], spark: SparkSession, top: int | None = 15) -> DataFrame:
    """(feature, coef, abs_coef) ranked by magnitude."""
    coefs = model.coefficients.toArray() if hasattr(model, "coefficients") else np.asarray(model.coef)
    rows = [(f, float(c), float(abs(c))) for f, c in zip(feature_names, coefs)]
    df = spark.createDataFrame(rows, "feature string, coef double, abs_coef double")
    df = df.orderBy(F.col("abs_coef").desc(), "feature")
    return df.limit(top) if top else df
