"""Query plans for models and clustering.

Trained-model outputs have no SQL twin (rows-only check + unit tests); ``ols``,
``gd_steps``, ``dbscan`` and ``components`` do have one.
"""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.operators import cluster as C
from tessera.operators import evaluate as E
from tessera.operators import features as X
from tessera.operators import models as M
from tessera.operators.density import dbscan_nd
from tessera.operators.linkage import complete_linkage, merge_table
from tessera.operators.boosting import BoostedTrees
from tessera.operators.network import PerceptronNetwork
from tessera.operators.paths import linear_cv, logistic_paths
from tessera.operators.trees import BestFirstTree
from tessera.plans.inputs import passengers
from tessera.session import cut_lineage, spread, table

DOC_FEATURES = ["log_chars", "log_words", "digit_share", "upper_share", "line_share"]


def _docs(spark: SparkSession, d: str) -> DataFrame:
    """documents with quality labels -> numeric text features, language/source dummies, split flag."""
    lab = table(spark, d, "labels")
    # whole texts are processed; spread first so a single-split file is not one task
    docs = spread(table(spark, d, "documents").join(lab.select("doc_id"), "doc_id", "left_semi"))
    n = F.greatest(F.length("text"), F.lit(1))
    feats = docs.join(lab, "doc_id").select(
        "doc_id", "lang", "source", F.col("quality").cast("double").alias("label"),
        F.log1p(F.col("n_chars").cast("double")).alias("log_chars"),
        F.log1p(F.regexp_count("text", F.lit(r"\S+")).cast("double")).alias("log_words"),
        ((F.length("text") - F.length(F.translate("text", "0123456789", ""))) / n).alias("digit_share"),
        ((F.length("text") - F.length(F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", ""))) / n)
        .alias("upper_share"),
        ((F.length("text") - F.length(F.translate("text", "\n", ""))) / n).alias("line_share"))
    # text features are computed once; every later pass reads the small checkpointed table
    feats = cut_lineage(feats)
    return cut_lineage(X.stratified_split(feats, "doc_id", "label", 0.25, seed=42))


def _doc_table(spark: SparkSession, d: str):
    """Features with dummy columns, not scaled (pipelines scale inside each fold)."""
    f = _docs(spark, d)
    dm = X.DummyEncoder(["lang", "source"]).fit(f.where(~F.col("is_test")))
    cols = DOC_FEATURES + dm.output_columns()
    return dm.transform(f), cols


def _doc_matrix(spark: SparkSession, d: str):
    f, cols = _doc_table(spark, d)
    sm = X.Standardizer(cols).fit(f.where(~F.col("is_test")))
    full = VectorAssembler(inputCols=cols, outputCol="features").transform(sm.transform(f))
    return cut_lineage(spread(full.select("doc_id", "label", "is_test", "features", *cols))), cols


GRID_C = [0.01, 0.1, 1, 10, 100]
GRID = [(penalty, float(c)) for penalty in ("l1", "l2") for c in GRID_C]


def _logistic_search(spark: SparkSession, d: str):
    """All points of the grid with the scaler inside the folds; (paths, table, columns)."""
    f, cols = _doc_table(spark, d)
    full = cut_lineage(spread(f.select("doc_id", "label", "is_test", *cols)))
    train = X.kfold(full.where(~F.col("is_test")), 5, ["doc_id"], label="label")
    return logistic_paths(train, cols, "label", GRID, "fold", 5), full, cols


def _emb(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "embeddings")
    e = e.select("vec_id", F.col("label").cast("double").alias("label"),
                 array_to_vector(F.col("embedding").cast("array<double>")).alias("features"),
                 (F.col("label") >= 5).cast("double").alias("binary"))
    return cut_lineage(spread(X.hash_split(e, "vec_id", 0.25, seed=42)))


def logistic(spark: SparkSession, d: str) -> DataFrame:
    """Logistic regression (C=1, L2) on scaled document features."""
    full, _ = _doc_matrix(spark, d)
    train = full.where(~F.col("is_test"))
    model = M.logistic(C=1.0, n=train.count()).fit(train)
    out = M.predict_proba(model, full.where(F.col("is_test")))
    return out.select("doc_id", "label", F.col("prediction").cast("int").alias("prediction"), "p")


def logistic_grid(spark: SparkSession, d: str) -> DataFrame:
    """L1/L2 x five C values (intercept penalised), scored by 5-fold cross-validated AUC; the
    scaler is fitted inside the folds, ``is_best`` marks the point whose model the other queries use."""
    found, _, _ = _logistic_search(spark, d)
    scores = found.scores()
    best = found.points[max(range(len(scores)), key=lambda i: (scores[i] is not None, scores[i] or 0.0, -i))]
    rows = [(p, c, score, (best.penalty, best.C) == (p, c)) for (p, c), score in zip(GRID, scores)]
    return spark.createDataFrame(rows, "penalty string, C double, auc double, is_best boolean")


def coefficients(spark: SparkSession, d: str) -> DataFrame:
    """Top-15 coefficients of the tuned logistic model by magnitude."""
    found, _, cols = _logistic_search(spark, d)
    return M.coefficients(found.best(), cols, spark, top=15)


def _svm_search(spark: SparkSession, d: str, whole: bool):
    """RBF SVM over C x gamma (nine points), three folds; with ``whole`` also fitted on all training rows."""
    full, cols = _doc_matrix(spark, d)
    train = cut_lineage(X.kfold(full.where(~F.col("is_test")), 3, ["doc_id"], label="label"))
    n_fit = int(train.count() * 2 / 3)
    found = M.svm_search(train, len(cols), [M.reg_param(c, n_fit) for c in (0.1, 1, 10)],
                         [0.1 / len(cols), 1.0 / len(cols), 10.0 / len(cols)], "fold", 3, n_features=128, whole=whole)
    return found, n_fit, full


def svm_grid(spark: SparkSession, d: str) -> DataFrame:
    """RBF SVM grid over C and gamma, scored by cross-validated AUC."""
    found, n_fit, _ = _svm_search(spark, d, whole=False)
    rows = [(float(round(1.0 / (reg * n_fit), 6)), float(gamma), score) for (reg, gamma), score in zip(found.points, found.avgMetrics)]
    return spark.createDataFrame(rows, "C double, gamma double, auc double")


def svm_sweep(spark: SparkSession, d: str) -> DataFrame:
    """Threshold sweep over the Platt probabilities of the best RBF SVM of the grid."""
    found, _, full = _svm_search(spark, d, whole=True)
    return E.threshold_sweep(M.predict_proba(found.platt(), full.where(F.col("is_test"))), "label", "p")


def svm_rbf(spark: SparkSession, d: str) -> DataFrame:
    """M5: ten-class RBF SVM (random Fourier features + one-vs-rest LinearSVC)."""
    e = _emb(spark, d)
    train = e.where(~F.col("is_test"))
    pipe = M.svm_rbf(64, C=10.0, n=train.count(), gamma=0.001 * 64, n_features=256, multiclass=True)
    model = pipe.fit(train)
    return model.transform(e.where(F.col("is_test"))).select("vec_id", "label", "prediction")


def svm_poly(spark: SparkSession, d: str) -> DataFrame:
    """M6 M7: cubic-kernel SVM with Platt probabilities on document features."""
    full, cols = _doc_matrix(spark, d)
    train = cut_lineage(X.kfold(full.where(~F.col("is_test")), 3, ["doc_id"], label="label"))
    pipe = M.svm_poly(len(cols), C=1.0, n=train.count())
    model = M.PlattScaler(pipe, "fold", k=3).fit(train)
    out = model.transform(full.where(F.col("is_test")))
    return out.select("doc_id", "label", F.col("prediction").cast("int").alias("prediction"),
                      F.get(vector_to_array("probability"), 1).alias("p"))


def tree(spark: SparkSession, d: str) -> DataFrame:
    """M8 H1: entropy tree, depth <= 6 and at most 6 leaves (best-first)."""
    full, cols = _doc_matrix(spark, d)
    train = full.where(~F.col("is_test"))
    t = BestFirstTree(cols, "label", maxLeaves=6, maxDepth=6).fit(train)
    return t.transform(full).select("doc_id", "is_test", "label", "prediction")


def forest(spark: SparkSession, d: str) -> DataFrame:
    """M9: 200 trees, depth 7, 10 features per split, on embeddings (ten classes)."""
    e = _emb(spark, d)
    model = M.random_forest(200, 7, "10").fit(e.where(~F.col("is_test")))
    return model.transform(e.where(F.col("is_test"))).select("vec_id", "label", "prediction")


def gbt(spark: SparkSession, d: str) -> DataFrame:
    """Gradient boosting, 100 rounds, rate 1, depth 3 (binary embedding label)."""
    e = _emb(spark, d)
    model = M.gbt_classifier(100, 1.0, 3, labelCol="binary").fit(e.where(~F.col("is_test")))
    return model.transform(e.where(F.col("is_test"))).select("vec_id", "binary", "prediction")


def _emb_columns(spark: SparkSession, d: str) -> tuple[DataFrame, list[str]]:
    e = table(spark, d, "embeddings")
    cols = [f"e{i}" for i in range(64)]
    flat = e.select("vec_id", (F.col("label") >= 5).cast("int").alias("binary"),
                    *[F.get("embedding", i).cast("double").alias(c) for i, c in enumerate(cols)])
    return cut_lineage(spread(X.hash_split(flat, "vec_id", 0.25, seed=42))), cols


def boost(spark: SparkSession, d: str) -> DataFrame:
    """Second-order boosted classifier, up to 500 rounds at rate 0.1, depth 6, stopped after
    ten rounds without a lower validation loss."""
    e, cols = _emb_columns(spark, d)
    train = X.hash_split(e.where(~F.col("is_test")), "vec_id", 0.2, seed=5, flag="is_valid")
    model = BoostedTrees(cols, "binary", "logistic", numRounds=500, eta=0.1, maxDepth=6,
                         validationCol="is_valid", earlyStop=10).fit(train)
    return model.transform(e.where(F.col("is_test"))).select("vec_id", "binary", "prediction", "p")


def boost_reg(spark: SparkSession, d: str) -> DataFrame:
    """Second-order boosted regressor (up to 500 rounds at rate 0.15, depth 5, stopped after
    five rounds without a lower validation loss) for price on lineitem."""
    li = table(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_quantity", "l_discount", "l_tax",
        (F.col("l_extendedprice") / 1000).alias("y"))
    li = X.hash_split(li, "l_orderkey", 0.25, seed=42)
    train = X.hash_split(li.where(~F.col("is_test")), "l_orderkey", 0.2, seed=5, flag="is_valid")
    model = BoostedTrees(["l_quantity", "l_discount", "l_tax"], "y", "squared", numRounds=500, eta=0.15,
                         maxDepth=5, validationCol="is_valid", earlyStop=5).fit(train)
    return model.transform(li.where(F.col("is_test"))).select("l_orderkey", "l_linenumber", "y", "prediction")


def mlp(spark: SparkSession, d: str) -> DataFrame:
    """Perceptron network, two hidden layers of 100 rectifier units, weight penalty, L-BFGS, ten classes."""
    e = _emb(spark, d)
    model = PerceptronNetwork((100, 100), max_iter=200).fit(e.where(~F.col("is_test")))
    return model.transform(e.where(F.col("is_test"))).select("vec_id", "label", "prediction")


def cv_scores(spark: SparkSession, d: str) -> DataFrame:
    """5-fold accuracy of a 50-tree forest; per-fold rows plus mean and population std."""
    full, _ = _doc_matrix(spark, d)
    train = cut_lineage(X.kfold(full.where(~F.col("is_test")), 5, ["doc_id"], label="label"))
    scores = M.cv_scores(M.random_forest(50, 5, "auto"), train, "fold", 5)
    summ = scores.agg(F.lit(-1).alias("fold"), F.avg("score").alias("score"))
    spread = scores.agg(F.lit(-2).alias("fold"), F.stddev_pop("score").alias("score"))
    return scores.unionByName(summ).unionByName(spread)


FLOW_COLUMNS = ["value", "k", "hour"]


def _flow_table(spark: SparkSession, d: str) -> tuple[DataFrame, list[str]]:
    """Passenger rows through impute -> dummies -> scale, fitted on the labelled ones: (event_id, label or NULL,
    raw and scaled features), and the feature columns."""
    ev = passengers(spark, d).withColumns({
        "label": (F.col("event_type") == "purchase").cast("double"), "hour": F.hour("ts").cast("double"),
        "day": F.date_format("ts", "E")})
    labelled = F.col("label").isNotNull()
    imp = X.ImputeRules(group_median={"value": ["user_id"]}, median=["k"], mode=[]).fit(ev.where(labelled))
    base = imp.transform(ev).fillna(0.0, ["value", "k"])
    dm = X.DummyEncoder(["day"]).fit(base.where(labelled))
    cols = FLOW_COLUMNS + dm.output_columns()
    full = dm.transform(base).select("event_id", "label", *[F.col(c).cast("double").alias(c) for c in cols])
    sm = X.Standardizer(cols, suffix="_s").fit(full.where(F.col("label").isNotNull()))
    return cut_lineage(spread(sm.transform(full))), cols


def _flow_models(cols: list[str], n: int) -> dict:
    """The four models of the flow: the forest and the boosted trees on raw, the others on scaled features."""
    raw_va = VectorAssembler(inputCols=cols, outputCol="features")
    sc_va = VectorAssembler(inputCols=[f"{c}_s" for c in cols], outputCol="features")
    return {
        "RandomForest": Pipeline(stages=[raw_va, M.random_forest(100, 5, "auto")]),
        "SVC_poly": _FittedFolds(M.svm_poly(len(cols), C=1.0, n=n), sc_va),
        "Boosted": _Fitted(lambda df: BoostedTrees(cols, "label", "logistic", numRounds=30, eta=0.3, maxDepth=4).fit(df)),
        "MLP": _Fitted(lambda df: PerceptronNetwork((100,), max_iter=100).fit(df), sc_va),
    }


class _Fitted:
    """An own estimator, behind an optional assembling stage, in the shape of a pipeline."""

    def __init__(self, fit, before=None):
        self._fit, self._before = fit, before

    def fit(self, df: DataFrame) -> "_Fitted":
        out = _Fitted(self._fit, self._before)
        out._model = self._fit(self._prepared(df))
        return out

    def _prepared(self, df: DataFrame) -> DataFrame:
        return self._before.transform(df) if self._before else df

    def transform(self, df: DataFrame) -> DataFrame:
        return self._model.transform(self._prepared(df))


class _FittedFolds(_Fitted):
    """The same for an estimator that fits all folds in the same scans."""

    def __init__(self, estimator, before=None):
        super().__init__(estimator.fit, before)
        self._estimator = estimator

    def fit_folds(self, df: DataFrame, fold: str, k: int) -> list[_Fitted]:
        out = []
        for model in self._estimator.fit_folds(self._prepared(df), fold, k):
            out.append(_Fitted(self._fit, self._before))
            out[-1]._model = model
        return out


def cv_models(spark: SparkSession, d: str) -> DataFrame:
    """Five-fold accuracy of the four models of the flow on the labelled rows: a row per model and
    fold, then its mean (fold -1) and population standard deviation (fold -2)."""
    data, cols = _flow_table(spark, d)
    train = cut_lineage(X.kfold(data.where(F.col("label").isNotNull()), 5, ["event_id"], label="label"))
    out = None
    for name, model in _flow_models(cols, int(train.count() * 0.8)).items():
        scores = M.cv_scores(model, train, "fold", 5)
        both = scores.unionByName(scores.agg(F.lit(-1).alias("fold"), F.avg("score").alias("score"))) \
            .unionByName(scores.agg(F.lit(-2).alias("fold"), F.stddev_pop("score").alias("score")))
        both = both.select(F.lit(name).alias("model"), "fold", "score")
        out = both if out is None else out.unionByName(both)
    return out


def compare_models(spark: SparkSession, d: str) -> DataFrame:
    """Impute -> dummies -> scale -> four models fitted on the labelled rows; the tagged
    predictions of each for the rows without a label."""
    data, cols = _flow_table(spark, d)
    train, unlabelled = data.where(F.col("label").isNotNull()), data.where(F.col("label").isNull())
    return M.compare_models(_flow_models(cols, train.count()), train, unlabelled, "event_id")


def ols(spark: SparkSession, d: str) -> DataFrame:
    """M2: slope, intercept and R^2 of price on quantity per return flag."""
    li = table(spark, d, "lineitem")
    r = M.ols_columns(li, "l_quantity", "l_extendedprice", by=["l_returnflag"])
    return r.select("l_returnflag", F.round("slope", 4).alias("slope"), F.round("intercept", 4).alias("intercept"),
                    F.round("r2", 6).alias("r2"))


def gd_steps(spark: SparkSession, d: str) -> DataFrame:
    """M1: first five gradient-descent iterates (alpha 0.1) from one statistics scan."""
    li = table(spark, d, "lineitem").select((F.col("l_quantity") / 50).alias("x"),
                                            (F.col("l_extendedprice") / 100000).alias("y"))
    path = M.gd_path(li, ["x"], "y", alpha=0.1, steps=5)
    rows = [(it, round(b, 8), round(w, 8), round(j, 8)) for it, b, w, j in path]
    return spark.createDataFrame(rows, "iteration int, b double, w double, J double")


def cost_history(spark: SparkSession, d: str) -> DataFrame:
    """Full descent with the lagging stop test; (iteration, J) history."""
    li = table(spark, d, "lineitem").select((F.col("l_quantity") / 50).alias("x"),
                                            (F.col("l_discount") * 10).alias("d"),
                                            (F.col("l_extendedprice") / 100000).alias("y"))
    model = M.LinearRegressionGD(["x", "d"], "y", alpha=0.5, eps=1e-10, max_iter=10000).fit(li)
    return model.history_frame(spark).select("iteration", F.round("J", 10).alias("J"))


def kmeans(spark: SparkSession, d: str) -> DataFrame:
    """K-means (k=10) on embeddings; cluster per vector."""
    e = _emb(spark, d)
    model = C.kmeans(e, 10, seed=0)
    return model.transform(e).select("vec_id", F.col("prediction").alias("cluster"))


def elbow(spark: SparkSession, d: str) -> DataFrame:
    """Inertia for k = 1..10 on embeddings."""
    return C.elbow(_emb(spark, d), range(1, 11))


def _points(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "customer")
    return c.select("c_custkey", (F.col("c_acctbal") / 1000).alias("x"), (F.col("c_nationkey") * 0.4).alias("y"))


def dbscan(spark: SparkSession, d: str) -> DataFrame:
    """Density clusters (eps 0.75, 20 samples) of customers on two scaled columns."""
    return C.dbscan(_points(spark, d), "c_custkey", ["x", "y"], 0.75, 20)


def dbscan_vectors(spark: SparkSession, d: str) -> DataFrame:
    """Density clusters (eps 1.15, 3 samples) of the 64-dimensional embeddings."""
    return dbscan_nd(table(spark, d, "embeddings"), "vec_id", F.col("embedding"), 1.15, 3)


def _suppliers(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "supplier").select("s_suppkey", (F.col("s_acctbal") / 1000).alias("x"),
                                              (F.col("s_nationkey") * 0.4).alias("y"))


def single_link(spark: SparkSession, d: str) -> DataFrame:
    """Single-linkage clusters (k = 5) of suppliers on two scaled columns."""
    return C.single_linkage(_suppliers(spark, d), "s_suppkey", ["x", "y"], 5) \
        .withColumn("height", F.round("height", 9))


def single_link_merges(spark: SparkSession, d: str) -> DataFrame:
    """The merges (a, b, height) of single linkage over all suppliers."""
    return merge_table(_suppliers(spark, d), "s_suppkey", ["x", "y"]).select("a", "b", F.round("height", 9).alias("height"))


def complete_link(spark: SparkSession, d: str) -> DataFrame:
    """Complete-linkage clusters (k = 5) of suppliers on two scaled columns."""
    return complete_linkage(_suppliers(spark, d), "s_suppkey", ["x", "y"], 5).withColumn("height", F.round("height", 9))


def components(spark: SparkSession, d: str) -> DataFrame:
    """G1: connected components of parts linked by consecutive lines of an order."""
    li = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    nxt = li.select("l_orderkey", (F.col("l_linenumber") - 1).alias("l_linenumber"),
                    F.col("l_partkey").alias("dst"))
    edges = li.join(nxt, ["l_orderkey", "l_linenumber"]).select(F.col("l_partkey").alias("src"), "dst")
    return C.components(edges).select(F.col("node").alias("part"), "component")


def model_metrics(spark: SparkSession, d: str) -> DataFrame:
    """Metrics table (accuracy, precision, recall, F1, AUC) of
    logistic regression and an RBF SVM with Platt probabilities on the same test rows."""
    full, cols = _doc_matrix(spark, d)
    train = cut_lineage(X.kfold(full.where(~F.col("is_test")), 3, ["doc_id"], label="label"))
    test = full.where(F.col("is_test"))
    n = train.count()
    search, table_, _ = _logistic_search(spark, d)
    svm = M.PlattScaler(M.svm_rbf(len(cols), C=1.0, n=n, gamma=1.0 / len(cols), n_features=128), "fold",
                        k=3).fit(train)
    results = {}
    scored = {"logistic": search.best().transform(table_.where(F.col("is_test"))), "svm_rbf": M.predict_proba(svm, test)}
    for name, rows in scored.items():
        results[name] = E.classification_metrics(rows.select("label", "prediction", "p"), "label", "prediction", "p")
    return E.metrics_table(results, wide=True)


def model_sweep(spark: SparkSession, d: str) -> DataFrame:
    """Threshold sweep (0.10 ... 0.90) over the tuned logistic model's test probabilities."""
    found, full, _ = _logistic_search(spark, d)
    return E.threshold_sweep(found.best().transform(full.where(F.col("is_test"))), "label", "p")


def cv_linear(spark: SparkSession, d: str) -> DataFrame:
    """Held-out R^2 of price on quantity in five folds by order; one aggregate."""
    li = table(spark, d, "lineitem").withColumn("fold", F.col("l_orderkey") % 5)
    return linear_cv(li, ["l_quantity"], "l_extendedprice", "fold").select("fold", "n", F.round("r2", 6).alias("r2"))


QUERIES = {
    "model_metrics": model_metrics, "model_sweep": model_sweep,
    "logistic": logistic, "logistic_grid": logistic_grid, "coefficients": coefficients, "svm_rbf": svm_rbf,
    "svm_grid": svm_grid, "svm_sweep": svm_sweep,
    "svm_poly": svm_poly, "tree": tree, "forest": forest, "gbt": gbt, "boost": boost, "boost_reg": boost_reg,
    "mlp": mlp, "cv_scores": cv_scores, "cv_models": cv_models, "compare_models": compare_models, "ols": ols, "gd_steps": gd_steps,
    "cost_history": cost_history, "cv_linear": cv_linear, "kmeans": kmeans, "elbow": elbow, "dbscan": dbscan, "dbscan_vectors": dbscan_vectors, "single_link": single_link,
    "single_link_merges": single_link_merges, "complete_link": complete_link, "components": components,
}
