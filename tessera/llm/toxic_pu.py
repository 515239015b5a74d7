"""Toxicity scores by non-negative positive-unlabelled learning.

Confirmed toxic documents (label 1) are the positives; the unlabelled set is a hash
sample of all training documents, whatever their label.  With the class prior p (the
toxic share among labelled training rows) the risk of a linear classifier is

    p E_P[l(z)] + max(0, E_U[l(-z)] - p E_P[l(-z)]),   l(z) = log(1 + exp(-z)),

where the second term, the risk on negatives seen through the unlabelled set, is kept
non-negative: in a step where it falls below zero only it is pushed back up.  ``MODELS``
classifiers with different seeds are trained in numpy, one Spark task each, on the same
bounded sample (``POSITIVE`` and ``UNLABELLED`` documents, documented bounds), each
leaving out a part on which its threshold is set by the prior-corrected 0-1 risk; their
margins are averaged.

A document's features are the hashed words (runs of ASCII letters and of bytes above
127, A-Z lower-cased) and their beginnings of four and six bytes, each counted once.

Defined cases: null or empty text -> no feature, the score is that of the intercept; no
positive labels -> every score is the prior (0 without labels); labels without a document
and null labels are not used; repeated rows are scored one by one; extra columns are
carried by ``with_score``, which keeps all columns of its input.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.bytesops import LOWER, doc_ranges, flat, runs, span_hashes
from tessera.llm.lang_zstd import fold

BITS = 18
POSITIVE = 3000
UNLABELLED = 9000
MODELS = 3
EPOCHS = 40
BATCH = 400
RATE = 0.05
DECAY = 1e-5
CLEAN = 3.0  # weight of a rejected clean document in choosing the threshold
ZMIN = 6.0  # standard errors by which a feature's share in the positives must exceed that in the unlabelled

_LETTER = np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123), *range(128, 256)]] = True


def features(buf: np.ndarray, off: np.ndarray) -> Iterator[np.ndarray]:
    """Sorted distinct feature numbers (uint32, below 2 ** BITS) of each document."""
    for i, j in doc_ranges(off):
        low, o = LOWER[buf[off[i]:off[j]]], off[i:j + 1] - off[i]
        start, end = runs(_LETTER[low], o)
        parts = [span_hashes(low, start, end)]
        for k in (4, 6):
            h = span_hashes(low, start, np.minimum(end, start + k)) + np.uint64(k)
            parts.append(np.where(end - start >= k, h, parts[0]))
        h = (np.stack(parts, axis=1) >> np.uint64(64 - BITS)).astype(np.uint32)
        first = np.searchsorted(start, o)
        for d in range(j - i):
            x = np.sort(h[first[d]:first[d + 1]], axis=None)
            yield x[np.append(True, x[1:] != x[:-1])] if len(x) else x


def _margin(w: np.ndarray, idx: np.ndarray, n: np.ndarray) -> np.ndarray:
    total = np.concatenate(([0.0], np.cumsum(w[idx], dtype=np.float64)))
    end = np.cumsum(n)
    return total[end] - total[end - n]


def fit(pos: list[np.ndarray], unl: list[np.ndarray], prior: float, seed: int) -> tuple[np.ndarray, float]:
    """Weights and intercept by Adam on the non-negative risk."""
    rng = np.random.default_rng(seed)
    dims = 1 << BITS
    df = np.bincount(np.concatenate([*pos, *unl]), minlength=dims)
    in_pos = np.bincount(np.concatenate(pos), minlength=dims)
    share = (df + 1) / (len(pos) + len(unl) + 2)
    keep = (in_pos >= 3) & (in_pos / len(pos) - (df - in_pos) / len(unl) > ZMIN * np.sqrt(
        share * (1 - share) * (1 / len(pos) + 1 / len(unl))))
    scale = np.where(keep, np.sqrt(np.log1p((len(pos) + len(unl)) / np.maximum(df, 1))), 0.0)
    slot = np.full(dims, -1, np.int64)
    slot[keep] = np.arange(keep.sum())
    scale = scale[keep]
    pos, unl = ([slot[x][slot[x] >= 0] for x in rows] for rows in (pos, unl))
    w, m, v = (np.zeros(len(scale) + 1) for _ in range(3))  # the last entry is the intercept
    w[-1] = -2.0
    step = 0
    for epoch in range(EPOCHS):
        order = rng.permutation(len(unl))
        for a in range(0, len(order), BATCH):
            some = [unl[i] for i in order[a:a + BATCH]]
            known = [pos[i] for i in rng.integers(0, len(pos), max(BATCH // 3, 1))]
            rows = known + some
            n = np.array([len(r) for r in rows])
            idx = np.concatenate(rows)
            z = _margin(w[:-1] * scale, idx, n) + w[-1]
            p = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
            k, u = len(known), len(some)
            risk = np.logaddexp(0, z[k:]).mean() - prior * np.logaddexp(0, z[:k]).mean()
            g = np.empty(len(rows))
            if risk >= 0:
                g[:k] = prior * (p[:k] - 1) / k - prior * p[:k] / k
                g[k:] = p[k:] / u
            else:  # only the negative part, upwards
                g[:k] = prior * p[:k] / k
                g[k:] = -p[k:] / u
            grad = np.append(np.bincount(idx, np.repeat(g, n), minlength=len(scale)) * scale, g.sum())
            grad[:-1] += DECAY * w[:-1]
            step += 1
            m = 0.9 * m + 0.1 * grad
            v = 0.999 * v + 0.001 * grad * grad
            rate = RATE * (1 - epoch / EPOCHS)
            w -= rate * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-9)
    out = np.zeros(dims, np.float32)
    out[keep] = w[:-1] * scale
    return out, float(w[-1])


def threshold(z_pos: np.ndarray, z_unl: np.ndarray, prior: float) -> float:
    """The margin that minimises the prior-corrected 0-1 risk on rows held out of the fit;
    excess in the unlabelled rows (rejected clean ones) counts ``CLEAN`` times."""
    cuts = np.unique(np.concatenate([z_pos, [0.0]]))
    miss = np.searchsorted(np.sort(z_pos), cuts) / len(z_pos)
    share = 1 - np.searchsorted(np.sort(z_unl), cuts) / len(z_unl)
    risk = prior * miss + CLEAN * np.maximum(0, share - prior * (1 - miss))
    best = np.flatnonzero(risk == risk.min())
    return float(cuts[best[len(best) // 2]])


def fit_held_out(pos: list[np.ndarray], unl: list[np.ndarray], prior: float, seed: int, of: int) -> tuple[np.ndarray, float]:
    """Weights from all but one part in ``of``, intercept set on that part so that 0 is its threshold."""
    part = lambda rows, own: [r for i, r in enumerate(rows) if (i % of == seed % of) == own]
    if of < 2 or len(pos) < 2 * of or len(unl) < 2 * of:
        return fit(pos, unl, prior, seed)
    w, b = fit(part(pos, False), part(unl, False), prior, seed)
    margin = lambda rows: np.array([w[r].sum(dtype=np.float64) for r in rows]) + b
    return w, b - threshold(margin(part(pos, True)), margin(part(unl, True)), prior)


def train(docs: DataFrame, labels: DataFrame, trained: Column, positive: int = POSITIVE,
          unlabelled: int = UNLABELLED, models: int = MODELS) -> tuple[np.ndarray | None, float]:
    """(weights, intercept); (None, prior) without positives.  ``trained`` is a condition on doc_id."""
    known = labels.where(trained & F.col("toxic").isNotNull()) \
        .select(F.col("doc_id").cast("long").alias("l_id"), F.col("toxic").cast("int").alias("toxic"))
    n, n_pos = known.agg(F.count(F.lit(1)), F.count(F.when(F.col("toxic") == 1, 1))).first()
    if not n_pos:
        return None, 0.0
    prior = n_pos / n
    total = docs.where(trained).count()

    def draw(c: Column, seed: int, want: int, of: int) -> Column:
        return F.pmod(F.xxhash64(c, F.lit(seed)), F.lit(1 << 30)) < int((1 << 30) * min(1.0, want / max(of, 1)))

    # both sides of the sample are bounded by their parameters
    ids = known.where((F.col("toxic") == 1) & draw(F.col("l_id"), 41, positive, n_pos)).select("l_id").distinct()
    rows = docs.where(trained).select(F.col("doc_id").cast("long").alias("doc_id"),
                                      F.col("text").cast("string").alias("text"))
    sample = rows.join(F.broadcast(ids), F.col("doc_id") == F.col("l_id"), "left") \
        .select("doc_id", F.col("l_id").isNotNull().alias("is_pos"),
                draw(F.col("doc_id"), 42, unlabelled, total).alias("is_unl"), "text") \
        .where(F.col("is_pos") | F.col("is_unl"))

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = [f.astype("<u4").tobytes() for f in features(*flat(batch.column(3)))]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(x, pa.binary())],
                                             ["doc_id", "is_pos", "is_unl", "x"])

    def one(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("doc_id", kind="stable")
        x = [np.frombuffer(b, "<u4") for b in group["x"]]
        pos = [r for r, y in zip(x, group["is_pos"], strict=True) if y]
        unl = [r for r, y in zip(x, group["is_unl"], strict=True) if y] or pos
        if not pos:
            return pd.DataFrame({"w": [b""], "b": [0.0]})
        w, b = fit_held_out(pos, unl, prior, int(group["model"].iloc[0]), models)
        return pd.DataFrame({"w": [w.astype("<f4").tobytes()], "b": [b]})

    fitted = sample.mapInArrow(extract, "doc_id long, is_pos boolean, is_unl boolean, x binary") \
        .withColumn("model", F.explode(F.sequence(F.lit(0), F.lit(models - 1)))) \
        .groupBy("model").applyInPandas(one, "w binary, b double").where(F.length("w") > 0).collect()
    if not fitted:
        return None, prior
    return (np.mean([np.frombuffer(r.w, "<f4") for r in fitted], axis=0).astype(np.float32),
            float(np.mean([r.b for r in fitted])))


def with_score(docs: DataFrame, model: tuple[np.ndarray | None, float], out: str = "score") -> DataFrame:
    """All rows and columns of ``docs`` and the score of ``text`` as column ``out``."""
    w, b = model
    if w is None:
        return docs.withColumn(out, F.lit(float(b)))
    shared = docs.sparkSession.sparkContext.broadcast(w)  # 4 * 2 ** BITS bytes
    at = docs.columns.index("text")

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weight = shared.value
        for batch in batches:
            col = batch.column(at)
            z = np.array([weight[x].sum(dtype=np.float64) for x in features(*flat(col.cast(pa.string())))]) + b
            s = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(s, pa.float64())], names)

    schema = T.StructType([*docs.schema.fields, T.StructField(out, T.DoubleType())])
    names = schema.fieldNames()
    return docs.mapInArrow(score, schema)


def trained_rows() -> Column:
    return fold(F.col("doc_id"), 5) != 0


def score_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted of every document."""
    model = train(docs, labels, trained_rows())
    rows = with_score(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")),
                      model)
    return rows.select("doc_id", (~trained_rows()).alias("held_out"), "score",
                       F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"))


def drop_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that are not rejected, with all their columns."""
    model = train(docs, labels, trained_rows())
    name = "score_" + "_".join(docs.columns)
    return with_score(docs, model, name).where(F.col(name) < 0.5).drop(name)
