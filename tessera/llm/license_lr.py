"""Licence scan: a trained paragraph classifier confirmed by template comparison.

Paragraphs are the lines of a text that hold a letter.  Sparse logistic regressions over
hashed word uni-, bi- and trigrams give each paragraph a licence family or ``unknown``: a binary one tells
licences from all other paragraphs, a multinomial one the families apart; their product is the
probability of a family.  They are trained here: examples of the families are variants of their short templates (whole, and each
run of the template's words that is long enough) and the paragraphs of the whole corpus
that hold no template; these are ``unknown``, those of three documents in ten held out.
The unknown class is calibrated on the held-out paragraphs: a family needs a
probability that at most ``FALSE`` of them reach.

A prediction stands when the template confirms it: at least ``CONFIRM`` of the template's
distinct word bigrams are in the paragraph.  Everything is DataFrame expressions and
spark.ml; the paragraph table is never joined with itself or gathered, findings are
grouped by document after they have become few.  The grams and covers of a paragraph are worked out once and
written; only paragraphs that cover a template are scored.

Defined cases: null or empty text -> no finding; a paragraph of any length is scored
whole; repeated rows give repeated findings per doc_id; no held-out paragraphs for a
calibration -> the threshold is 0.5; empty table -> empty result; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.shared import cut_lineage, scratch

UNKNOWN = "unknown"
DIMS = 1 << 13
ITERATIONS = 30
FALSE = 1e-3
CONFIRM = 0.8
# writer version 2 stores numbers without a dictionary as differences
STORED = {"compression": "zstd", "parquet.writer.version": "PARQUET_2_0", "parquet.enable.dictionary#features.indices.list.element": "false"}
SHORTEST = 4  # words of a template run used as a training example

# Own short wordings by which each family is named in a file.
TEMPLATES = {
    "apache-2.0": ["licensed under the apache license version 2 0", "apache license version 2 0 january 2004"],
    "mit": ["released under the mit license", "licensed under the mit license",
            "permission is hereby granted free of charge to any person obtaining a copy of this software"],
    "bsd": ["licensed under the bsd license", "released under the 3 clause bsd license",
            "redistribution and use in source and binary forms with or without modification are permitted"],
    "gpl": ["this work is licensed under the gnu general public license version 3",
            "licensed under the gnu general public license version 2",
            "you can redistribute it and or modify it under the terms of the gnu general public license"],
    "lgpl": ["licensed under the gnu lesser general public license",
             "under the terms of the gnu lesser general public license"],
    "mpl-2.0": ["subject to the terms of the mozilla public license v 2 0", "licensed under the mozilla public license 2 0"],
    "cc-by-nc": ["licensed under cc by nc 4 0", "creative commons attribution noncommercial 4 0 international license"],
    "cc-by-sa": ["licensed under cc by sa 4 0", "creative commons attribution sharealike 4 0 international license"],
    "cc-by": ["licensed under cc by 4 0", "creative commons attribution 4 0 international license"],
    "cc0": ["dedicated to the public domain under cc0 1 0", "cc0 1 0 universal public domain dedication"],
    "proprietary": ["copyright all rights reserved", "all rights reserved do not distribute without permission"],
}
FAMILIES = [UNKNOWN, *TEMPLATES]


def tokens(paragraph: Column) -> Column:
    """Lower-case words: runs of ASCII letters and digits and of other letters."""
    return F.filter(F.split(F.lower(paragraph), r"[^\p{L}\p{N}]+"), lambda w: w != "")


def _once(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with the value worked out once a row, however often the body names it."""
    return F.get(F.transform(F.array(value), body), 0)


def grams(rows: DataFrame) -> DataFrame:
    """``grams``: words, pairs and triples of neighbours of column ``words``, which it takes the place of; ``hashed`` tells them by hashes."""
    w = F.col("words")
    pairs = F.transform(F.slice(w, 2, F.size(w)), lambda x, i: F.concat_ws(" ", F.get(w, i), x))
    triples = F.transform(F.slice(w, 3, F.size(w)), lambda x, i: F.concat_ws(" ", F.get(w, i), F.get(w, i + 1), x))
    return rows.withColumn("grams", F.concat(w, pairs, triples)).drop("words")


def hashed(rows: DataFrame, name: str) -> DataFrame:
    """The words, pairs and triples of column ``words`` as a sparse 0/1 vector ``features``, which takes its place: a gram
    lies at its XXH64 modulo ``DIMS`` (of a pair: of one word after the other; of a triple: of the pair's hash and the third word).

    The rows are written once and read as vectors, so that no later pass makes the grams again.  Ascending places
    are stored as differences, about 12 bits each.
    """
    w = F.col("words")
    rows = rows.withColumn("one", F.transform(w, lambda a: F.xxhash64(a)))
    # the last word has none after it: its pair is hashed as the word alone, which is there already
    rows = rows.withColumn("two", F.zip_with(w, F.slice(w, 2, F.size(w)), lambda a, b: F.xxhash64(a, b)))
    three = F.zip_with(F.slice("two", 1, F.greatest(F.size(w) - 2, F.lit(0))), F.slice(w, 3, F.size(w)), lambda a, b: F.xxhash64(a, b))
    at = F.transform(F.concat("one", "two", three), lambda h: F.pmod(h, F.lit(DIMS)).cast("int"))
    rows = rows.withColumn("at", F.array_distinct(F.sort_array(at))).drop("words", "one", "two")
    # the fields of spark.ml's sparse vector
    rows = rows.withColumn("features", F.struct(
        F.lit(0).cast("byte").alias("type"), F.lit(DIMS).alias("size"), F.col("at").alias("indices"),
        F.array_repeat(F.lit(1.0), F.size("at")).alias("values"))).drop("at")
    path = scratch(rows.sparkSession, name)
    rows.write.options(**STORED).parquet(path)
    fields = [T.StructField(f.name, VectorUDT() if f.name == "features" else f.dataType) for f in rows.schema]
    return rows.sparkSession.read.schema(T.StructType(fields)).parquet(path)


def _neighbours(words: Column) -> Column:
    """Each word with the one after it; the last word alone."""
    return F.zip_with(words, F.slice(words, 2, F.size(words)), lambda a, b: F.concat_ws(" ", a, b))


def _pairs(words: list[str]) -> list[str]:
    return sorted({" ".join(p) for p in zip(words, words[1:], strict=False)})


def paragraphs(docs: DataFrame) -> DataFrame:
    """doc_id, line (from 0), paragraph: the lines that hold a letter."""
    return docs.where(F.col("text").isNotNull()).select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.posexplode(F.split(F.col("text").cast("string"), "\n")).alias("line", "paragraph")) \
        .where(F.col("paragraph").rlike(r"\p{L}"))


def needed_words(share: float = CONFIRM) -> list[str]:
    """A paragraph that covers ``share`` of a template holds at least one of these words: it may
    lack a share of 1 - ``share`` of the template's pairs, so of one pair more than that it has
    at least one, and with it that pair's longest word."""
    out = set()
    for texts in TEMPLATES.values():
        for t in texts:
            pairs = sorted(_pairs(t.split()), key=lambda p: (-max(map(len, p.split())), p))
            spare = int((1 - share) * len(pairs) + 1e-9)
            out |= {max(p.split(), key=len) for p in pairs[:spare + 1]}
    return sorted(out)


def known_pairs(pairs: Column) -> Column:
    """Those of the pairs that are in a template: a paragraph's few of them stand for all in ``cover``."""
    every = sorted({p for texts in TEMPLATES.values() for t in texts for p in _pairs(t.split())})
    return F.array_intersect(F.array(*[F.lit(p) for p in every]), pairs)


def cover(pairs: Column) -> dict[str, Column]:
    """family -> largest share of a template's word pairs found in the paragraph."""
    out = {}
    for name, texts in TEMPLATES.items():
        each = []
        for t in texts:
            want = _pairs(t.split())
            each.append(F.size(F.array_intersect(F.array(*[F.lit(p) for p in want]), pairs)) / F.lit(float(len(want))))
        out[name] = F.greatest(*each) if len(each) > 1 else each[0]
    return out


class Classifier:
    """P(family) = P(licence) P(family | licence): two logistic regressions, the second over the families only."""

    def __init__(self, licence: LogisticRegressionModel, family: LogisticRegressionModel):
        self.licence, self.family = licence, family

    def probability(self, rows: DataFrame) -> DataFrame:
        """Adds ``p``: the probability that column ``features`` is of a licence."""
        return _scores(self.licence, rows, "both").withColumn("p", F.get("both", 1)).drop("both")

    def probabilities(self, rows: DataFrame) -> DataFrame:
        """Adds ``p`` and ``each``: the probability of every family, ``unknown`` first."""
        scored = _scores(self.family, self.probability(rows), "given")
        return scored.withColumn("each", F.concat(F.array(1 - F.col("p")), *[F.array(F.get("given", k) * F.col("p"))
                                                                              for k in range(len(TEMPLATES))])).drop("given")


def _scores(model: LogisticRegressionModel, rows: DataFrame, out: str) -> DataFrame:
    scored = model.copy({model.probabilityCol: "v", model.predictionCol: "", model.rawPredictionCol: ""}).transform(rows)
    return scored.withColumn(out, vector_to_array("v")).drop("v")


def paragraph_words(docs: DataFrame) -> DataFrame:
    """doc_id, line, fit (not held out), words, covers (of every family; null: all less than a half) of every paragraph."""
    need = F.array(*[F.lit(w) for w in needed_words(0.5)])
    w = F.col("words")
    rows = paragraphs(docs).select("doc_id", "line", (F.pmod(F.xxhash64("doc_id", F.lit(8)), F.lit(10)) < 7).alias("fit"),
                                   tokens(F.col("paragraph")).alias("words"))
    # half of a template is covered only where one of a few words is found: other paragraphs are not compared
    return rows.withColumn("covers", F.when(F.arrays_overlap(w, need), _once(known_pairs(_neighbours(w)), lambda p: F.array(*cover(p).values()))))


def train(docs: DataFrame) -> tuple[Classifier, float]:
    """(classifier, probability a family needs), from the paragraphs of all documents."""
    return _fit(paragraph_words(docs))[:2]


def _fit(rows: DataFrame) -> tuple[Classifier, float, DataFrame]:
    """As ``train``, and the rows with their features."""
    unknown = F.coalesce(F.array_max("covers"), F.lit(0.0)) < 0.5
    table = hashed(rows.where("fit"), "paragraphs")
    plain = table.where(unknown)
    known = []
    for k, name in enumerate(FAMILIES[1:]):
        for t in TEMPLATES[name]:
            w = t.split()
            for n in range(SHORTEST, len(w) + 1):
                runs = {tuple(w[a:a + n]) for a in range(len(w) - n + 1)}
                known += [(list(r), float(k)) for r in sorted(runs) if 2 * len(r) > len(w)]
    own = hashed(table.sparkSession.createDataFrame(known, "words array<string>, label double"), "templates")
    n_plain = plain.count()
    weight = max(1.0, n_plain / max(len(known), 1))
    data = plain.select("features", F.lit(0.0).alias("label"), F.lit(1.0).alias("weight")) \
        .union(own.select("features", F.lit(1.0).alias("label"), F.lit(weight).alias("weight")))
    # unknown paragraphs tell nothing of the families apart, so that part learns from the examples alone
    model = Classifier(LogisticRegression(family="binomial", weightCol="weight", regParam=1e-4, maxIter=ITERATIONS).fit(data),
                       LogisticRegression(family="multinomial", regParam=1e-4, maxIter=ITERATIONS).fit(own))
    # written only now, when the fit has given up its packed rows
    held = hashed(rows.where("not fit"), "held_out")
    n, at = model.probability(held.where(unknown)).agg(F.count(F.lit(1)), F.percentile_approx("p", 1 - FALSE, 10_000)).first()
    return model, max(0.5, at if n else 0.5), table.union(held)


def scan(docs: DataFrame) -> DataFrame:
    """doc_id, line, family, probability, cover of every confirmed licence paragraph."""
    model, need, table = _fit(paragraph_words(docs))
    # the template's confirmation is part of the result, so this filter changes none
    rows = model.probabilities(table.where(F.array_max("covers") >= CONFIRM)).drop("features", "fit")
    # cut: else the planner repeats the models in every condition below
    scored = cut_lineage(rows).withColumn("k", F.array_position("each", F.array_max("each")).cast("int") - 1)
    hit = scored.where((F.col("k") > 0) & (F.col("p") >= need))
    names = F.array(*[F.lit(f) for f in FAMILIES])
    return hit.withColumn("cover", F.get("covers", F.col("k") - 1)).where(F.col("cover") >= CONFIRM).select(
        "doc_id", "line", F.get(names, F.col("k")).alias("family"), F.get("each", F.col("k")).alias("probability"), "cover")


def licences(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, families (sorted, distinct), n_paragraphs, first_line."""
    found = scan(docs).groupBy(F.col("doc_id").alias("f_id")).agg(
        F.sort_array(F.collect_set("family")).alias("families"), F.count(F.lit(1)).alias("n"), F.min("line").alias("first_line"))
    none = F.array().cast("array<string>")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id")) \
        .join(found, F.col("doc_id") == F.col("f_id"), "left").select(
        "doc_id", F.coalesce("families", none).alias("families"), F.coalesce("n", F.lit(0)).cast("long").alias("n_paragraphs"),
        "first_line")
