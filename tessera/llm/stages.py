"""The pipeline's stages: (spark, docs, sf_dir) -> DataFrame.  Each applies one operator
to all rows it gets, and all but the last return the columns of ``documents``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tessera.llm.shared import table

NEAR_PERCENT = 80  # the pipeline's bound on word shingles; op7's own query takes 85 by its contract


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 4: documents scored as toxic go."""
    from tessera.llm.toxic_pu import drop_toxic

    return drop_toxic(docs, table(spark, sf_dir, "labels"))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 8: of equal texts one document stays."""
    from tessera.llm.exact_dedup import drop_exact_copies

    return drop_exact_copies(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 7: of each component of near copies (similarity of 0.8 or more) the smallest doc_id stays."""
    from tessera.llm.lsh_forest import drop_near_copies

    return drop_near_copies(docs, percent=NEAR_PERCENT)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 5: documents that hold a benchmark item go."""
    from tessera.llm.decontam_template import drop_leaks

    return drop_leaks(docs, table(spark, sf_dir, "benchmark"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 9: the place of every piece of every document in training sequences."""
    from tessera.llm.packing import pack_documents

    return pack_documents(docs)
