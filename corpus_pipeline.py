"""The corpus pipeline: documents go through the stages in order, each stage's rows are
written as Parquet and read again as the next one's ``docs``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tessera.llm import stages
from tessera.llm.shared import prepare, table, written

STAGES = [
    ("toxicity", stages.toxicity),
    ("exact_dedup", stages.exact_dedup),
    ("near_dedup", stages.near_dedup),
    ("decontamination", stages.decontamination),
    ("packing", stages.packing),
]

# Trained scores, MinHash and tokenizers have no SQL form: tests/llm checks the stages
# against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; returns the last stage's rows."""
    prepare(spark)
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
