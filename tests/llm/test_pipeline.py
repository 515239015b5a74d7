import pytest

import corpus_pipeline
from tessera.llm import decontam_template, exact_dedup, lsh_forest, toxic_pu
from tessera.llm.shared import prepare

DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def steps(spark):
    """Every stage's result, each written and read again."""
    prepare(spark)
    out = [spark.read.parquet(f"{DIR}/documents.parquet")]
    for name, stage in corpus_pipeline.STAGES:
        out.append(corpus_pipeline.written(stage(spark, out[-1], DIR), name))
    return out


def ids(df):
    return sorted(r.doc_id for r in df.select("doc_id").collect())


def test_order_of_stages():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "exact_dedup", "near_dedup", "decontamination", "packing"]


def test_all_but_the_last_return_documents(steps):
    for df in steps[1:-1]:
        assert df.columns == steps[0].columns


def test_decisions_take_effect(spark, steps):
    docs, kept_clean, kept_exact, kept_near, kept_bench, packed = steps
    scores = toxic_pu.score_documents(docs, spark.read.parquet(f"{DIR}/labels.parquet")).collect()
    assert ids(kept_clean) == sorted(r.doc_id for r in scores if not r.predicted)
    assert ids(kept_exact) == sorted(r.doc_id for r in exact_dedup.exact_groups(kept_clean).collect() if r.kept)
    assert ids(kept_near) == sorted(r.doc_id for r in lsh_forest.near_groups(kept_exact, 80).collect() if r.kept)
    flags = decontam_template.flagged(kept_near, spark.read.parquet(f"{DIR}/benchmark.parquet")).collect()
    assert ids(kept_bench) == sorted(r.doc_id for r in flags if not r.flagged)
    assert {r.doc_id for r in packed.collect()} == set(ids(kept_bench))


def test_run_gives_the_last_stage(spark, steps):
    got = sorted((r.doc_id, r.piece, r.length, r.ids_crc32) for r in corpus_pipeline.run(spark, DIR).collect())
    assert got == sorted((r.doc_id, r.piece, r.length, r.ids_crc32) for r in steps[-1].collect())


def test_near_stage_takes_pairs_above_080(spark):
    words = [f"w{i}" for i in range(100)]
    near = [w if i not in (30, 70) else "x" + w for i, w in enumerate(words)]      # 86 of 106 shingles: 0.81
    far = [w if i not in (20, 50, 80) else "y" + w for i, w in enumerate(words)]   # 81 of 111: 0.73
    rows = [(i, " ".join(t), "en", "s", 1) for i, t in ((4, words), (6, near), (8, far))]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    assert ids(dict(corpus_pipeline.STAGES)["near_dedup"](spark, docs, DIR)) == [4, 8]
