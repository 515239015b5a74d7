import pytest

from tessera.llm import decontam_template, exact_dedup, lsh_forest

WORDS = [f"w{i}" for i in range(120)]
BASE, EDIT = " ".join(WORDS), " ".join([*WORDS[:-2], "other", "end"])
OTHER = " ".join(f"v{i}" for i in range(90))


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string").repartition(3)


def left(df):
    return sorted(((r.doc_id, r.text) for r in df.collect()), key=lambda r: (r[0] is not None, r))


def test_exact_decisions_hold_for_a_text_not_an_id(spark):
    rows = [(None, "a b"), (None, "a  b"), (None, "unique"), (1, "a b"), (1, "second text"), (2, "second text"), (2, "third")]
    got = left(exact_dedup.drop_exact_copies(frame(spark, rows)))
    assert len(got) == 4 and {t.replace(" ", "") for _, t in got} == {"ab", "unique", "secondtext", "third"}
    assert {i for i, _ in got} == {None, 1, 2}


@pytest.mark.parametrize("shift", [0, 10])
def test_near_decisions_hold_for_a_text_not_an_id(spark, shift):
    rows = [(1, BASE), (5 + shift, EDIT), (5 + shift, OTHER), (None, BASE), (None, "free"), (9, EDIT)]
    assert left(lsh_forest.drop_near_copies(frame(spark, rows))) == sorted(
        [(None, BASE), (None, "free"), (1, BASE), (5 + shift, OTHER)], key=lambda r: (r[0] is not None, r))


def test_null_ids_that_hold_an_item_go(spark):
    item = spark.createDataFrame([(1, BASE)], "item_id long, text string")
    rows = [(None, "x " + BASE + " y"), (None, OTHER), (3, BASE), (3, OTHER), (4, None)]
    got = left(decontam_template.drop_leaks(frame(spark, rows), item))
    assert got == sorted([(None, OTHER), (3, OTHER), (4, None)], key=lambda r: (r[0] is not None, r[0]))
