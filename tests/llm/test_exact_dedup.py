import hashlib
import re

from pyspark.sql import functions as F

from tessera.llm.exact_dedup import drop_exact_copies, exact_groups

SCHEMA = "doc_id long, text string, h string, r string, norm string, n_chars long"


def frame(spark, pairs):
    return spark.createDataFrame([(i, t, "a", "b", "c", 1) for i, t in pairs], SCHEMA).repartition(4)


def brute(pairs):
    norm = lambda t: re.sub(r"[\x20\x09-\x0D]", "", t or "")
    out = set()
    for i, t in pairs:
        group = sorted((-len(u or ""), j) for j, u in pairs if norm(u) == norm(t))
        out.add((i, group[0][1], len(group), i == group[0][1], hashlib.sha256(norm(t).encode()).hexdigest()))
    return out


PAIRS = [(5, "a b c"), (2, "abc"), (9, "a  b c"), (4, None), (3, ""), (8, " \t\n\x0b\x0c\r"), (1, "é x"),
         (7, "éx"), (6, "long " * 30_000), (10, "long " * 30_000), (11, "abd")]


def test_groups_equal_brute_force(spark):
    assert {tuple(r) for r in exact_groups(frame(spark, PAIRS)).collect()} == brute(PAIRS)


def test_collisions_are_excluded_by_comparing_bytes(spark):
    weak = exact_groups(frame(spark, PAIRS), digest=lambda t: F.length(t).cast("string"))
    assert {tuple(r) for r in weak.collect()} == brute(PAIRS)


def test_drop_keeps_one_of_each(spark):
    got = drop_exact_copies(frame(spark, [*PAIRS, (2, "abc"), (9, "a  b c")]))
    assert got.columns == ["doc_id", "text", "h", "r", "norm", "n_chars"]
    assert sorted(r.doc_id for r in got.collect()) == [1, 6, 7, 8, 9, 11]


def test_null_id_and_empty_table(spark):
    got = exact_groups(frame(spark, [(None, "x"), (1, "x")])).collect()
    assert {(r.doc_id, r.keep_id, r.kept) for r in got} == {(None, None, True), (1, None, False)}
    assert exact_groups(frame(spark, [])).collect() == []


REPEATED = [(1, "abc"), (2, "abc"), (1, "aaa"), (None, "xyz"), (None, "xyy"), (3, "x yz"), (4, "xyz"), (1, "abc"), (5, "a aa"), (None, "xyz")]


def test_repeated_and_null_ids_of_equal_length(spark):
    def order(pair):
        return -len(pair[1]), pair[0] is not None, pair[0] or 0

    norm = lambda t: t.replace(" ", "")
    want = []
    for i, t in REPEATED:
        group = sorted((p for p in REPEATED if norm(p[1]) == norm(t)), key=order)
        want.append((i, group[0][0], len(group), i == group[0][0], hashlib.sha256(norm(t).encode()).hexdigest()))
    for digest in (F.md5, lambda t: F.length(t).cast("string")):
        got = [tuple(r) for r in exact_groups(frame(spark, REPEATED), digest).collect()]
        assert sorted(got, key=repr) == sorted(want, key=repr)
    left = drop_exact_copies(frame(spark, REPEATED)).collect()
    assert sorted(norm(r.text) for r in left) == ["aaa", "abc", "xyy", "xyz"]


def test_a_large_group_is_compared_in_parts(spark, monkeypatch):
    from tessera.llm import exact_dedup

    monkeypatch.setattr(exact_dedup, "PART", 7)
    pairs = [(i, "same text" if i % 3 else f"other{i % 2}") for i in range(200)]
    for digest in (F.md5, lambda t: F.lit("h")):
        assert {tuple(r) for r in exact_groups(frame(spark, pairs), digest).collect()} == brute(pairs)
