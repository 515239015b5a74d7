import zlib
from collections import Counter, defaultdict

import pytest

from tessera.llm.shard_kd import kd_shards

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, node long, cut long, size string"


def frame(spark, rows):
    return spark.createDataFrame([(*r, 5, 6, "s") for r in rows], SCHEMA).repartition(3)


def laws(got, rows, shards):
    assert Counter(r.doc_id for r in got) == Counter(r[0] for r in rows)
    text = {r[0]: r[1] or "" for r in rows}
    slots = defaultdict(list)
    total = Counter()
    for r in got:
        b = text[r.doc_id].encode()
        assert (r["size"], r.text_crc32, r.law, r.grown_shard) == (len(b) + 1, zlib.crc32(b), "bytes", None)
        slots[r.shard].append(r.slot)
        total[r.shard] += r["size"]
    assert all(0 <= s < shards for s in slots)
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())
    return total


@pytest.mark.parametrize("shards", [1, 3, 8])
def test_sizes_are_near_equal_with_a_hot_source(spark, shards):
    rows = [(i, "w" * (1 + i * 37 % 90), "en", "hot" if i % 3 == 0 else f"s{i % 7}", None if i % 11 == 0 else i * 37 % 90)
            for i in range(900)]
    total = laws(kd_shards(frame(spark, rows), shards=shards).collect(), rows, shards)
    assert len(total) == shards
    assert max(total.values()) - min(total.values()) <= 2 * 91


def test_one_text_everywhere_is_still_cut(spark):
    rows = [(i, "same text", None, None, 9) for i in range(400)]
    total = laws(kd_shards(frame(spark, rows), shards=8).collect(), rows, 8)
    assert max(total.values()) - min(total.values()) <= 20


def test_target_bytes_sets_the_number_of_leaves(spark):
    rows = [(i, "x" * 99, "en", "a", 99) for i in range(100)]
    total = laws(kd_shards(frame(spark, rows), target_bytes=2000).collect(), rows, 5)
    assert sorted(total.values()) == [2000] * 5


def test_edge_rows(spark):
    assert kd_shards(frame(spark, []), shards=8).collect() == []
    rows = [(1, None, None, None, None), (2, "", "en", None, 0), (3, "long " * 30_000, "de", "s", None), (4, "é", "x", "y", 1)]
    laws(kd_shards(frame(spark, rows), shards=8).collect(), rows, 8)
    again = [(7, "a b", "en", "s", 3)] * 5 + [(None, "c", "en", "s", 1)]
    laws(kd_shards(frame(spark, again), shards=2).collect(), again, 2)


def test_repeated_rows_are_cut_too(spark):
    rows = [(7, "one text of a repeated row", "en", "s", 26)] * 400 + [(1000 + i, f"another text, number {1000 + i}", "de", "t", 25) for i in range(400)]
    total = laws(kd_shards(frame(spark, rows), shards=8).collect(), rows, 8)
    assert len(total) == 8 and max(total.values()) - min(total.values()) <= 3 * 27
    same = [(None, "x" * 99, None, None, None)] * 333
    total = laws(kd_shards(frame(spark, same), shards=7).collect(), same, 7)
    assert len(total) == 7 and max(total.values()) - min(total.values()) <= 300
