import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tessera.llm.bytesops import flat
from tessera.llm.shared import prepare, scratch
from tessera.llm.tokens import Encoder, encoder, vocabulary_path

ODD = ["", "it's l'eau 'tis '' '''s 's't x''s don't 12'34 '", "ABC É È ß ẞ İ ı Σς ΣΑΣ", "<|endoftext|> a <|x", "日本 a",
       "a b", "x²½ª º µ", "ÀÉ×÷ÿŸ", "a\x1cb\x85c\x0bd", "hello\n\n\tworld  !!??  a1b2", "Ǆǅǆ Ⱥ ɐ", "'É 'été 'S",
       "é K Å", "#" * 300 + "z" * 300, "'", "a'", "'\n's", " \t\n "]
SCHEMA = "doc_id long, text string, frame string, chunk string, length string"


def by_library(text):
    return np.array(encoder(vocabulary_path()).whole.encode(text or "", add_special_tokens=False).ids, np.uint32)


def crc(ids):
    return zlib.crc32(np.asarray(ids, "<u4").tobytes())


def test_encoder_equals_library_on_odd_texts():
    got = list(encoder(vocabulary_path()).encode(*flat(pa.array(ODD))))
    assert [g.tolist() for g in got] == [by_library(t).tolist() for t in ODD]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from(list("ab'stmdvelrEÉéßç 09\n.!-<|>̀日ªİ")), max_size=40), max_size=6))
def test_encoder_equals_library(texts):
    got = list(encoder(vocabulary_path()).encode(*flat(pa.array(texts, pa.string()))))
    assert [g.tolist() for g in got] == [by_library(t).tolist() for t in texts]


def test_encoder_cache_starts_anew(monkeypatch):
    import tessera.llm.tokens as T

    monkeypatch.setattr(T, "CACHE_UNITS", 40)
    enc = Encoder(vocabulary_path())
    texts = [" ".join(f"w{chr(97 + i % 26)}{chr(97 + i // 26)}x" for i in range(a, a + 60)) for a in (0, 30, 90, 0)]
    assert [g.tolist() for g in enc.encode(*flat(pa.array(texts)))] == [by_library(t).tolist() for t in texts]


def rows(spark, texts, ids=None):
    ids = ids if ids is not None else range(len(texts))
    return spark.createDataFrame([(i, t, "x", "y", "z") for i, t in zip(ids, texts, strict=True)], SCHEMA).repartition(3)


def test_token_files_round_trip(spark):
    from tessera.llm.token_files import read_document, read_index, write_tokens

    prepare(spark)
    texts = [*ODD, None, "word " * 30_000, "same", "same"]
    ids = [7 * i + 3 for i in range(len(texts) - 1)] + [7 * (len(texts) - 2) + 3]  # the last id repeats
    path = scratch(spark, "t")
    write_tokens(rows(spark, texts, ids), path, buckets=4)
    got = sorted((r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in read_index(spark, path).collect())
    want, start = [], 0
    for i, t in sorted(zip(ids, texts, strict=True), key=lambda x: x[0]):
        x = np.append(by_library(t), 1)
        want.append((i, start, len(x), crc(x)))
        start += len(x)
    assert got == want
    assert read_document(spark, path, 10) == [*by_library(texts[1]).tolist(), 1]
    assert read_document(spark, path, 11) is None


def test_token_files_empty_table_and_null_id(spark):
    from tessera.llm.token_files import read_index, write_tokens

    prepare(spark)
    path = scratch(spark, "t")
    write_tokens(rows(spark, []), path)
    assert read_index(spark, path).collect() == []
    path = scratch(spark, "t")
    write_tokens(rows(spark, ["a b", "c"], [None, 5]), path)
    got = {r.doc_id: r.start for r in read_index(spark, path).collect()}
    assert got == {None: 0, 5: 3}


def check_bins(placed, capacity):
    """placed: (sequence, offset, length).  Gapless from 0, never over the capacity."""
    bins = defaultdict(list)
    for s, o, n in placed:
        bins[s].append((o, n))
    for parts in bins.values():
        at = 0
        for o, n in sorted(parts):
            assert o == at
            at += n
        assert at <= capacity
    return len(bins)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 30), max_size=80))
def test_plan_places_every_piece(lengths):
    from tessera.llm.packing import plan_runs

    count = {n: lengths.count(n) for n in set(lengths)}
    placed, ranks = [], defaultdict(list)
    for length, rank, n, first, per, offset in plan_runs(count, 30):
        for r in range(n):
            ranks[length].append(rank + r)
            placed.append((first + r // per, offset + r % per * length, length))
    assert {k: sorted(v) for k, v in ranks.items()} == {k: list(range(v)) for k, v in count.items()}
    n = check_bins(placed, 30)
    least = max(-(-sum(lengths) // 30), sum(x > 15 for x in lengths))
    assert least <= n <= max(least, 11 * least // 9 + 1 + least // 2)


def test_packing_covers_whole_documents(spark):
    from tessera.llm.packing import pack_documents

    prepare(spark)
    texts = [*ODD, None, "word " * 5000, *["one two three"] * 40, *["x " * 700] * 7]
    got = pack_documents(rows(spark, texts)).collect()
    by_doc = defaultdict(list)
    for r in got:
        by_doc[r.doc_id].append(r)
    for i, t in enumerate(texts):
        ids = np.append(by_library(t), 0)
        parts = sorted(by_doc[i], key=lambda r: r.piece)
        assert [(r.piece, r.start, r.length, r.ids_crc32) for r in parts] == [
            (p, a, len(ids[a:a + 2048]), crc(ids[a:a + 2048])) for p, a in enumerate(range(0, len(ids), 2048))]
    check_bins([(r.sequence_id, r.offset, r.length) for r in got], 2048)
    assert pack_documents(rows(spark, [])).collect() == []


@pytest.mark.parametrize("name", ["op2_token_files", "op9_packing"])
def test_queries_on_the_smallest_table(spark, name):
    from tessera.llm.queries import queries

    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()
    got = queries()[name](spark, "/root/testdata/sf0.001").collect()
    assert {r.doc_id for r in got} == {d.doc_id for d in docs}
    end = 1 if name.startswith("op2") else 0
    if end:
        want = {d.doc_id: crc(np.append(by_library(d.text), 1)) for d in docs}
        assert {r.doc_id: r.ids_crc32 for r in got} == want
    else:
        want = {(d.doc_id, p): crc(np.append(by_library(d.text), 0)[p * 2048:(p + 1) * 2048])
                for d in docs for p in range(-(-(len(by_library(d.text)) + 1) // 2048))}
        assert {(r.doc_id, r.piece): r.ids_crc32 for r in got} == want
        check_bins([(r.sequence_id, r.offset, r.length) for r in got], 2048)


def test_files_of_another_dictionary_and_repeated_ids(spark):
    import uuid

    from tessera.llm.shared import scratch
    from tessera.llm.token_files import read_index, write_tokens

    rows = [(i % 40, f"some text number {i} with words " * (1 + i % 5)) for i in range(120)]
    one, two = (scratch(spark, f"tokens-{uuid.uuid4().hex}") for _ in range(2))
    write_tokens(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), one)
    write_tokens(spark.createDataFrame(rows[::-1], "doc_id long, text string").repartition(5), two)
    a, b = ([tuple(r) for r in read_index(spark, p).orderBy("start").collect()] for p in (one, two))
    assert [r[1] for r in a] == [sum(x[2] for x in a[:i]) for i in range(len(a))] and [r[0] for r in a] == sorted(r[0] for r in a)
    assert a == b or spark.read.parquet(one + "/dictionary").first().dict_sha256 != spark.read.parquet(two + "/dictionary").first().dict_sha256
    other = spark.read.parquet(one + "/dictionary").selectExpr("dict_sha256", "cast(concat(dictionary, X'00') as binary) as dictionary",
                                                               "width", "vocabulary", "end_id").collect()
    spark.createDataFrame(other, "dict_sha256 string, dictionary binary, width int, vocabulary string, end_id int") \
        .write.mode("overwrite").parquet(two + "/dictionary")
    with pytest.raises(Exception, match="another dictionary"):
        read_index(spark, two).collect()
