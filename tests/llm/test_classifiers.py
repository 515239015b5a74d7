import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

from tessera.llm import lang_zstd as Z
from tessera.llm import toxic_pu as T
from tessera.llm.bytesops import flat

SCHEMA = "doc_id long, text string, lang string, score string, margin long"
WORDS = {"aa": "the of and ing tion er on re", "bb": "der die und heit keit ung schaft zu", "cc": "le la que ment eau oux ait ez"}


def text(rng, lang, n):
    parts = WORDS[lang].split()
    return " ".join("".join(rng.choice(parts) for _ in range(rng.randint(1, 3))) for _ in range(n))


def corpus(n=900, seed=1):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        lang = rng.choice(sorted(WORDS))
        t = text(rng, lang, rng.randint(4, 80))
        out.append((i, t.upper() if rng.random() < 0.1 else t, lang if rng.random() < 0.9 else None, "s", 1))
    return out


def test_language_held_out_accuracy_and_edges(spark):
    rows = corpus()
    odd = [(5000, None, "aa", "s", 1), (5001, "", "aa", "s", 1), (5002, "12 !? 3", "aa", "s", 1), (5003, text(random.Random(2), "bb", 30_000), None, "s", 1)]
    got = {r.doc_id: r for r in Z.identify(spark.createDataFrame(rows + odd, SCHEMA).repartition(3)).collect()}
    assert len(got) == len(rows) + 4
    held = [(r[0], r[2]) for r in rows if zlib.crc32(str(r[0]).encode()) % 3 == 1 and r[2]]
    assert np.mean([got[i].lang_pred == lang for i, lang in held]) > 0.95
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and 0 <= r.score <= 1 for r in got.values())
    assert [got[i].lang_pred for i in (5000, 5001, 5002)] == ["und"] * 3 and got[5003].lang_pred == "bb"


def test_language_labels_of_held_out_rows_do_not_matter(spark):
    rows = corpus(300)
    other = [(i, t, "zz" if zlib.crc32(str(i).encode()) % 3 == 1 else lang, s, m) for i, t, lang, s, m in rows]
    a, b = ({r.doc_id: (r.lang_pred, r.score) for r in Z.identify(spark.createDataFrame(x, SCHEMA)).collect()} for x in (rows, other))
    assert a == b


def test_narrow_margin_is_rejected(spark):
    model = {"aa": (5, b" the of and "), "bb": (9, b" der die und ")}
    got = Z.predict(spark.createDataFrame([(1, "xyz qqq", None, "s", 1)], SCHEMA), model).first()
    assert got.rejected and got.lang_pred == "bb" and got.score == pytest.approx(0.5)


def test_language_without_training_rows(spark):
    got = Z.identify(spark.createDataFrame([(1, "a b", None, "s", 1)], SCHEMA)).collect()
    assert [(r.lang_pred, r.score) for r in got] == [("und", 0.0)]
    assert Z.identify(spark.createDataFrame([], SCHEMA)).collect() == []


def toxic_corpus(n=1500, seed=3):
    rng = random.Random(seed)
    docs, labels = [], []
    for i in range(n):
        words = text(rng, "aa", rng.randint(10, 200)).split()
        bad = rng.random() < 0.15
        if bad:
            for _ in range(rng.randint(1, 4)):
                words.insert(rng.randrange(len(words)), rng.choice(["vilest", "rotten", "lowlife", "scoundrel"]))
        docs.append((i, " ".join(words), "aa", "s", 1))
        if rng.random() < 0.6:
            labels.append((i, 1, int(bad)))
    return docs, labels


LABELS = "doc_id long, quality int, toxic int"


def test_toxicity_held_out(spark):
    docs, labels = toxic_corpus()
    got = {r.doc_id: r for r in T.score_documents(spark.createDataFrame(docs, SCHEMA).repartition(3),
                                                  spark.createDataFrame(labels, LABELS)).collect()}
    assert len(got) == len(docs)
    held = [(i, y) for i, _, y in labels if got[i].held_out]
    assert all(got[i].held_out == (zlib.crc32(str(i).encode()) % 5 == 0) for i, _ in held)
    right = [got[i].predicted == y for i, y in held]
    assert np.mean(right) > 0.95
    kept = T.drop_toxic(spark.createDataFrame(docs, SCHEMA), spark.createDataFrame(labels, LABELS))
    assert kept.columns == ["doc_id", "text", "lang", "score", "margin"]
    assert {r.doc_id for r in kept.collect()} == {i for i, r in got.items() if not r.predicted}


def test_toxicity_edges(spark):
    docs, labels = toxic_corpus(200)
    odd = [(9000, None, "x", "s", 1), (9001, "", "x", "s", 1), (9002, "vilest " * 50_000, "x", "s", 1), (None, "a", "x", "s", 1)]
    frame = spark.createDataFrame(docs + odd, SCHEMA)
    got = T.score_documents(frame, spark.createDataFrame([*labels, (77_777, 1, 1), (3, None, None)], LABELS)).collect()
    assert len(got) == 204 and all(0 <= r.score <= 1 for r in got)
    none = T.score_documents(frame, spark.createDataFrame([], LABELS)).collect()
    assert {(r.score, r.predicted) for r in none} == {(0.0, 0)}
    assert T.score_documents(spark.createDataFrame([], SCHEMA), spark.createDataFrame(labels, LABELS)).collect() == []


def test_risk_gradient_is_that_of_the_non_negative_estimator():
    rng = np.random.default_rng(0)
    pos = [np.array([1, 5 + i % 3]) for i in range(60)]
    unl = [np.array([9, 5 + i % 3]) for i in range(180)] + pos[:20]
    w, b = T.fit(pos, unl, 0.1, 0)
    assert w[1] > 0 and b < 0 and abs(w[5]) < w[1] and w[9] == 0
    del rng


def test_features_are_the_distinct_words_and_beginnings():
    buf, off = flat(pa.array(["Idiot idiot, x", None, "idiots"]))
    a, b, c = list(T.features(buf, off))
    assert len(b) == 0 and 3 <= len(a) <= 4 and len(set(a) & set(c)) >= 1


def test_language_by_plain_zstandard(spark):
    """Predictions against one plain encoder a language, and texts without a letter."""
    import zstandard

    from tessera.llm import lang_zstd as Z

    words = {"xx": "lorem ipsum dolor sit amet consectetur".split(), "yy": "river stone green walk under bridge".split()}
    rows = [(i, " ".join(words[k][(i * 7 + j * j) % 6] for j in range(30)), k) for i, k in enumerate(["xx", "yy"] * 40)]
    odd = [(100, "² ½ 12 ?", None), (101, None, "xx"), (102, "", "yy"), (103, "lorem ² dolor", None), (104, "123", "xx")]
    docs = spark.createDataFrame(rows + odd, "doc_id long, text string, lang string").repartition(3)
    model = Z.train(docs, Z.fold(docs.doc_id, 3) != 1)
    names = sorted(model, key=lambda k: (-model[k][0], k))

    def plain(text):
        if not text or not any(c.isalpha() for c in text):
            return "und"
        data = Z._payload(list(dict.fromkeys(Z._WORD.findall(text.lower()))))
        size = []
        for k in names:
            d = zstandard.ZstdCompressionDict(model[k][1], dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            c = zstandard.ZstdCompressor(level=Z.LEVEL, dict_data=d, write_content_size=False, write_checksum=False, write_dict_id=False)
            size.append(len(c.compress(data)))
        return names[size.index(min(size))]

    got = {r.doc_id: r.lang_pred for r in Z.identify(docs).collect()}
    assert got == {i: plain(t) for i, t, _ in rows + odd}
    assert [got[i] for i in (100, 101, 102, 103, 104)] == ["und", "und", "und", "xx", "und"]
