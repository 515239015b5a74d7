import hashlib
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tessera.llm import license_lr as LIC
from tessera.llm import pii_boost as P

PLAIN = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
         "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+",
         "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def luhn(d):
    return sum((x if i % 2 == 0 else (2 * x if x < 5 else 2 * x - 9)) for i, x in enumerate(map(int, reversed(d)))) % 10 == 0


def valid(kind, m):
    d = re.sub("[^0-9]", "", m)
    return {"email": True, "ip": all(int(x) <= 255 for x in m.split(".")) if kind == "ip" else False,
            "card": 12 <= len(d) <= 19 and luhn(d) if kind == "card" else False, "phone": 9 <= len(d) <= 15}[kind]


def brute(text):
    found = []
    for k, kind in enumerate(P.KINDS):
        found += [(m.start(), k, m.end()) for m in re.finditer(PLAIN[kind], text or "") if valid(kind, m[0])]
    return sorted(found)


def joined(spans):
    return ",".join(f"{P.KINDS[k]}:{a}:{b}" for a, k, b in spans)


TEXTS = ["", None, "mail a.b@c.de.", "x@y z@w.v_q@r.s", "a@b.c.d..e@f.g", "é 10.0.0.255 and 1.2.3.256 1.2.3.4.5.6.7.8",
         "card 4111 1111 1111 1111, 4111-1111-1111-1112", "+1 (499) 555-6503, +12 3", "0004.1.1.1 99999999999.1.1.1",
         "a@1.2.3.4 x", "@@ a@b @c.d", "1--2 3- 4 5", "+1(((", "." * 3000 + "a" * 3000 + "@b.c" + ".d" * 3000,
         "1 " * 20_000, "7" * 30_000, "a@b.c " * 1500, "🙂 1.2.3.4 🙂 x@y.z", "% % %a@b-.c-"]


def check(spark, texts):
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, t string").repartition(2)
    t = F.coalesce("t", F.lit(""))
    got = rows.select("doc_id", F.array_sort(F.concat(*[P.base_spans(t, P.has_digit(t), k) for k in P.KINDS])).alias("s")).collect()
    for r in got:
        assert [tuple(x) for x in r.s] == brute(texts[r.doc_id]), texts[r.doc_id][:80]


def test_base_spans_equal_the_plain_patterns(spark):
    check(spark, TEXTS)


@settings(max_examples=8, deadline=None)
@given(texts=st.lists(st.text(alphabet=list("a1.@+- ()_%4é\n0"), max_size=60), min_size=20, max_size=60))
def test_base_spans_property(spark, texts):
    check(spark, texts)


def corpus(n=600):
    out = []
    for i in range(n):
        body = {0: f"please mail john{i}@site{i % 9}.example.com now", 1: f"host 10.{i % 250}.3.{i % 200} is up",
                2: f"call me +1 (499) 555-{1000 + i} today", 3: f"the value {i}.{i}.{i + 300}.{i + 400} here",
                4: f"ask joe{i} (at) site{i % 7} (dot) org soon", 5: f"number {4111111111111111 + i} paid"}[i % 6]
        out.append((i, "text " + body + " end", "x", 1))
    return out


def test_all_spans_hold_the_base_and_touch_nothing(spark):
    rows = corpus()
    got = P.find_private(spark.createDataFrame(rows, "doc_id long, text string, spans string, b long").repartition(3)).collect()
    assert len(got) == len(rows)
    for r in got:
        base = brute(rows[r.doc_id][1])
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == j for _, k, _ in base) for j in range(4)]
        assert r.base_sha256 == hashlib.sha256(joined(base).encode()).hexdigest()
        spans = [(int(a), P.KINDS.index(k), int(b)) for k, a, b in (s.split(":") for s in r.spans.split(",") if s)]
        assert spans == sorted(spans) and set(base) <= set(spans) and r.n_added == len(spans) - len(base)
        for s in set(spans) - set(base):
            assert all(s[2] <= o[0] or o[2] <= s[0] for o in spans if o != s)


def with_check_digit(i):
    stem = f"4111{i:011d}"
    return next(stem + c for c in "0123456789" if luhn(stem + c))


def dotted(d):
    return ".".join(d[i:i + 4] for i in range(0, len(d), 4))


def test_boosted_trees_add_the_shapes_that_the_base_patterns_miss(spark):
    body = [lambda i: f"please mail john{i}@site{i % 9}.example.com now", lambda i: f"host 10.{i % 250}.3.{i % 200} is up",
            lambda i: f"call me +1 (499) 555-{1000 + i} today", lambda i: f"card {with_check_digit(i)} was paid",
            lambda i: f"the version {i}.{i}.{i + 300}.{i + 400} of part {1000 + i} came", lambda i: f"at 10:{i % 60:02d} on 2024-03-{1 + i % 28:02d} we sat"]
    rows = [(i, "text " + body[i % 6](i) + " end") for i in range(1500)]
    card = dotted(with_check_digit(77))
    planted = [("ask joe (at) site (dot) org soon", "email", "joe (at) site (dot) org"),
               ("host 2001:db8:a:3:0:c8 is up", "ip", "2001:db8:a:3:0:c8"), (f"card {card} was paid", "card", card),
               ("call me (499) 555-1234 today", "phone", "(499) 555-1234")]
    clean = ["please look (at) this now", "version 3.4.700.900 came", f"card {card[:-1]}{(int(card[-1]) + 1) % 10} was paid",
             "at 10:20:30:40 we sat", "on 2024-03-15 10 people", "john@home now"]
    rows += [(5000 + j, "text " + p[0]) for j, p in enumerate(planted)] + [(6000 + j, "text " + c) for j, c in enumerate(clean)]
    got = {r.doc_id: r for r in P.find_private(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()}
    for j, (t, kind, m) in enumerate(planted):
        at = 5 + t.index(m)
        assert (got[5000 + j].spans, got[5000 + j].n_added) == (f"{kind}:{at}:{at + len(m)}", 1), t
    assert [got[6000 + j].spans for j in range(len(clean))] == [""] * len(clean)
    assert sum(got[i].n_added for i in range(1500)) == 0


def test_overlap_sweeps_equal_plain_search(spark):
    import random
    rng = random.Random(5)
    cases = []
    for i in range(60):
        n = 300 if i == 0 else rng.randrange(0, 9)
        cut = lambda: sorted((a, rng.randrange(4), a + rng.randint(1, 9)) for a in (rng.randrange(40 if i else 900) for _ in range(n)))  # noqa: B023,E731
        cases.append((i, [(*s, str(j), "", "") for j, s in enumerate(cut())], cut(), [(*s, rng.randrange(5) / 4) for s in cut()]))
    frame = spark.createDataFrame(cases, f"i int, f {P._FOUND}, b {P._SPAN}, p array<struct<start:int,kind:int,end:int,p:double>>")
    for r in frame.select("i", P.untouched(F.col("f"), F.col("b")).alias("u"), P.likeliest(F.col("p")).alias("l")).collect():
        _, found, base, scored = cases[r.i]
        want = [s for s in found if not any(s[0] < b[2] and b[0] < s[2] for b in base)]
        assert sorted(tuple(x) for x in r.u) == sorted(want)
        best, reach, chain = [], 0, []
        for s in [*scored, (10 ** 6, 0, 10 ** 6 + 1, 0.0)]:
            if s[0] >= reach and chain:
                best.append(min(chain, key=lambda c: (-c[3], c[0], c[1]))[:3])
                chain = []
            chain.append(s)
            reach = max(reach, s[2])
        assert sorted(tuple(x) for x in r.l) == sorted(best)

def test_model_expression_equals_the_trees(spark):
    model = P.Model([(4, 10.5, 0.5, (5, 3.0, -0.25, 1.0))], [2.0], [0.5, None, None, None])
    s = F.struct(F.lit(0).alias("kind"), *[F.lit(float(i * 3)).alias(f"f{i}") for i in range(P.N_FEATURES)])
    p = spark.range(1).select(model.probability(s)).first()[0]
    assert p == pytest.approx(1 / (1 + 2.718281828 ** -4))


def test_empty_table_and_rare_labels(spark):
    schema = "doc_id long, text string"
    assert P.find_private(spark.createDataFrame([], schema)).collect() == []
    got = P.find_private(spark.createDataFrame([(1, "a@b.c"), (None, None), (1, "a@b.c")], schema)).collect()
    assert sorted(r.spans for r in got) == ["", "email:0:5", "email:0:5"]


LINES = [("Licensed under the Apache License, Version 2.0.", "apache-2.0"), ("Released under the MIT License.", "mit"),
         ("Licensed under CC BY-NC 4.0.", "cc-by-nc"), ("under the terms of the GNU Lesser General Public License", "lgpl"),
         ("This work is licensed under the GNU General Public License, version 3.", "gpl")]


def test_licences(spark):
    rows = [(i, f"Some words of line {i} here.\n" + "plain text goes on " * (i % 5) + "\n" + (
        LINES[i % 9][0] if i % 9 < 5 else "the licence of a driver"), "x", 2) for i in range(300)]
    rows += [(900, None, "x", 1), (901, "", "x", 1), (902, "license " * 20_000, "x", 1), (903, "\n\n 12 \n", "x", 1)]
    got = {r.doc_id: r for r in LIC.licences(spark.createDataFrame(
        rows, "doc_id long, text string, families string, line long").repartition(3)).collect()}
    assert len(got) == len(rows)
    for i in range(300):
        assert got[i].families == ([LINES[i % 9][1]] if i % 9 < 5 else []), i
        assert got[i].n_paragraphs == (1 if i % 9 < 5 else 0)
    assert all(got[i].families == [] for i in (900, 901, 902, 903))
    assert LIC.licences(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_every_confirmed_paragraph_holds_a_needed_word():
    from itertools import combinations

    need = set(LIC.needed_words())
    for texts in LIC.TEMPLATES.values():
        for t in texts:
            pairs = LIC._pairs(t.split())
            spare = int((1 - LIC.CONFIRM) * len(pairs) + 1e-9)
            for gone in combinations(pairs, spare):
                held = {w for p in pairs if p not in gone for w in p.split()}
                assert held & need, (t, gone)


def test_models_learn_from_every_document(spark, monkeypatch):
    """Neither training reads a sample: both see the rows of every document."""
    seen = []
    monkeypatch.setattr(P, "cut_lineage", lambda df: (seen.append(df.count()), df)[1])
    docs = spark.range(21_000).select(F.col("id").alias("doc_id"), F.lit("x").alias("text"))
    assert P.train(docs) is None and seen[0] == 21_000
    seen.clear()
    monkeypatch.setattr(LIC, "paragraphs", lambda df, real=LIC.paragraphs: (seen.append(df.count()), real(df))[1])
    LIC.train(spark.range(2500).select(F.col("id").alias("doc_id"), F.lit("plain words of no licence").alias("text")))
    assert seen[0] == 2500


def test_paragraphs_not_compared_cover_less_than_half():
    """The training compares with the templates only paragraphs holding a word that half a cover implies."""
    need = set(LIC.needed_words(0.5))
    assert set(LIC.needed_words()) <= need
    for texts in LIC.TEMPLATES.values():
        for t in texts:
            pairs = LIC._pairs(t.split())
            bare = [p for p in pairs if not set(p.split()) & need]
            assert len(bare) < 0.5 * len(pairs), t


def test_grams_are_words_pairs_and_triples(spark):
    rows = spark.createDataFrame([(["a", "b", "c"],), (["a", "b"],), (["a"],), ([],)], "words array<string>")
    assert [r.grams for r in LIC.grams(rows).collect()] == [["a", "b", "c", "a b", "b c", "a b c"], ["a", "b", "a b"], ["a"], []]


def test_hashed_grams_are_the_vector_of_the_plain_grams(spark):
    """One place a distinct gram, equal for equal grams wherever they stand, and read back as spark.ml's vectors."""
    texts = ["a b c a b c", "a b", "a", "x a b", "b c d e f g"]
    rows = spark.createDataFrame([(t.split(),) for t in texts], "words array<string>")
    plain = {" ".join(r.words): set(r.grams) for r in LIC.grams(rows.select("words", F.col("words").alias("w")))
             .select(F.col("w").alias("words"), "grams").collect()}
    got = {r.t: r.features for r in LIC.hashed(rows.withColumn("t", F.concat_ws(" ", "words")), "test").collect()}
    at = {t: set(v.indices.tolist()) for t, v in got.items()}
    for t, v in got.items():
        assert v.size == LIC.DIMS and list(v.indices) == sorted(at[t]) and set(v.values) == {1.0}
        assert len(at[t]) == len(plain[t]), t
        assert all(at[t] & at[o] == at[t] for o in got if plain[t] <= plain[o])
    assert len(set().union(*at.values())) == len(set().union(*plain.values()))


def test_grams_are_made_once_a_paragraph(spark, monkeypatch):
    """The scan writes every paragraph's features once; fit, calibration and scoring read them back."""
    seen = []
    monkeypatch.setattr(LIC, "hashed", lambda rows, name, real=LIC.hashed: (seen.append((name, rows.count())), real(rows, name))[1])
    docs = [(i, f"plain words of line {i}\nReleased under the MIT License.") for i in range(200)]
    got = LIC.licences(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert {tuple(r.families) for r in got} == {("mit",)}
    written = dict(seen)
    assert len(written) == len(seen) and written["paragraphs"] + written["held_out"] == 400 and min(written.values()) > 0
    model, need = LIC.train(spark.createDataFrame(docs, "doc_id long, text string"))
    assert model.licence.numClasses == 2 and model.family.numClasses == len(LIC.TEMPLATES) and 0.5 <= need <= 1


def test_covers_of_known_pairs_are_those_of_all_pairs(spark):
    texts = [t for many in LIC.TEMPLATES.values() for t in many] + ["a licensed under the mit license b", "no licence", "all rights reserved do not"]
    w = F.split("t", " ")
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select(LIC._neighbours(w).alias("p"))
    for r in rows.select(F.array(*LIC.cover(F.col("p")).values()).alias("a"), F.array(*LIC.cover(LIC.known_pairs(F.col("p"))).values()).alias("b")).collect():
        assert r.a == r.b
