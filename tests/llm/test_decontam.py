import random

from tessera.llm import decontam_template as D

DOC = "doc_id long, text string, item_id string, cover string, line long"
ITEM = "item_id long, text string, doc_id string"


def docs(spark, rows):
    return spark.createDataFrame([(i, t, "x", "y", 1) for i, t in rows], DOC).repartition(3)


def items(spark, rows):
    return spark.createDataFrame([(i, t, "z") for i, t in rows], ITEM)


Q = "A farmer named Alice buys 12 apples for 3 dollars each and then Alice walks 40 miles to the market with them"
CASES = {
    1: f"Some text before. {Q}. And after.",
    2: "A farmer named Bob buys 99 apples for 7 euros each and then Bob walks 8 km to the market with them",
    3: "A farmer named Bob buys 99 apples for 7 euros each and then Carl walks 8 km to the market with them",
    4: Q.lower(),
    5: "A farmer named Alice buys the market with them and nothing else happens on that day in town",
    6: "nothing of the kind is here but the market with them",
    7: None, 8: "", 9: "word " * 40_000,
    10: "x " * 5000 + Q.replace("apples", "pears") + " y" * 5000,
}


def test_reparameterised_passages_are_found_and_clean_ones_left(spark):
    got = {r.doc_id: r for r in D.flagged(docs(spark, list(CASES.items())), items(spark, [(70, Q), (71, None), (72, "too short")])).collect()}
    assert set(got) == set(CASES)
    assert {i for i, r in got.items() if r.flagged} == {1, 2, 4, 10}
    assert got[1].item_ids == [70] and got[6].item_ids is None


def test_slot_consistency_is_what_tells_two_from_three(spark):
    found = {r.doc_id: r.cover for r in D.leaks(docs(spark, [(2, CASES[2]), (3, CASES[3])]), items(spark, [(70, Q)])).collect()}
    assert 2 in found and 3 not in found


def brute(doc_rows, item_rows):
    """Items whose words all stand in a row in the document."""
    words = lambda t: "".join(c.lower() if c.isalnum() else " " for c in t or "").split()
    out = set()
    for i, t in doc_rows:
        w = words(t)
        for j, u in item_rows:
            q = words(u)
            if len(q) >= 5 and any(w[a:a + len(q)] == q for a in range(len(w) - len(q) + 1)):
                out.add((i, j))
    return out


def test_planted_passages_equal_brute_force(spark):
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randint(3, 7)))
    bench = [(k, " ".join(word() for _ in range(rng.randint(5, 40)))) for k in range(30)]
    rows = []
    for i in range(200):
        parts = [word() for _ in range(rng.randint(0, 80))]
        if i % 3 == 0:
            parts.insert(rng.randint(0, len(parts)), rng.choice(bench)[1].capitalize() + ".")
        rows.append((i, rng.choice([" ", "\n"]).join(parts)))
    rows += [(500 + k, bench[0][1]) for k in range(40)]
    got = {(r.doc_id, r.item_id) for r in D.leaks(docs(spark, rows), items(spark, bench)).collect()}
    assert got == brute(rows, bench)
    kept = D.drop_leaks(docs(spark, rows), items(spark, bench))
    assert kept.columns == ["doc_id", "text", "item_id", "cover", "line"]
    assert {r.doc_id for r in kept.collect()} == {i for i, _ in rows} - {i for i, _ in got}


def test_empty_tables(spark):
    assert D.flagged(docs(spark, []), items(spark, [(1, Q)])).collect() == []
    assert [r.flagged for r in D.flagged(docs(spark, [(1, Q)]), items(spark, [])).collect()] == [False]


def test_query_returns_the_leaking_documents(spark):
    from tessera.llm.queries import queries

    folder = "/root/testdata/sf0.001"
    table = lambda n: [tuple(r) for r in spark.read.parquet(f"{folder}/{n}.parquet").collect()]
    got = queries()["op5_template_decontamination"](spark, folder).collect()
    want = brute([(r[0], r[1]) for r in table("documents")], [(r[0], r[1]) for r in table("benchmark")])
    assert want and {(r.doc_id, int(i)) for r in got for i in r.items.split(",")} == want
    assert all(r.cover >= D.COVER for r in got)


LONG = " ".join(f"word{i % 7}{chr(97 + i % 26)}{i}" for i in range(500))
SUMS = "If a tank holds 5 buckets and each of the 5 buckets weighs 9 pounds then how many pounds do the buckets weigh together"


def test_plain_windows_count_where_a_slot_is_inconsistent(spark):
    edited = SUMS.replace("holds 5", "holds 6")  # one of two equal numbers
    rows = [(1, edited), (2, SUMS.replace("5", "6")), (3, SUMS.replace("5", "6", 1).replace("weighs 9", "weighs 4").replace("tank", "vat"))]
    got = {r.doc_id: (r.cover, r.run) for r in D.leaks(docs(spark, rows), items(spark, [(70, SUMS)])).collect()}
    assert {1, 2} <= set(got) and got[1][1] >= 13


def test_a_part_of_a_long_item_is_found(spark):
    words = LONG.split()
    rows = [(1, "x " * 30 + " ".join(words[100:400]) + " y"), (2, " ".join(words[50:63])), (3, " ".join(words[50:62])),
            (4, " ".join(w for i, w in enumerate(words) if i % 16 < 8))]
    got = {r.doc_id: r.run for r in D.leaks(docs(spark, rows), items(spark, [(70, LONG)])).collect()}
    assert got == {1: 300, 2: 13}


def test_null_and_repeated_ids(spark):
    rows = [(None, Q), (None, "clean text without any of it"), (5, Q[:60]), (5, Q[60:]), (6, Q), (6, Q)]
    got = D.leaking_documents(docs(spark, rows), items(spark, [(70, Q), (None, Q)])).collect()
    assert {(r.doc_id, r["items"]) for r in got} == {(None, "70"), (6, "70")}  # the halves of doc 5 are texts of their own
    flags = {(r.doc_id, r.flagged) for r in D.flagged(docs(spark, rows), items(spark, [(70, Q)])).collect()}
    assert flags == {(None, True), (5, False), (6, True)}


def plain_leaks(text, item):
    """Longest run of words that stands in both, by plain search."""
    words = lambda t: "".join(c.lower() if c.isalnum() else " " for c in t).split()
    a, b = words(text), words(item)
    best, row = 0, [0] * (len(b) + 1)
    for x in a:
        row = [0] + [row[j] + 1 if x == y else 0 for j, y in enumerate(b)]
        best = max(best, *row)
    return best


def test_runs_equal_plain_search(spark):
    rng = random.Random(8)
    item = " ".join(rng.choice(["red", "blue", "green", "stone", "river"]) + str(rng.randint(0, 9)) for _ in range(60))
    w, rows = item.split(), []
    for i in range(60):
        a = rng.randint(0, 40)
        rows.append((i, " ".join(["pre"] * rng.randint(0, 4) + w[a:a + rng.randint(8, 20)] + ["mid"] + w[:rng.randint(0, 14)])))
    want = {i: plain_leaks(t, item) for i, t in rows}
    got = {r.doc_id: r.run for r in D.leaks(docs(spark, rows), items(spark, [(1, item)])).collect()}
    assert got == {i: n for i, n in want.items() if n >= D.RUN}
