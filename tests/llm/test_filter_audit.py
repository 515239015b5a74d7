import itertools
import math
import random
import re

import pytest

from tessera.llm import filter_audit as fa

DOCS = "doc_id long, text string, source string, mask long, part string, good long, n long"
LABELS = "doc_id long, quality long, toxic long, source string"


def brute(rows, labels):
    def words(t):
        return re.findall(r"[^\x20\x09-\x0D]+", t)

    docs = [(i, t or "", s or "") for i, t, s in rows]
    fails, out = [], {}
    for i, t, _ in docs:
        w = words(t)
        fails.append("".join(x for x, bad in zip("ABCDE", (
            len(w) < 200, 100 * len(set(w)) < 50 * len(w), 100 * len(re.findall("[A-Z]", t)) > 2 * len(t), re.search(r"[#$%&*|]", t),
            i is not None and any(j is not None and j < i and u == t for j, u, _ in docs))) if bad))
    good = {i for i, q, _ in labels if q == 1}
    toxic = {i for i, _, x in labels if x == 1}
    for part in {s for _, _, s in docs}:
        mine = [(i, f) for (i, _, s), f in zip(docs, fails) if s == part]
        share = dict.fromkeys("ABCDE", 0)
        for order in itertools.permutations("ABCDE"):
            left = mine
            for step, x in enumerate(order, 1):
                gone = [(i, f) for i, f in left if x in f]
                left = [(i, f) for i, f in left if x not in f]
                share[x] += len(gone)
                before = set(order[:step - 1])
                out[part, "".join(order), step] = [
                    len(left), len(gone), sum(x in f and bool(before & set(f)) for _, f in mine), sum(f == x for _, f in mine),
                    sum(i in good and i is not None for i, _ in gone), sum(i in toxic and i is not None for i, _ in gone), x]
        for key in [k for k in out if k[0] == part]:
            out[key][-1] = share[out[key][-1]]
    return {(*k, *v) for k, v in out.items()}


def corpus():
    rng = random.Random(4)
    plain = [" ".join(f"w{rng.randint(0, 3000)}" for _ in range(n)) for n in (199, 200, 260, 300)]
    texts = [*plain, plain[1] + " #", plain[2].upper(), "a b " * 150, None, "", "\x0b \n", "Short Text", "É" * 10 + "A", "x" * 30_000,
             " ".join(["y z\x1cq"] * 400)]
    rows = [(i, t, rng.choice(["a", "b", None, ""])) for i, t in enumerate(texts * 3)]
    rows += [(5, plain[3], "a"), (5, plain[3], "a"), (None, plain[1], "a"), (None, plain[1], None), (None, None, "c"), (99, plain[0], "only")]
    labels = [(i, rng.choice([0, 1, None]), rng.choice([0, 1, None])) for i in range(0, 60, 2)] + [(4, 1, 0), (4, 0, 1), (None, 1, 1)]
    rng.shuffle(rows)
    return rows, labels


def test_audit_equals_brute_force(spark):
    rows, labels = corpus()
    docs = spark.createDataFrame([(*r, 1, "p", 2, 3) for r in rows], DOCS).repartition(5)
    got = fa.audit_documents(docs, spark.createDataFrame([(*r, "s") for r in labels], LABELS)).collect()
    assert got[0].__fields__ == ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
    assert {tuple(r) for r in got} == brute(rows, labels)
    assert len(got) == 600 * len({s or "" for _, _, s in rows})


def test_empty_tables(spark):
    docs, labels = spark.createDataFrame([], DOCS), spark.createDataFrame([], LABELS)
    assert fa.audit_documents(docs, labels).collect() == []
    one = fa.audit_documents(spark.createDataFrame([(1, "x", None, 0, "", 0, 0)], DOCS), labels)
    assert one.count() == 600 and one.where("part = '' and good_lost = 0").count() == 600


@pytest.mark.parametrize("k", [1, 3, 5])
def test_path_counts(k):
    edges = fa.allowed(k)
    forward, backward = fa.path_counts(k, edges)
    assert forward == [math.factorial(s.bit_count()) for s in range(1 << k)]
    assert backward == [math.factorial(k - s.bit_count()) for s in range(1 << k)]
    assert sorted(fa.orders(k, edges)) == sorted(itertools.permutations(range(k)))


def test_restricted_orders(spark):
    rows = [("p", m, 1, 0, 0) for m in range(8)]
    counts = spark.createDataFrame(rows, "part string, mask int, n long, good long, toxic long")
    got = fa.audit(counts, "XYZ", before=[("X", "Z")]).collect()
    kept = [o for o in itertools.permutations("XYZ") if o.index("X") < o.index("Z")]
    assert {r.filter_order for r in got} == {"".join(o) for o in kept} and len(got) == 9
    for x in "XYZ":
        total = sum(r.removed for r in got if r.filter_order[r.step - 1] == x)
        assert {r.shapley for r in got if r.filter_order[r.step - 1] == x} == {total}
    with pytest.raises(ValueError):
        fa.audit(counts, "XYZ", before=[("X", "Z"), ("Z", "X")])
