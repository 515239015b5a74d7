import hashlib
import itertools
import random
import re
import zlib

import pytest

from tessera.llm import conversation_repair as cr

SCHEMA = "conv_id long, turn long, role string, text string, audit string, lead long, cost long, times long"
GOOD = re.compile(r"(s?(ua)+)?")


def brute_plan(rows):
    """(cost, audit, repaired lines) by trying every edit of every row and up to two inserts a gap."""
    seen, faults = set(), []
    for role, text in rows:
        solid = re.sub(r"[\x20\x09-\x0D]", "", text)
        faults.append("blank" if not solid else "duplicate" if (role, text) in seen else "truncated" if solid[-1] not in ".!?" else None)
        seen.add((role, text))
    gaps = [(), ("user",), ("assistant",), ("user", "assistant"), ("assistant", "user")]
    options = []
    for (role, text), fault in zip(rows, faults):
        extra, edits = 5 * (fault == "truncated"), [(2, "D", [])]
        if fault not in ("blank", "duplicate"):
            edits += [(extra, "K", [(role, text)])] + [(1 + extra, "R", [(r, text)]) for r in ("user", "assistant")]
        options.append(edits)
    best = None
    for edits in itertools.product(*options):
        for fill in itertools.product(gaps, repeat=len(rows) + 1):
            cost, audit, lines = sum(e[0] for e in edits) + 5 * sum(map(len, fill)), "", []
            if best and cost > best[0]:
                continue
            for i, f in enumerate(fill):
                audit += "I" * len(f)
                lines += [(r, "") for r in f]
                if i < len(edits):
                    audit += edits[i][1]
                    lines += edits[i][2]
            if all(r for r, _ in lines) and GOOD.fullmatch("".join(r[0] for r, _ in lines)):
                new = (cost, audit, "\n".join(f"{r}:{t}" for r, t in lines))
                best = min(best, new) if best else new
    return best, faults


def brute(table):
    out = {}
    for conv in {r[0] for r in table}:
        rows = []
        for c, turn, role, text in table:
            if c != conv:
                continue
            part = zlib.crc32(f"{' ' if c is None else c}:{' ' if turn is None else turn}".encode()) % 20
            role, text = " " if role is None else role, " " if text is None else text
            if part:
                text = "" if part == 1 else re.sub("[.!?]", "", text) if part == 2 else text
                row = (turn is not None, turn or 0, "user" if part == 4 else role, hashlib.md5(text.encode()).digest(), text)
                rows += [row] * (2 if part == 3 else 1)
        rows.sort()
        lines = [(r[2], r[4]) for r in rows]
        (cost, audit, repaired), faults = brute_plan(lines)
        turns = {r[1] for r in rows if r[0]}
        illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in zip(lines, lines[1:]))
        out[conv] = (conv, max(turns) - min(turns) + 1 - len(turns) if turns else 0, *(faults.count(f) for f in ("blank", "duplicate", "truncated")),
                     illegal, cost, audit, hashlib.sha256(repaired.encode()).hexdigest())
    return set(out.values())


def test_cheapest_equals_brute_force():
    rng = random.Random(1)
    texts = ["a.", "b!", "c", " ", "a."]
    for _ in range(120):
        rows = [(rng.choice(["system", "user", "assistant", "tool", "u"]), rng.choice(texts)) for _ in range(rng.randint(0, 3))]
        (cost, audit, _), faults = brute_plan(rows)
        code = [2 if f in ("blank", "duplicate") else 1 if f else 0 for f in faults]
        got = cr.cheapest([(r[:1], f) for (r, _), f in reversed(list(zip(rows, code)))], len(rows))
        assert got == (cost, audit), rows


def test_shorter_audit_first_and_width():
    assert cr.cheapest([], 0) == (0, "")
    assert cr.cheapest([("u", 0)], 1) == (2, "D")
    n = 4000
    cost, audit = cr.cheapest([("a" if i % 2 == 0 else "u", 0) for i in range(n)], n)
    assert (cost, audit) == (0, "K" * n)


def test_query_equals_brute_force(spark):
    rng = random.Random(7)
    table = []
    for conv in range(60):
        roles = ["system"] * rng.randint(0, 1) + ["user", "assistant", "user", "assistant"]
        for turn, role in enumerate(roles[:rng.randint(1, 3)]):
            table.append((conv, rng.choice([turn, turn, turn + 3, None]), rng.choice([role, role, role, None, "", "Tool"]),
                          rng.choice(["Hello.", "What is it?", "cut off", None, "", "\x0b", "Ünï !", "x.\x0c"])))
    table += [(None, 1, "user", "Hi."), (None, 1, "assistant", "Yes."), (None, None, None, None)]
    table += [table[0]]
    rows = [(*r, "x", 1, 2, 3) for r in table]
    rng.shuffle(rows)
    got = cr.repair_damaged(spark.createDataFrame(rows, SCHEMA).repartition(4)).collect()
    assert got[0].__fields__ == [
        "conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    assert {tuple(r) for r in got} == brute(table) and len(got) == len({r[0] for r in table})


def test_all_dropped_and_empty_table(spark):
    gone = next(i for i in range(1000) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    got = cr.repair_damaged(spark.createDataFrame([(gone, 0, "user", "Hi.")], "conv_id long, turn long, role string, text string")).collect()
    assert [tuple(r) for r in got] == [(gone, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]
    assert cr.repair_damaged(spark.createDataFrame([], "conv_id long, turn long, role string, text string")).collect() == []


@pytest.mark.parametrize("kind", ["string", "int"])
def test_other_id_types(spark, kind):
    df = spark.createDataFrame([(1, 1, "user", "Hi. " * 50_000), (1, 2, "assistant", "Yes.")], "conv_id int, turn int, role string, text string")
    got = cr.repair_damaged(df.withColumn("conv_id", df.conv_id.cast(kind)).select("conv_id", "turn", "role", "text")).collect()
    assert len(got) == 1 and str(got[0].conv_id) == "1"
