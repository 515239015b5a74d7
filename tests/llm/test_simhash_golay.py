import random
import re

import numpy as np
import pytest
import xxhash

from tessera.llm import simhash_golay as sg

SCHEMA = "doc_id long, text string, fp long, key long, component string"


def plain_fingerprint(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    shingles = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] if len(words) > 2 else [" ".join(words)] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def reach(pairs_of, ids):
    """Smallest id reachable, by plain search."""
    out = {}
    for i in sorted(ids):
        if i in out:
            continue
        stack = [i]
        while stack:
            j = stack.pop()
            if j not in out:
                out[j] = i
                stack.extend(pairs_of(j))
    return out


def test_codewords_are_all_within_four_errors():
    code = np.array([(m << 11) | int(sg._REMAINDER[m]) for m in range(1 << 12)])
    distance = np.bitwise_count(code[:, None] ^ code[None, :200])
    assert distance[distance > 0].min() == 7
    words = np.random.default_rng(5).integers(0, 1 << 23, 400)
    for word, found in zip(words, sg.codewords(words)):
        d = np.bitwise_count(code ^ word)
        near = np.flatnonzero(d <= 4)
        assert set(found[found >= 0]) == set(near >> 0) and d[found[0]] == d.min() <= 3


def test_two_errors_always_share_a_stored_key():
    rng = np.random.default_rng(3)
    flips = np.append(sg._masks(), np.uint64(0))
    for fp in rng.integers(0, 2**64, 12, dtype=np.uint64):
        both = np.concatenate([[fp], fp ^ flips])
        batch = sg.pa.RecordBatch.from_arrays([sg.pa.array(both.view(np.int64))], names=["fp"])
        out = next(sg._keys([batch]))
        key, at, stored = (out.column(i).to_numpy(zero_copy_only=False) for i in (0, 2, 3))
        mine = {k: s for k, a, s in zip(key, at.view(np.uint64), stored) if a == fp}
        linked = {a for k, a, s in zip(key, at.view(np.uint64), stored) if k in mine and (s or mine[k])}
        assert linked >= set(both)


@pytest.mark.parametrize("split,dense", [(1 << 20, 1 << 12), (5, 1 << 12), (5, 4), (1 << 20, 4)])
def test_links_equal_brute_force(spark, split, dense):
    rng = random.Random(split + dense)
    fps = {0, 2**64 - 1}
    for _ in range(25):  # chains and balls around random centres
        c = rng.getrandbits(64)
        for _ in range(rng.choice([1, 4, 40])):
            fps.add(c)
            near = c
            for b in rng.sample(range(64), rng.choice([1, 2, 2, 3])):
                near ^= 1 << b
            fps.add(near)
            c = near if rng.random() < 0.5 else c
    fps = sorted(fps)
    signed = [f - (f >> 63 << 64) for f in fps]
    nodes = spark.createDataFrame([(f,) for f in signed], "fp long").repartition(4)
    got = {(r.a % 2**64, r.b % 2**64) for r in sg.links(nodes, split, dense).collect()}
    assert all(0 < (a ^ b).bit_count() <= 2 for a, b in got)
    back = {}
    for a, b in got:
        back.setdefault(a, []).append(b)
        back.setdefault(b, []).append(a)
    want = reach(lambda f: [g for g in fps if (f ^ g).bit_count() <= 2], fps)
    assert reach(lambda f: back.get(f, []), fps) == want


def documents():
    rng = random.Random(11)
    base = [" ".join(rng.choice("abcdefghij") * rng.randint(1, 5) + str(rng.randint(0, 60)) for _ in range(n)) for n in (3, 40, 400)]
    rows = [(5, None), (3, ""), (9, " \t\x0b\n"), (4, "One"), (14, "oNE"), (6, "one two"), (7, "é ü x Ÿ"), (8, "A b\x0cC d"), (2, "a B c D"),
            (20, base[2]), (21, base[2] + " tail"), (22, "head " + base[2]), (19, base[1]), (23, base[1]), (24, base[0]),
            (26, " ".join(["w"] * 5000)), (25, "x" * 20000), (30, None)]
    return [(i, t, 1, 2, "z") for i, t in rows]


def test_near_fingerprints_equal_brute_force(spark, monkeypatch):
    rows = documents()
    want_fp = {i: plain_fingerprint(t) for i, t, *_ in rows}
    want = reach(lambda i: [j for j in want_fp if (want_fp[i] ^ want_fp[j]).bit_count() <= 2], want_fp)
    got = sg.near_fingerprints(spark.createDataFrame(rows, SCHEMA).repartition(3)).collect()
    assert {(r.doc_id, r.fingerprint, r.component_id) for r in got} == {(i, f"{want_fp[i]:016x}", want[i]) for i in want_fp}
    assert want[30] == want[5] == 3
    monkeypatch.setattr(sg, "PIECE", 7)
    assert all(sg.fingerprint(t) == want_fp[i] for i, t, *_ in rows)


def test_null_and_repeated_ids_and_empty_table(spark):
    rows = [(None, "a b c d"), (None, "a b c d"), (7, "a b c d"), (7, "a b c d"), (None, "other words here now")]
    got = sg.near_fingerprints(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(((r.doc_id, r.component_id) for r in got), key=repr) == [(7, 7), (7, 7), (None, 7), (None, 7), (None, None)]
    assert sg.near_fingerprints(spark.createDataFrame([], "doc_id long, text string")).collect() == []
