"""SimHash near-duplicates by Golay-code fuzzy hashing.

A fingerprint has 64 bits: bit i is 1 if it is set in over half of the XXH64 values (seed
42) of the text's 3-word shingles, repeats included.  Fingerprints link at 2 or fewer
differing bits, and links are transitive.

1. Equal fingerprints are one node from the first aggregate on (partial aggregates, so a
   group of copies of any size is one row a task).
2. The 64 bits are cut in segments of 22, 21 and 21.  By pigeonhole 2 errors leave, in one
   of the cyclic pairs (1,2), (2,3), (3,1), the first segment without and the second with at
   most one error.  The second is a word of the perfect [23,12,7] Golay code (zero-padded):
   every word lies within 3 errors of exactly one codeword, and a word at 3 errors has five
   more codewords at 4.  Two words one error apart always share one of these codeword indices,
   and one of the two has it as its nearest.  So a fingerprint has one stored key and up to
   five more probing keys in each of three tables: (table, exact segment, codeword index).
3. Fingerprints meet by key (one shuffle); links are verified on all 64 bits and a bucket
   yields a spanning forest, never its pairs.  A bucket above ``SPLIT`` fingerprints is not
   gathered: its rows go on to a second round whose keys add the codeword indices of the third
   segment (2 errors there still share one within 4 errors), which splits it without loss.
   A bucket above ``DENSE`` looks up the words within 2 bits instead of comparing all.
4. Components over fingerprints; each takes the smallest doc_id of its documents.

Defined cases: no words (null, empty, white text) -> fingerprint zero, linked like any other; fewer than
3 words -> the whole sequence is the shingle; a null doc_id links like any other document, but does
not name a component unless no document in it has an id (component_id null then); repeated
rows come out each; extra columns are ignored; long texts are read in pieces.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.bytesops import LOWER
from tessera.llm.shared import components, cut_lineage

K, SEED, BITS = 3, 42, 2
PIECE = 1 << 20          # bytes of a text whose shingles are hashed at once
SPLIT = 1 << 20          # fingerprints of a bucket gathered in a task
DENSE = 1 << 12          # above: look up the words within 2 bits instead of comparing all
SEGMENTS = [(0, 22), (22, 21), (43, 21)]  # (shift, width)
PAIRS = [(0, 1), (1, 2), (2, 0)]          # (exact segment, segment with at most one error)
_GENERATOR = 0xC75       # x^11+x^10+x^6+x^5+x^4+x^2+1
_SPACE = re.compile(rb"[\x20\x09-\x0D]")
_FOLD = bytes(LOWER)
U = np.uint64


# ---- fingerprints

def _pieces(text: bytes) -> Iterator[list[bytes]]:
    """The words of a text in lists that overlap by K - 1 words."""
    at, carry = 0, []
    while at < len(text):
        cut = _SPACE.search(text, min(at + PIECE, len(text)))
        end = cut.start() if cut else len(text)
        words = carry + text[at:end].split()
        yield words
        carry, at = words[1 - K:], end
        if end == len(text):
            return


def fingerprint(text: str | None) -> int:
    """The 64-bit fingerprint of a text, unsigned."""
    data = (text or "").encode("utf-8", "surrogatepass").translate(_FOLD)
    ones, n, first = np.zeros(64, np.int64), 0, []
    for words in _pieces(data):
        first = words
        if len(words) >= K:
            h = np.fromiter((xxhash.xxh64_intdigest(b" ".join(s), SEED) for s in zip(*(words[i:] for i in range(K)))),
                            np.uint64, len(words) - K + 1)
            ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
            n += len(h)
    if not n:
        return xxhash.xxh64_intdigest(b" ".join(first), SEED) if first else 0
    return int(np.packbits(2 * ones > n, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, fp): the fingerprint as a signed 64-bit number."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = np.fromiter((fingerprint(t.as_py()) for t in b.column(1)), np.uint64, b.num_rows)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fp.view(np.int64))], names=["doc_id", "fp"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(run, f"doc_id {kind}, fp long")


# ---- Golay keys

def _remainders() -> np.ndarray:
    """Remainder modulo the generator of each 12-bit message shifted by 11."""
    out = np.arange(1 << 12, dtype=np.int64) << 11
    for i in range(22, 10, -1):
        out = np.where(out >> i & 1, out ^ (_GENERATOR << (i - 11)), out)
    return out


def _errors() -> np.ndarray:
    """For each 11-bit syndrome the error words of weight at most 4, lightest first; -1 fills."""
    table = np.full((1 << 11, 6), -1, np.int64)
    used = np.zeros(1 << 11, np.int64)
    for weight in range(5):
        for places in combinations(range(23), weight):
            word = sum(1 << p for p in places)
            s = int(_REMAINDER[word >> 11] ^ (word & 0x7FF))
            table[s, used[s]] = word
            used[s] += 1
    return table


_REMAINDER = _remainders()
_ERRORS = _errors()


def codewords(words: np.ndarray) -> np.ndarray:
    """Indices (0 to 4095) of the codewords within 4 errors of each word of up to 23 bits:
    the nearest first, then up to five more; -1 fills the rows."""
    e = _ERRORS[_REMAINDER[words >> 11] ^ (words & 0x7FF)]
    return np.where(e < 0, -1, (words[:, None] ^ e) >> 11)


def _segment(fp: np.ndarray, i: int) -> np.ndarray:
    shift, width = SEGMENTS[i]
    return ((fp >> U(shift)) & U((1 << width) - 1)).astype(np.int64)


def _keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        fp = b.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
        key, at, stored = [], [], []
        for t, (exact, fuzzy) in enumerate(PAIRS):
            code = codewords(_segment(fp, fuzzy))
            row, col = np.nonzero(code >= 0)
            key.append((t << 34 | _segment(fp, exact) << 12)[row] | code[row, col])
            at.append(row)
            stored.append(col == 0)
        at = np.concatenate(at)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate(key)), pa.array(np.zeros(len(at), np.int64)), pa.array(fp[at].view(np.int64)),
             pa.array(np.concatenate(stored))], names=["key", "more", "fp", "stored"])


def _refined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Keys of large buckets, with the codeword indices of the third segment added."""
    for b in batches:
        key = b.column(0).to_numpy(zero_copy_only=False)
        fp = b.column(1).to_numpy(zero_copy_only=False).view(np.uint64)
        third = np.array([3 - sum(p) for p in PAIRS])[key >> 34]
        word = np.choose(third, [_segment(fp, i) for i in range(3)])
        code = codewords(word)
        row, col = np.nonzero(code >= 0)
        yield pa.RecordBatch.from_arrays(
            [pa.array(key[row]), pa.array(1 + code[row, col]), pa.array(fp[row].view(np.int64)),
             pa.array(np.ones(len(row), bool))], names=["key", "more", "fp", "stored"])


# ---- links inside a bucket

def _masks() -> np.ndarray:
    one = [1 << i for i in range(64)]
    return np.array([a | b for a, b in combinations(one, 2)] + one, np.uint64)


def forest(fp: np.ndarray, dense: int = DENSE) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the links between distinct fingerprints."""
    left = np.sort(fp)
    a, b = [], []
    if len(left) <= dense:
        while len(left):
            queue, left = [left[0]], left[1:]
            while queue and len(left):
                c = queue.pop()
                near = np.bitwise_count(left ^ c) <= BITS
                if near.any():
                    found = left[near]
                    left = left[~near]
                    queue.extend(found)
                    a.append(np.full(len(found), c))
                    b.append(found)
    else:
        flips, open_ = _masks(), np.ones(len(left), bool)
        for i in range(len(left)):
            if not open_[i]:
                continue
            open_[i], queue = False, [left[i]]
            while queue:
                c = queue.pop()
                other = np.sort(c ^ flips)
                at = np.searchsorted(left, other)
                at[at == len(left)] = 0
                at = at[(left[at] == other) & open_[at]]
                if len(at):
                    open_[at] = False
                    queue.extend(left[at])
                    a.append(np.full(len(at), c))
                    b.append(left[at])
    none = np.zeros(0, np.uint64)
    return (np.concatenate(a), np.concatenate(b)) if a else (none, none)


def _meet(split: int | None, dense: int):
    """Sorted (key, more, fp, stored) -> links (a, b) and, of buckets above ``split``, the
    rows themselves (key, a)."""
    def out(key, a, b):
        return pa.RecordBatch.from_arrays([pa.array(key, pa.int64()), pa.array(a.view(np.int64)),
                                           pa.array(b.view(np.int64)) if b is not None else pa.nulls(len(a), pa.int64())],
                                          names=["key", "a", "b"])

    def closed(key, fps, stored) -> Iterator[pa.RecordBatch]:
        """Links of whole buckets."""
        border = np.flatnonzero(np.any(key[1:] != key[:-1], axis=1)) + 1
        lo, hi = np.append(0, border), np.append(border, len(key))
        has = np.logical_or.reduceat(stored, lo)
        ends_a, ends_b = [], []
        for i in np.flatnonzero((hi - lo > 1) & has):
            a, b = forest(np.unique(fps[lo[i]:hi[i]]), dense)
            ends_a.append(a)
            ends_b.append(b)
        if sum(map(len, ends_a)):
            a, b = np.concatenate(ends_a), np.concatenate(ends_b)
            yield out(np.full(len(a), -1), a, b)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, fps, stored = np.zeros((0, 2), np.int64), np.zeros(0, np.uint64), np.zeros(0, bool)
        over = None  # the key of a bucket that is passed on
        for batch in batches:
            c = [x.to_numpy(zero_copy_only=False) for x in batch.columns]
            key = np.concatenate([key, np.stack(c[:2], 1)])
            fps, stored = np.concatenate([fps, c[2].view(np.uint64)]), np.concatenate([stored, c[3]])
            if over is not None:
                n = int(np.argmax(np.append(np.any(key != over, axis=1), True)))
                if n:
                    yield out(key[:n, 0], fps[:n], None)
                key, fps, stored = key[n:], fps[n:], stored[n:]
                if not len(key):
                    continue
                over = None
            last = int(np.argmax(np.all(key == key[-1], axis=1)))  # the last bucket may go on
            if last:
                yield from closed(key[:last], fps[:last], stored[:last])
                key, fps, stored = key[last:], fps[last:], stored[last:]
            if split is not None and len(key) > split:
                over = key[0].copy()
                yield out(key[:, 0], fps, None)
                key, fps, stored = key[:0], fps[:0], stored[:0]
        if len(key):
            yield from closed(key, fps, stored)

    return run


def links(nodes: DataFrame, split: int = SPLIT, dense: int = DENSE) -> DataFrame:
    """(a, b): links that connect the same fingerprints as all links do.  ``nodes``: distinct fp."""
    def bucketed(keys: DataFrame, limit: int | None) -> DataFrame:
        return keys.repartition("key", "more").sortWithinPartitions("key", "more") \
            .mapInArrow(_meet(limit, dense), "key long, a long, b long")

    schema = "key long, more long, fp long, stored boolean"
    met = cut_lineage(bucketed(nodes.select("fp").mapInArrow(_keys, schema), split))
    found, large = met.where("b is not null").select("a", "b"), met.where("b is null").select("key", "a")
    if large.isEmpty():
        return found
    return found.union(bucketed(large.mapInArrow(_refined, schema), None).select("a", "b"))


def near_fingerprints(docs: DataFrame, split: int = SPLIT, dense: int = DENSE) -> DataFrame:
    """One row per document: doc_id, fingerprint (16 lowercase hex digits), component_id."""
    rows = cut_lineage(fingerprints(docs))
    nodes = cut_lineage(rows.groupBy("fp").agg(F.min("doc_id").alias("low")))
    joined = nodes.join(components(links(nodes, split, dense)).withColumnRenamed("id", "fp"), "fp", "left") \
        .select("fp", "low", F.coalesce("component", "fp").alias("component"))
    named = joined.select("fp", "component").join(joined.groupBy("component").agg(F.min("low").alias("component_id")), "component")
    return rows.join(named.select("fp", "component_id"), "fp").select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
