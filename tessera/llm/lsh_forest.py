"""MinHash near-deduplication with an LSH forest.

Words are the runs of other characters than ``[\\x20\\x09-\\x0D]``, A-Z lower-cased; a
document's set holds its distinct 5-word shingles (fewer words: the whole sequence as
one; no word: empty, linked with nothing).  Documents whose sets have a Jaccard
similarity of at least ``percent`` / 100 are linked; a component's smallest doc_id stays.

1. *Classes.*  Documents with one and the same set (128-bit hash and size) are one class;
   the smallest doc_id represents it.  A group of exact copies of any size is one
   aggregated row from here on.
2. *Forest.*  ``trees(percent)`` trees (12 at 85, 16 at 80), each the sorted order of the representatives by
   their own ``DEPTH`` MinHash values: one range sort over (tree, values), and the length of the prefix
   that a row shares with the row before it, across the borders of the partitions too.  A
   maximal run of neighbours that share ``LEAST`` values or more is a region; all documents of a region are
   candidates, whatever its size.  A pair at the threshold is missed by all trees with a
   probability of at most ``MISS``, whatever the threshold.
3. *Loose groups.*  The documents of a region are looked at by their sketches; where these
   agree too little to reach the threshold (``SLACK`` below it, several standard errors)
   they are told apart, the rest is joined to loose groups by at most one edge per
   document.  Pairs are neither shuffled nor collected.  Depth adapts where a region holds more than
   ``REGION`` documents: each of them descends to the least depth at which the run of its prefix is
   smaller, and those runs are joined first, like small regions; a typical document takes in what is similar to it.
   Only what neither of them joined to the typical document's group is still open: it is compared with all of the region,
   in salted parts, every part of it with every part of the region in a task of its own.
4. *Confirmation.*  The whole texts of loose groups are read again and all links inside a
   group are decided on full shingle sets: documents are compared with one centre at a
   time, and a document that already is in the largest component need not be a centre.
   Nothing is capped: a group of more than ``BLOCK`` shingles is cut in blocks and every
   pair of blocks is confirmed in a task of its own.

Defined cases: null or empty text -> n_shingles 0, its own component; repeated rows come
out as often as they came in; a null doc_id is never linked and is its own component;
rows that share a doc_id but not the text are confirmed on the union of their sets (each
keeps its own n_shingles); empty table -> empty result; extra columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.bytesops import U64, flat, mix, shingle_sets
from tessera.llm.shared import components, cut_lineage, written
from tessera.operators.windows import ordinal

K = 5
PERCENT = 85
MISS = 1.1e-5
DEPTH = 8
LEAST = 3
REGION = 8192
PIVOT = 512
SLACK = 0.17
BLOCK = 4_000_000


def trees(percent: int) -> int:
    """As many trees as let all of them miss a pair at the threshold with a probability of MISS at most."""
    one = 1 - (percent / 100) ** LEAST
    return max(1, math.ceil(math.log(MISS) / math.log(one))) if one > 0 else 1


def _hashes(count: int) -> tuple[np.ndarray, np.ndarray]:
    """Multipliers and offsets of ``count`` MinHash functions."""
    rng = np.random.default_rng(85)
    a = rng.integers(0, 2**31, count, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
    return a[:, None], rng.integers(0, 2**32, count, dtype=np.uint32)[:, None]


def minhashes(s: np.ndarray, hashes: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """MinHash values (uint32) of a non-empty array of 64-bit shingle hashes."""
    mult, add = hashes
    x = (s >> U64(32)).astype(np.uint32)[None, :]
    out = None
    for a in range(0, x.shape[1], 1024):
        part = x[:, a:a + 1024] * mult
        part += add
        part ^= part >> np.uint32(15)
        part *= np.uint32(0x2C1B3C6D)
        low = part.min(axis=1)
        out = low if out is None else np.minimum(out, low)
    return out


def _id_text(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def signatures(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, set_hash (16 bytes; null for an empty set), signature (all
    MinHash values), sketch (their lowest bytes)."""
    hashes = _hashes(trees(percent) * DEPTH)

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size, digest, sig, sketch = [], [], [], []
            for s in shingle_sets(*flat(batch.column(1)), K):
                size.append(len(s))
                if len(s):
                    twice = mix(s ^ U64(0x5851F42D4C957F2D))
                    digest.append(np.array([s.sum(dtype=np.uint64), twice.sum(dtype=np.uint64)]).tobytes())
                    values = minhashes(s, hashes)
                    sig.append(values.astype("<u4").tobytes())
                    sketch.append(values.astype(np.uint8).tobytes())
                else:
                    digest.append(None)
                    sig.append(None)
                    sketch.append(None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(size, pa.int64()), *[pa.array(x, pa.binary()) for x in (digest, sig, sketch)]],
                ["doc_id", "n_shingles", "set_hash", "signature", "sketch"])

    return _id_text(docs).mapInArrow(
        sign, "doc_id long, n_shingles long, set_hash binary, signature binary, sketch binary")


def orders(reps: DataFrame, n_trees: int) -> DataFrame:
    """The trees' sorted orders: (part, pos, tree, rep, lcp, run, border), one row per representative and tree.

    ``lcp``: leading values shared with the row before in the same tree; 0 for a partition's first
    row, which ``regions`` completes.  ``run`` numbers the runs of lcp >= LEAST of a partition
    from 1; ``border`` holds the values of the first and last rows of the batches read."""

    def spell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = len(batch)
            v = np.frombuffer(b"".join(batch.column(1).to_pylist()), "<u4").reshape(n * n_trees, DEPTH).astype(">u4")
            data = v.tobytes()
            keys = pa.Array.from_buffers(pa.binary(4 * DEPTH), n * n_trees, [None, pa.py_buffer(data)]).cast(pa.binary())
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.tile(np.arange(n_trees, dtype=np.int32), n)), keys,
                 batch.column(0).take(pa.array(np.repeat(np.arange(n), n_trees)))], ["tree", "key", "rep"])

    def neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before, at, run = None, 0, 0
        for batch in batches:
            n = len(batch)
            if not n:
                continue
            tree = batch.column(1).to_numpy()
            keys = batch.column(2).to_pylist()
            v = np.column_stack([tree.astype(np.uint32), np.frombuffer(b"".join(keys), ">u4").reshape(n, DEPTH)])
            last = np.vstack([v[:1] + np.uint32(1) if before is None else before, v[:-1]])
            same = np.minimum.accumulate(v == last, axis=1)
            lcp = np.where(same[:, 0], same[:, 1:].sum(axis=1), 0).astype(np.int32)
            runs = run + np.cumsum(lcp < LEAST)
            border = [None] * n
            border[-1] = keys[-1]
            if before is None:
                border[0] = keys[0]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(np.arange(at, at + n)), batch.column(1), batch.column(3), pa.array(lcp),
                 pa.array(runs.astype(np.int64)), pa.array(border, pa.binary())],
                ["part", "pos", "tree", "rep", "lcp", "run", "border"])
            before, at, run = v[-1:], at + n, int(runs[-1])

    keys = reps.select("rep", "signature").mapInArrow(spell, "tree int, key binary, rep long")
    return keys.repartitionByRange("tree", "key", "rep").sortWithinPartitions("tree", "key", "rep") \
        .select(F.spark_partition_id().alias("part"), "tree", "key", "rep") \
        .mapInArrow(neighbours, "part int, pos long, tree int, rep long, lcp int, run long, border binary")


def _shared(a, b) -> int:
    """Leading values that two border rows (tree, values) share."""
    if a["tree"] != b["tree"]:
        return 0
    x, y = np.frombuffer(a["border"], ">u4"), np.frombuffer(b["border"], ">u4")
    return int(np.minimum.accumulate(x == y).sum())


def regions(reps: DataFrame, n_trees: int) -> DataFrame:
    """(rep, tree, lcp, region): a region is a maximal run of a tree's order whose neighbours share ``LEAST``
    leading values or more.  ``reps``: rep, signature."""
    order = written(orders(reps, n_trees), "forest")
    # one row a partition: its first and last values and its number of runs
    ends = order.groupBy("part").agg(
        F.min_by(F.struct("tree", "border"), "pos").alias("first"), F.max("run").alias("runs"),
        F.max_by(F.struct("tree", "border"), F.when(F.col("border").isNotNull(), F.col("pos"))).alias("last")).orderBy("part").collect()
    shift, before, total = [], None, 0
    for e in ends:
        lcp = _shared(before, e["first"]) if before else 0
        start = total - (lcp >= LEAST)  # the first run goes on with the last one of the partition before
        shift.append((e["part"], lcp, start))
        before, total = e["last"], start + e["runs"]
    borders = reps.sparkSession.createDataFrame(shift, "part int, b_lcp int, start long")
    return order.join(F.broadcast(borders), "part").select(
        "rep", "tree", F.when(F.col("pos") == 0, F.col("b_lcp")).otherwise(F.col("lcp")).alias("lcp"),
        (F.col("start") + F.col("run")).alias("region"))


def deeper(large: DataFrame, reps: DataFrame, n_trees: int) -> DataFrame:
    """(rep, region): the documents of regions above REGION by the least depth whose run is smaller; a document
    whose run is too large, or alone, at every depth has no row.  ``large``: region, tree, rep."""

    def descend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        levels = DEPTH - LEAST
        for batch in batches:
            n = len(batch)
            tree = batch.column(1).to_numpy()
            v = np.frombuffer(b"".join(batch.column(3).to_pylist()), "<u4").reshape(n, n_trees, DEPTH)[np.arange(n), tree].astype(np.uint64)
            h, out = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64).copy(), []
            for d in range(DEPTH):
                h = mix((h + v[:, d]) * U64(0xD6E8FEB86659FD93) + U64(d + 1))
                if d >= LEAST:
                    out.append(h)
            yield pa.RecordBatch.from_arrays(
                [batch.column(2).take(pa.array(np.repeat(np.arange(n), levels))), pa.array(np.tile(np.arange(LEAST + 1, DEPTH + 1, dtype=np.int32), n)),
                 pa.array(np.stack(out, 1).ravel().view(np.int64))], ["rep", "depth", "cell"])

    cells = cut_lineage(large.join(reps.select("rep", "signature"), "rep").select("region", "tree", "rep", "signature")
                        .mapInArrow(descend, "rep long, depth int, cell long"))
    fit = cells.groupBy("cell").agg(F.count(F.lit(1)).alias("m")).where(F.col("m").between(2, REGION))
    return cells.join(fit, "cell").groupBy("rep").agg(F.min_by("cell", "depth").alias("region"))


def _runs(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[pa.Table]:
    """The rows of each group of a partition that is sorted by its first ``keys`` columns."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not len(batch):
            continue
        new = np.zeros(len(batch), bool)
        for k in range(keys):
            v = batch.column(k).to_numpy(zero_copy_only=False)
            new[1:] |= v[1:] != v[:-1]
            new[0] |= not held or held[-1].column(k)[-1].as_py() != v[0]
        cuts = [*np.flatnonzero(new).tolist(), len(batch)]
        if held and cuts[0] == 0:
            yield pa.Table.from_batches(held)
            held = []
        if cuts[0] > 0:
            held.append(batch.slice(0, cuts[0]))
            if len(cuts) == 1:
                continue
            if cuts[0] < len(batch):
                yield pa.Table.from_batches(held)
                held = []
        for a, b in zip(cuts[:-2], cuts[1:-1], strict=True):
            yield pa.Table.from_batches([batch.slice(a, b - a)])
        if cuts[0] < len(batch):
            held = [batch.slice(cuts[-2], cuts[-1] - cuts[-2])]
    if held:
        yield pa.Table.from_batches(held)


def _forest(group_of: int, near) -> list[tuple[int, int]]:
    """Edges that join ``group_of`` items wherever near(c, others) -> those similar to c says
    so.  An item that the largest group has taken in before its turn needs no turn: any
    other item compares itself with it."""
    group, done, edges = np.arange(group_of), np.zeros(group_of, bool), []
    c = 0
    while True:
        done[c] = True
        others = np.flatnonzero(~done & (group != group[c]))
        if len(others):
            found = near(c, others)
            joined, first = np.unique(group[found], return_index=True)
            edges += [(c, int(found[i])) for i in first]
            group[np.isin(group, joined)] = group[c]
        rest = np.flatnonzero(~done & (group != np.bincount(group).argmax()))
        if not len(rest):
            return edges
        c = int(rest[0])


def _edge_batch(edges: list[tuple[int, int]]) -> pa.RecordBatch:
    e = np.array(edges, np.int64).reshape(-1, 2)
    return pa.RecordBatch.from_arrays([pa.array(e[:, 0]), pa.array(e[:, 1])], ["a", "b"])


def _sketches(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(len(column), -1)


def _need(percent: int) -> float:
    """Values in which the sketches of two documents of a loose group agree at least."""
    return (percent / 100 - SLACK) * trees(percent) * DEPTH


def _typical_first(rep: np.ndarray, sketch: np.ndarray) -> np.ndarray:
    usual = np.array([np.bincount(col).argmax() for col in sketch.T], np.uint8)
    return np.lexsort((rep, -(sketch == usual).sum(axis=1)))


def _loose_edges(percent: int):
    """Joins the documents of a region whose sketches agree enough, by one edge per document at most."""
    need = _need(percent)

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        edges: list[tuple[int, int]] = []
        for t in _runs(batches, 1):
            rep, sketch = t.column("rep").to_numpy(), _sketches(t.column("sketch"))
            if len(rep) > 2:  # typical documents first: they are near to most others
                order = _typical_first(rep, sketch)
                rep, sketch = rep[order], sketch[order]
            edges += [(int(rep[i]), int(rep[j])) for i, j in _forest(
                len(rep), lambda c, o, s=sketch: o[(s[o] == s[c]).sum(axis=1) >= need])]
            if len(edges) > 10_000:
                yield _edge_batch(edges)
                edges = []
        yield _edge_batch(edges)

    return join


def _large_edges(large: DataFrame, near: DataFrame, percent: int) -> DataFrame:
    """The loose edges of regions of more than REGION documents.  ``large``: region, rep, sketch, n;
    ``near``: edges (a, b) already found, which spare the documents they join to a typical one."""
    need = _need(percent)

    def pivot(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in _runs(batches, 1):
            rep = t.column("rep").to_numpy()
            at = _typical_first(rep, _sketches(t.column("sketch")))[0]
            yield t.slice(int(at), 1).rename_columns(["region", "pivot", "p_sketch"]).combine_chunks().to_batches()[0]

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            inside = np.zeros(len(batch), bool)
            some = batch.column("p_sketch").is_valid().to_numpy(zero_copy_only=False)
            if some.any():
                part = batch.filter(pa.array(some))
                inside[some] = (_sketches(part.column("sketch")) == _sketches(part.column("p_sketch"))).sum(axis=1) >= need
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in ("region", "rep", "sketch", "n", "pivot")], pa.array(inside)],
                ["region", "rep", "sketch", "n", "pivot", "inside"])

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in _runs(batches, 3):
            every, turn = t.column("rep").to_numpy(), t.column("turn").to_numpy(zero_copy_only=False)
            rep, at = np.unique(every, return_index=True)
            sketch, inside = _sketches(t.column("sketch"))[at], t.column("inside").to_numpy(zero_copy_only=False)[at]
            group, edges = np.arange(len(rep)), []
            group[inside] = len(rep)  # joined to the pivot
            for c in np.flatnonzero(np.isin(rep, every[turn])):
                others = np.flatnonzero(group != group[c])
                found = others[(sketch[others] == sketch[c]).sum(axis=1) >= need]
                joined, first = np.unique(group[found], return_index=True)
                edges += [(int(rep[c]), int(rep[found[i]])) for i in first]
                group[np.isin(group, joined)] = group[c]
            yield _edge_batch(edges)

    # a sample of about PIVOT documents a region shows which one is typical
    shown = large.where(F.pmod(F.xxhash64("rep"), F.ceil(F.col("n") / PIVOT)) == 0)
    pivots = shown.select("region", "rep", "sketch").repartition("region").sortWithinPartitions("region") \
        .mapInArrow(pivot, "region long, pivot long, p_sketch binary")
    marked = cut_lineage(large.join(pivots, "region", "left").select("region", "rep", "sketch", "n", "pivot", "p_sketch")
                         .mapInArrow(mark, "region long, rep long, sketch binary, n long, pivot long, inside boolean"))
    star = marked.where("inside and rep <> pivot").select(F.col("pivot").alias("a"), F.col("rep").alias("b"))
    # what hangs together with the pivot by any edge found so far needs no turn
    known = components(star.union(near))
    marked = cut_lineage(
        marked.join(known.select(F.col("id").alias("rep"), F.col("component").alias("own")), "rep", "left")
        .join(known.select(F.col("id").alias("pivot"), F.col("component").alias("its")), "pivot", "left")
        .select("region", "rep", "sketch", "n", "pivot", (F.col("inside") | F.coalesce(F.col("own") == F.col("its"), F.lit(False))).alias("inside")))
    left = marked.where("not inside").groupBy("region").agg(F.count(F.lit(1)).alias("m"))
    rows = marked.join(left, "region").select(
        "region", "rep", "sketch", "inside", F.ceil(F.col("n") / REGION).cast("int").alias("parts"),
        F.ceil(F.col("m") / REGION).cast("int").alias("own"))
    salt = F.xxhash64("rep", F.lit(7))
    each = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    cells = rows.select("region", each("own").alias("i"), F.pmod(salt, F.col("parts")).cast("int").alias("j"),
                        "rep", "sketch", "inside", F.lit(False).alias("turn")).union(
        rows.where("not inside").select("region", F.pmod(salt, F.col("own")).cast("int").alias("i"), each("parts").alias("j"),
                                        "rep", "sketch", "inside", F.lit(True).alias("turn")))
    return star.union(cells.repartition("region", "i", "j").sortWithinPartitions("region", "i", "j")
                      .mapInArrow(meet, "a long, b long"))


def loose_groups(reps: DataFrame, percent: int = PERCENT) -> DataFrame:
    """(id, component) of representatives that may be similar.  ``reps``: rep, signature, sketch."""
    level = regions(reps, trees(percent))
    size = level.groupBy("region").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    inside, sketch = level.join(size, "region"), reps.select("rep", "sketch")

    def near(members: DataFrame) -> DataFrame:
        return members.join(sketch, "rep").select("region", "rep", "sketch").repartition("region").sortWithinPartitions("region") \
            .mapInArrow(_loose_edges(percent), "a long, b long")

    edges = near(inside.where(F.col("n") <= REGION).select("region", "rep"))
    large = cut_lineage(inside.where(F.col("n") > REGION).select("region", "tree", "rep", "n"))
    if not large.isEmpty():
        first = cut_lineage(near(deeper(large, reps, trees(percent))))
        edges = edges.union(first).union(_large_edges(large.join(sketch, "rep").select("region", "rep", "sketch", "n"), first, percent))
    return components(edges)


def _links(ids: list[int], sets: list[np.ndarray], percent: int) -> list[tuple[int, int]]:
    """A spanning forest of the links between documents, decided on full sets."""
    size = np.array([len(s) for s in sets], np.int64)
    start = np.cumsum(size) - size
    at = np.unique(np.concatenate(sets), return_inverse=True)[1]
    common = np.add.reduceat(np.bincount(at)[at], start) / size
    order = np.lexsort((ids, -common))  # typical documents first
    sets = [at[start[i]:start[i] + size[i]] for i in order]
    size = size[order]
    joint, start = np.concatenate(sets), np.cumsum(size) - size
    mark = np.zeros(int(at.max()) + 1, bool)

    def near(c: int, others: np.ndarray) -> np.ndarray:
        mark[sets[c]] = True
        inter = np.add.reduceat(mark[joint], start, dtype=np.int64)[others] if len(others) > 8 else \
            np.array([np.count_nonzero(mark[sets[o]]) for o in others], np.int64)
        mark[sets[c]] = False
        return others[100 * inter >= percent * (size[others] + size[c] - inter)]

    return [(ids[order[i]], ids[order[j]]) for i, j in _forest(len(sets), near)]


def confirmed(docs: DataFrame, loose: DataFrame, reps: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) on full sets inside the loose groups."""
    weight = loose.join(reps.select(F.col("rep").alias("id"), "n_shingles"), "id")
    total = weight.groupBy("component").agg(F.sum("n_shingles").alias("all"))
    # a group above BLOCK shingles: every two of its n blocks meet in a task of their own
    n = F.ceil(F.col("all") / BLOCK).cast("int")
    member = weight.join(total, "component").select(
        "id", "component", n.alias("n"), F.pmod(F.xxhash64("id"), n).cast("int").alias("mine")).distinct()
    other = F.explode(F.sequence(F.lit(0), F.col("n") - 1))
    parts = _id_text(docs).withColumnRenamed("doc_id", "id").join(member, "id") \
        .select("id", "text", "component", "mine", other.alias("other")) \
        .select("component", F.least("mine", "other").alias("i"), F.greatest("mine", "other").alias("j"), "id", "text")

    def decide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in _runs(batches, 3):
            sets: dict[int, np.ndarray] = {}
            for i, s in zip(t.column("id").to_pylist(), shingle_sets(*flat(t.column("text")), K), strict=True):
                if len(s):
                    sets[i] = np.union1d(sets[i], s) if i in sets else s
            if len(sets) > 1:
                yield _edge_batch(_links(list(sets), list(sets.values()), percent))

    return parts.repartition("component", "i", "j").sortWithinPartitions("component", "i", "j") \
        .mapInArrow(decide, "a long, b long")


def near_groups(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept, class_id (smallest
    doc_id with the same set)."""
    rows = cut_lineage(signatures(docs, percent))
    classes = cut_lineage(rows.where("set_hash is not null and doc_id is not null").groupBy("set_hash", "n_shingles").agg(
        F.min("doc_id").alias("rep"), F.min("signature").alias("signature"), F.min("sketch").alias("sketch")))
    links = components(confirmed(docs, loose_groups(classes, percent), classes, percent))
    out = rows.select("doc_id", "set_hash", "n_shingles") \
        .join(classes.select("set_hash", "n_shingles", "rep"), ["set_hash", "n_shingles"], "left") \
        .join(links.select(F.col("id").alias("rep"), "component"), "rep", "left")
    own = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "rep", "doc_id"))
    return out.select("doc_id", "n_shingles", own.alias("component_id"), F.col("doc_id").eqNullSafe(own).alias("kept"),
                      F.when(F.col("doc_id").isNotNull(), F.coalesce("rep", "doc_id")).alias("class_id"))


def drop_near_copies(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """One document of each component stays, with all columns of ``docs``.  Texts that share a
    doc_id are documents of their own here; null ids are never linked and stay."""
    own = F.xxhash64(F.col("text").cast("string"))
    many = cut_lineage(docs.where("doc_id is not null").select("doc_id", own.alias("own")).distinct()
                       .groupBy("doc_id").count().where("count > 1").select("doc_id"))
    if many.isEmpty():
        gone = near_groups(docs, percent).where(~F.col("kept")).select(F.col("doc_id").alias("gone_id")).distinct()
        return docs.join(gone, docs["doc_id"] == F.col("gone_id"), "left_anti")
    # numbers in the order of (doc_id, text) stand for the ids
    number = cut_lineage(ordinal(docs.where("doc_id is not null").select(F.col("doc_id").alias("n_id"), own.alias("n_text")).distinct(),
                                 [], ["n_id", "n_text"], "number"))
    as_numbered = docs.join(number, (docs["doc_id"] == F.col("n_id")) & (own == F.col("n_text")), "left") \
        .select(F.col("number").alias("doc_id"), "text")
    gone = near_groups(as_numbered, percent).where(~F.col("kept")).select(F.col("doc_id").alias("number")).distinct() \
        .join(number, "number").select("n_id", "n_text")
    return docs.join(gone, (docs["doc_id"] == F.col("n_id")) & (own == F.col("n_text")), "left_anti")
