"""Best-fit packing with large-item matching into sequences of a fixed token capacity.

Documents are token ids plus an end id; only a document longer than the capacity is cut,
into pieces of the capacity and a last shorter one.  Pieces above a third of the capacity
("large") fit at most twice into a sequence: from the longest down, each is matched with
the longest large partner that still fits.  The other pieces, longest first, go to the
smallest gap that holds them, or open a sequence.

The plan needs the number of pieces of each length only -- at most ``capacity`` numbers,
whatever the size of the corpus -- so it is made on the driver from that histogram, as
runs "the next n pieces of this length go to these sequences".  Spark ranks the pieces of
each length (row numbers inside hash chunks plus chunk offsets, so a length held by a
third of all pieces is still spread over all tasks) and looks every rank up in the runs.

Defined cases: null or empty text -> a piece holding the end id; empty table -> empty
result; repeated rows are packed one by one; extra columns are ignored.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.bytesops import flat
from tessera.llm.shared import cut_lineage, running_offset, tasks
from tessera.llm.tokens import VOCABULARY, encoder, vocabulary_path

CAPACITY = 2048


def token_pieces(docs: DataFrame, vocabulary: str = VOCABULARY, end_id: int = 0, capacity: int = CAPACITY) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 of every piece."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(vocabulary_path(vocabulary))
        for batch in batches:
            row, piece, length, crc = [], [], [], []
            for d, ids in enumerate(enc.encode(*flat(batch.column(1)))):
                ids = np.append(ids, end_id).astype("<u4")
                for p, a in enumerate(range(0, len(ids), capacity)):
                    part = ids[a:a + capacity]
                    row.append(d)
                    piece.append(p)
                    length.append(len(part))
                    crc.append(zlib.crc32(part.tobytes()))
            at = np.array(piece, np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(row, pa.int64())), pa.array(piece, pa.int32()), pa.array(at * capacity),
                 pa.array(length, pa.int64()), pa.array(crc, pa.int64())],
                ["doc_id", "piece", "start", "length", "ids_crc32"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")) \
        .mapInArrow(cut, "doc_id long, piece int, start long, length long, ids_crc32 long")


def plan_runs(count: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int, int]]:
    """Runs (length, first rank, n, first sequence, pieces per sequence, offset): rank r of
    the run goes to sequence ``first + (r - rank) // per`` at ``offset + (r - rank) % per * length``."""
    left = {k: v for k, v in count.items() if v > 0}
    rank: dict[int, int] = defaultdict(int)
    runs, gaps, bins = [], defaultdict(list), 0  # gap -> ranges [first sequence, number]

    def put(length: int, n: int, first: int, per: int, offset: int) -> None:
        runs.append((length, rank[length], n, first, per, offset))
        rank[length] += n
        left[length] -= n

    def gap(size: int, first: int, n: int) -> None:
        if size and n:
            gaps[size].append([first, n])

    large = sorted((k for k in left if 3 * k > capacity), reverse=True)
    for a in large:
        for b in (x for x in large if x <= min(a, capacity - a)):  # longest partner first
            n = left[a] // 2 if a == b else min(left[a], left[b])
            if n and a == b:
                put(a, 2 * n, bins, 2, 0)
            elif n:
                put(a, n, bins, 1, 0)
                put(b, n, bins, 1, a)
            gap(capacity - a - b, bins, n)
            bins += n
        if left[a]:
            n = left[a]
            put(a, n, bins, 1, 0)
            gap(capacity - a, bins, n)
            bins += n
    for s in sorted((k for k in left if 3 * k <= capacity), reverse=True):
        while left[s]:
            fit = min((g for g in gaps if g >= s), default=None)
            if fit is None:
                n = -(-left[s] // (capacity // s))
                gaps[capacity].append([bins, n])
                bins += n
                continue
            first, n = gaps[fit].pop()
            if not gaps[fit]:
                del gaps[fit]
            per = fit // s
            full = min(n, left[s] // per)
            if full:
                put(s, full * per, first, per, capacity - fit)
                gap(fit - per * s, first, full)
            rest = left[s] if full < n else 0
            if rest:
                rest = min(rest, per)
                put(s, rest, first + full, rest, capacity - fit)
                gap(fit - rest * s, first + full, 1)
            gap(fit, first + full + (1 if rest else 0), n - full - (1 if rest else 0))
    return runs


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` (any columns with doc_id, piece, length) plus sequence_id and offset."""
    spark = pieces.sparkSession
    rows = cut_lineage(pieces.withColumn("chunk", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(tasks(spark))).cast("int")))
    count = rows.groupBy("length", "chunk").agg(F.count(F.lit(1)).alias("n"))
    histogram = {r.length: r.n for r in rows.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    runs = plan_runs(histogram, capacity)
    plan = F.broadcast(spark.createDataFrame(
        runs, "length long, rank long, n long, first long, per long, offset0 long"))  # bounded by the capacity
    ranked = rows.withColumn("inner", F.row_number().over(
        Window.partitionBy("length", "chunk").orderBy("doc_id", "piece")) - 1)
    ranked = ranked.join(running_offset(count, ["length"], "chunk", "n", "before"), ["length", "chunk"]) \
        .withColumn("r", F.col("inner") + F.col("before")).drop("inner", "before", "chunk")
    step = F.col("r") - F.col("rank")
    return ranked.join(plan, "length").where((step >= 0) & (step < F.col("n"))) \
        .withColumn("sequence_id", F.col("first") + F.floor(step / F.col("per"))) \
        .withColumn("offset", F.col("offset0") + F.pmod(step, F.col("per")) * F.col("length")) \
        .drop("r", "rank", "n", "first", "per", "offset0")


def pack_documents(docs: DataFrame, vocabulary: str = VOCABULARY, end_id: int = 0, capacity: int = CAPACITY) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset of every piece."""
    return pack(token_pieces(docs, vocabulary, end_id, capacity), capacity).select(
        "doc_id", "piece", "start", "length", "ids_crc32", F.col("sequence_id").cast("long").alias("sequence_id"),
        F.col("offset").cast("long").alias("offset"))
