"""Rows packed as numpy matrices, for fits that read the same numbers many times.

``pack`` turns rows into blocks of a few thousand rows, each one row of a DataFrame with binary
columns; a pass over the data is then one numpy call a block and no row conversion.
``reduced`` sums what each partition makes of its blocks: one array a partition, added up in
about the square root of the partitions' number of tasks, so that the driver receives
few arrays of the model's size whatever the number of partitions.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.session import cut_lineage

BLOCK_ROWS = 8192
PART_ROWS, PART_VALUES = 20_000, 1 << 21  # rows of a partition of blocks; more for large tables, of at most so many numbers (16 MB)


def pack(df: DataFrame, features: Column, others: Sequence[str], dtype: str = "f8", rows: int = BLOCK_ROWS) -> DataFrame:
    """(n, x, other...): blocks of up to ``rows`` rows; x and the others (doubles) are the bytes of numpy arrays."""
    schema = ", ".join(["n int", "x binary", *(f"{c} binary" for c in others)])

    def matrix(b: pa.RecordBatch) -> np.ndarray:
        """The features of a batch; the values of its lists lie in one buffer, so no row becomes an object."""
        x = b.column("__x")
        length = x.value_lengths().to_numpy(zero_copy_only=False)
        if x.null_count or (length != length[0]).any():
            raise ValueError("rows differ in their number of features")
        return x.flatten().to_numpy(zero_copy_only=False).reshape(len(x), -1).astype(dtype)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0

        def block() -> pa.RecordBatch:
            cells = [np.concatenate(c).tobytes() for c in zip(*held)]
            return pa.RecordBatch.from_arrays([pa.array([n], pa.int32()), *(pa.array([c], pa.binary()) for c in cells)], ["n", "x", *others])

        for b in batches:
            for i in range(0, b.num_rows, rows):
                part = b.slice(i, rows)
                if n and n + part.num_rows > rows:
                    yield block()
                    held, n = [], 0
                held.append((matrix(part), *(part.column(c).to_numpy(zero_copy_only=False).astype("f8") for c in others)))
                n += part.num_rows
        if n:
            yield block()

    source = df.select(features.alias("__x"), *[F.col(c).cast("double").alias(c) for c in others])
    return cut_lineage(source.repartition(_partitions(source, len(others))).mapInArrow(run, schema))


def _partitions(source: DataFrame, others: int) -> int:
    """``PART_ROWS`` rows each; a table with many more partitions than two a core has larger ones, since a fit reads
    them dozens of times and a task that is soon done costs more than its rows."""
    n, rows, slots = source.count(), PART_ROWS, 2 * source.sparkSession.sparkContext.defaultParallelism
    if n > slots * rows:
        width = max(source.select(F.size("__x")).first()[0] or 0, 0) + others
        rows = max(rows, min(-(-n // slots), PART_VALUES // max(width, 1)))
    return max(1, -(-n // rows))


def array(cell: bytes, n: int, dtype: str = "f8") -> np.ndarray:
    """A block's cell as an array of n rows."""
    out = np.frombuffer(cell, dtype)
    return out if len(out) == n else out.reshape(n, -1)


def reduced(blocks: DataFrame, make: Callable[[pd.Series], np.ndarray],
            merge: Callable[[np.ndarray, np.ndarray], np.ndarray] = np.add) -> np.ndarray | None:
    """``make(block)``, an array of doubles of fixed length, over all blocks, added up or combined by
    ``merge`` (in any order); None without blocks."""
    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = None
        for b in batches:
            for i in range(len(b)):
                part = make(b.iloc[i])
                total = part if total is None else merge(total, part)
        if total is not None:
            yield pd.DataFrame({"v": [np.ascontiguousarray(total, "f8").tobytes()]})

    def add(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = None
        for b in batches:
            for v in b["v"]:
                part = np.frombuffer(v)
                total = part.copy() if total is None else merge(total, part)
        if total is not None:
            yield pd.DataFrame({"v": [total.tobytes()]})

    out = blocks.mapInPandas(partial, "v binary")
    parts = blocks.rdd.getNumPartitions()
    if parts > 64:
        out = out.repartition(math.isqrt(parts)).mapInPandas(add, "v binary")
    total = None
    for r in out.collect():
        part = np.frombuffer(r["v"])
        total = part.copy() if total is None else merge(total, part)
    return total
