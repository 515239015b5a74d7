"""Token-id files: zstandard frames per document under one shared dictionary.

``write_tokens`` encodes whole texts, appends the end id, serialises each id array as
little-endian integers of 2 bytes (4 where the vocabulary needs it), and compresses each
document by itself with a zstandard dictionary trained on serialised id arrays of a
bounded hash sample (``sample_docs`` documents; lossless, so the sample affects size
only).  Documents are ordered by doc_id: bucket borders are approximate quantiles of
doc_id, tasks compress before the shuffle, and each bucket is one file's run of blocks.

Layout below ``path`` (Parquet as the container, so any store Spark reaches will do):

* ``dictionary``: one row -- dict_sha256, dictionary, width, vocabulary, end_id
* ``blocks``: bucket, block, start (ids of the bucket before the block), doc_ids,
  n_tokens, offsets (byte offset of each document's frame, one more than documents),
  payload (the frames, concatenated), dict_sha256

``read_document`` decodes one short document: column statistics of first_id / last_id
prune the blocks, the offset index cuts its frame out of the payload.

Defined cases: null or empty text -> the end id alone; null doc_id sorts first; rows
repeated keep one entry each; an empty table writes no blocks; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.llm.bytesops import flat
from tessera.llm.shared import tasks
from tessera.llm.tokens import VOCABULARY, encoder, vocabulary_path

DICT_BYTES = 1 << 16
SAMPLE_DOCS = 2000
SAMPLE_IDS = 1 << 14  # ids of a sampled document given to the trainer
BLOCK_BYTES = 1 << 18
BLOCK_DOCS = 4096
LEVEL = 3

_BLOCKS = ("bucket int, block int, start long, first_id long, last_id long, doc_ids array<long>, "
           "n_tokens array<long>, offsets array<long>, payload binary, dict_sha256 string")


@lru_cache(maxsize=4)
def _dictionary(data: bytes):
    import zstandard

    d = zstandard.ZstdCompressionDict(data, dict_type=zstandard.DICT_TYPE_AUTO)
    if data:
        d.precompute_compress(level=LEVEL)
    return d


def _compressor(data: bytes):
    import zstandard

    return zstandard.ZstdCompressor(level=LEVEL, dict_data=_dictionary(data), write_content_size=True) if data \
        else zstandard.ZstdCompressor(level=LEVEL, write_content_size=True)


def _decompressor(data: bytes):
    import zstandard

    return zstandard.ZstdDecompressor(dict_data=_dictionary(data)) if data else zstandard.ZstdDecompressor()


def train_dictionary(docs: DataFrame, vocabulary: str, end_id: int, sample_docs: int = SAMPLE_DOCS,
                     dict_bytes: int = DICT_BYTES) -> tuple[bytes, int]:
    """(dictionary bytes, id width).  The sample is the documents with a small hash of
    doc_id, so it spreads over the table and does not depend on its layout.  Too few or
    too short documents for the trainer: an empty dictionary (plain frames)."""
    import zstandard

    width = 2 if encoder(vocabulary_path(vocabulary)).whole.get_vocab_size() <= 1 << 16 else 4
    total = docs.count()
    share = F.pmod(F.xxhash64(F.col("doc_id"), F.lit(7)), F.lit(1 << 30)) < int((1 << 30) * min(1.0, sample_docs / max(total, 1)))

    def ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(vocabulary_path(vocabulary))
        for batch in batches:
            out = [np.append(x, end_id)[:SAMPLE_IDS].astype(f"<u{width}").tobytes() for x in enc.encode(*flat(batch.column(0)))]
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["ids"])

    rows = [bytes(r.ids) for r in docs.where(share).select(F.col("text").cast("string").alias("text"))
            .mapInArrow(ids, "ids binary").limit(2 * sample_docs).collect()]
    try:
        return zstandard.train_dictionary(dict_bytes, sorted(rows), level=LEVEL).as_bytes(), width
    except zstandard.ZstdError:  # not enough sample data
        return b"", width


def write_tokens(docs: DataFrame, path: str, vocabulary: str = VOCABULARY, end_id: int = 1,
                 buckets: int | None = None, sample_docs: int = SAMPLE_DOCS) -> None:
    """Write the token files of ``docs`` (doc_id, text) below ``path``."""
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    data, width = train_dictionary(docs, vocabulary, end_id, sample_docs)
    sha = hashlib.sha256(data).hexdigest()
    spark.createDataFrame([(sha, bytearray(data), width, vocabulary, end_id)],
                          "dict_sha256 string, dictionary binary, width int, vocabulary string, end_id int") \
        .coalesce(1).write.parquet(f"{path}/dictionary")

    n = buckets or tasks(spark)
    cuts = docs.agg(F.percentile_approx("doc_id", [i / n for i in range(1, n)] or [0.5], 10 * n)).first()[0] or []
    cuts = np.array(sorted(set(cuts)) if n > 1 else [], np.int64)
    shared = spark.sparkContext.broadcast(data)  # DICT_BYTES at most

    def compress(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, zip_ = encoder(vocabulary_path(vocabulary)), _compressor(shared.value)
        for batch in batches:
            key = batch.column(0)
            bucket = np.searchsorted(cuts, key.fill_null(-(1 << 63)).to_numpy(zero_copy_only=False), "right") \
                if len(cuts) else np.zeros(len(key), np.int64)
            count, frames = [], []
            for ids in enc.encode(*flat(batch.column(1))):
                count.append(len(ids) + 1)
                frames.append(zip_.compress(np.append(ids, end_id).astype(f"<u{width}").tobytes()))
            yield pa.RecordBatch.from_arrays(
                [pa.array(bucket, pa.int32()), key, pa.array(count, pa.int64()), pa.array(frames, pa.binary())],
                ["bucket", "doc_id", "n_tokens", "frame"])

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket, block, start, size = None, 0, 0, 0
        ids: list = []
        counts: list[int] = []
        frames: list[bytes] = []

        def full():
            offsets = [0, *np.cumsum([len(f) for f in frames]).tolist()]
            known = [i for i in ids if i is not None]
            row = [[bucket], [block], [start], [known[0] if known else None], [known[-1] if known else None], [ids],
                   [counts], [offsets], [b"".join(frames)], [sha]]
            kinds = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), *[pa.list_(pa.int64())] * 3,
                     pa.binary(), pa.string()]
            return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(row, kinds, strict=True)],
                                              [c.split()[0] for c in _BLOCKS.split(", ")])

        for batch in batches:
            for b, i, c, f in zip(*(batch.column(k).to_pylist() for k in range(4)), strict=True):
                if ids and (b != bucket or size >= BLOCK_BYTES or len(ids) >= BLOCK_DOCS):
                    yield full()
                    block, start, size = (block + 1, start + sum(counts), 0) if b == bucket else (0, 0, 0)
                    ids, counts, frames = [], [], []
                bucket = b
                ids.append(i)
                counts.append(c)
                frames.append(f)
                size += len(f)
        if ids:
            yield full()

    (docs.mapInArrow(compress, "bucket int, doc_id long, n_tokens long, frame binary")
     .repartitionById(n, F.col("bucket")).sortWithinPartitions("bucket", "doc_id", "frame")  # rows of one id follow their bytes
     .mapInArrow(blocks, _BLOCKS).write.option("compression", "none").parquet(f"{path}/blocks"))


def _meta(spark: SparkSession, path: str):
    return spark.read.parquet(f"{path}/dictionary").first()


def read_index(spark: SparkSession, path: str) -> DataFrame:
    """Decode all files: doc_id, start (ids of all documents before it), n_tokens,
    ids_crc32 (of the ids as little-endian unsigned 32-bit integers).  Raises if a block was written
    with another dictionary or a document does not have as many ids as the index says."""
    meta = _meta(spark, path)
    sha = hashlib.sha256(bytes(meta.dictionary)).hexdigest()
    shared, width = spark.sparkContext.broadcast(bytes(meta.dictionary)), meta.width
    blocks = spark.read.schema(_BLOCKS).parquet(f"{path}/blocks")
    total = blocks.select("bucket", F.aggregate("n_tokens", F.lit(0).cast("long"), lambda a, x: a + x).alias("n")) \
        .groupBy("bucket").agg(F.sum("n").alias("n"))
    # one row per bucket
    before = total.select("bucket", F.coalesce(F.sum("n").over(
        Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unzip = _decompressor(shared.value)
        for batch in batches:
            for row in batch.to_pylist():
                if row["dict_sha256"] != sha:
                    raise ValueError("the block was written with another dictionary")
                crc, found = [], []
                for a, b in zip(row["offsets"], row["offsets"][1:], strict=False):
                    ids = np.frombuffer(unzip.decompress(row["payload"][a:b]), f"<u{width}")
                    found.append(len(ids))
                    crc.append(zlib.crc32(ids.astype("<u4").tobytes()))
                if found != row["n_tokens"]:
                    raise ValueError("the index does not fit the documents")
                counts = np.array(found, np.int64)
                n = len(counts)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row["bucket"]] * n, pa.int32()), pa.array(row["doc_ids"], pa.int64()),
                     pa.array(row["start"] + np.cumsum(counts) - counts, pa.int64()), pa.array(counts, pa.int64()),
                     pa.array(crc, pa.int64())], ["bucket", "doc_id", "inner", "n_tokens", "ids_crc32"])

    rows = blocks.select("bucket", "start", "doc_ids", "n_tokens", "offsets", "payload", "dict_sha256") \
        .mapInArrow(decode, "bucket int, doc_id long, inner long, n_tokens long, ids_crc32 long")
    return rows.join(F.broadcast(before), "bucket").select(  # as many rows as buckets
        "doc_id", (F.col("inner") + F.col("before")).cast("long").alias("start"), "n_tokens", "ids_crc32")


def read_document(spark: SparkSession, path: str, doc_id: int) -> list[int] | None:
    """Ids of one document through the offset index; None if there is no such document."""
    meta = _meta(spark, path)
    found = spark.read.schema(_BLOCKS).parquet(f"{path}/blocks").where(
        (F.col("first_id") <= doc_id) & (F.col("last_id") >= doc_id) & F.array_contains("doc_ids", doc_id))
    at = F.array_position("doc_ids", F.lit(doc_id)).cast("int")
    row = found.withColumn("at", at).select(
        F.expr("substring(payload, cast(offsets[at - 1] as int) + 1, cast(offsets[at] - offsets[at - 1] as int))")
        .alias("frame"), "dict_sha256")
    first = row.first()
    if first is None:
        return None
    data = bytes(meta.dictionary)
    if hashlib.sha256(data).hexdigest() != first.dict_sha256:
        raise ValueError("the block was written with another dictionary")
    return np.frombuffer(_decompressor(data).decompress(bytes(first.frame)), f"<u{meta.width}").tolist()
