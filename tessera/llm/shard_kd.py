"""K-d tree sharding: space is cut at byte-weighted medians of document metadata.

A region is split along its widest metadata dimension (range in the region over range in
the table) into two with half of its leaves each, at the key where the running sum of
bytes reaches the left part's share, until every region is one leaf -- one shard of the
target bytes.  Dimensions are the length (logarithm), and hashes of language and source.

Keys are 63-bit numbers: 20 bits of the coordinate, then 22 bits of the text's CRC and 21
of the id's hash, so ties in a coordinate (a source with a third of all rows) are still
cut anywhere, and equal texts lie side by side.  The weighted median of all regions of a
level is found at once by histograms: each round sums bytes in ``BINS`` bins a region and
keeps the bin the median lies in, until that bin holds less than ``TOLERANCE`` of a leaf.
Rows that share a key (repeated rows) and outweigh that are cut by the hash of a row number,
fixed once by a checkpoint, in the same rounds.  Rows are never sorted or gathered; the driver sees one row a region and round.

Law: ``bytes`` (sizes near equal).  Defined cases: null text counts one byte and has the
CRC of the empty text; null metadata is coordinate 0; repeated rows are spread over shards
where their bytes ask for it; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.shared import cut_lineage, running_offset, size_bytes, tasks

BINS = 4096
TOLERANCE = 1e-4
_COORD, _TIE = 20, 43


def _length(c: Column) -> Column:
    return F.least(F.lit((1 << _COORD) - 1), F.floor(F.log2(F.lit(1.0) + F.greatest(c, F.lit(0))) * (1 << 14))).cast("long")


def _name(c: Column) -> Column:
    return F.when(c.isNull(), 0).otherwise(1 + F.pmod(F.crc32(c.cast("string").cast("binary")), F.lit((1 << _COORD) - 1))).cast("long")


def coordinates(docs: DataFrame) -> list[Column]:
    """Coordinates below 2 ** 20: length, language, source (those that the table has)."""
    text = F.length(F.col("text").cast("string"))
    length = F.coalesce(F.col("n_chars").cast("long"), text, F.lit(0)) if "n_chars" in docs.columns else F.coalesce(text, F.lit(0))
    return [_length(length), *[_name(F.col(c)) for c in ("lang", "source") if c in docs.columns]]


def _key(dims: int) -> Column:
    """The row's key along the dimension ``dim`` of its region."""
    c = F.col("c0")
    for d in range(1, dims):
        c = F.when(F.col("dim") == d, F.col(f"c{d}")).otherwise(c)
    return F.shiftleft(c, _TIE).bitwiseOR(F.col("tie"))


def _narrow(rows: DataFrame, key: Column, state: dict[int, dict], leaf_bytes: float) -> tuple[dict[int, int], dict[int, int]]:
    """(region -> smallest key of its right part, region -> the key that alone outweighs the
    tolerance, where the cut falls inside it).  ``state`` has dim, target and base (bytes
    left of the rows given) of each region; base is kept up to date."""
    spark = rows.sparkSession
    small = F.broadcast(spark.createDataFrame([(n, s["dim"]) for n, s in state.items()], "node long, dim int"))
    ends = rows.join(small, "node").groupBy("node").agg(F.min(key).alias("lo"), F.max(key).alias("hi"))
    for r in ends.collect():
        state[r.node] |= {"lo": r.lo, "hi": r.hi}
    cuts: dict[int, int] = {}
    heavy: dict[int, int] = {}
    while open_ := {n: s for n, s in state.items() if n not in cuts and n not in heavy}:
        for s in open_.values():
            s["shift"] = max(0, (s["hi"] - s["lo"]).bit_length() - BINS.bit_length() + 1)
        ask = F.broadcast(spark.createDataFrame(  # one row a region: bounded by the number of leaves
            [(n, s["dim"], s["lo"], s["hi"], s["shift"], float(s["target"] - s["base"])) for n, s in open_.items()],
            "node long, dim int, lo long, hi long, shift int, want double"))
        bins = rows.join(ask, "node").where((key >= F.col("lo")) & (key <= F.col("hi"))) \
            .withColumn("bin", F.call_function("shiftright", key - F.col("lo"), F.col("shift"))) \
            .groupBy("node", "bin", "want").agg(F.sum("size").alias("w"), F.count(F.lit(1)).alias("n"))
        upto = F.sum("w").over(Window.partitionBy("node").orderBy("bin"))  # BINS rows a region
        hit = bins.withColumn("upto", upto).where("upto >= want").groupBy("node") \
            .agg(F.min(F.struct("bin", "upto", "w", "n")).alias("h"))
        for r in hit.collect():
            s, low = state[r.node], state[r.node]["lo"] + (r.h.bin << state[r.node]["shift"])
            high = low + (1 << s["shift"]) - 1
            before = s["base"] + r.h.upto - r.h.w
            if r.h.w <= TOLERANCE * leaf_bytes or (s["shift"] == 0 and r.h.n == 1):
                nearer_end = abs(before + r.h.w - s["target"]) < abs(before - s["target"])
                cuts[r.node] = high + 1 if nearer_end else low
            elif s["shift"] == 0:
                s["base"] = before
                heavy[r.node] = low
            else:
                s |= {"lo": max(s["lo"], low), "hi": min(s["hi"], high), "base": before}
    return cuts, heavy


def _cuts(rows: DataFrame, dims: int, state: dict[int, dict], leaf_bytes: float) -> dict[int, tuple[int, int]]:
    """region -> (key, row number): its right part begins there.  Rows of one key that
    outweighs the tolerance are cut by their row numbers, in the same way."""
    for s in state.values():
        s["base"] = 0
    cuts, heavy = _narrow(rows, _key(dims), state, leaf_bytes)
    out = {n: (c, 0) for n, c in cuts.items()}
    if heavy:
        only = F.broadcast(rows.sparkSession.createDataFrame(
            [(n, state[n]["dim"], k) for n, k in heavy.items()], "node long, dim int, only long"))
        equal = rows.join(only, "node").where(_key(dims) == F.col("only")).drop("dim", "only")
        inner, left = _narrow(equal, F.col("row"), {n: state[n] for n in heavy}, leaf_bytes)
        out |= {n: (heavy[n], c) for n, c in (inner | left).items()}
    return out


def kd_shards(docs: DataFrame, shards: int | None = None, target_bytes: int | None = None) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard of every row; either the
    number of shards or the bytes that a leaf shall reach is given."""
    coord = coordinates(docs)
    dims = len(coord)
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    crc = F.crc32(text.cast("binary"))
    tie = F.shiftleft(F.shiftright(crc, 10), 21).bitwiseOR(F.shiftrightunsigned(F.xxhash64("doc_id"), 43))
    rows = cut_lineage(docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), (size_bytes(F.col("text").cast("string")) + 1).alias("size"),
        crc.cast("long").alias("text_crc32"), tie.cast("long").alias("tie"),
        F.shiftrightunsigned(F.xxhash64(F.monotonically_increasing_id()), 1).alias("row"),  # fixed by the checkpoint
        *[c.alias(f"c{d}") for d, c in enumerate(coord)], F.lit(1).cast("long").alias("node")))
    spread = [F.max(f"c{d}") - F.min(f"c{d}") for d in range(dims)]
    whole = rows.agg(F.sum("size"), *spread).first()
    total = whole[0] or 0
    shards = shards or max(1, math.ceil(total / target_bytes))
    leaves = {1: shards}  # open regions and the leaves below each
    while total and any(k > 1 for k in leaves.values()):
        state = {}
        for r in rows.groupBy("node").agg(F.sum("size").alias("w"), F.array(*spread).alias("s")).collect():
            k = leaves.get(r.node, 1)
            if k > 1:
                share = [x / (t or 1) for x, t in zip(r.s, whole[1:], strict=True)]
                state[r.node] = {"dim": share.index(max(share)), "target": r.w * ((k + 1) // 2) / k}
        cuts = _cuts(rows, dims, state, total / shards)
        plan = F.broadcast(rows.sparkSession.createDataFrame(
            [(n, state[n]["dim"], *c) for n, c in cuts.items()], "node long, dim int, cut long, first long"))
        rows = rows.join(plan, "node", "left").withColumn("node", F.when(
            F.col("cut").isNull(), F.col("node")).otherwise(2 * F.col("node") + (
                (_key(dims) > F.col("cut")) | ((_key(dims) == F.col("cut")) & (F.col("row") >= F.col("first")))).cast("long"))) \
            .drop("dim", "cut", "first")
        rows = cut_lineage(rows)
        nxt = {}
        for n, k in leaves.items():
            if n in cuts:
                nxt |= {2 * n: (k + 1) // 2, 2 * n + 1: k // 2}
            elif n not in state:  # a leaf, or a region no row fell into
                nxt[n] = 1
        leaves = nxt
    order = sorted(leaves, key=lambda n: (bin(n)[2:] + "0" * 64)[:64])  # from left to right
    number = F.broadcast(rows.sparkSession.createDataFrame([(n, i) for i, n in enumerate(order)], "node long, shard int"))
    placed = rows.join(number, "node").withColumn("chunk", F.pmod(F.xxhash64("doc_id"), F.lit(tasks(rows.sparkSession))).cast("int"))
    count = placed.groupBy("shard", "chunk").agg(F.count(F.lit(1)).alias("n"))
    inner = F.row_number().over(Window.partitionBy("shard", "chunk").orderBy("doc_id", "text_crc32", "size")) - 1
    return placed.withColumn("inner", inner).join(running_offset(count, ["shard"], "chunk", "n", "before"), ["shard", "chunk"]) \
        .select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
                (F.col("inner") + F.col("before")).cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))
