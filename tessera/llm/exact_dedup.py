"""Exact deduplication by content hash, with a byte comparison inside each group.

Two texts are equal when they are identical after every character of
``[\\x20\\x09-\\x0D]`` is deleted; a null text counts as empty.  Rows are grouped by
the 128-bit MD5 of that normalised text (partial aggregates, so a group of any size is
one combined row per task), the row with the most code points and then the smallest
doc_id stays, and every other row's normalised bytes are compared with those of the
row that stays.  A row that differs (a hash collision) goes to a group of its own
bytes.

Defined cases: empty table -> empty result; null doc_id sorts first, as Spark orders
nulls, and such a row can stay; repeated rows and repeated ids are members like any other
(every row of the id that stays is kept); extra columns are ignored by ``exact_groups`` and carried by ``drop_exact_copies``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.shared import cut_lineage

PART = 512  # rows of a group whose bytes one task compares
WHITE = [" ", "\t", "\n", "\x0b", "\x0c", "\r"]


def normalised(text: Column) -> Column:
    out = F.coalesce(text, F.lit(""))
    for c in WHITE:
        out = F.replace(out, F.lit(c), F.lit(""))
    return out


def exact_groups(docs: DataFrame, digest: Callable[[Column], Column] = F.md5) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256.

    ``digest`` is the grouping hash; any function of the text gives the same result
    (a weak one only makes more rows go through the collision path)."""
    norm = normalised(F.col("text"))
    hashed = F.unhex(digest(norm)) if digest is F.md5 else digest(norm)
    # position of a row inside its group: the longest original first, then the smallest id
    rank = F.struct((-F.length(F.coalesce("text", F.lit("")))).cast("long").alias("c"), F.col("doc_id").alias("i"))
    # x tells rows of one id, length and hash apart
    rows = cut_lineage(docs.select("doc_id", hashed.alias("h"), F.sha2(norm, 256).alias("text_sha256"), rank.alias("r"),
                                   F.xxhash64(norm).alias("x")))
    groups = rows.groupBy("h").agg(F.min("r").alias("best"), F.count(F.lit(1)).alias("n"))
    shared = groups.where("n > 1")

    # bytes of the members of shared groups against the bytes of the row that stays; the texts of a
    # group meet in parts of about PART rows, each with a copy of the text that stays
    parts = F.ceil(F.col("n") / PART).cast("int")
    member = rows.join(shared, "h").select(F.col("h").alias("m_h"), F.col("r").alias("m_r"), F.col("x").alias("m_x"), "best", "n").distinct()
    text = docs.select(norm.alias("norm"), hashed.alias("t_h"), rank.alias("t_r"), F.xxhash64(norm).alias("t_x"))
    held = member.join(text, (F.col("m_h") == F.col("t_h")) & F.col("m_r").eqNullSafe(F.col("t_r")) & (F.col("m_x") == F.col("t_x"))) \
        .select(F.col("m_h").alias("h"), "m_r", "m_x", "best", "norm", parts.alias("parts"))
    keeper = held.where("m_r <=> best").groupBy("h", "parts").agg(F.min("norm").alias("k_norm")) \
        .select("h", "k_norm", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))
    odd = cut_lineage(held.withColumn("part", F.pmod(F.xxhash64("m_r"), F.col("parts")).cast("int")).join(keeper, ["h", "part"])
                      .where("norm <> k_norm").select(F.col("h").alias("o_h"), F.col("m_r").alias("o_r"), F.col("m_x").alias("o_x"), "norm").distinct())
    if odd.isEmpty():
        variants = rows.withColumn("norm", F.lit(None).cast("string"))
    else:
        variants = rows.join(odd, (F.col("h") == F.col("o_h")) & F.col("r").eqNullSafe(F.col("o_r")) & (F.col("x") == F.col("o_x")), "left") \
            .drop("o_h", "o_r", "o_x")
        groups = variants.groupBy("h", F.col("norm").alias("g_norm")) \
            .agg(F.min("r").alias("best"), F.count(F.lit(1)).alias("n"))
    groups = groups.withColumnRenamed("h", "g_h")
    on = F.col("h") == F.col("g_h")
    if "g_norm" in groups.columns:
        on = on & F.col("norm").eqNullSafe(F.col("g_norm"))
    return variants.join(groups, on).select(
        "doc_id", F.col("best.i").alias("keep_id"), F.col("n").cast("long").alias("group_size"),
        F.col("doc_id").eqNullSafe(F.col("best.i")).alias("kept"), "text_sha256")


def drop_exact_copies(docs: DataFrame) -> DataFrame:
    """The rows that stay, with all columns of ``docs``.  A decision holds for the doc_id with
    that text, so null or repeated ids take no other text along.  Rows repeated with the
    same doc_id and equal text are one document and come out once."""
    groups = exact_groups(docs)
    own = F.sha2(normalised(F.col("text")), 256)
    gone = groups.where(~F.col("kept")).select(F.col("doc_id").alias("gone_id"), F.col("text_sha256").alias("gone_text")).distinct()
    left = docs.join(gone, docs["doc_id"].eqNullSafe(F.col("gone_id")) & (own == F.col("gone_text")), "left_anti")
    again = cut_lineage(groups.where("kept").groupBy("doc_id", "text_sha256").count().where("count > 1")
                        .select(F.col("doc_id").alias("again_id"), F.col("text_sha256").alias("again_text")))
    if again.isEmpty():
        return left
    same = left["doc_id"].eqNullSafe(F.col("again_id")) & (own == F.col("again_text"))
    return left.join(again, same, "left_anti").unionByName(
        left.join(again, same, "left_semi").withColumn("again_norm", own)
        .dropDuplicates(["doc_id", "again_norm"]).drop("again_norm"))
