"""Benchmark decontamination by template windows.

Words are runs of ASCII letters, digits and bytes above 127, lower-cased.  A template
replaces typed slots by placeholders: a word that begins with a digit is a number, a unit
word after a number is a unit of its kind, and a capitalised word inside a sentence that
is not all capitals is a name.  Every five consecutive template words of a benchmark item
are one window; a window needs ``LITERALS`` words that are not slots.  The windows of the
plain words (no slot replaced) are kept beside them, so a passage whose capitals were
lost is still found.

Documents are cut in windows inside the tasks.  A fixed-size bitmap of the benchmark's
window hashes (``BITMAP`` bits whatever the benchmark) lets nearly all windows of clean
documents go at once; the others are hash-joined with the benchmark's windows, so false
hits of the bitmap end there.

Slot consistency: windows of a document and an item with the same distance between their
positions form one alignment.  In it every slot value of the item must stand for one
value of the document ("Ann" always becomes "Bob"); the template windows of an alignment that breaks
this are not used, its plain windows are.  An item leaks into a document when the matched windows
cover at least ``COVER`` of the item's words, or when ``RUN`` of its words in a row stand in
the document as they are (part of a long item).

Defined cases: an item with fewer than five words or null text has no window and never
matches; null or empty document -> not flagged; texts are matched one by one also where ids are null
or repeated (``leaks`` and ``flagged`` give one result per doc_id, null included; ``drop_leaks`` decides by
text); empty tables -> nothing is flagged; extra columns are ignored by ``leaks`` and carried by ``drop_leaks``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.bytesops import LOWER, U64, doc_ranges, flat, runs, span_hashes, windows
from tessera.llm.shared import cut_lineage

K = 5
LITERALS = 3
COVER = 0.8
RUN = 13  # words in a row
BITMAP = 1 << 24

UNITS = {
    "length": "mm cm m km inch inches foot feet yard yards mile miles meter meters metre metres kilometer kilometers",
    "mass": "mg g kg gram grams kilogram kilograms pound pounds lb lbs ounce ounces oz ton tons",
    "time": "s sec second seconds min minute minutes h hour hours day days week weeks month months year years",
    "money": "dollar dollars cent cents euro euros eur usd gbp yen",
    "volume": "ml l liter liters litre litres gallon gallons cup cups",
    "share": "percent degrees degree",
}

_WORD = np.zeros(256, bool)
_WORD[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True
_STOP = np.zeros(256, bool)
_STOP[[ord(c) for c in ".!?:;\n\""]] = True
_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True
_NUMBER, _NAME = U64(11), U64(12)


def _units() -> tuple[np.ndarray, np.ndarray]:
    words = [(w, U64(20 + k)) for k, kind in enumerate(sorted(UNITS)) for w in UNITS[kind].split()]
    buf, off = flat(pa.array([w for w, _ in words]))
    h = span_hashes(buf, off[:-1], off[1:])
    order = np.argsort(h)
    return h[order], np.array([k for _, k in words], np.uint64)[order]


_UNIT_HASH, _UNIT_KIND = _units()


def template(buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(word hash, placeholder or 0, first word of each document)."""
    start, end = runs(_WORD[buf], off)
    first = np.searchsorted(start, off)
    low = LOWER[buf].copy()
    accent = np.flatnonzero((buf[:-1] == 0xC3) & (buf[1:] >= 0x80) & (buf[1:] <= 0x9E) & (buf[1:] != 0x97)) + 1 \
        if len(buf) > 1 else np.zeros(0, np.int64)
    low[accent] += 0x20
    h = span_hashes(low, start, end)
    slot = np.zeros(len(h), np.uint64)
    if not len(h):
        return h, slot, first
    upper = _UPPER[buf]
    upper[accent - 1] = True
    lead = buf[start]
    number = (lead >= 48) & (lead < 58)
    # a sentence starts where a stop stands between this word and the one before
    stops = np.concatenate(([0], np.cumsum(_STOP[buf])))
    opens = np.ones(len(h), bool)
    opens[1:] = stops[start[1:]] > stops[end[:-1]]
    opens[first[first < len(h)]] = True
    after = np.minimum(start + np.where(lead < 128, 1, 2), end - 1)
    shout = upper[after] & (after > start)
    slot[upper[start] & ~opens & ~shout] = _NAME
    at = np.minimum(np.searchsorted(_UNIT_HASH, h), len(_UNIT_HASH) - 1)
    unit = np.zeros(len(h), bool)
    unit[1:] = (_UNIT_HASH[at[1:]] == h[1:]) & number[:-1]
    unit[first[first < len(h)]] = False
    slot[unit] = _UNIT_KIND[at[unit]]
    slot[number] = _NUMBER
    return h, slot, first


def cut_windows(buf: np.ndarray, off: np.ndarray):
    """(document, position, plain?, window hash) of all windows, and word hashes, slots and
    first words for looking slot values up."""
    h, slot, first = template(buf, off)
    n = max(len(h) - K + 1, 0)
    doc = np.searchsorted(first, np.arange(n), "right") - 1
    ok = np.arange(n) + K <= first[doc + 1]
    literal = np.concatenate(([0], np.cumsum(slot == 0)))
    typed = literal[K:K + n] - literal[:n]
    masked = windows(np.where(slot > 0, slot, h), K) ^ U64(1)
    plain = windows(h, K) & ~U64(1)
    masked |= U64(1)  # template windows are odd, plain ones even
    at = np.flatnonzero(ok & (typed >= LITERALS) & (typed < K))
    even = np.flatnonzero(ok)
    return (np.concatenate((doc[even], doc[at])), np.concatenate((even, at)), np.concatenate((plain[even], masked[at])),
            h, slot, first)


_WINDOWS = "id long, own long, pos int, h long, words int, slots array<long>"


def _table(ids: pa.Array, own: pa.Array, doc, pos, win, h, slot, first) -> pa.RecordBatch:
    """One row per window; slots holds the word hashes at slot positions of a template window, else 0."""
    at = pos[:, None] + np.arange(K)
    values = np.where((slot[at] > 0) & ((win & U64(1)) > 0)[:, None], h[at], U64(0)).view(np.int64)
    slots = pa.ListArray.from_arrays(pa.array(np.arange(0, len(pos) * K + 1, K), pa.int32()), pa.array(values.ravel()))
    count = (first[1:] - first[:-1])[doc]
    return pa.RecordBatch.from_arrays(
        [ids.take(pa.array(doc)), own.take(pa.array(doc)), pa.array((pos - first[doc]).astype(np.int32)), pa.array(win.view(np.int64)),
         pa.array(count.astype(np.int32)), slots], ["id", "own", "pos", "h", "words", "slots"])


def _bit(h: np.ndarray) -> np.ndarray:
    return (h >> U64(64 - (BITMAP - 1).bit_length())).astype(np.int64)


def window_table(rows: DataFrame, id_col: str, bitmap: bytes | None = None) -> DataFrame:
    """Windows of ``text``; with a bitmap only those whose bit is set.  ``own`` (a hash of the text) tells
    texts apart that share an id or have none."""
    shared = rows.sparkSession.sparkContext.broadcast(bitmap) if bitmap is not None else None  # BITMAP bits

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.unpackbits(np.frombuffer(shared.value, np.uint8)).view(bool) if shared else None
        for batch in batches:
            buf, off = flat(batch.column(1))
            for i, j in doc_ranges(off):
                doc, pos, win, h, slot, first = cut_windows(buf[off[i]:off[j]], off[i:j + 1] - off[i])
                if bits is not None:
                    keep = np.flatnonzero(bits[_bit(win)])
                    doc, pos, win = doc[keep], pos[keep], win[keep]
                if len(doc):
                    yield _table(batch.column(0).slice(i, j - i), batch.column(2).slice(i, j - i), doc, pos, win, h, slot, first)

    text = F.col("text").cast("string")
    return rows.where(text.isNotNull()).select(F.col(id_col).cast("long").alias("id"), text.alias("text"), F.xxhash64(text).alias("own")) \
        .mapInArrow(cut, _WINDOWS)


def _bitmap(items: DataFrame) -> bytes:
    """The benchmark's bitmap.  Distinct bits come one partition at a time, so the driver
    holds BITMAP flags whatever the benchmark."""
    bit = F.shiftrightunsigned("h", 64 - (BITMAP - 1).bit_length())
    out = np.zeros(BITMAP, bool)
    for r in items.select(bit.alias("bit")).distinct().toLocalIterator():
        out[r.bit] = True
    return np.packbits(out).tobytes()


def leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, item_id, cover (share of the item's words), run (most of its words in a row, as they are)
    of every item that leaks into a text."""
    items = cut_lineage(window_table(benchmark.where(F.col("item_id").isNotNull()), "item_id"))
    hits = window_table(docs, "doc_id", _bitmap(items)).select(
        F.col("id").alias("doc_id"), "own", F.col("pos").alias("d_pos"), "h", F.col("slots").alias("d_slots"))
    pair = hits.join(items.select(F.col("id").alias("item_id"), F.col("own").alias("i_own"), "pos", "h", "words", "slots"), "h")
    match = F.transform("slots", lambda v, k: F.struct(v.alias("item"), F.get("d_slots", k).alias("doc")))
    plain = F.col("h").bitwiseAND(F.lit(1)) == 0
    text = ["doc_id", "own", "item_id", "i_own"]
    lines = pair.withColumn("line", F.col("d_pos") - F.col("pos")).groupBy(*text, "line").agg(
        F.array_sort(F.collect_set(F.when(plain, F.col("pos")))).alias("as_is"), F.collect_set(F.when(~plain, F.col("pos"))).alias("typed"),
        F.max("words").alias("words"),
        F.array_distinct(F.flatten(F.collect_set(F.filter(match, lambda m: m["item"] != 0)))).alias("slots"))
    same = F.size("slots") == F.size(F.array_distinct(F.transform("slots", lambda m: m["item"])))
    covered = F.flatten(F.transform(F.when(same, F.concat("as_is", "typed")).otherwise(F.col("as_is")), lambda p: F.sequence(p, p + K - 1)))
    zero = F.struct(F.lit(0).alias("start"), F.lit(0).alias("end"), F.lit(0).alias("best"))

    def longer(a, p):
        start = F.when(p <= a["end"], a["start"]).otherwise(p)
        return F.struct(start.alias("start"), (p + K).alias("end"), F.greatest(a["best"], p + K - start).alias("best"))

    return lines.groupBy(*text).agg(
        F.max("words").alias("words"), F.size(F.array_distinct(F.flatten(F.collect_list(covered)))).alias("n"),
        F.max(F.aggregate("as_is", zero, longer)["best"]).alias("run")) \
        .where((F.col("n") >= COVER * F.col("words")) | (F.col("run") >= RUN)) \
        .groupBy("doc_id", "item_id").agg(F.max(F.col("n") / F.col("words")).alias("cover"), F.max("run").alias("run"))


def flagged(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per document: doc_id, flagged, item_ids (sorted), cover (the largest)."""
    found = leaks(docs, benchmark).groupBy(F.col("doc_id").alias("f_id")).agg(
        F.sort_array(F.collect_set("item_id")).alias("item_ids"), F.max("cover").alias("cover"))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id")).join(found, F.col("doc_id").eqNullSafe(F.col("f_id")), "left") \
        .select("doc_id", F.col("item_ids").isNotNull().alias("flagged"), "item_ids", "cover")


def leaking_documents(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per document that holds an item: doc_id, items (their ids, comma-joined in
    order), cover and run (the largest)."""
    return leaks(docs, benchmark).groupBy("doc_id").agg(
        F.concat_ws(",", F.sort_array(F.collect_set("item_id")).cast("array<string>")).alias("items"),
        F.max("cover").alias("cover"), F.max("run").alias("run"))


def drop_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents no item leaks into, with all their columns.  Texts are matched by their
    content (64-bit hash), so null or repeated ids make no difference."""
    own = F.xxhash64(F.col("text").cast("string"))
    gone = leaks(docs.select(own.alias("doc_id"), "text"), benchmark).select(F.col("doc_id").alias("gone_text")).distinct()
    return docs.join(gone, own == F.col("gone_text"), "left_anti")
