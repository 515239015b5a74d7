"""Array helpers that run inside Spark tasks on the bytes of Arrow string columns.

Texts of a batch are looked at as one UTF-8 byte buffer with document offsets, so
words are found and hashed with a handful of numpy passes instead of a Python loop
over words.  Nothing here talks to Spark.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U64 = np.uint64
PIECE = 1 << 20  # bytes hashed at once; bounds the work arrays

WHITE = np.zeros(256, bool)
WHITE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_rng = np.random.default_rng(20240229)
_BYTE = _rng.integers(1, 2**63, 256, dtype=np.uint64) * U64(2) + U64(1)
_BASE = int(_rng.integers(2**40, 2**62)) * 2 + 1
_INV = pow(_BASE, -1, 2**64)
_POW = np.ones(1, np.uint64)
_IPOW = np.ones(1, np.uint64)


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    global _POW, _IPOW
    if len(_POW) < n:
        size = max(n, min(PIECE + 1, 2 * n))

        def run(base: int) -> np.ndarray:
            out = np.full(size, U64(base))
            out[0] = 1
            return np.multiply.accumulate(out)

        _POW, _IPOW = run(_BASE), run(_INV)
    return _POW, _IPOW


def mix(h: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser (array of uint64)."""
    h = (h ^ (h >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> U64(27))) * U64(0x94D049BB133111EB)
    return h ^ (h >> U64(31))


def flat(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; a null is an empty text."""
    col = col.combine_chunks() if isinstance(col, pa.ChunkedArray) else col
    if col.null_count:
        col = col.fill_null("")
    wide = pa.types.is_large_string(col.type) or pa.types.is_large_binary(col.type)
    off = np.frombuffer(col.buffers()[1], np.int64 if wide else np.int32)[col.offset:col.offset + len(col) + 1]
    off = off.astype(np.int64)
    data = col.buffers()[2]
    buf = np.frombuffer(data, np.uint8)[off[0]:off[-1]] if data is not None and len(off) else np.zeros(0, np.uint8)
    return buf, off - off[0]


def doc_ranges(off: np.ndarray, limit: int = PIECE) -> Iterator[tuple[int, int]]:
    """Consecutive document ranges of about ``limit`` bytes; a longer document is a range of its own."""
    i, n = 0, len(off) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(off, off[i] + limit, "right")) - 1)
        yield i, min(j, n)
        i = min(j, n)


def runs(inside: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of each maximal run of True that does not cross a document border."""
    n = len(inside)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    at = off[(off < n)]
    first[at] |= inside[at]
    at = off[off > 0] - 1
    last[at] |= inside[at]
    return np.flatnonzero(first), np.flatnonzero(last) + 1


def span_hashes(buf: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hash of the bytes of each span; spans are sorted and do not overlap."""
    out = np.empty(len(start), np.uint64)
    i = 0
    while i < len(start):
        j = max(i + 1, int(np.searchsorted(end, start[i] + PIECE, "right")))
        lo, hi = int(start[i]), int(end[j - 1])
        up, down = _powers(hi - lo + 1)
        run = np.zeros(hi - lo + 1, np.uint64)
        np.cumsum(_BYTE[buf[lo:hi]] * up[:hi - lo], out=run[1:])
        s, e = start[i:j] - lo, end[i:j] - lo
        out[i:j] = (run[e] - run[s]) * down[s] + (e - s).astype(np.uint64) * U64(0x9E3779B97F4A7C15)
        i = j
    return mix(out)


def words(buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, first): byte spans of the words between ASCII white space, and the
    index of each document's first word (one entry more than documents)."""
    start, end = runs(~WHITE[buf], off)
    return start, end, np.searchsorted(start, off)


_STEP = 0xD6E8FEB86659FD93


def windows(h: np.ndarray, k: int) -> np.ndarray:
    """Hash of every k consecutive word hashes."""
    n = len(h) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for j in range(k):
        out += h[j:n + j] * U64(pow(_STEP, j + 1, 2**64))
    return mix(out + U64(k))


def shingle_sets(buf: np.ndarray, off: np.ndarray, k: int = 5) -> Iterator[np.ndarray]:
    """For each document, the sorted distinct hashes of its k-word shingles (words are
    lower-cased over A-Z).  Fewer than k words: the whole sequence is one shingle; no
    word: empty."""
    for i, j in doc_ranges(off):
        lo, hi = off[i], off[j]
        part, o = LOWER[buf[lo:hi]], off[i:j + 1] - lo
        start, end, first = words(part, o)
        h = span_hashes(part, start, end)
        win = windows(h, k)
        for d in range(j - i):
            a, b = int(first[d]), int(first[d + 1])
            if b - a >= k:
                yield np.unique(win[a:b - k + 1])
            else:
                yield windows(h[a:b], b - a) if b > a else np.zeros(0, np.uint64)
