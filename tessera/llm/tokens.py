"""Fast exact token ids of whole texts with a public word-level BPE file.

The tokenizer normalises (NFC, white space, lower case), splits a text into units --
letter runs, single digits, runs of other signs, contractions -- and applies BPE to each
unit alone.  A task therefore finds the units of a batch with numpy, hashes them to 64
bits, and asks the tokenizers library only for units it has not met yet; ids of known
units come from a bounded cache that lives as long as the Python worker.  A document
with characters outside the range for which this split is proven equal (code points
from U+0250 on, U+0080-U+00BF, signs whose lower case leaves the range, the strings of
special tokens) is encoded whole by the library.
"""

from __future__ import annotations

import os
from functools import lru_cache

import numpy as np

from tessera.llm.bytesops import LOWER, doc_ranges, span_hashes

VOCABULARY = "word_bpe_49k.json"
CACHE_UNITS = 400_000
_SLOTS = 1 << 20  # of the cache's hash table, over twice as many as units

_SPACE, _LETTER, _DIGIT, _OTHER = 0, 1, 2, 3
_CLASS = np.full(256, _OTHER, np.uint8)
_CLASS[[0x20, *range(0x09, 0x0E)]] = _SPACE
_CLASS[48:58] = _DIGIT
_CLASS[[*range(65, 91), *range(97, 123), *range(128, 256)]] = _LETTER

# lower-case code point of each two-byte letter, 0 where the fast split is not proven
_FOLD = np.zeros(0x800, np.uint16)
for _c in range(0xC0, 0x250):
    _low = chr(_c).lower()
    if chr(_c).isalpha() and len(_low) == 1 and ord(_low) < 0x250:
        _FOLD[_c] = ord(_low)


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class Encoder:
    """Token ids of the documents of a byte buffer; one instance per Python worker."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer, normalizers, pre_tokenizers

        self.whole = Tokenizer.from_file(path)
        self.unit = Tokenizer.from_file(path)  # same BPE; units come separated by blanks
        self.unit.normalizer = normalizers.Sequence([])
        self.unit.pre_tokenizer = pre_tokenizers.Sequence([
            pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        size = self.whole.get_vocab_size()
        self.ends = np.zeros(size, bool)  # ids that end a unit
        for token, i in self.whole.get_vocab().items():
            self.ends[i] = token.endswith("</w>")
        self._clear()

    def _clear(self) -> None:
        self.known = 0
        self.slot_key = np.zeros(_SLOTS, np.uint64)  # open addressing; 0: free
        self.slot_row = np.zeros(_SLOTS, np.int32)
        self.at = np.zeros(1024, np.int64)  # first id of each known unit, and number of ids
        self.n = np.zeros(1024, np.int64)
        self.ids = np.zeros(4096, np.uint32)
        self.used = 0

    def encode_text(self, text: str) -> np.ndarray:
        return np.array(self.whole.encode(text, add_special_tokens=False).ids, np.uint32)

    def _learn(self, units: list[bytes]) -> list[np.ndarray]:
        out: list[np.ndarray | None] = [None] * len(units)
        plain = [i for i, u in enumerate(units) if not (len(u) > 1 and u[:1] == b"'")]
        for a in range(0, len(plain), 5000):
            some = plain[a:a + 5000]
            ids = np.array(self.unit.encode(b" ".join(units[i] for i in some).decode(), add_special_tokens=False).ids,
                           np.uint32)
            cut = np.flatnonzero(self.ends[ids]) + 1
            if len(cut) == len(some):
                for i, piece in zip(some, np.split(ids, cut[:-1]), strict=True):
                    out[i] = piece
        return [self.encode_text(u.decode()) if x is None else x for u, x in zip(units, out, strict=True)]

    def _find(self, key: np.ndarray) -> np.ndarray:
        """Cache row of each unit hash, -1 where it is not known."""
        pos = (key & np.uint64(_SLOTS - 1)).astype(np.int64)
        have = self.slot_key[pos]
        row = np.where(have == key, self.slot_row[pos], -1)
        todo = np.flatnonzero((have != key) & (have != 0))
        at = pos[todo]
        while len(todo):
            at = (at + 1) & (_SLOTS - 1)
            have = self.slot_key[at]
            same = have == key[todo]
            row[todo[same]] = self.slot_row[at[same]]
            more = ~same & (have != 0)
            todo, at = todo[more], at[more]
        return row

    def _add(self, key: np.ndarray, units: list[bytes]) -> None:
        found = self._learn(units)
        base, need = self.known, self.used + sum(map(len, found))
        if len(self.at) < base + len(units):
            self.at, self.n = (np.resize(x, 2 * (base + len(units))) for x in (self.at, self.n))
        if len(self.ids) < need:
            self.ids = np.resize(self.ids, 2 * need)
        n = np.array([len(x) for x in found], np.int64)
        self.n[base:base + len(n)] = n
        self.at[base:base + len(n)] = self.used + np.cumsum(n) - n
        self.ids[self.used:need] = np.concatenate(found)
        self.used, self.known = need, base + len(n)
        row = np.arange(base, self.known, dtype=np.int32)
        pos = (key & np.uint64(_SLOTS - 1)).astype(np.int64)
        while len(key):
            free = self.slot_key[pos] == 0
            self.slot_key[pos[free]] = key[free]
            mine = self.slot_key[pos] == key
            self.slot_row[pos[mine]] = row[mine]
            key, row, pos = key[~mine], row[~mine], (pos[~mine] + 1) & (_SLOTS - 1)

    def _rows(self, key: np.ndarray, unit) -> np.ndarray:
        """Cache row of each unit hash; unit(i) gives the bytes of the i-th."""
        key = np.where(key == 0, np.uint64(1), key)
        row = self._find(key)
        new = np.flatnonzero(row < 0)
        if not len(new):
            return row
        distinct, at = np.unique(key[new], return_index=True)
        if self.known + len(distinct) > CACHE_UNITS or self.used > 16 * CACHE_UNITS:
            self._clear()
            distinct, at = np.unique(key, return_index=True)
            new = np.arange(len(key))
        self._add(distinct, [unit(i) for i in new[at]])
        return self._find(key)

    def encode(self, buf: np.ndarray, off: np.ndarray):
        """Yield the ids (uint32) of each document in order."""
        for i, j in doc_ranges(off):
            yield from self._range(buf[off[i]:off[j]], off[i:j + 1] - off[i])

    def _range(self, raw: np.ndarray, off: np.ndarray):
        n = len(raw)
        low = LOWER[raw]
        bad = (raw >= 0xCA) | (raw == 0xC2)
        lead = np.flatnonzero((raw >= 0xC3) & (raw < 0xCA))
        cp = _FOLD[((raw[lead].astype(np.uint16) & 0x1F) << 6) | (raw[lead + 1] & 0x3F)]
        bad[lead[cp == 0]] = True
        low[lead], low[lead + 1] = 0xC0 | (cp >> 6), 0x80 | (cp & 0x3F)
        if n > 1:
            bad[:-1] |= (raw[:-1] == ord("<")) & (raw[1:] == ord("|"))
        bad = np.concatenate(([0], np.cumsum(bad)))
        slow = bad[off[1:]] > bad[off[:-1]]

        kind = _CLASS[low]
        first, last = kind != _SPACE, kind != _SPACE
        if n:
            first[1:] &= (kind[1:] != kind[:-1]) | (kind[1:] == _DIGIT)
            last[:-1] &= (kind[1:] != kind[:-1]) | (kind[:-1] == _DIGIT)
            edge = off[off < n]
            first[edge] = kind[edge] != _SPACE
            edge = off[off > 0] - 1
            last[edge] = kind[edge] != _SPACE
        start, end = np.flatnonzero(first), np.flatnonzero(last) + 1
        # an apostrophe alone before letters may be a contraction: one unit with them
        if len(start) > 1:
            join = (end[:-1] == start[1:]) & (end[:-1] - start[:-1] == 1) & (low[start[:-1]] == ord("'")) \
                & (kind[start[1:]] == _LETTER) & ~np.isin(start[1:], off)
            end = np.where(np.append(join, False), np.append(end[1:], 0), end)
            keep = np.append(True, ~join)
            start, end = start[keep], end[keep]
        if slow.any():  # units of documents encoded whole are not needed
            keep = ~slow[np.searchsorted(off, start, "right") - 1]
            start, end = start[keep], end[keep]
        hashes, count, ids = span_hashes(low, start, end), [], []
        for a in range(0, len(start), CACHE_UNITS // 2):  # the cache may start anew between slices
            rows = self._rows(hashes[a:a + CACHE_UNITS // 2], lambda i, a=a: low[start[a + i]:end[a + i]].tobytes())
            n = self.n[rows]
            skip = np.cumsum(n) - n
            ids.append(self.ids[np.repeat(self.at[rows] - skip, n) + np.arange(n.sum())])
            count.append(n)
        past = np.concatenate(([0], np.cumsum(np.concatenate([np.zeros(0, np.int64), *count]))))
        ids = np.concatenate([np.zeros(0, np.uint32), *ids])
        border = past[np.searchsorted(start, off)]
        for d in range(len(off) - 1):
            if slow[d]:
                yield self.encode_text(raw[off[d]:off[d + 1]].tobytes().decode())
            else:
                yield ids[border[d]:border[d + 1]]


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """The encoder of this Python worker (workers are reused between tasks)."""
    return Encoder(path)
