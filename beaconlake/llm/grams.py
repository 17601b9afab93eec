"""Words of whole texts and 64-bit hashes of words and word runs, for blocks of texts at a time.

Texts stay UTF-8 bytes: both word patterns used here break at ASCII bytes only, so a table of 256 bytes says which
bytes belong to words and lower-cases A-Z.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 20  # texts are worked on in slices of about so many bytes; one text is never cut


def _word_bytes(is_word: list[bool]) -> np.ndarray:
    table = np.arange(256, dtype=np.uint8)
    table[65:91] += 32
    table[~np.array(is_word)[table]] = 0
    return table


# 0 where a byte parts words, else the lower-cased byte.
SPACED = _word_bytes([b != 0x20 and not 0x09 <= b <= 0x0D for b in range(256)])
SPACED[0] = 1  # a NUL byte is part of a word; no other byte takes the place of 1 and 0 together in texts
ALNUM = _word_bytes([0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 for b in range(256)])

_RANDOM = np.random.default_rng(20240229)
_OF_BYTE = _RANDOM.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 2**64))
_powers: list[np.ndarray] = []


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers; one to one."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers 0..n of the base and of its inverse modulo 2^64."""
    if not _powers or len(_powers[0]) <= n:
        size = max(n + 1, SLICE_BYTES + 1)
        made = []
        for base in (_BASE, _INVERSE):
            powers = np.full(size, base, dtype=np.uint64)
            powers[0] = 1
            made.append(np.cumprod(powers, dtype=np.uint64))
        if size > 8 * SLICE_BYTES:
            return made[0], made[1]  # for one huge text; not kept
        _powers[:] = made
    return _powers[0], _powers[1]


class Words:
    """Words of consecutive texts: their byte range, text and hash."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, table: np.ndarray):
        self.data = table[data]
        n = len(data)
        self.texts = len(offsets) - 1
        if n == 0:
            self.start = self.end = np.zeros(0, np.int64)
            self.text = np.zeros(0, np.int64)
            self.hash = np.zeros(0, np.uint64)
        else:
            inside = self.data != 0
            first = np.zeros(n + 1, bool)
            first[offsets] = True
            before = np.empty(n, bool)
            before[0] = False
            before[1:] = inside[:-1]
            after = np.empty(n, bool)
            after[-1] = False
            after[:-1] = inside[1:]
            self.start = np.flatnonzero(inside & (~before | first[:-1]))
            self.end = np.flatnonzero(inside & (~after | first[1:])) + 1
            self.text = np.searchsorted(offsets, self.start, side="right") - 1
            up, down = _power_tables(n)
            sums = np.empty(n + 1, np.uint64)
            sums[0] = 0
            np.cumsum(_OF_BYTE[self.data] * up[:n], out=sums[1:])
            self.hash = mix((sums[self.end] - sums[self.start]) * down[self.start] + (self.end - self.start).astype(np.uint64))
        # Words of text i are those from bounds[i] to bounds[i + 1].
        self.bounds = np.searchsorted(self.text, np.arange(self.texts + 1))

    def runs(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Hash of every run of k words within a text, and the number of its first word."""
        n = len(self.hash) - k + 1
        if n <= 0:
            return np.zeros(0, np.uint64), np.zeros(0, np.int64)
        total = np.full(n, k, np.uint64)
        for j in range(k):
            total = total * np.uint64(0xD6E8FEB86659FD93) + self.hash[j : j + n]
        first = np.flatnonzero(self.text[:n] == self.text[k - 1 :])
        return mix(total[first]), first

    def joined(self, first: int, last: int) -> bytes:
        """Words first..last-1, with blanks between."""
        return b" ".join(self.data[self.start[i] : self.end[i]].tobytes() for i in range(first, last))


def buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of string values; null counts as empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if texts.null_count:
        texts = texts.fill_null("")
    texts = texts.cast(pa.large_string())
    if len(texts) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    if data is None:
        return np.zeros(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


def sliced(texts: pa.Array, table: np.ndarray) -> Iterator[tuple[int, Words]]:
    """Words of consecutive texts in slices of bounded bytes, with the number of the first text."""
    data, offsets = buffers(texts)
    at, n = 0, len(offsets) - 1
    while at < n:
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + SLICE_BYTES, side="right")) - 1)
        yield at, Words(data[offsets[at] : offsets[to]], offsets[at : to + 1] - offsets[at], table)
        at = to
