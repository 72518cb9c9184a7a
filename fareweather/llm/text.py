"""Whole texts as numpy arrays: words, hashes and windows of an Arrow string column.

A batch is worked off in chunks of whole documents, about ``CHUNK_BYTES`` of text each, so the
arrays of a task stay small however many rows a batch has. Words are the runs of bytes outside
``[\\x20\\x09-\\x0D]``. Hashes have 64 bits.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import cached_property

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 20

_RANDOM = np.random.default_rng(20240611)
_BYTE_CODES = _RANDOM.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_LOWER_CODES = _BYTE_CODES.copy()
_LOWER_CODES[65:91] = _BYTE_CODES[97:123]
_BASE = 0x9E3779B97F4A7C1B
_BASE_INVERSE = pow(_BASE, -1, 2**64)

#: Bytes of a word: all but white space, or only letters and digits of any script.
WORD_BYTES = np.ones(256, bool)
WORD_BYTES[[9, 10, 11, 12, 13, 32]] = False
LETTER_BYTES = np.zeros(256, bool)
LETTER_BYTES[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True


def mix(values: np.ndarray, seed: int = 0) -> np.ndarray:
    """A fresh array of well-mixed 64-bit values."""
    x = values ^ np.uint64(seed * 0x9E3779B97F4A7C15 & (2**64 - 1))
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _power_tables(size: int) -> list[np.ndarray]:
    if len(_powers[0]) < size:
        for i, base in enumerate((_BASE, _BASE_INVERSE)):
            table = np.full(size, np.uint64(base))
            table[0] = 1
            _powers[i] = np.multiply.accumulate(table)
    return _powers


def hash_spans(data: np.ndarray, start: np.ndarray, end: np.ndarray, lower: bool = False) -> np.ndarray:
    """One hash for each span ``data[start:end]``; spans ascend and don't overlap."""
    codes = _LOWER_CODES if lower else _BYTE_CODES
    out = np.zeros(len(start), np.uint64)
    first = 0
    while first < len(start):
        last = max(first + 1, int(np.searchsorted(end, start[first] + CHUNK_BYTES, "right")))
        begin, stop = int(start[first]), int(end[last - 1])
        powers, inverse = _power_tables(stop - begin + 1)
        sums = np.zeros(stop - begin + 1, np.uint64)
        np.cumsum(codes[data[begin:stop]] * powers[: stop - begin], out=sums[1:])
        s, e = start[first:last] - begin, end[first:last] - begin
        out[first:last] = (sums[e] - sums[s]) * inverse[s] + (e - s).astype(np.uint64)
        first = last
    return mix(out)


def counts_in(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """How many of ``flags`` are set in each part that ``offsets`` bound."""
    sums = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=sums[1:])
    return sums[offsets[1:]] - sums[offsets[:-1]]


@dataclass
class Texts:
    """Some documents of a batch: ``data[offsets[i]:offsets[i + 1]]`` is the UTF-8 of row ``row + i``."""

    row: int
    data: np.ndarray
    offsets: np.ndarray
    word_bytes: np.ndarray = field(default_factory=lambda: WORD_BYTES)

    def __len__(self) -> int:
        return len(self.offsets) - 1

    @cached_property
    def bounds(self) -> tuple[np.ndarray, np.ndarray]:
        """Start and end of every word."""
        edges = np.zeros(len(self.data) + 1, bool)
        inside = self.word_bytes[self.data]
        edges[1:-1] = inside[1:] != inside[:-1]
        edges[self.offsets] = True
        begins = edges[:-1] & inside
        ends = edges[1:] & inside
        return np.flatnonzero(begins), np.flatnonzero(ends) + 1

    @cached_property
    def first_word(self) -> np.ndarray:
        """The words of document ``i`` are ``first_word[i]`` to ``first_word[i + 1]``."""
        return np.searchsorted(self.bounds[0], self.offsets)

    @cached_property
    def n_words(self) -> np.ndarray:
        return np.diff(self.first_word)

    @cached_property
    def word_doc(self) -> np.ndarray:
        return np.repeat(np.arange(len(self)), self.n_words)

    def word_hashes(self, lower: bool = False) -> np.ndarray:
        return hash_spans(self.data, *self.bounds, lower)


def text_chunks(
    column: pa.Array, chunk_bytes: int = CHUNK_BYTES, word_bytes: np.ndarray = WORD_BYTES, max_rows: int = 1 << 30
) -> Iterator[Texts]:
    """The rows of a string column in order, at most ``max_rows`` at once; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    body = column.buffers()[2]
    data = np.frombuffer(body, np.uint8) if body is not None else np.zeros(0, np.uint8)
    row = 0
    while row < len(column):
        stop = int(np.searchsorted(offsets, offsets[row] + chunk_bytes, "right")) - 1
        stop = min(max(stop, row + 1), row + max_rows, len(column))
        own = offsets[row : stop + 1]
        yield Texts(row, data[own[0] : own[-1]], own - own[0], word_bytes)
        row = stop


def window_hashes(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hashes of all runs of ``size`` neighbours; built by doubling."""
    if size <= 1 or len(hashes) < size:
        return hashes.copy() if size <= 1 else np.zeros(0, np.uint64)
    half = size // 2
    low = window_hashes(hashes, half)
    high = low if size == 2 * half else window_hashes(hashes, size - half)
    n = len(hashes) - size + 1
    return join_hashes(low[:n], high[half : half + n])


def join_hashes(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """The hash of two neighbouring runs."""
    return mix(left * np.uint64(0xD6E8FEB86659FD93) + (right ^ np.uint64(0xA5A3B1C9E2F4D687)))


def windows_of(first_word: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Start word and document of every run of ``size`` words within one document."""
    counts = np.maximum(np.diff(first_word) - size + 1, 0)
    docs = np.repeat(np.arange(len(counts)), counts)
    before = np.cumsum(counts) - counts
    return np.arange(len(docs)) - before[docs] + first_word[:-1][docs], docs


def distinct_shingles(texts: Texts, size: int, lower: bool) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingles of each document, and their offsets.

    A document with fewer words than ``size`` has its whole sequence as its only shingle, one
    without words has none.
    """
    hashes = texts.word_hashes(lower)
    starts, docs = windows_of(texts.first_word, size)
    values = window_hashes(hashes, size)[starts] if len(starts) else np.zeros(0, np.uint64)
    short = np.flatnonzero((texts.n_words > 0) & (texts.n_words < size))
    if len(short):
        whole = np.array(
            [window_hashes(hashes[texts.first_word[d] : texts.first_word[d + 1]], int(texts.n_words[d]))[0] for d in short],
            np.uint64,
        )
        at = np.searchsorted(docs, short)
        values = np.insert(values, at, mix(whole, 7))
        docs = np.insert(docs, at, short)
    ends = np.searchsorted(docs, np.arange(len(texts) + 1))
    for a, b in zip(ends[:-1].tolist(), ends[1:].tolist()):
        values[a:b].sort()
    new = np.ones(len(values), bool)
    new[1:] = (values[1:] != values[:-1]) | (docs[1:] != docs[:-1])
    return values[new], np.concatenate([[0], np.cumsum(counts_in(new, ends))])


def set_fingerprints(values: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """128 bits for each set, the same for the same members."""
    both = []
    for seed in (11, 12):
        sums = np.zeros(len(values) + 1, np.uint64)
        np.cumsum(mix(values, seed), out=sums[1:])
        both.append(mix(sums[offsets[1:]] - sums[offsets[:-1]], seed + 2))
    return both[0], both[1]


def signed(values: np.ndarray) -> np.ndarray:
    """Spark's longs have a sign."""
    return values.astype(np.uint64).view(np.int64)
