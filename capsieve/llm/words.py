"""Words of many texts at once, as numpy arrays over the bytes of an Arrow string column.

A word is a run of bytes other than space and U+0009 to U+000D; as these are ASCII, words of UTF-8 text are found on bytes.
Hashes have 64 bits and depend on the bytes alone, so that they agree between tasks and runs.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 256 << 10
LONG = 256
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_BASE_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_SEPARATOR = np.zeros(256, bool)
_SEPARATOR[[0x20, 9, 10, 11, 12, 13]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def powers(n: int) -> list[np.ndarray]:
    """Powers 0 to n of the hash base, and of its inverse modulo 2^64."""
    if len(_powers[0]) <= n:
        for i, base in enumerate((_BASE, _BASE_INVERSE)):
            steps = np.full(n + 1, base, np.uint64)
            steps[0] = 1
            _powers[i] = np.cumprod(steps, dtype=np.uint64)
    return _powers


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values whose output bits all depend on all input bits (the finaliser of splitmix64)."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


@dataclass
class Words:
    """data: bytes; starts, ends: of each word in data; first: index of each text's first word, and the number of words."""

    data: np.ndarray
    offsets: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    @property
    def text_of(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), self.counts)

    def hashes(self, lower: bool = False) -> np.ndarray:
        """Hash of each word: its blocks of eight bytes are mixed in one after another, after its length.

        Words of up to eight bytes and equal length never share a hash; others do by chance only, as every step depends on all
        bits before it. Words of over LONG bytes are digested by BLAKE2.
        """
        data = _LOWER[self.data] if lower else self.data
        size = self.ends - self.starts
        out = mix(size.astype(np.uint64) + _BASE)
        if not len(size):
            return out
        padded = np.concatenate([data, np.zeros(8, np.uint8)])
        blocks = np.ndarray(len(data) + 1, "<u8", padded, strides=(1,))  # the eight bytes from each place on
        which, at = np.flatnonzero((size > 0) & (size <= LONG)), 0
        while len(which):
            block, left = blocks[self.starts[which] + at], size[which] - at
            short = left < 8
            block[short] &= (np.uint64(1) << (left[short] * 8).astype(np.uint64)) - np.uint64(1)
            out[which] = mix((out[which] ^ block) + _BASE)
            at += 8
            which = which[left > 8]
        long = np.flatnonzero(size > LONG)
        if len(long):
            raw = data.tobytes()
            out[long] = [int.from_bytes(hashlib.blake2b(raw[i:j], digest_size=8).digest(), "little")
                         for i, j in zip(self.starts[long].tolist(), self.ends[long].tolist(), strict=True)]
        return out

    def units(self, longest: int) -> Words:
        """Words, but those of over `longest` bytes as their single characters: text without spaces has none else."""
        long = (self.ends - self.starts) > longest
        if not long.any():
            return self
        inside = np.zeros(len(self.data) + 1, np.int8)
        np.add.at(inside, self.starts[long], 1)
        np.add.at(inside, self.ends[long], -1)
        places = np.flatnonzero((np.cumsum(inside[:-1]) > 0) & ((self.data & 0xC0) != 0x80))
        starts = np.concatenate([self.starts[~long], places])
        # a character ends where the next one of its word begins, or where the word ends
        after = np.append(places[1:], len(self.data))
        word_end = self.ends[np.searchsorted(self.starts, places, "right") - 1]
        ends = np.concatenate([self.ends[~long], np.minimum(after, word_end)])
        order = np.argsort(starts, kind="stable")
        return Words(self.data, self.offsets, starts[order], ends[order], np.searchsorted(starts[order], self.offsets))

    def strings(self, which: np.ndarray) -> list[bytes]:
        raw = self.data.tobytes()
        return [raw[a:b] for a, b in zip(self.starts[which].tolist(), self.ends[which].tolist(), strict=True)]


def utf8(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], column.type)
    column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    body = column.buffers()[2]
    data = np.frombuffer(body, np.uint8) if body else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def find(data: np.ndarray, offsets: np.ndarray) -> Words:
    inside = ~_SEPARATOR[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    before, after = np.zeros(len(data), bool), np.zeros(len(data), bool)
    before[1:], after[:-1] = inside[:-1], inside[1:]
    starts = np.flatnonzero(inside & (~before | edge[:-1]))
    ends = np.flatnonzero(inside & (~after | edge[1:])) + 1
    return Words(data, offsets, starts, ends, np.searchsorted(starts, offsets))


def chunks(column: pa.Array, size: int = CHUNK_BYTES) -> Iterator[tuple[int, int, Words]]:
    """(first row, end row, words) for runs of rows of about `size` bytes; a longer text is a run of its own."""
    data, offsets = utf8(column)
    row, n = 0, len(offsets) - 1
    while row < n:
        end = max(row + 1, int(np.searchsorted(offsets, offsets[row] + size, "right")) - 1)
        yield row, end, find(data[offsets[row] : offsets[end]], offsets[row : end + 1] - offsets[row])
        row = end


def grams(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hash of the k words from each word on; the last k - 1 entries of every text are to be left out by the caller."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = hashes[:n].copy()
    for j in range(1, k):
        out *= _BASE
        out += hashes[j : j + n]
    return mix(out)


def segment_ids(counts: np.ndarray) -> np.ndarray:
    return np.repeat(np.arange(len(counts)), counts)


def ramp(counts: np.ndarray) -> np.ndarray:
    """0, 1, ... within each segment."""
    ends = np.cumsum(counts)
    return np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - counts, counts)


def shingles(words: Words, k: int, lower: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashes of k-word shingles of each text, ascending, and the bounds of the texts in them.

    A text of fewer than k words has its whole sequence as one shingle, a text without words none.
    """
    h, counts, first = words.hashes(lower), words.counts, words.first
    texts = len(counts)
    per_text = np.maximum(counts - k + 1, 0)
    owner = segment_ids(per_text)
    value = grams(h, k)[np.repeat(first[:-1], per_text) + ramp(per_text)] if len(owner) else np.zeros(0, np.uint64)
    short = np.flatnonzero((counts > 0) & (counts < k))
    if len(short):
        whole = np.zeros(len(short), np.uint64)
        for j in range(k - 1):
            has = counts[short] > j
            whole[has] = mix(whole[has] * _BASE + h[first[short[has]] + j] + np.uint64(j + 1))
        owner, value = np.concatenate([owner, short]), np.concatenate([value, whole])
    order = np.lexsort((value, owner))
    owner, value = owner[order], value[order]
    new = np.ones(len(value), bool)
    new[1:] = (owner[1:] != owner[:-1]) | (value[1:] != value[:-1])
    owner, value = owner[new], value[new]
    return value, np.searchsorted(owner, np.arange(texts + 1))
