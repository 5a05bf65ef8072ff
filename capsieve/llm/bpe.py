"""Byte-pair encoding with contiguous rank arrays, for the word-end vocabulary files of the tokenizers library.

A word is an array of part ids beside an array of the merge ranks of neighbouring parts. The least rank is looked for
again and again; its boundary is deleted from both arrays and the ranks of the two new neighbours are refreshed. All new
words of a batch are merged side by side, a row of a matrix each; words of over 64 parts go through a heap instead.

Texts are cut into raw words at ASCII white space, which no rule of these files looks across. Each different raw word is
normalised, split and encoded once while it stays in the worker's cache, whose size is bounded.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from capsieve.llm import words as W

FAR = np.int32(2**31 - 1)
SHORT = 64
CACHED_WORDS = 500_000
VOCABULARY = "word_bpe_49k.json"


def _printable_bytes() -> list[str]:
    """The character that stands for each byte in byte-level vocabularies: itself where printable, else 256 and on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    spare = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(spare)) for b in range(256)]


def gather(flat: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """The stretches of `flat` one after another."""
    return flat[np.repeat(start, length) + W.ramp(length)]


class Encoder:
    """Encodes and decodes like tokenizers.Tokenizer.from_file(path), add_special_tokens=False, skip_special_tokens=False.

    Only for files of this kind: NFC, white space, lower case; the split pattern of the file; byte level; no decoder.
    """

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        ids = dict(model["vocab"])
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.token = {i: t for t, i in (ids | self.special).items()}
        self.pattern = regex.compile(spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"])
        self.split = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")") if self.special else None
        end = model["end_of_word_suffix"]
        self._path, self._library = path, None
        self.byte = np.array([ids[c] for c in _printable_bytes()], np.int32)
        self.last = np.array([ids[c + end] for c in _printable_bytes()], np.int32)
        self.width = max(self.token) + 1
        self._ranks([(ids[a], ids[b], ids[a + b]) for a, b in (m if isinstance(m, list) else m.split(" ") for m in model["merges"])])
        names = [self.token.get(i, "").encode() + b" " for i in range(self.width)]
        self._name = self._table(names)
        self._number = self._table([b"%d " % i for i in range(self.width)])
        self.forget()

    def _table(self, strings: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        length = np.array([len(s) for s in strings])
        return np.frombuffer(b"".join(strings), np.uint8), np.cumsum(length) - length, length

    def _ranks(self, merges: list[tuple[int, int, int]]) -> None:
        """An open hash table from a pair of ids to the rank of its merge."""
        bits = max(10, len(merges).bit_length() + 3)
        self._shift, self._mask = np.uint64(64 - bits), (1 << bits) - 1
        self._keys, self._rank = np.full(1 << bits, -1, np.int64), np.full(1 << bits, FAR, np.int32)
        self.merged = np.array([m[2] for m in merges] or [0], np.int32)
        self.pairs = {}
        for rank, (a, b, _) in enumerate(merges):
            self.pairs.setdefault(a * self.width + b, rank)
        keys = np.array(list(self.pairs), np.int64)
        for key, slot, rank in zip(keys.tolist(), self._slot(keys).tolist(), self.pairs.values(), strict=True):
            while self._keys[slot] >= 0:
                slot = (slot + 1) & self._mask
            self._keys[slot], self._rank[slot] = key, rank

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self._shift).astype(np.int64)

    def rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        keys = a.astype(np.int64) * self.width + b
        slot = self._slot(keys)
        found = self._keys[slot]
        out = np.where(found == keys, self._rank[slot], FAR)
        left = np.flatnonzero((found != keys) & (found >= 0))
        while len(left):
            slot[left] = (slot[left] + 1) & self._mask
            found = self._keys[slot[left]]
            hit = found == keys[left]
            out[left[hit]] = self._rank[slot[left[hit]]]
            left = left[~hit & (found >= 0)]
        return out

    def _merge_rows(self, parts: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """parts: a word in each row, of so many parts; returns the merged parts and their numbers."""
        n, width = parts.shape
        length = length.copy()
        if width > 1:
            ranks = self.rank(parts[:, :-1].ravel(), parts[:, 1:].ravel()).reshape(n, width - 1)
            ranks[np.arange(width - 1) >= (length - 1)[:, None]] = FAR
            ids, row = parts, np.arange(n)
            column = np.arange(width)
            while len(row):
                at = ranks.argmin(axis=1)
                best = ranks[np.arange(len(row)), at]
                going = best < FAR
                if not going.all():
                    parts[row[~going]] = ids[~going]
                    row, ids, ranks, at, best = row[going], ids[going], ranks[going], at[going], best[going]
                    if not len(row):
                        break
                every = np.arange(len(row))
                ids[every, at] = self.merged[best]
                shift = np.minimum(column + (column > at[:, None]), width - 1)
                ids = np.take_along_axis(ids, shift, 1)
                ranks = np.take_along_axis(ranks, np.minimum(shift[:, :-1] + (column[:-1] == at[:, None]), width - 2), 1)
                length[row] -= 1
                size = length[row]
                ranks[column[:-1] >= (size - 1)[:, None]] = FAR
                right = np.flatnonzero(at < size - 1)
                ranks[right, at[right]] = self.rank(ids[right, at[right]], ids[right, at[right] + 1])
                left = np.flatnonzero(at > 0)
                ranks[left, at[left] - 1] = self.rank(ids[left, at[left] - 1], ids[left, at[left]])
        return parts, length

    def _merge_long(self, parts: list[int]) -> list[int]:
        """One long word: a heap of (rank, place) over a linked list of parts."""
        n, pairs, width = len(parts), self.pairs, self.width
        before, after = list(range(-1, n - 1)), list(range(1, n + 1))
        heap = [(r, i) for i in range(n - 1) if (r := pairs.get(parts[i] * width + parts[i + 1])) is not None]
        heapq.heapify(heap)
        while heap:
            rank, i = heapq.heappop(heap)
            j = after[i]
            if parts[i] < 0 or j >= n or pairs.get(parts[i] * width + parts[j]) != rank:
                continue
            parts[i], parts[j], after[i] = int(self.merged[rank]), -1, after[j]
            if after[i] < n:
                before[after[i]] = i
            for a, b in ((before[i], i), (i, after[i])):
                if a >= 0 and b < n and (r := pairs.get(parts[a] * width + parts[b])) is not None:
                    heapq.heappush(heap, (r, a))
        return [p for p in parts if p >= 0]

    def merge(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words that are split already, one word's after the other's, and how many each has."""
        size = np.array([len(w) for w in words], np.int64)
        data = np.frombuffer(b"".join(words), np.uint8)
        flat = self.byte[data]
        flat[np.cumsum(size) - 1] = self.last[data[np.cumsum(size) - 1]]
        start, count = np.cumsum(size) - size, size.copy()
        out = flat.copy()
        order = np.argsort(size, kind="stable")
        bounds = np.searchsorted(size[order], [0, 5, 9, 13, 17, 25, 33, SHORT + 1])
        for lo, hi in zip(bounds[:-1], bounds[1:], strict=True):
            for at in range(lo, hi, 20_000):
                which = order[at : min(hi, at + 20_000)]
                width = size[which].max()
                cells = np.arange(width)
                inside = cells < size[which][:, None]
                parts = np.where(inside, flat[np.minimum(start[which][:, None] + cells, len(flat) - 1)], 0)
                parts, count[which] = self._merge_rows(parts, size[which])
                keep = cells < count[which][:, None]
                out[np.repeat(start[which], count[which]) + W.ramp(count[which])] = parts[keep]
        for i in order[bounds[-1] :]:
            ids = self._merge_long(flat[start[i] : start[i] + size[i]].tolist())
            out[start[i] : start[i] + len(ids)], count[i] = ids, len(ids)
        return gather(out, start, count), count

    def pieces(self, raw: bytes) -> list[bytes | int]:
        """A raw word as normalised words, and the ids of special tokens between them."""
        text = raw.decode("utf-8")
        if text.isascii() and "<|" not in text:
            low = text.lower()
            return [low.encode()] if low.isalpha() else [w.encode() for w in self.pattern.findall(low)]
        out: list[bytes | int] = []
        for part in self.split.split(text) if self.split else [text]:
            if part in self.special:
                out.append(self.special[part])
            elif part and max(part) >= "\u0530":
                out += self._by_library(part)
            else:
                part = unicodedata.normalize("NFC", part)
                part = "".join(c.lower() for c in part) if "Σ" in part else part.lower()
                out += [w.encode() for w in self.pattern.findall(part)]
        return out

    def _by_library(self, part: str) -> list[bytes]:
        """Words of other scripts, whose characters change class between Unicode versions, by the library's own tables."""
        if self._library is None:
            self._library = Tokenizer.from_file(self._path)
            self._unprintable = {c: b for b, c in enumerate(_printable_bytes())}
        words = self._library.pre_tokenizer.pre_tokenize_str(self._library.normalizer.normalize_str(part))
        return [bytes(self._unprintable[c] for c in w) for w, _ in words]

    def forget(self) -> None:
        self._known, self._place = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self._start, self._length, self._ids = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int32)

    def _learn(self, hashes: np.ndarray, raw: list[bytes]) -> None:
        pieces = [self.pieces(w) for w in raw]
        number: dict[bytes, int] = {}
        code = [number.setdefault(p, len(number)) if isinstance(p, bytes) else -1 - p for w in pieces for p in w]
        per_word = np.array([len(w) for w in pieces], np.int64)
        ids, count = self.merge(list(number)) if number else (np.zeros(0, np.int32), np.zeros(0, np.int64))
        special = np.array(sorted(self.special.values()), np.int32)
        start = np.concatenate([np.cumsum(count) - count, len(ids) + np.arange(len(special))])
        ids, count = np.concatenate([ids, special]), np.concatenate([count, np.ones(len(special), np.int64)])
        code_at = np.array(code, np.int64)
        below = code_at < 0
        code_at[below] = len(number) + np.searchsorted(special, -1 - code_at[below])
        bounds = np.concatenate([[0], np.cumsum(per_word)])
        total = np.concatenate([[0], np.cumsum(count[code_at])])
        length = total[bounds[1:]] - total[bounds[:-1]]
        if len(self._known) > CACHED_WORDS:
            self.forget()
        place = len(self._start) + np.arange(len(raw))
        self._start = np.append(self._start, len(self._ids) + np.cumsum(length) - length)
        self._length = np.append(self._length, length)
        self._ids = np.append(self._ids, gather(ids, start[code_at], count[code_at]))
        at = np.searchsorted(self._known, hashes)
        self._known, self._place = np.insert(self._known, at, hashes), np.insert(self._place, at, place)

    def encode(self, found: W.Words) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts of a chunk one after another, and the bounds of each text's."""
        if not len(found.starts):
            return np.zeros(0, np.int32), np.zeros(len(found.first), np.int64)
        hashes, one, back = np.unique(found.hashes(), return_index=True, return_inverse=True)

        def looked_up() -> tuple[np.ndarray, np.ndarray]:
            at = np.searchsorted(self._known, hashes)
            known = at < len(self._known)
            known[known] = self._known[at[known]] == hashes[known]
            return at, known

        at, known = looked_up()
        if not known.all():
            self._learn(hashes[~known], found.strings(one[~known]))
            at, known = looked_up()
            if not known.all():  # the cache was emptied
                self._learn(hashes[~known], found.strings(one[~known]))
                at, known = looked_up()
        place = self._place[at][back]
        length = self._length[place]
        bounds = np.concatenate([[0], np.cumsum(length)])[found.first]
        return gather(self._ids, self._start[place], length), bounds

    def _written(self, table: tuple[np.ndarray, np.ndarray, np.ndarray], ids: np.ndarray, bounds: np.ndarray) -> list[bytes]:
        flat, start, length = table
        body = gather(flat, start[ids], length[ids]).tobytes()
        edges = np.concatenate([[0], np.cumsum(length[ids])])[bounds]
        return [body[a : max(a, b - 1)] for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True)]

    def decode(self, ids: np.ndarray, bounds: np.ndarray) -> list[bytes]:
        """Texts of the ids in UTF-8: without a decoder, tokens are joined by one space."""
        return self._written(self._name, ids, bounds)

    def decimal(self, ids: np.ndarray, bounds: np.ndarray) -> list[bytes]:
        return self._written(self._number, ids, bounds)


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """One encoder for each worker process; the file is installed beside the tokenizers on every machine."""
    return Encoder(path)


def _digests(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(path)
        for batch in batches:
            for lo, hi, found in W.chunks(batch.column("text"), 1 << 20):
                ids, bounds = coder.encode(found)
                digests = [pa.array([hashlib.sha256(t).hexdigest() for t in texts]) for texts in (coder.decimal(ids, bounds), coder.decode(ids, bounds))]
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(lo, hi - lo), pa.array(np.diff(bounds)), *digests],
                                                 ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])
    return run


def _encoded(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(path)
        for batch in batches:
            for lo, hi, found in W.chunks(batch.column("text"), 1 << 20):
                ids, bounds = coder.encode(found)
                yield pa.RecordBatch.from_arrays([
                    batch.column("doc_id").slice(lo, hi - lo), pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(ids, pa.int32())),
                    pa.array([t.decode("utf-8") for t in coder.decode(ids, bounds)])], ["doc_id", "ids", "decoded"])
    return run


def encode(docs: DataFrame, path: str) -> DataFrame:
    """docs (doc_id, text) -> (doc_id, ids, decoded). Null text counts as empty: no ids, empty decoded text."""
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(_encoded(path), "doc_id long, ids array<int>, decoded string")


def digests(docs: DataFrame, path: str) -> DataFrame:
    """docs (doc_id, text) -> (doc_id, n_tokens, ids_sha256, decoded_sha256) of the same encoding and decoding."""
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(_digests(path), "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
