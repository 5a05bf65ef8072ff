"""Removal of repeated passages: anchored blocks and window hashes, in place of relative Lempel-Ziv parsing.

Greedy factors are not used. A window of 20 words must go whenever its words start earlier anywhere, also where it lies across
two greedy factors, and the earliest start must be known for each window of thousands of copies; factors against reference blocks
give neither without comparing members of a group in pairs. What is kept of the parsing is the index of reference blocks, whole
blocks taken at once, and checks where blocks of one anchor differ.

A reference block is the stretch of words around an anchor: every window of 20 words picks the 5-word gram with the least
hash in it, and the windows that pick one gram follow each other, so that the anchors cut a document into blocks. Equal
windows pick equal anchors, wherever they stand; the index of blocks is keyed by the anchor's hash.

Documents are parsed against all indexed blocks. A whole block that stands earlier too is one factor, taken without
looking at its windows; every occurrence but the first goes. At factor boundaries, where blocks of one anchor differ, the
first occurrences of the different blocks are compared window by window. Together this finds exactly the windows whose
word sequence also starts earlier (smaller doc_id, or same document and earlier start), whatever the number of copies.

Blocks are counted with partial aggregation before they are shuffled, and no group is collected: a hot anchor costs
counts and first occurrences, its window comparisons one row per different block. Texts go through one shuffle,
compressed; those that share an anchor with something else go through two more.

Defined results: null text has no words; rows without doc_id are kept whole and are no reference; rows that share a doc_id
are taken as repeats of one row, and all of them get its result. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from capsieve.llm import words as W
from capsieve.llm.store import written

WINDOW, GRAM = 20, 5
_REACH = WINDOW - GRAM + 1  # grams of a window; a power of two


@dataclass
class Blocks:
    """Of each block: its text, its anchor's hash and word, its first and last window. Words count from the first text."""

    text: np.ndarray
    anchor: np.ndarray
    at: np.ndarray
    s1: np.ndarray
    s2: np.ndarray
    sums: np.ndarray

    def hash_of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Hash of the words from start to before end, two or more, by the hashes of their pairs."""
        return W.mix((self.sums[end - 1] - self.sums[start]) * W.powers(len(self.sums))[1][start])


def blocks(found: W.Words) -> Blocks:
    h, first = found.hashes(), found.first
    windows = np.maximum(found.counts - WINDOW + 1, 0)
    text = W.segment_ids(windows)
    start = np.repeat(first[:-1], windows) + W.ramp(windows)
    sums = np.zeros(len(h) + 1, np.uint64)
    # pairs of words, not words: sums of two alternating values can cancel whatever the base
    pair = W.mix(h[:-1] * np.uint64(0x9E3779B97F4A7C15) + h[1:])
    np.cumsum(pair * W.powers(len(h) + 1)[0][: len(pair)], out=sums[1 : len(pair) + 1])
    if not len(start):
        none = np.zeros(0, np.int64)
        return Blocks(none, np.zeros(0, np.uint64), none, none, none, sums)
    grams = W.grams(h, GRAM)
    least, at, step = grams, np.arange(len(grams)), 1
    while step < _REACH:
        later = least[step:] < least[:-step]
        at = np.where(later, at[step:], at[:-step])
        least = np.where(later, least[step:], least[:-step])
        step *= 2
    at = at[start]
    new = np.ones(len(at), bool)
    new[1:] = at[1:] != at[:-1]
    runs = np.flatnonzero(new)
    ends = np.append(runs[1:], len(at)) - 1
    return Blocks(text[runs], grams[at[runs]], at[runs], start[runs], start[ends], sums)


def _anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids = batch.column("id").to_numpy()
        for lo, _, found in W.chunks(batch.column("text")):
            b = blocks(found)
            yield pa.RecordBatch.from_arrays([
                pa.array(b.anchor.view(np.int64)), pa.array(ids[lo + b.text]), pa.array((b.at - found.first[b.text]).astype(np.int32))],
                ["anchor", "id", "at"])


def _pressed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    press = zstandard.ZstdCompressor(level=1)
    for batch in batches:
        z = pa.array((press.compress((t.as_py() or "").encode()) for t in batch.column("text")), pa.binary())
        yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("row"), z], ["id", "row", "z"])


def _opened(batch: pa.RecordBatch) -> Iterator[tuple[int, int, W.Words]]:
    """Chunks of the texts of a batch of compressed ones."""
    open_ = zstandard.ZstdDecompressor()
    lo, texts, size = 0, [], 0
    for i, z in enumerate(batch.column("z")):
        texts.append(open_.decompress(z.as_py()))
        size += len(texts[-1])
        if size >= W.CHUNK_BYTES or i + 1 == batch.num_rows:
            offsets = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
            yield lo, i + 1, W.find(np.frombuffer(b"".join(texts), np.uint8), offsets)
            lo, texts, size = i + 1, [], 0


def _lists(batch: pa.RecordBatch, column: str, lo: int, hi: int, base: np.ndarray) -> np.ndarray:
    """Word numbers in an array column of rows lo to hi, counted from the first text of the chunk; sorted within rows."""
    part = batch.column(column).slice(lo, hi - lo)
    counts = np.nan_to_num(part.value_lengths().to_numpy(zero_copy_only=False)).astype(np.int64)
    return part.flatten().to_numpy() + np.repeat(base, counts)


def _shared(batch: pa.RecordBatch, lo: int, hi: int, found: W.Words, b: Blocks) -> np.ndarray:
    """Which blocks have an anchor that stands elsewhere too."""
    return np.isin(b.at, _lists(batch, "marks", lo, hi, found.first[:-1]))


def _contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks with shared anchors: (anchor, hash of the block's words, id, s1)."""
    for batch in batches:
        ids = batch.column("id").to_numpy()
        for lo, hi, found in _opened(batch):
            b = blocks(found)
            keep = _shared(batch, lo, hi, found, b)
            text, s1, s2, at = b.text[keep], b.s1[keep], b.s2[keep], b.at[keep]
            block = W.mix(b.hash_of(s1, s2 + WINDOW) + ((at - s1) * 64 + (s2 - s1)).astype(np.uint64))
            yield pa.RecordBatch.from_arrays([
                pa.array(b.anchor[keep].view(np.int64)), pa.array(block.view(np.int64)), pa.array(ids[lo + text]),
                pa.array((s1 - found.first[text]).astype(np.int32))], ["anchor", "block", "id", "s1"])


def _windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Windows of the blocks that begin at `edges`: (anchor, hash of the window's words, id, s)."""
    for batch in batches:
        ids = batch.column("id").to_numpy()
        for lo, hi, found in _opened(batch):
            b = blocks(found)
            keep = np.isin(b.s1, _lists(batch, "edges", lo, hi, found.first[:-1]))
            n = b.s2[keep] - b.s1[keep] + 1
            s = np.repeat(b.s1[keep], n) + W.ramp(n)
            text = np.repeat(b.text[keep], n)
            yield pa.RecordBatch.from_arrays([
                pa.array(np.repeat(b.anchor[keep], n).view(np.int64)), pa.array(b.hash_of(s, s + WINDOW).view(np.int64)),
                pa.array(ids[lo + text]), pa.array((s - found.first[text]).astype(np.int32))], ["anchor", "window", "id", "s"])


def _joined(found: W.Words, gone: np.ndarray) -> list[bytes]:
    """Of each text, the words that stay, joined by one space."""
    stay = np.flatnonzero(~gone)
    text = found.text_of[stay]
    body = found.data.copy()
    change = np.zeros(len(body) + 1, np.int8)
    change[found.starts[stay]] += 1
    change[found.ends[stay]] -= 1
    keep = np.cumsum(change[:-1], dtype=np.int8).astype(bool)
    gaps = found.ends[stay[:-1]][text[1:] == text[:-1]]
    body[gaps], keep[gaps] = 0x20, True
    bounds = np.concatenate([[0], np.cumsum(keep)])[found.offsets]
    flat = body[keep].tobytes()
    return [flat[a:b] for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)]


def _without(found: W.Words, gone: np.ndarray) -> list[bytes]:
    """Of each text, what is left without the words that go and the separators after each; other bytes are unchanged."""
    change = np.zeros(len(found.data) + 1, np.int8)
    which = np.flatnonzero(gone)
    text = found.text_of
    last = np.ones(len(gone), bool)
    last[:-1] = text[1:] != text[:-1]
    end = np.where(last, found.offsets[text + 1], np.append(found.starts[1:], 0)) if len(gone) else np.zeros(0, np.int64)
    np.add.at(change, found.starts[which], 1)
    np.add.at(change, end[which], -1)
    keep = np.cumsum(change[:-1], dtype=np.int8) == 0
    bounds = np.concatenate([[0], np.cumsum(keep)])[found.offsets]
    flat = found.data[keep].tobytes()
    return [flat[a:b] for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)]


def _result(with_text: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, found in _opened(batch):
                b, base = blocks(found), found.first[:-1]
                factor = _shared(batch, lo, hi, found, b) & ~np.isin(b.s1, _lists(batch, "firsts", lo, hi, base))
                late = _lists(batch, "late", lo, hi, base)
                edge = np.zeros(len(found.starts) + 1, np.int64)
                np.add.at(edge, np.concatenate([b.s1[factor], late]), 1)
                np.add.at(edge, np.concatenate([b.s2[factor], late]) + WINDOW, -1)
                gone = np.cumsum(edge[:-1]) > 0
                removed = np.concatenate([[0], np.cumsum(gone)])
                columns = [batch.column("row").slice(lo, hi - lo), pa.array(found.counts), pa.array(removed[found.first[1:]] - removed[base]),
                           pa.array([hashlib.sha256(t).hexdigest() for t in _joined(found, gone)])]
                names = ["row", "n_words", "n_removed", "kept_sha256"]
                if with_text:
                    columns.append(pa.array([t.decode("utf-8") for t in _without(found, gone)]))
                    names.append("kept_text")
                yield pa.RecordBatch.from_arrays(columns, names)
    return run


def remove_repeats(docs: DataFrame, with_text: bool = True) -> DataFrame:
    """docs (doc_id, text, others) -> (row: struct of all columns but text, n_words, n_removed, kept_sha256, kept_text).

    kept_text is the text without the removed words; kept_sha256 digests the kept words joined by one space.
    """
    others = [c for c in docs.columns if c != "text"]
    docs = docs.select(F.col("doc_id").cast("long").alias("id"), F.struct(*[F.col(f"`{c}`") for c in others]).alias("row"), "text")
    named = docs.where("id IS NOT NULL")
    anchors = named.select("id", "text").mapInArrow(_anchors, "anchor long, id long, at int")
    # written, so that the joins below have two plain sides and skewed anchors are split
    several = written(anchors.groupBy("anchor").count().where("count > 1").select("anchor"), "anchors")
    marks = anchors.join(several, "anchor").groupBy("id").agg(F.array_sort(F.collect_set("at")).alias("marks"))

    schema = T.StructType([docs.schema["id"], docs.schema["row"], T.StructField("z", T.BinaryType())])
    parsed = written(docs.mapInArrow(_pressed, schema).join(marks, "id", "left"), "parsed")
    touched = parsed.where("marks IS NOT NULL")

    first = F.min(F.struct("id", "s1"))
    factors = written(touched.mapInArrow(_contexts, "anchor long, block long, id long, s1 int")
                      .groupBy("anchor", "block").agg(first.alias("f")).select("anchor", "f.*"), "factors")
    differing = written(factors.groupBy("anchor").count().where("count > 1").select("anchor"), "anchors")
    edges = factors.join(differing, "anchor").groupBy("id").agg(F.collect_set("s1").alias("edges"))
    windows = written(touched.join(edges, "id").mapInArrow(_windows, "anchor long, window long, id long, s int"), "windows")
    earliest = windows.groupBy("anchor", "window").agg(F.min(F.struct("id", "s")).alias("f"), F.max(F.struct("id", "s")).alias("l")).where("f != l").drop("l")
    earliest = written(earliest, "earliest")
    late = windows.join(earliest, ["anchor", "window"]).where("struct(id, s) > f").groupBy("id").agg(F.collect_set("s").alias("late"))
    firsts = factors.groupBy("id").agg(F.collect_set("s1").alias("firsts"))

    out = T.StructType([docs.schema["row"], *(T.StructField(n, t) for n, t in (
        ("n_words", T.LongType()), ("n_removed", T.LongType()), ("kept_sha256", T.StringType()),
        *((("kept_text", T.StringType()),) if with_text else ())))])
    nothing = [F.lit(None).cast("array<int>").alias(c) for c in ("firsts", "late")]
    changed = touched.join(firsts, "id", "left").join(late, "id", "left").select("row", "z", "marks", "firsts", "late")
    rest = parsed.where("marks IS NULL").select("row", "z", "marks", *nothing)
    return changed.unionByName(rest).mapInArrow(_result(with_text), out)
