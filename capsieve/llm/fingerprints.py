"""Order MinHash fingerprints, whose likeness follows edit distance.

A text is a sequence of words, and of the single characters of runs of over 48 bytes, as scripts without spaces have them; its 3-word grams are numbered by occurrence, so that repeats differ. For each of 64 hash
functions the two grams with the least hashes are taken, put back into text order, and hashed as a pair to 16 bits; the
fingerprint is the row of these values in hexadecimal. Likeness is the share of equal values. As pairs keep their order,
moving text lowers the likeness, which a plain MinHash does not notice.

Defined results: null text counts as empty; texts without words share one fingerprint, of zeros; a text of fewer than three
words is one gram. Equal texts have equal fingerprints. Documents follow each other by doc_id, rows that share one by their
text, rows without doc_id come first; the last is followed by the first, a lone one by itself.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from capsieve.llm import words as W

GRAM, VALUES = 3, 64
LONGEST = 48  # bytes of a word; longer runs are taken character by character
_NONE = np.uint64(2**64 - 1)
_MULTIPLIERS = W.mix(np.arange(1, VALUES + 1, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93)) | np.uint64(1)


def fingerprints(found: W.Words) -> np.ndarray:
    """texts x 64 values of 16 bits."""
    found = found.units(LONGEST)
    counts, first, h = found.counts, found.first, found.hashes()
    out = np.zeros((len(counts), VALUES), np.uint16)
    per_text = np.where(counts > 0, np.maximum(counts - GRAM + 1, 1), 0)
    full = np.flatnonzero(per_text)
    if not len(full):
        return out
    owner, place = W.segment_ids(per_text), W.ramp(per_text)
    at = np.repeat(first[:-1], per_text) + place
    value = np.zeros(len(at), np.uint64)
    for j in range(GRAM):
        inside = at + j < first[owner + 1]
        value = W.mix(value * np.uint64(0x9E3779B97F4A7C15) + np.where(inside, h[np.minimum(at + j, len(h) - 1)], np.uint64(j)))
    order = np.lexsort((value, owner))
    new = np.ones(len(order), bool)
    new[1:] = (owner[order][1:] != owner[order][:-1]) | (value[order][1:] != value[order][:-1])
    occurrence = np.empty(len(order), np.uint64)
    occurrence[order] = W.ramp(np.diff(np.append(np.flatnonzero(new), len(order)))).astype(np.uint64)
    numbered = W.mix(value + occurrence * np.uint64(0xA0761D6478BD642F))

    starts = np.concatenate([[0], np.cumsum(per_text[full])[:-1]])
    low = np.uint64((1 << 32) - 1)  # bits that hold the place in the text
    places = place.astype(np.uint64)
    for j, multiplier in enumerate(_MULTIPLIERS):
        keyed = ((numbered * multiplier) & ~low) | places
        one = starts + (np.minimum.reduceat(keyed, starts) & low).astype(np.int64)
        keyed[one] = _NONE
        least = np.minimum.reduceat(keyed, starts)
        two = np.where(least == _NONE, one, starts + (least & low).astype(np.int64))
        early, late = value[np.minimum(one, two)], value[np.maximum(one, two)]
        out[full, j] = W.mix(W.mix(early) * np.uint64(3) + late + np.uint64(j)) >> np.uint64(48)
    return out


def of_texts(texts: list[bytes]) -> np.ndarray:
    out = np.zeros((len(texts), VALUES), np.uint16)
    lo, size = 0, 0
    for i, text in enumerate(texts):
        size += len(text)
        if size >= W.CHUNK_BYTES or i + 1 == len(texts):
            offsets = np.concatenate([[0], np.cumsum([len(t) for t in texts[lo : i + 1]])]).astype(np.int64)
            out[lo : i + 1] = fingerprints(W.find(np.frombuffer(b"".join(texts[lo : i + 1]), np.uint8), offsets))
            lo, size = i + 1, 0
    return out


def hexadecimal(values: np.ndarray) -> list[str]:
    flat, width = values.astype(">u2").tobytes().hex(), 4 * VALUES
    return [flat[i : i + width] for i in range(0, len(flat), width)]


def fingerprint(docs: DataFrame) -> DataFrame:
    """docs (doc_id, text) -> (doc_id, fingerprint)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, found in W.chunks(batch.column("text")):
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(lo, hi - lo), pa.array(hexadecimal(fingerprints(found)))], ["doc_id", "fingerprint"])
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, fingerprint string")


def _dealt(firsts: np.ndarray):
    """Rows to the range that holds their key; the first of each range also goes to the range before, as what lies ahead."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdCompressor(level=1)
        for batch in batches:
            key = batch.column("key").to_numpy()
            z = pa.array((press.compress((t.as_py() or "").encode()) for t in batch.column("text")), pa.binary())
            place = np.maximum(np.searchsorted(firsts, key, "right") - 1, 0)
            ahead = np.flatnonzero(firsts[place] == key)
            rows = np.concatenate([np.arange(len(key)), ahead])
            places = np.concatenate([place, (place[ahead] - 1) % len(firsts)])
            flag = np.arange(len(rows)) >= len(key)
            take = pa.array(rows)
            yield pa.RecordBatch.from_arrays([pa.array(places.astype(np.int32)), pa.array(flag), pa.array(key[rows]), batch.column("doc_id").take(take), z.take(take)],
                                             ["place", "ahead", "key", "doc_id", "z"])
    return run


def _beside_next(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows in order; each text is compared with its edited form and with the next text."""
    open_ = zstandard.ZstdDecompressor()
    held: tuple | None = None
    for whole in batches:
        for at in range(0, whole.num_rows, 1000):
            batch = whole.slice(at, 1000)
            place, ahead, ids = (batch.column(c).to_pylist() for c in ("place", "ahead", "doc_id"))
            raw = [open_.decompress(z.as_py()) for z in batch.column("z")]
            texts, values = [t.decode("utf-8") for t in raw], of_texts(raw)
            if held is not None:
                place, ahead, ids, texts = ([x, *xs] for x, xs in zip(held[:4], (place, ahead, ids, texts), strict=True))
                values = np.vstack([held[4][None, :], values])
            own = [i for i in range(len(ids) - 1) if not ahead[i]]
            held = (place[-1], ahead[-1], ids[-1], texts[-1], values[-1])
            if not own:
                continue
            edited = []
            for i in own:
                half = len(texts[i]) // 2
                edited.append((texts[i][: len(texts[i]) - half] + texts[i + 1][:half]).encode())
            changed = of_texts(edited)
            mine, following = values[own], values[[i + 1 for i in own]]
            yield pa.RecordBatch.from_arrays([
                pa.array([ids[i] for i in own], pa.int64()), pa.array([len(texts[i]) for i in own], pa.int64()),
                pa.array([hashlib.sha256(t).hexdigest() for t in edited]), pa.array(hexadecimal(mine)), pa.array(hexadecimal(changed)),
                pa.array((mine == changed).mean(axis=1)), pa.array((mine == following).mean(axis=1))],
                ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"])


def edit_likeness(docs: DataFrame) -> DataFrame:
    """docs (doc_id, text) -> fingerprints of each text and of its edited form, and the likeness to that and to the next text.

    Texts are shuffled once, compressed, into ranges of doc_id. The ranges' first ids are all that the driver gets.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").withColumn("key", F.coalesce("doc_id", F.lit(-(2**63)).cast("long")))
    ranges = int(spark.conf.get("spark.sql.shuffle.partitions"))
    firsts = docs.select("key").repartitionByRange(ranges, "key").groupBy(F.spark_partition_id()).agg(F.min("key").alias("key")).toPandas()
    if not len(firsts):
        firsts = firsts.reindex([0], fill_value=0)
    at = np.sort(firsts["key"].to_numpy(np.int64))
    rows = docs.mapInArrow(_dealt(at), "place int, ahead boolean, key long, doc_id long, z binary")
    return (rows.repartition(ranges, "place").sortWithinPartitions("place", "ahead", "key", "z")
            .mapInArrow(_beside_next, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"))
