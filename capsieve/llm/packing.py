"""Best-fit packing of tokenised documents into fixed-length sequences, with certified bin counts.

Documents become pieces of at most `capacity` tokens. Pieces are dealt to groups of bounded size, and each group is packed
by best-fit decreasing. Dual-feasible functions give a lower bound on the bins that a group needs; a group that meets its
bound is certified, and only its emptiest bin goes on. In the others, full bins stay and the pieces of bins with gaps are exchanged.
These pieces are dealt to new, full-sized groups and packed again. A round counts only if it saves bins; rounds end when one saves
less than a thousandth of the open bins.

Only lengths are packed; ids never leave the task that encodes them. Groups are bounded by `group_size`, so no task or
driver ever sees more. Defined results: null text is empty and becomes one piece with the end mark alone; repeated rows
are packed once each; an empty table gives no rows; extra columns of the input are not looked at.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from capsieve.llm import words as W
from capsieve.llm.bpe import encoder
from capsieve.llm.store import written

CAPACITY, END, GROUP = 2048, 0, 4096
LEAST_SAVING = 1000  # a round that saves less than this part of the open sequences is the last: the next would save still less
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def _pieces(path: str, capacity: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(path)
        for batch in batches:
            for lo, hi, found in W.chunks(batch.column("text"), 1 << 20):
                ids, bounds = coder.encode(found)
                flat = np.insert(ids, bounds[1:], END).astype("<u4")
                bounds = bounds + np.arange(len(bounds))
                tokens = np.diff(bounds)
                n = -(-tokens // capacity)
                piece = W.ramp(n)
                start = piece * capacity
                length = np.minimum(np.repeat(tokens, n) - start, capacity)
                at = (np.repeat(bounds[:-1], n) + start) * 4
                body = memoryview(flat.tobytes())
                sums = [zlib.crc32(body[a : a + b]) for a, b in zip(at.tolist(), (length * 4).tolist(), strict=True)]
                owner = pa.array(np.repeat(np.arange(hi - lo), n))
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(lo, hi - lo).take(owner), pa.array(piece.astype(np.int32)), pa.array(start),
                                                  pa.array(length), pa.array(sums, pa.int64())], ["doc_id", "piece", "start", "length", "ids_crc32"])
    return run


def best_fit(sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Best-fit decreasing: the bin and the offset in it of each size. Open bins lie in stacks by gap, with a bit set for each used gap."""
    bins, offsets = np.empty(len(sizes), np.int64), np.empty(len(sizes), np.int64)
    by_gap: list[list[int]] = [[] for _ in range(capacity + 1)]
    used, count = 0, 0
    for i in np.argsort(-sizes, kind="stable").tolist():
        size = int(sizes[i])
        fits = used >> size
        if fits:
            gap = size + (fits & -fits).bit_length() - 1
            at = by_gap[gap].pop()
            if not by_gap[gap]:
                used &= ~(1 << gap)
        else:
            gap, at, count = capacity, count, count + 1
        bins[i], offsets[i] = at, capacity - gap
        if gap > size:
            by_gap[gap - size].append(at)
            used |= 1 << (gap - size)
    return bins, offsets


def lower_bound(sizes: np.ndarray, capacity: int) -> int:
    """Bins that any packing needs: the best of the sum, the large-item rule for each limit, and the rounding rule for k to 64."""
    if not len(sizes):
        return 0
    count = np.bincount(sizes, minlength=capacity + 1)
    number, total = np.cumsum(count), np.cumsum(count * np.arange(capacity + 1))
    best = -(-int(total[-1]) // capacity)
    limit = np.arange(1, capacity // 2 + 1)
    # sizes over capacity - limit fill a bin, those under limit count nothing
    large = len(sizes) - number[capacity - limit]
    middle = total[capacity - limit] - total[limit - 1]
    best = max(best, int((large + -(-middle // capacity)).max()))
    size = np.arange(capacity + 1)
    for k in range(1, 65):
        exact = (k + 1) * size % capacity == 0
        worth = np.where(exact, size * k, (k + 1) * size // capacity * capacity)
        best = max(best, -(-int((count * worth).sum()) // (capacity * k)))
    return best


def _pack(capacity: int, round_: int):
    def run(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["length", "doc_id", "piece", "ids_crc32"], ascending=False, kind="stable", ignore_index=True)
        sizes = frame["length"].to_numpy()
        bins, offsets = best_fit(sizes, capacity)
        filled = np.bincount(bins, sizes)
        certified = len(filled) == lower_bound(sizes, capacity)
        out = frame[["doc_id", "piece", "start", "length", "ids_crc32"]].copy()
        out["sequence_id"] = (round_ << 56) + (int(frame["group"].iloc[0]) << 28) + bins
        # what a certified group cannot save by itself may still fill another's gaps: its emptiest sequence goes on
        again = (bins == filled.argmin()) if certified else True
        out["offset"], out["open"] = offsets, (filled[bins] < capacity) & again
        return out
    return run


def pack_pieces(pieces: DataFrame, capacity: int = CAPACITY, group_size: int = GROUP, least_saving: int = LEAST_SAVING) -> DataFrame:
    """pieces -> the same with sequence_id and offset. Rounds of exchange go on while one saves a `least_saving`-th of the open sequences."""
    schema = f"{PIECES}, sequence_id long, offset long, open boolean"
    columns = ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]

    def dealt(rows: DataFrame, number: int, round_: int) -> DataFrame:
        groups = max(1, -(-number // group_size))
        # the row's number beside its content: repeated rows are dealt apart
        place = F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32", F.monotonically_increasing_id(), F.lit(round_)), F.lit(groups))
        return rows.select(*columns[:5], place.cast("long").alias("group")).groupBy("group").applyInPandas(_pack(capacity, round_), schema)

    pieces = written(pieces, "pieces")
    number = pieces.count()
    state = written(dealt(pieces, number, 0), "packed")
    done, round_ = [], 0
    while True:
        round_ += 1
        loose = state.where("open")
        number, before = loose.agg(F.count("*"), F.count_distinct("sequence_id")).first()
        if not number:
            break
        again = written(dealt(loose, number, round_), "packed")
        saved = before - again.agg(F.count_distinct("sequence_id")).first()[0]
        if saved > 0:
            done.append(state.where("NOT open"))
            state = again
        if saved * least_saving < before:
            break
    for part in done:
        state = state.unionByName(part)
    return state.select(columns)


def cut(docs: DataFrame, path: str, capacity: int = CAPACITY) -> DataFrame:
    """docs (doc_id, text) -> pieces of at most `capacity` tokens, with the CRC of their ids."""
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(_pieces(path, capacity), PIECES)


def pack(docs: DataFrame, path: str, capacity: int = CAPACITY) -> DataFrame:
    """docs (doc_id, text) -> (doc_id, piece, start, length, ids_crc32, sequence_id, offset)."""
    return pack_pieces(cut(docs, path, capacity), capacity)
