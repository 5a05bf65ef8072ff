"""MinHash near-duplicate groups with b-bit signatures.

Every text becomes a set of word shingles. 128 minima of the set give (a) band keys, from whole minima, that bring likely
partners into one bucket, and (b) a packed signature of the low four bits of each minimum. The share of equal low bits of
two signatures, corrected for chance collisions, estimates the similarity of two sets; pairs far below the threshold stop
there, the others are confirmed on the full sets.

Equal sets are first collapsed into classes. Buckets are never expanded into all pairs: members are compared with the
smallest member of their bucket (a star), and after the components of those links are known, only members of one bucket
that are still in different components are compared, in blocks of bounded size that return a spanning forest of the links
found in them. A pair at similarity s shares a band
with probability 1 - (1 - s^4)^32, which at 0.8 is 1 - 5e-8; the estimate's margin is five standard deviations.

Defined results: null or empty text and text without words is an empty set, linked with nothing; rows without doc_id are
their own group (component_id null, kept true); rows that share a doc_id count as one document. An empty table gives no
rows. Other columns of the input are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from capsieve.llm import words as W
from capsieve.llm.graph import components
from capsieve.llm.store import written

HASHES, BAND_ROWS, BITS = 128, 4, 4
BANDS = HASHES // BAND_ROWS
MARGIN = 0.18  # five standard deviations of the estimate at 0.8
BLOCK = 512  # members of a bucket that one task compares with as many others
_MULTIPLIERS = W.mix(np.arange(1, HASHES + 1, dtype=np.uint64) * np.uint64(0xA24BAED4963EE407)) | np.uint64(1)
_LOW_OF_EACH = np.uint64(0x1111111111111111)


def minima(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """The minimum of each of the 128 permutations over each segment; segments are not empty."""
    out = np.empty((HASHES, len(bounds) - 1), np.uint64)
    for i, multiplier in enumerate(_MULTIPLIERS):
        out[i] = np.minimum.reduceat(values * multiplier, bounds[:-1])
    return out


def band_keys(least: np.ndarray) -> np.ndarray:
    keys = np.empty((least.shape[1], BANDS), np.uint64)
    for b in range(BANDS):
        key = np.full(least.shape[1], b + 1, np.uint64)
        for row in least[b * BAND_ROWS : (b + 1) * BAND_ROWS]:
            key = W.mix(key * np.uint64(0x9E3779B97F4A7C15) + row)
        keys[:, b] = key
    return keys


def packed(least: np.ndarray) -> np.ndarray:
    """Signatures: the low bits of the (mixed) minima, 16 to a 64-bit value."""
    low = (W.mix(least) & np.uint64(15)).T.reshape(least.shape[1], HASHES // 16, 16)
    return (low << (np.arange(16, dtype=np.uint64) * np.uint64(BITS))).sum(axis=2, dtype=np.uint64)


def estimate(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Similarity estimated from packed signatures: (share of equal low bits - 1/16) / (1 - 1/16)."""
    x = a ^ b
    x = (x | x >> np.uint64(1) | x >> np.uint64(2) | x >> np.uint64(3)) & _LOW_OF_EACH
    equal = 1 - np.bitwise_count(x).sum(axis=-1, dtype=np.int64) / HASHES
    chance = 0.5**BITS
    return (equal - chance) / (1 - chance)


def _sketch(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, found in W.chunks(batch.column("text")):
                values, bounds = W.shingles(found, k)
                n = np.diff(bounds)
                full = np.flatnonzero(n)
                sums = np.zeros((2, len(n)), np.uint64)
                keys = np.zeros((0, BANDS), np.uint64)
                signatures: list[bytes | None] = [None] * len(n)
                if len(full):
                    edges = np.append(bounds[:-1][full], bounds[-1])
                    sums[0, full] = np.add.reduceat(W.mix(values), edges[:-1])
                    sums[1, full] = np.add.reduceat(W.mix(values ^ np.uint64(0x5851F42D4C957F2D)), edges[:-1])
                    least = minima(values, edges)
                    keys = band_keys(least)
                    for i, row in zip(full.tolist(), packed(least), strict=True):
                        signatures[i] = row.tobytes()
                offsets = np.concatenate([[0], np.cumsum(np.where(n > 0, BANDS, 0))])
                yield pa.RecordBatch.from_arrays([
                    batch.column("id").slice(lo, hi - lo), pa.array(n), *(pa.array(s.view(np.int64)) for s in sums),
                    pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(keys.reshape(-1).view(np.int64))),
                    pa.array(signatures, pa.binary())], ["id", "n", "h1", "h2", "bands", "signature"])
    return run


def _compressed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    press = zstandard.ZstdCompressor(level=1)
    for batch in batches:
        texts = (press.compress((t.as_py() or "").encode()) for t in batch.column("text"))
        yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(texts, pa.binary())], ["id", "z"])


def _confirm(k: int, percent: int):
    """Rows (a, b, na, nb, za, zb, sa, sb) -> the pairs that meet the threshold."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_ = zstandard.ZstdDecompressor()
        for batch in batches:
            if not batch.num_rows:
                continue
            n = {c: batch.column(c).to_numpy() for c in ("na", "nb")}
            signs = [np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint64).reshape(-1, HASHES // 16) for c in ("sa", "sb")]
            low, high = np.minimum(n["na"], n["nb"]), np.maximum(n["na"], n["nb"])
            likely = (100 * low >= percent * high) & (estimate(*signs) >= percent / 100 - MARGIN)
            pairs = batch.filter(pa.array(likely))
            step = max(1, int(200_000 // max(1, high.mean())))
            for at in range(0, pairs.num_rows, step):
                part = pairs.slice(at, step)
                texts = [open_.decompress(z.as_py()) for c in ("za", "zb") for z in part.column(c)]
                offsets = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
                value, bounds = W.shingles(W.find(np.frombuffer(b"".join(texts), np.uint8), offsets), k)
                m, sizes = part.num_rows, np.diff(bounds)
                pair = np.repeat(np.tile(np.arange(m), 2), sizes)
                order = np.lexsort((value, pair))
                pair, value = pair[order], value[order]
                twice = (pair[1:] == pair[:-1]) & (value[1:] == value[:-1])
                both = np.bincount(pair[1:][twice], minlength=m)
                yield part.select(["a", "b"]).filter(pa.array(100 * both >= percent * (sizes[:m] + sizes[m:] - both)))
    return run


def _common(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of each set on the left with each on the right, by products of 0/1 matrices over shared values."""
    out = np.zeros((len(left), len(right)), np.float32)
    shared = np.intersect1d(np.unique(np.concatenate(left)), np.unique(np.concatenate(right)), assume_unique=True)
    for at in range(0, len(shared), 4096):
        values = shared[at : at + 4096]
        sides = []
        for sets in (left, right):
            flat, sizes = np.concatenate(sets), [len(s) for s in sets]
            column = np.minimum(np.searchsorted(values, flat), len(values) - 1)
            hit = values[column] == flat
            side = np.zeros((len(sets), len(values)), np.float32)
            side[np.repeat(np.arange(len(sets)), sizes)[hit], column[hit]] = 1
            sides.append(side)
        out += sides[0] @ sides[1].T
    return out


def _forest(linked: np.ndarray) -> list[tuple[int, int]]:
    """Links of a spanning forest of a symmetric link matrix: at most one for each node, whatever the number of links."""
    todo, out = np.ones(len(linked), bool), []
    for root in range(len(linked)):
        if not todo[root]:
            continue
        todo[root] = False
        waiting = [root]
        while waiting:
            node = waiting.pop()
            new = np.flatnonzero(linked[node] & todo)
            todo[new] = False
            out += [(node, int(i)) for i in new]
            waiting += new.tolist()
    return out


def _between_components(k: int, percent: int):
    """Members of buckets, sorted by (key, bi, bj) -> links between different components, confirmed on the full sets.

    Within a block pair, likely pairs are found with the signatures and counted on the full sets; of the links found, a
    spanning forest is returned, so that the rows grow with the members and not with the pairs.
    """
    def of_group(g: dict[str, np.ndarray], lo: int, hi: int) -> list[tuple[int, int]]:
        bi, bj = g["bi"][lo], g["bj"][lo]
        block, rows = g["block"][lo:hi], np.arange(lo, hi)
        left, right = rows[block == bi], rows[block == bj]
        if not len(left) or not len(right):
            return []
        likely = np.zeros((len(left), len(right)), bool)
        for at in range(0, len(left), 128):
            x, y = left[at : at + 128, None], right[None, :]
            ok = g["component"][x] != g["component"][y]
            nx, ny = g["n"][x], g["n"][y]
            ok &= 100 * np.minimum(nx, ny) >= percent * np.maximum(nx, ny)
            i, j = np.nonzero(ok)
            good = estimate(g["signature"][x[i, 0]], g["signature"][right[j]]) >= percent / 100 - MARGIN
            likely[at + i[good], j[good]] = True
        i, j = np.flatnonzero(likely.any(axis=1)), np.flatnonzero(likely.any(axis=0))
        if not len(i):
            return []
        open_ = zstandard.ZstdDecompressor()
        members = np.unique(np.concatenate([left[i], right[j]]))
        texts = [open_.decompress(g["z"][m]) for m in members]
        offsets = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
        value, bounds = W.shingles(W.find(np.frombuffer(b"".join(texts), np.uint8), offsets), k)
        sets = [value[a:b] for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
        place_i, place_j = np.searchsorted(members, left[i]), np.searchsorted(members, right[j])
        both = _common([sets[m] for m in place_i], [sets[m] for m in place_j])
        sizes = np.diff(bounds)
        linked = likely[np.ix_(i, j)] & (100 * both >= percent * (sizes[place_i][:, None] + sizes[place_j][None, :] - both))
        matrix = np.zeros((len(members), len(members)), bool)
        matrix[np.ix_(place_i, place_j)] = linked
        ids = g["id"][members]
        return [(ids[a], ids[b]) for a, b in _forest(matrix | matrix.T)]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rest: pd.DataFrame | None = None

        def pairs(frame: pd.DataFrame) -> Iterator[pd.DataFrame]:
            g = {c: frame[c].to_numpy() for c in ("key", "bi", "bj", "block", "id", "component", "n", "z")}
            g["signature"] = np.frombuffer(b"".join(frame["signature"]), np.uint64).reshape(-1, HASHES // 16)
            new = np.flatnonzero((g["key"][1:] != g["key"][:-1]) | (g["bi"][1:] != g["bi"][:-1]) | (g["bj"][1:] != g["bj"][:-1])) + 1
            out = [p for lo, hi in zip([0, *new], [*new, len(frame)], strict=True) for p in of_group(g, lo, hi)]
            if out:
                a, b = np.array(out, np.int64).T
                yield pd.DataFrame({"a": np.minimum(a, b), "b": np.maximum(a, b)}).drop_duplicates()

        for frame in frames:
            frame = frame if rest is None else pd.concat([rest, frame], ignore_index=True)
            if not len(frame):
                continue
            last = frame.iloc[-1]
            tail = (frame["key"] == last["key"]) & (frame["bi"] == last["bi"]) & (frame["bj"] == last["bj"])
            rest = frame[tail]
            if not tail.all():
                yield from pairs(frame[~tail])
        if rest is not None and len(rest):
            yield from pairs(rest)
    return run


def near_duplicates(docs: DataFrame, words: int = 4, percent: int = 80) -> DataFrame:
    """docs (doc_id, text) -> (doc_id, n_shingles, component_id, kept), a row for each row."""
    docs = docs.select(F.col("doc_id").cast("long").alias("id"), "text")
    sketches = written(docs.mapInArrow(_sketch(words), "id long, n long, h1 long, h2 long, bands array<long>, signature binary"), "sketches")
    known = sketches.where("id IS NOT NULL AND n > 0")

    # classes of equal sets; only those of several documents need to be looked up
    several = known.groupBy("n", "h1", "h2").agg(F.min("id").alias("rep"), F.max("id").alias("other")).where("rep != other").drop("other")
    several = written(several, "classes")  # here and below: a join with a written table can split skewed keys
    members = written(known.join(several, ["n", "h1", "h2"], "left").select("id", F.coalesce("rep", "id").alias("rep"), "n", "bands", "signature"), "members")
    reps = members.where("id = rep")

    # buckets with several classes, each member beside the smallest
    banded = reps.select("id", F.explode("bands").alias("key"))
    buckets = banded.groupBy("key").agg(F.min("id").alias("hub"), F.max("id").alias("other")).where("hub != other").drop("other")
    buckets = written(buckets, "buckets")
    placed = written(banded.join(buckets, "key"), "placed")
    stars = placed.where("id != hub").select(F.col("hub").alias("a"), F.col("id").alias("b")).distinct()
    wanted = placed.select("id").distinct()
    texts = written(
        docs.where("id IS NOT NULL").mapInArrow(_compressed, "id long, z binary").join(wanted, "id", "left_semi")
        .join(reps.select("id", "n", "signature"), "id").groupBy("id").agg(F.max(F.struct("n", "signature", "z")).alias("x")).select("id", "x.*"), "texts")

    def confirmed(pairs: DataFrame) -> DataFrame:
        side = lambda c: texts.select(F.col("id").alias(c), F.col("n").alias(f"n{c}"), F.col("z").alias(f"z{c}"), F.col("signature").alias(f"s{c}"))
        return pairs.join(side("b"), "b").join(side("a"), "a").mapInArrow(_confirm(words, percent), "a long, b long")

    first = written(confirmed(stars), "links")
    label = components(first)

    # what is left: members of one bucket in different components
    labelled = (placed.join(label, "id", "left").select("key", "id", F.coalesce("component", "id").alias("component")))
    labelled = written(labelled, "labelled")
    mixed = labelled.groupBy("key").agg(F.min("component").alias("x"), F.max("component").alias("y"), F.count("*").alias("size")).where("x != y")
    mixed = written(mixed.select("key", F.ceil(F.col("size") / BLOCK).cast("int").alias("blocks")), "mixed")
    sides = (labelled.join(mixed, "key")
             .join(texts, "id")
             .withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
             .select("key", "id", "component", "n", "signature", "z", "block", F.least("block", "other").alias("bi"), F.greatest("block", "other").alias("bj")))
    second = written(sides.repartition("key", "bi", "bj").sortWithinPartitions("key", "bi", "bj")
                     .mapInPandas(_between_components(words, percent), "a long, b long").distinct(), "links")
    if not second.isEmpty():
        label = components(first.unionByName(second))

    component = F.coalesce("component", "rep")
    of_rep = members.select("id", "rep", "n").join(label.withColumnRenamed("id", "rep"), "rep", "left")
    placed_rows = of_rep.select(F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), component.alias("component_id"))
    rest = sketches.where("id IS NULL OR n = 0").select(F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), F.col("id").alias("component_id"))
    return placed_rows.unionByName(rest).withColumn("kept", F.expr("doc_id <=> component_id"))
