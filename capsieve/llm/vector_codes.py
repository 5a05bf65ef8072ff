"""Product codes of vectors: each part of a vector is replaced by the index of its nearest codebook entry.

Vectors become integers floor(256 x) and are cut into equal consecutive parts, each with a codebook of at most 64 entries.
The nearest entry is found by slicing and intersecting bit masks. For every dimension of a part the entries' coordinates
are sorted, and beside each place stands the mask of the entries before it, so the entries of a range of coordinates are
the difference of two masks. The distance to the closest of a few entries that are near in one dimension is an initial
radius; the ranges that it selects, one for each dimension, are intersected by AND of 64-bit masks. No entry outside the
intersection can be nearer, so only its entries are compared exactly.

Codebooks start from the vectors with the smallest ids and are improved by rounds of assignment and integer means. A task
sums the parts that it assigns; Spark adds the tasks' sums, and the driver holds the codebooks only (64 entries a part).

Defined results: rows whose vector is null or holds null or non-finite components are left out. Vectors of several
lengths, or of a length that the parts do not divide, count as if followed by zeros up to the smallest length that parts
divide and that holds the longest one; an empty vector is all zeros. Fewer vectors than entries give shorter codebooks;
an empty table gives no codes. Repeated rows are coded each, rows with equal or null ids are taken in the order of their
integers where codebooks start (null ids last). Equal distances go to the lower index. Integers beyond +-2^27 / sqrt(length)
are clamped to that, so that 64-bit sums cannot overflow. Further columns, whatever their names, are kept in `row`.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from capsieve.llm.store import written

PARTS = 16
ENTRIES = 64
ROUNDS = 2
SCALE = 256


@dataclass
class Book:
    """Entries of one part (entries x dimensions), and for each dimension the sorted coordinates, their entries and prefix masks."""

    entries: np.ndarray
    sorted_at: np.ndarray
    order: np.ndarray
    before: np.ndarray

    @classmethod
    def of(cls, entries: np.ndarray) -> Book:
        n, width = entries.shape
        order = np.argsort(entries, axis=0, kind="stable")
        before = np.zeros((n + 1, width), np.uint64)
        before[1:] = np.bitwise_or.accumulate(np.uint64(1) << order.astype(np.uint64), axis=0)
        return cls(entries, np.take_along_axis(entries, order, axis=0), order, before)

    def distances(self, x: np.ndarray, entry: np.ndarray) -> np.ndarray:
        return ((x - self.entries[entry]) ** 2).sum(axis=1)

    def radius(self, x: np.ndarray) -> np.ndarray:
        """Whole number that the distance to the nearest entry does not exceed: from the entries next to x in each dimension."""
        least = None
        for d in range(x.shape[1]):
            place = np.searchsorted(self.sorted_at[:, d], x[:, d])
            for p in (np.maximum(place - 1, 0), np.minimum(place, len(self.entries) - 1)):
                found = self.distances(x, self.order[p, d])
                least = found if least is None else np.minimum(least, found)
        return np.sqrt(least.astype(np.float64)).astype(np.int64) + 1

    def candidates(self, x: np.ndarray) -> np.ndarray:
        """Mask of the entries within the radius in every dimension; the nearest are among them."""
        radius = self.radius(x)
        mask = np.full(len(x), np.uint64(0xFFFFFFFFFFFFFFFF))
        for d in range(x.shape[1]):
            low = np.searchsorted(self.sorted_at[:, d], x[:, d] - radius, "left")
            high = np.searchsorted(self.sorted_at[:, d], x[:, d] + radius, "right")
            mask &= self.before[high, d] ^ self.before[low, d]
        return mask

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index of the nearest entry and its squared distance; of equally near ones the lower index."""
        bits = np.unpackbits(self.candidates(x).astype("<u8").view(np.uint8).reshape(len(x), 8), axis=1, bitorder="little")
        row, entry = np.nonzero(bits)
        distance = self.distances(x[row], entry)
        starts = np.searchsorted(row, np.arange(len(x)))
        least = np.minimum.reduceat(distance, starts)
        hit = np.flatnonzero(distance == least[row])
        _, first = np.unique(row[hit], return_index=True)
        return entry[hit[first]], least


@dataclass
class Layout:
    """length: components after padding, a multiple of parts."""

    length: int
    parts: int

    @property
    def width(self) -> int:
        return self.length // self.parts

    @property
    def largest(self) -> int:
        return int(2**27 / math.sqrt(self.length))

    def integers(self, column: pa.Array) -> np.ndarray:
        """(rows, parts, width) of floor(256 x) of an Arrow list column without nulls."""
        column = column.cast(pa.large_list(pa.float64()))
        counts = np.diff(np.asarray(column.offsets))
        flat = np.asarray(column.flatten(), np.float64)
        out = np.zeros((len(column), self.length), np.int64)
        whole = np.clip(np.floor(flat * SCALE), -self.largest, self.largest).astype(np.int64)
        out[np.repeat(np.arange(len(counts)), counts), np.arange(len(flat)) - np.repeat(np.cumsum(counts) - counts, counts)] = whole
        return out.reshape(len(column), self.parts, self.width)


def usable(vectors: DataFrame, vec: str) -> DataFrame:
    """Rows whose vector is there and holds neither nulls nor non-finite components."""
    finite = F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf")))
    return vectors.where(F.col(vec).isNotNull() & finite)


def _layout(vectors: DataFrame, vec: str, parts: int) -> Layout | None:
    longest = vectors.agg(F.max(F.size(vec))).first()[0]
    return None if longest is None else Layout(max(1, -(-longest // parts)) * parts, parts)


def _start(vectors: DataFrame, vec_id: str, vec: str, layout: Layout, entries: int) -> list[np.ndarray]:
    """The parts of the vectors with the smallest ids: `entries` rows reach the driver."""
    whole = F.transform("v", lambda x: F.floor(x.cast("double") * SCALE))
    named = vectors.select(F.col(vec_id).alias("i"), F.col(vec).alias("v"))
    rows = named.orderBy(F.col("i").asc_nulls_last(), whole).limit(entries).collect()
    first = layout.integers(pa.array([list(r.v) for r in rows], pa.large_list(pa.float64())))
    return [first[:, p].copy() for p in range(layout.parts)]


def _sums(vectors: DataFrame, vec: str, layout: Layout, books: list[np.ndarray]) -> DataFrame:
    """(part, entry, n, s0, s1, ...): number and sum of the parts nearest to each entry."""
    columns = [f"s{d}" for d in range(layout.width)]

    def assigned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ready = [Book.of(b) for b in books]
        n = np.zeros((layout.parts, len(books[0])), np.int64)
        total = np.zeros((*n.shape, layout.width), np.int64)
        for batch in batches:
            x = layout.integers(batch.column(0))
            if len(x):
                for p, book in enumerate(ready):
                    entry, _ = book.nearest(x[:, p])
                    np.add.at(n[p], entry, 1)
                    np.add.at(total[p], entry, x[:, p])
        part, entry = np.nonzero(n)
        if len(part):
            yield pa.RecordBatch.from_arrays(
                [pa.array(part), pa.array(entry), pa.array(n[part, entry]), *(pa.array(total[part, entry, d]) for d in range(layout.width))],
                names=["part", "entry", "n", *columns])

    schema = "part long, entry long, n long, " + ", ".join(f"{c} long" for c in columns)
    each = vectors.select(vec).mapInArrow(assigned, schema)
    return each.groupBy("part", "entry").agg(F.sum("n").alias("n"), *(F.sum(F.col(c).cast("decimal(38,0)")).alias(c) for c in columns))


def train(vectors: DataFrame, vec_id: str = "vec_id", vec: str = "embedding", parts: int = PARTS, entries: int = ENTRIES,
          rounds: int = ROUNDS) -> tuple[Layout, list[np.ndarray]] | None:
    """Codebooks (one array of entries x components for each part) from all usable vectors; None where there are none."""
    if not 0 < entries <= 64:
        raise ValueError("a mask holds 1 to 64 entries")
    vectors = usable(vectors, vec)
    layout = _layout(vectors, vec, parts)
    if layout is None:
        return None
    books = _start(vectors, vec_id, vec, layout, entries)
    for _ in range(rounds):
        for part, entry, n, *sums in _sums(vectors, vec, layout, books).collect():  # parts x entries rows at most
            books[part][entry] = [int(s) // n for s in sums]
    return layout, books


def digest(books: list[np.ndarray]) -> str:
    """SHA-256 of all entries' components by part, entry and position."""
    return hashlib.sha256(",".join(str(c) for book in books for c in book.ravel().tolist()).encode()).hexdigest()


def encode(vectors: DataFrame, trained: tuple[Layout, list[np.ndarray]] | None, vec: str = "embedding") -> DataFrame:
    """(row: all columns of the vector's row, code: two hex digits for each part, error: squared distances summed)."""
    vectors = usable(vectors, vec)
    packed = vectors.select(F.struct(*(F.col(f"`{c}`") for c in vectors.columns)).alias("row"))
    kind = T.StructType([packed.schema["row"], T.StructField("code", T.StringType()), T.StructField("error", T.LongType())])
    at = vectors.columns.index(vec)
    if trained is None:
        return packed.select("row", F.lit("").alias("code"), F.lit(0).cast("long").alias("error")).limit(0)
    layout, books = trained

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ready = [Book.of(b) for b in books]
        for batch in batches:
            x = layout.integers(batch.column(0).field(at))
            if not len(x):
                continue
            code, error = np.zeros((len(x), layout.parts), np.uint8), np.zeros(len(x), np.int64)
            for p, book in enumerate(ready):
                entry, distance = book.nearest(x[:, p])
                code[:, p] = entry
                error += distance
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([c.tobytes().hex() for c in code]), pa.array(error)], names=["row", "code", "error"])

    return packed.mapInArrow(coded, kind)


def codes(vectors: DataFrame, vec_id: str = "vec_id", vec: str = "embedding", label: str = "label") -> DataFrame:
    """(vec_id, code, error, label_error, codebooks_sha256): label_error is the error summed over the rows of equal label."""
    vectors = vectors.select(F.col(vec_id).alias("vec_id"), F.col(vec).alias("vector"), F.col(label).alias("label"))
    trained = train(vectors, "vec_id", "vector")
    # only ids and labels go through the workers beside the vectors; the table is written as it is used twice
    coded = written(encode(vectors, trained, "vector").select("row.vec_id", "row.label", "code", "error"), "codes")
    largest = F.lit(2**63 - 1).cast("decimal(38,0)")
    by_label = written(coded.groupBy(F.col("label").alias("of")).agg(
        F.least(F.sum(F.col("error").cast("decimal(38,0)")), largest).cast("long").alias("label_error")), "label_errors")
    joined = coded.join(by_label, F.col("label").eqNullSafe(F.col("of")))
    return joined.select("vec_id", "code", "error", "label_error", F.lit(digest(trained[1]) if trained else "").alias("codebooks_sha256"))


def sql(parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> str:
    """The same codes in DuckDB, every part compared with every entry. Written for vectors of one length that parts divide."""
    steps = [f"""
kept AS (SELECT vec_id, label, list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)::BIGINT) AS v, len(embedding) // {parts} AS w
         FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
numbered AS (SELECT *, row_number() OVER (ORDER BY vec_id NULLS LAST, v) AS n FROM kept),
piece AS (SELECT n, p, v[p * w + 1:(p + 1) * w] AS c FROM numbered, range({parts}) r(p)),
book0 AS (SELECT p, n - 1 AS e, c FROM piece WHERE n <= {entries})"""]
    squared = "list_sum(list_transform(list_zip(piece.c, b.c), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT"
    for k in range(rounds + 1):
        steps.append(f"""
near{k} AS (SELECT n, p, e, d, c FROM (SELECT n, piece.p, e, {squared} AS d, piece.c FROM piece JOIN book{k} b ON b.p = piece.p)
            QUALIFY row_number() OVER (PARTITION BY n, p ORDER BY d, e) = 1)""")
        if k < rounds:
            steps.append(f"""
mean{k} AS (SELECT p, e, list(floor(m)::BIGINT ORDER BY i) AS c
            FROM (SELECT p, e, i, sum(x)::DOUBLE / count(*) AS m FROM (SELECT p, e, unnest(c) AS x, unnest(range(len(c))) AS i FROM near{k}) GROUP BY ALL) GROUP BY ALL),
book{k + 1} AS (SELECT b.p, b.e, coalesce(m.c, b.c) AS c FROM book{k} b LEFT JOIN mean{k} m ON m.p = b.p AND m.e = b.e)""")
    steps.append(f"""
coded AS (SELECT n, string_agg(printf('%02x', e), '' ORDER BY p) AS code, sum(d)::BIGINT AS error FROM near{rounds} GROUP BY n),
digest AS (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY p, e)) AS codebooks_sha256 FROM book{rounds})""")
    return "WITH" + ",".join(steps) + """
SELECT vec_id, code, error, sum(error) OVER (PARTITION BY label)::BIGINT AS label_error, codebooks_sha256
FROM numbered JOIN coded USING (n), digest"""
