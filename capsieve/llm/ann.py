"""Approximate nearest neighbours by cosine: a hierarchical k-means tree with best-bin-first traversal.

The tree is grown on at most `sample` vectors, those with the smallest hash of their id, on the driver; every vector is
indexed, by descending to a leaf. A query visits leaves best first: a priority queue holds tree nodes by the closeness of
their centre. How many leaves it visits is calibrated: the number is widened by a quarter until queries reach the target
recall, two standard errors below their mean. The queries are vectors of the sample that are kept out of the tree, and
copies of a vector count once, so that neither fit nor copies flatter the recall.

Leaves are compared with their queries in blocks: a leaf of many vectors, or with many queries, is split into blocks of
bounded size, and each pair of blocks gives at most k rows for a query. No pair of vectors ever becomes a row.

Defined results: vectors that are null, zero, of another length than most of the sample, or hold null or non-finite values
take no part, nor do rows without vec_id; rows that share a vec_id count once. Ties go to the smaller vec_id. An empty table,
or one vector, gives no rows.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from capsieve.llm.store import written

SAMPLE, BRANCHES, LEAF, RECALL, CALIBRATION = 20_000, 12, 48, 0.98, 400
VECTOR_BLOCK, QUERY_BLOCK = 4096, 512


@dataclass
class Tree:
    """children[i]: first and last node below node i (0, 0 for a leaf); leaf[i]: its number, -1 for inner nodes."""

    centre: np.ndarray
    children: np.ndarray
    leaf: np.ndarray

    @property
    def leaves(self) -> int:
        return int(self.leaf.max()) + 1

    def assign(self, unit: np.ndarray) -> np.ndarray:
        out = np.empty(len(unit), np.int64)
        waiting = [(0, np.arange(len(unit)))]
        while waiting:
            node, rows = waiting.pop()
            lo, hi = self.children[node]
            if hi == 0:
                out[rows] = self.leaf[node]
                continue
            best = (unit[rows] @ self.centre[lo:hi].T).argmax(axis=1)
            waiting += [(lo + c, rows[best == c]) for c in np.unique(best)]
        return out

    def visit(self, query: np.ndarray, most: int) -> list[int]:
        """The first `most` leaves in best-bin-first order."""
        queue, out = [(0.0, 0)], []
        while queue and len(out) < most:
            _, node = heapq.heappop(queue)
            lo, hi = self.children[node]
            if hi == 0:
                out.append(int(self.leaf[node]))
            else:
                for child, near in enumerate((self.centre[lo:hi] @ query).tolist(), lo):
                    heapq.heappush(queue, (-near, child))
        return out


def _means(x: np.ndarray, k: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    centre = x[np.random.default_rng(seed).choice(len(x), k, replace=False)]
    for _ in range(8):
        of = (x @ centre.T).argmax(axis=1)
        total = np.zeros_like(centre)
        np.add.at(total, of, x)
        norm = np.linalg.norm(total, axis=1, keepdims=True)
        centre = np.where(norm > 1e-12, total / np.maximum(norm, 1e-12), centre)
    return centre, (x @ centre.T).argmax(axis=1)


def grow(unit: np.ndarray) -> Tree:
    centre, children, leaf, leaves = [unit.mean(axis=0)], [(0, 0)], [-1], 0
    waiting = [(0, np.arange(len(unit)))]
    while waiting:
        node, rows = waiting.pop(0)
        groups: list[np.ndarray] = []
        if len(rows) > LEAF:
            centres, of = _means(unit[rows], min(BRANCHES, max(2, len(rows) // LEAF)), node)
            used = np.unique(of)
            groups = [rows[of == c] for c in used]
        if len(groups) < 2:
            leaf[node], leaves = leaves, leaves + 1
            continue
        children[node] = (len(centre), len(centre) + len(groups))
        for c, group in zip(used, groups, strict=True):
            waiting.append((len(centre), group))
            centre.append(centres[c])
            children.append((0, 0))
            leaf.append(-1)
    return Tree(np.array(centre), np.array(children), np.array(leaf))


def calibrated(tree: Tree, unit: np.ndarray, queries: np.ndarray, k: int, target: float) -> int:
    """Leaf visits, widened by a quarter until `queries`, which the tree was not grown on, find `target` of their k nearest of `unit`."""
    if not len(queries):
        return tree.leaves
    near = queries @ unit.T
    k = min(k, len(unit))
    best = np.argpartition(near, -k, axis=1)[:, -k:]
    of = tree.assign(unit)
    # the place of each true neighbour's leaf among the leaves that its query visits
    place = np.empty(best.shape, np.int64)
    for i, q in enumerate(queries):
        at = np.empty(tree.leaves, np.int64)
        at[tree.visit(q, tree.leaves)] = np.arange(tree.leaves)
        place[i] = at[of[best[i]]]
    visits = 1
    while visits < tree.leaves:
        found = (place < visits).mean(axis=1)
        if found.mean() - 2 * found.std() / np.sqrt(len(found)) >= target:
            break
        visits += max(1, visits // 4)
    return min(visits, tree.leaves)


def planned(unit: np.ndarray, k: int, target: float) -> tuple[Tree, int]:
    """A tree on the different vectors of the sample but those held out, and its calibrated visits; all leaves where few differ."""
    _, first = np.unique(np.round(unit, 9) + 0.0, axis=0, return_index=True)
    different = unit[np.sort(first)]
    held = min(CALIBRATION, len(different) // 5)
    tree = grow(different[held:])
    return tree, calibrated(tree, different[held:], different[:held], k, target)


def _unit(vectors: np.ndarray) -> np.ndarray:
    return vectors / np.linalg.norm(vectors, axis=1, keepdims=True)


def _usable(frames: Iterator[pa.RecordBatch], size: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    for batch in frames:
        rows = [i for i, (n, v) in enumerate(zip(batch.column("vec_id"), batch.column("v"), strict=True)) if n.is_valid and v.is_valid and len(v) == size]
        if not rows:
            continue
        part = batch.take(pa.array(rows))
        x = part.column("v").flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, size)
        with np.errstate(all="ignore"):
            norm = np.linalg.norm(x, axis=1)
        fine = np.isfinite(x).all(axis=1) & np.isfinite(norm) & (norm > 0)
        yield part.column("vec_id").to_numpy()[fine], x[fine]


def _compared(k: int):
    """A block of vectors and a block of queries -> the k best of each query, ties to the smaller id."""
    def run(vectors: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        vectors, queries = (f.sort_values(["vec_id", "x"]).drop_duplicates("vec_id") for f in (vectors, queries))
        if not len(vectors) or not len(queries):
            return pd.DataFrame({"query_id": np.zeros(0, np.int64), "vec_id": np.zeros(0, np.int64), "score": np.zeros(0)})
        x, q = (np.frombuffer(b"".join(f["x"]), np.float64).reshape(len(f), -1) for f in (vectors, queries))
        ids, query_ids = vectors["vec_id"].to_numpy(), queries["vec_id"].to_numpy()
        length, query_length = (np.sqrt(np.einsum("ij,ij->i", m, m)) for m in (x, q))
        near = (q / query_length[:, None]) @ (x / length[:, None]).T
        near[query_ids[:, None] == ids[None, :]] = -np.inf
        # what the fast product puts within rounding of the k-th is computed again in one fixed order
        kth = np.partition(near, -k, axis=1)[:, -k] if len(ids) >= k else np.full(len(q), -np.inf)
        i, j = np.nonzero((near >= kth[:, None] - 1e-9) & np.isfinite(near))
        scores = np.empty(len(i))
        for at in range(0, len(i), 20_000):
            a, b = i[at : at + 20_000], j[at : at + 20_000]
            scores[at : at + 20_000] = np.einsum("ij,ij->i", q[a], x[b]) / (query_length[a] * length[b])
        order = np.lexsort((ids[j], -scores, i))
        i, j, scores = i[order], j[order], scores[order]
        best = np.arange(len(i)) - np.searchsorted(i, i) < k
        return pd.DataFrame({"query_id": query_ids[i[best]], "vec_id": ids[j[best]], "score": scores[best]})
    return run


def nearest(embeddings: DataFrame, k: int = 5, every: int = 50, sample: int = SAMPLE, recall: float = RECALL) -> DataFrame:
    """embeddings (vec_id, embedding) -> (query_id, rank, vec_id, score): k nearest of each row whose id is divisible by `every`."""
    rows = embeddings.select(F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>").alias("v"))
    picked = rows.where("vec_id IS NOT NULL AND v IS NOT NULL AND size(v) > 0").orderBy(F.xxhash64("vec_id"), "vec_id").limit(sample).toArrow()
    empty = "query_id long, rank int, vec_id long, score double"
    if not picked.num_rows:
        return rows.sparkSession.createDataFrame([], empty)
    lengths = picked.column("v").combine_chunks().value_lengths().to_numpy()
    size = int(np.bincount(lengths).argmax())
    sampled = [x for _, x in _usable(iter(picked.to_batches()), size)]
    if not sampled or not sum(map(len, sampled)):
        return rows.sparkSession.createDataFrame([], empty)
    unit = _unit(np.vstack(sampled))
    tree, visits = planned(unit, k, recall)

    def leaf_of(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, x in _usable(frames, size):
            yield pa.RecordBatch.from_arrays([pa.array(tree.assign(_unit(x)).astype(np.int32)), pa.array(ids), pa.array([v.tobytes() for v in x], pa.binary())],
                                             ["leaf", "vec_id", "x"])

    def leaves_of(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, x in _usable(frames, size):
            seen = [tree.visit(u, visits) for u in _unit(x)]
            n = [len(s) for s in seen]
            raw = pa.array([v.tobytes() for v in x], pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array([leaf for s in seen for leaf in s], pa.int32()), pa.array(np.repeat(ids, n)),
                                              raw.take(pa.array(np.repeat(np.arange(len(ids)), n)))], ["leaf", "vec_id", "x"])

    schema = "leaf int, vec_id long, x binary"
    index = written(rows.mapInArrow(leaf_of, schema), "leaves")
    asked = written(rows.where(F.col("vec_id") % every == 0).mapInArrow(leaves_of, schema), "visits")
    # one row for each leaf: how many blocks its vectors and its queries take
    blocks = (index.groupBy("leaf").agg(F.count("*").alias("n")).join(asked.groupBy("leaf").agg(F.count("*").alias("q")), "leaf")
              .select("leaf", F.ceil(F.col("n") / VECTOR_BLOCK).cast("int").alias("vectors"), F.ceil(F.col("q") / QUERY_BLOCK).cast("int").alias("queries")))

    def dealt(side: DataFrame, own: str, other: str) -> DataFrame:
        block = F.pmod(F.xxhash64("vec_id"), F.col(own)).cast("int").alias(own)
        return side.join(blocks, "leaf").select("leaf", "vec_id", "x", block, F.explode(F.sequence(F.lit(0), F.col(other) - 1)).alias(other))

    key = ["leaf", "vectors", "queries"]
    found = (dealt(index, "vectors", "queries").groupBy(key).cogroup(dealt(asked, "queries", "vectors").groupBy(key))
             .applyInPandas(_compared(k), "query_id long, vec_id long, score double"))
    best = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    place = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return best.withColumn("rank", place).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
