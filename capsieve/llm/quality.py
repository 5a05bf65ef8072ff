"""Quality scores from histogram gradient-boosted trees over document statistics.

Statistics of the bytes, words and lines of a whole text (never its label, language, source or id) are computed for many
texts at once. Trees are grown on at most `sample` labelled rows, those with the smallest hash of their id, which is what
bounds the work and memory of the driver; everything else runs over all rows. The trees are complete binary trees
flattened into two arrays (feature, threshold), so that scoring is depth x trees array look-ups for a whole batch.

Defined results: null text counts as empty and is scored like any other; without usable labels, or with one class alone,
every score is the smoothed share of good labels. Rows without doc_id are scored and not held out. Extra columns are
carried by `with_scores` and not looked at. Repeated rows get equal scores.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from capsieve.llm import words as W

SAMPLE = 12_000
THRESHOLD = 0.3
_BYTE_CLASSES = ("lower", "upper", "digit", "space", "newline", "sentence", "bracket", "symbol", "high")


def _classes() -> np.ndarray:
    of = np.full(256, 7)
    of[97:123], of[65:91], of[48:58], of[128:] = 0, 1, 2, 8
    of[[32, 9, 11, 12, 13]], of[10] = 3, 4
    of[[ord(c) for c in ".,;:?!'\"-"]], of[[ord(c) for c in "()[]{}<>"]] = 5, 6
    return np.eye(len(_BYTE_CLASSES))[of]


_CLASS_OF = _classes()


def _per_text(value: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0.0], np.cumsum(value, dtype=np.float64)])
    return total[bounds[1:]] - total[bounds[:-1]]


def _distinct(owner: np.ndarray, value: np.ndarray, texts: int) -> tuple[np.ndarray, np.ndarray]:
    """Number of different values of each text, and how often the most frequent one occurs."""
    if not len(value):
        return np.zeros(texts), np.zeros(texts)
    order = np.lexsort((value, owner))
    owner, value = owner[order], value[order]
    new = np.ones(len(value), bool)
    new[1:] = (owner[1:] != owner[:-1]) | (value[1:] != value[:-1])
    at = np.flatnonzero(new)
    most = np.zeros(texts)
    np.maximum.at(most, owner[at], np.diff(np.append(at, len(value))))
    return np.bincount(owner[at], minlength=texts), most


def statistics(found: W.Words) -> np.ndarray:
    """A row of statistics for each text."""
    n, texts = np.diff(found.offsets), len(found.offsets) - 1
    words = found.counts
    size, count = np.maximum(n, 1), np.maximum(words, 1)
    counts = np.bincount(W.segment_ids(n) * 256 + found.data, minlength=texts * 256).reshape(texts, 256)
    shares = counts / size[:, None]
    entropy = -(shares * np.log(np.where(shares > 0, shares, 1))).sum(axis=1)
    lengths = (found.ends - found.starts).astype(np.float64)
    mean = _per_text(lengths, found.first) / count
    spread = np.sqrt(np.maximum(_per_text(lengths**2, found.first) / count - mean**2, 0))
    longest = np.zeros(texts)
    np.maximum.at(longest, found.text_of, lengths)

    cumulative = lambda flags: np.concatenate([[0], np.cumsum(flags)])
    of_word = lambda flags: cumulative(flags)[found.ends] - cumulative(flags)[found.starts]
    kind = _CLASS_OF.argmax(axis=1)[found.data]
    upper, lower, symbol = (of_word(kind == k) for k in (1, 0, 7))
    shouted = _per_text((upper > 1) & (lower == 0), found.first) / count
    marked = _per_text(symbol > 0, found.first) / count
    bare = _per_text(symbol == lengths, found.first) / count
    hashes, owner = found.hashes(True), found.text_of
    different, most = _distinct(owner, hashes, texts)
    same = owner[1:] == owner[:-1]
    pairs, most_pairs = _distinct(owner[1:][same], W.grams(hashes, 2)[same], texts)

    # lines, as runs of words without a newline between them
    breaks = cumulative(found.data == 10)
    line_start = np.ones(len(owner), bool)
    line_start[1:] = ~same | (breaks[found.starts[1:]] > breaks[found.starts[:-1]])
    at = np.flatnonzero(line_start)
    line_owner = owner[at]
    lines = np.bincount(line_owner, minlength=texts)
    line_hash = np.add.reduceat(hashes * W.mix(W.ramp(np.diff(np.append(at, len(owner)))).astype(np.uint64) + np.uint64(7)), at) if len(at) else hashes
    different_lines, _ = _distinct(line_owner, line_hash, texts)
    length_of_line = np.diff(np.append(at, len(owner))).astype(np.float64)
    short = np.bincount(line_owner, length_of_line <= 3, minlength=texts)
    some = np.maximum(lines, 1)
    return np.column_stack([
        np.log1p(n), np.log1p(words), mean, spread, np.log1p(longest), entropy, shares @ _CLASS_OF, shares.max(axis=1),
        shouted, marked, bare, different / count, most / count, pairs / np.maximum(words - 1, 1), most_pairs / count,
        np.log1p(lines), words / some, different_lines / some, short / some])


@dataclass
class Trees:
    """feature, threshold: trees x inner nodes, children of node i at 2i+1 and 2i+2; leaf: trees x leaves."""

    base: float
    feature: np.ndarray
    threshold: np.ndarray
    leaf: np.ndarray

    def score(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.base)
        rows, inner = np.arange(len(x)), self.feature.shape[1]
        for feature, threshold, leaf in zip(self.feature, self.threshold, self.leaf, strict=True):
            node = np.zeros(len(x), np.int64)
            while inner and (node < inner).all():
                node = 2 * node + 1 + (x[rows, feature[node]] > threshold[node])
            total += leaf[node - inner]
        return 1 / (1 + np.exp(-total))


def grow(x: np.ndarray, y: np.ndarray, trees: int = 80, depth: int = 4, bins: int = 64, rate: float = 0.15, l2: float = 2.0) -> Trees:
    """Boosting on logistic loss; splits are searched in histograms over quantile bins."""
    good = (y.sum() + 1) / (len(y) + 2)
    base, inner = float(np.log(good / (1 - good))), 2**depth - 1
    if not len(y) or y.min() == y.max():
        none = np.zeros((0, inner))
        return Trees(base, none.astype(np.int64), none, np.zeros((0, inner + 1)))
    features = x.shape[1]
    cuts = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1])) for j in range(features)]
    binned = np.column_stack([np.searchsorted(c, x[:, j]) for j, c in enumerate(cuts)])
    total = np.full(len(y), base)
    out = Trees(base, np.zeros((trees, inner), np.int64), np.full((trees, inner), np.inf), np.zeros((trees, inner + 1)))
    for t in range(trees):
        p = 1 / (1 + np.exp(-total))
        g, h = y - p, p * (1 - p)
        node = np.zeros(len(y), np.int64)
        for level in range(depth):
            first, width = 2**level - 1, 2**level
            best = np.full(width, 1e-6)
            for j in range(features):
                at = (node - first) * bins + binned[:, j]
                gs = np.cumsum(np.bincount(at, g, width * bins).reshape(width, bins), axis=1)
                hs = np.cumsum(np.bincount(at, h, width * bins).reshape(width, bins), axis=1)
                whole_g, whole_h = gs[:, -1:], hs[:, -1:]
                gain = gs**2 / (hs + l2) + (whole_g - gs) ** 2 / (whole_h - hs + l2) - whole_g**2 / (whole_h + l2)
                gain[(hs < 1) | (whole_h - hs < 1)] = -1
                gain[:, len(cuts[j]) :] = -1
                at_best = gain.argmax(axis=1)
                value = gain[np.arange(width), at_best]
                for k in np.flatnonzero(value > best):
                    best[k], out.feature[t, first + k], out.threshold[t, first + k] = value[k], j, cuts[j][at_best[k]]
            node = 2 * node + 1 + (x[np.arange(len(y)), out.feature[t, node]] > out.threshold[t, node])
        leaf = node - inner
        out.leaf[t] = rate * np.bincount(leaf, g, inner + 1) / (np.bincount(leaf, h, inner + 1) + l2)
        total += out.leaf[t, leaf]
    return out


def _held_out(doc_id: str = "doc_id"):
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Trees:
    """Trees from at most `sample` labelled rows that are not held out."""
    def of_labelled(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in frames:
            for lo, hi, found in W.chunks(batch.column("text")):
                x = statistics(found)
                yield pa.RecordBatch.from_arrays([
                    batch.column("labelled").slice(lo, hi - lo), batch.column("quality").slice(lo, hi - lo), pa.array(list(x), pa.list_(pa.float64()))],
                    ["labelled", "quality", "x"])

    chosen = (labels.where("quality IS NOT NULL AND doc_id IS NOT NULL").where(~_held_out())
              .groupBy(F.col("doc_id").cast("long").alias("labelled")).agg(F.max("quality").cast("int").alias("quality"))
              .orderBy(F.xxhash64("labelled"), "labelled").limit(sample))
    # at most `sample` ids of 12 bytes: small enough to send to every executor
    rows = (docs.select("doc_id", "text").join(F.broadcast(chosen), F.col("doc_id") == F.col("labelled"))
            .select("labelled", "quality", "text").mapInArrow(of_labelled, "labelled long, quality int, x array<double>")
            # one row an id, however many documents share it: at most `sample` rows
            .groupBy("labelled").agg(F.min(F.struct("quality", "x")).alias("r")).select("r.*").toPandas())
    if not len(rows):
        return grow(np.zeros((0, 1)), np.zeros(0))
    x, y = np.array(rows["x"].tolist()), rows["quality"].to_numpy(np.float64)
    order = np.lexsort((*x.T, y))  # the order of tasks makes no difference
    return grow(x[order], y[order])


def with_scores(docs: DataFrame, trees: Trees, carried: list[str] | None = None) -> DataFrame:
    """(row: struct of the carried columns, score, predicted); all columns are carried unless named."""
    carried = docs.columns if carried is None else carried

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, found in W.chunks(batch.column("text")):
                score = trees.score(statistics(found))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("row").slice(lo, hi - lo), pa.array(score), pa.array((score >= THRESHOLD).astype(np.int32))], ["row", "score", "predicted"])

    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in carried]).alias("row"), F.col("text"))
    schema = T.StructType([packed.schema["row"], T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())])
    return packed.mapInArrow(run, schema)


def quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """docs (doc_id, text), labels (doc_id, quality) -> (doc_id, held_out, score, predicted), a row for each document."""
    scored = with_scores(docs.select("doc_id", "text"), train(docs, labels), ["doc_id"])
    return scored.select("row.doc_id", "score", "predicted").select("doc_id", _held_out().alias("held_out"), "score", "predicted")
