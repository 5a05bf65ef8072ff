"""Vector codes, filter interactions and source mixes against plain versions."""

import hashlib
import heapq
import itertools
import math
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from capsieve.llm import filter_audit, mixing, vector_codes

WORD = re.compile(r"[^\x20\x09-\x0D]+")
VECTORS = "vec_id long, embedding array<float>, label int, code string, row int, `__p` int"


# ---------------------------------------------------------------- vector codes

def plain_codes(rows, parts, entries, rounds):
    """rows (vec_id, vector, label) -> [(vec_id, code, error, label)], digest: every part compared with every entry, in whole numbers."""
    kept = [r for r in rows if r[1] is not None and all(x is not None and math.isfinite(x) for x in r[1])]
    length = max(1, -(-max((len(r[1]) for r in kept), default=0) // parts)) * parts
    whole = [[math.floor(256 * float(np.float32(x))) for x in r[1]] + [0] * (length - len(r[1])) for r in kept]
    width = length // parts
    pieces = [[w[p * width:(p + 1) * width] for p in range(parts)] for w in whole]
    start = sorted(range(len(kept)), key=lambda i: (kept[i][0] is None, kept[i][0] or 0, whole[i]))[:entries]
    books = [[pieces[i][p] for i in start] for p in range(parts)]

    def nearest(p, x):
        return min((sum((a - b) ** 2 for a, b in zip(x, e)), i) for i, e in enumerate(books[p]))

    for _ in range(rounds):
        new = []
        for p in range(parts):
            groups = {}
            for piece in pieces:
                groups.setdefault(nearest(p, piece[p])[1], []).append(piece[p])
            new.append([[sum(c) // len(groups[i]) for c in zip(*groups[i])] if i in groups else e for i, e in enumerate(books[p])])
        books = new
    out = []
    for r, piece in zip(kept, pieces):
        best = [nearest(p, piece[p]) for p in range(parts)]
        out.append((r[0], "".join(f"{i:02x}" for _, i in best), sum(d for d, _ in best), r[2]))
    return out, hashlib.sha256(",".join(str(c) for b in books for e in b for c in e).encode()).hexdigest()


def checked_codes(spark, rows):
    table = spark.createDataFrame([(*r, "x", 1, 2) for r in rows], VECTORS).repartition(3)
    got = vector_codes.codes(table).collect()
    want, digest = plain_codes(rows, 16, 64, 2)
    totals = {}
    for *_, error, label in want:
        totals[label] = totals.get(label, 0) + error
    assert sorted(map(str, ((r.vec_id, r.code, r.error, r.label_error) for r in got))) == sorted(str((i, c, e, totals[n])) for i, c, e, n in want)
    assert not got or {r.codebooks_sha256 for r in got} == {digest}


def test_codes(spark):
    rng = np.random.default_rng(3)
    rows = [(i * 7 % 501, rng.normal(size=32).tolist(), [None, 1, 2][i % 3]) for i in range(400)]
    rows += [(1000, None, 1), (1001, [float("nan")] * 32, 1), (1002, [None] + [1.0] * 31, 1), (1003, [float("inf")] * 32, 2), (1004, [-0.001] * 32, None)]
    rows += [rows[0], (None, [0.5] * 32, 1), (None, [0.25] * 32, 1), (3, [0.0] * 32, 2), (1005, [300.0, -300.0] * 16, 2)]
    rows += [(2000 + i, [0.125] * 32, 5) for i in range(150)]  # copies
    checked_codes(spark, rows)


@pytest.mark.parametrize("rows", [
    [], [(1, None, 1)], [(5, [1.0] * 16, None)], [(1, [0.1, 0.2, 0.3], 1), (2, [], 1), (3, [0.1] * 20, 2), (4, [0.5] * 40, None)],
    [(i, [float(i % 3)] * 16, 1) for i in range(70)]])
def test_few_codes(spark, rows):
    checked_codes(spark, rows)


def test_masks_give_exact_candidates():
    rng = np.random.default_rng(5)
    for width in (1, 2, 4):
        entries = rng.integers(-30, 30, (64, width))
        entries[10], entries[20] = entries[3], entries[3]
        book, x = vector_codes.Book.of(entries), rng.integers(-60, 60, (500, width))
        every = ((x[:, None] - entries[None]) ** 2).sum(2)
        entry, distance = book.nearest(x)
        assert (distance == every.min(1)).all() and (entry == every.argmin(1)).all()
        inside = (np.abs(x[:, None] - entries[None]) <= book.radius(x)[:, None, None]).all(2)
        masks = book.candidates(x)
        assert [[bool(int(m) >> e & 1) for e in range(64)] for m in masks] == inside.tolist()


def test_far_components_are_clamped(spark):
    table = spark.createDataFrame([(1, [1e30] + [0.0] * 15), (2, [-1e30] + [0.0] * 15)], "vec_id long, embedding array<float>")
    layout, books = vector_codes.train(table)
    assert sorted(int(b[0][0]) for b in books[:1]) == [2**25] and layout.largest == 2**25
    assert {r.error for r in vector_codes.encode(table, (layout, books)).collect()} == {0}


# ---------------------------------------------------------------- filter interactions

def plain_audit(docs, labels):
    """Every order applied to every document of every part."""
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, t in labels if t == 1 and i is not None}
    first = {}
    for i, t, _ in docs:
        if i is not None:
            first[t or ""] = min(first.get(t or "", i), i)
    parts = {}
    for i, t, source in docs:
        t = t or ""
        w = WORD.findall(t)
        fails = {"A": len(w) < 200, "B": 100 * len(set(w)) < 50 * len(w), "C": 100 * len(re.findall("[A-Z]", t)) > 2 * len(t), "D": bool(re.search("[#$%&*|]", t)),
                 "E": i is not None and first.get(t, i) < i}
        parts.setdefault(source or "", []).append((fails, i in good, i in toxic))
    out = {}
    for part, rows in parts.items():
        shapley = dict.fromkeys("ABCDE", 0)
        for order in itertools.permutations("ABCDE"):
            alive = rows
            for step, f in enumerate(order, 1):
                removed = [r for r in alive if r[0][f]]
                alive = [r for r in alive if not r[0][f]]
                shapley[f] += len(removed)
                out[part, "".join(order), step] = [
                    len(alive), len(removed), sum(r[0][f] for r in rows) - len(removed), sum(r[0][f] and sum(r[0].values()) == 1 for r in rows),
                    sum(r[1] for r in removed), sum(r[2] for r in removed)]
        for (p, order, step), row in out.items():
            if p == part:
                row.append(shapley[order[step - 1]])
    return out


def audited(spark, docs, labels):
    d = spark.createDataFrame([(*r, 1, "x") for r in docs], "doc_id long, text string, source string, prefix int, part string").repartition(3)
    rows = filter_audit.audit(d, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).collect()
    return {(r.part, r.filter_order, r.step): [r.kept, r.removed, r.redundant, r.unique_fails, r.good_lost, r.toxic_lost, r.shapley] for r in rows}, len(rows)


def test_audit(spark):
    rng = random.Random(1)
    long = " ".join(f"word{i}" for i in range(250))
    texts = [long, long + " #", long.upper(), "same " * 300, "short", "", None, "SHORT & loud", long + " é", "x " * 199 + "y", " ".join(f"w{i % 100}" for i in range(200))]
    docs = [(rng.choice([None, *range(40)]), rng.choice(texts), rng.choice([None, "", "a", "b", "c'd"])) for _ in range(150)]
    docs += [docs[0], docs[0], (99, long + " clean", "only clean")]
    labels = [(i, rng.randint(0, 1), rng.choice([0, 1, None])) for i in range(0, 40, 2)] + [(2, 1, 1), (2, 1, 1), (None, 1, 1), (777, 1, 1)]
    got, n = audited(spark, docs, labels)
    want = plain_audit(docs, labels)
    assert n == len(want) == 120 * 5 * 5 and got == want


def test_audit_of_little(spark):
    assert audited(spark, [], [])[1] == 0
    one = [(1, "a b", "s")]
    assert audited(spark, one, [])[0] == plain_audit(one, [])


# ---------------------------------------------------------------- mixes

MIX = "doc_id long, text string, source string, size int, target string"


def mixed(spark, rows, parts=3, **given):
    return mixing.mix(spark.createDataFrame([(*r, 1, "t") for r in rows], MIX).repartition(parts), **given)


def plain_targets(sizes, weights=(5, 2, 1), passes=3):
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    total, capped = sum(sizes.values()), set()
    while True:
        left = total - sum(passes * sizes[s] for s in capped)
        free = sum(weight[s] for s in order if s not in capped)
        target = {s: float(passes * sizes[s]) if s in capped else weight[s] * left / free for s in order}
        more = {s for s in order if s not in capped and target[s] > passes * sizes[s]}
        if not more:
            return target
        capped |= more


def plain_seats(votes, seats):
    """Seats one by one to the highest quotient; ties to the first key."""
    won = dict.fromkeys(votes, 0)
    heap = [(-v, k) for k, v in votes.items() if v > 0]
    heapq.heapify(heap)
    for _ in range(seats if heap else 0):
        _, k = heapq.heappop(heap)
        won[k] += 1
        heapq.heappush(heap, (-votes[k] / (2 * won[k] + 1), k))
    return won


def test_quotas_against_one_by_one(spark):
    rng = random.Random(4)
    for case in range(4):
        n = (3, 40, 120, 7)[case]
        size = {i: rng.choice([1, 5, 5, 60, 9000 if case == 2 else 40]) for i in range(n)}
        total = sum(size.values())
        goals = spark.createDataFrame([(f"s{i:04d}", v, i, float(v)) for i, v in size.items()], "source string, size long, rank long, target double")
        seats = total // (2 + case)
        got = {int(r.source[1:]): r.quota for r in mixing.source_quotas(goals, seats, total).collect()}
        want = plain_seats({i: float(v) for i, v in size.items()}, seats)
        assert {i: got.get(i, 0) for i in size} == want and sum(got.values()) == seats


def test_shard_quotas_against_one_by_one(spark):
    rng = random.Random(6)
    lengths = {s: {k: rng.choice([0, 1, 30, 31, 500]) for k in range(8)} for s in ("a", "b", None)}
    shards = spark.createDataFrame([(s, k, v) for s, row in lengths.items() for k, v in row.items()], "source string, shard long, length long")
    quotas = spark.createDataFrame([("a", 57), (None, 3)], "source string, quota long")
    got = {(r.source, r.shard): r.quota for r in mixing.shard_quotas(shards, quotas).collect()}
    assert got == {(s, k): v for s, n in (("a", 57), ("b", 0), (None, 3)) for k, v in plain_seats({k: float(v) for k, v in lengths[s].items()}, n).items()}


def test_mix(spark):
    rng = random.Random(9)
    share = {"a": 300, "B": 40, "b": 20, None: 30, "": 10, "é": 25, "zero": 3}
    rows, i = [], 0
    for source, n in share.items():
        for _ in range(n):
            words = 0 if source == "zero" else rng.choice([0, 1, 3, 20, 80, 400])
            rows.append((None if i % 50 == 7 else i, rng.choice([None, "", " \t"]) if not words else "w " * words, source))
            i += 1
    rows += [(5000, "x y z", "b")] * 230 + [(0, "other words here", "a")]
    got = mixed(spark, rows).collect()
    sizes = {}
    for _, text, source in rows:
        sizes[source] = sizes.get(source, 0) + len(WORD.findall(text or ""))
    target, taken = plain_targets(sizes), {}
    assert len(got) == len(rows)
    for r in got:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(target[r.source]) and 0 <= r.taken <= 3 * r.size
        taken[r.source] = taken.get(r.source, 0) + r.taken
    assert all(abs(taken[s] - target[s]) <= mixing.BLOCK for s in sizes if target[s] < 3 * sizes[s])
    assert all(3 * sizes[s] - taken[s] <= mixing.BLOCK * mixing.SHARDS for s in sizes if target[s] == 3 * sizes[s])
    again = mixed(spark, rows[::-1], parts=7).collect()
    assert sorted(map(str, again)) == sorted(map(str, got))
    other = mixed(spark, rows, seed=14).collect()
    assert sorted(map(str, other)) != sorted(map(str, got))


@pytest.mark.parametrize("rows", [[], [(1, None, None)], [(1, "a b c", "s")], [(i, "", "s") for i in range(3)]])
def test_little_to_mix(spark, rows):
    got = mixed(spark, rows).collect()
    assert len(got) == len(rows) and all(r.taken == 0 for r in got)


def test_ranks_run_through_all_ranges(spark):
    df = spark.range(1000).select(((F.col("id") * 7919) % 1000).alias("k"))
    assert {(r.k, r["rank"]) for r in mixing.ranked(df, F.col("k").desc()).collect()} == {(k, 999 - k) for k in range(1000)}
