"""How document filters interact: what each of them removes, repeats or loses, in every order of applying them.

The relation of failing ids of each filter is stored as a table of its own. Survivors of a prefix, a set of filters applied
already, come by left-anti joins: step by step each filter's failing ids are taken from the survivors of every prefix that
lacks it, which makes the survivors of that prefix with the filter. What a filter removes after a prefix is the left-semi
join of those survivors with its failing ids; what it finds removed already is the rest of its failing ids. Label losses are
left-semi joins of the survivors with the ids of good and of toxic documents, carried through the same steps. As only
the set of earlier filters matters, not their order, 32 prefixes stand for the 120 orders. Rows that fail no filter survive
every prefix; they are counted once and leave the joins. Joins carry numbers of rows and no texts.

Defined results: a row of documents is a document, whatever its id; repeated rows count each. A null text is empty, a null
part is the part ''. Word counts and distinct words are exact (words are compared whole). A document has the label if any row of `labels`
with its id says so; a null id has no label, and repeated label rows count once. The copy filter compares
SHA-256 of the texts and needs a smaller id than the row's own: rows of the smallest id of their text pass, however often
they are repeated, and so do rows without id. Without documents there are no parts and so no rows. Further columns, whatever
their names, are not read.
"""

from __future__ import annotations

import itertools
from collections.abc import Sequence
from functools import reduce
from math import factorial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from capsieve.llm.store import written

#: Filters in the order of their bits: under 200 words; few distinct words; many capitals; markup characters; copies.
FILTERS = "ABCDE"
LEAST_WORDS = 200
_CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Rows that a filter or a prefix is counted for: all, those of good quality, toxic ones.
_KINDS = ("any", "good", "toxic")


def measured(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", part: str = "source") -> DataFrame:
    """(row, id, part, digest, A, B, C, D): one pass over the texts. `row` numbers the rows; the table is to be written."""
    whole = F.coalesce(F.col(text), F.lit(""))
    named = docs.select(
        F.monotonically_increasing_id().alias("row"), F.col(doc_id).alias("id"), F.coalesce(F.col(part), F.lit("")).alias("part"),
        F.sha2(whole, 256).alias("digest"), F.array_remove(F.split(whole, r"[\x20\x09-\x0D]+"), "").alias("words"),
        F.length(whole).alias("chars"), (F.length(whole) - F.length(F.translate(whole, _CAPITALS, ""))).alias("capitals"),
        whole.rlike(r"[#$%&*|]").alias("D"))
    n = F.size("words")
    return named.select(
        "row", "id", "part", F.unhex("digest").alias("digest"), (n < LEAST_WORDS).alias("A"),
        (100 * F.size(F.array_distinct("words")) < 50 * n).alias("B"), (100 * F.col("capitals") > 2 * F.col("chars")).alias("C"), "D")


def copies(rows: DataFrame) -> DataFrame:
    """(row): rows whose text a smaller id has too."""
    first = rows.where("id IS NOT NULL").groupBy("digest").agg(F.min("id").alias("first"), F.max("id").alias("last"))
    shared = written(first.where("first < last").select(F.col("digest").alias("of"), "first"), "shared")
    return rows.join(shared, F.expr("digest = of AND id > first")).select("row")


def failing_ids(rows: DataFrame) -> dict[str, DataFrame]:
    """One stored table of row numbers for each filter."""
    found = {f: rows.where(f).select("row") for f in FILTERS[:-1]} | {FILTERS[-1]: copies(rows)}
    return {f: written(ids, f"failing-{f}") for f, ids in found.items()}


def survivors(rows: DataFrame, failing: dict[str, DataFrame]) -> DataFrame:
    """(row, part, kind, prefix): rows that pass every filter of the prefix, for all 32 sets of filters."""
    alive = rows.withColumn("prefix", F.lit(0))
    for bit, letter in enumerate(FILTERS):
        passed = alive.join(failing[letter], "row", "left_anti").withColumn("prefix", F.col("prefix") + (1 << bit))
        alive = written(alive.unionByName(passed), f"alive-{letter}")
    return alive


def interactions(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", part: str = "source") -> DataFrame:
    """(part, kept, removed): map of prefix -> survivors, and map of prefix and filter -> what that filter removes next.

    Keys are prefix * 5 + place of the filter for `removed`; values are structs (any, good, toxic). `clean` and `failing`
    (array by filter) count the rows of the part that fail nothing, and that fail each filter.
    """
    rows = written(measured(docs, doc_id, text, part), "measured")
    failing = failing_ids(rows)
    ids = rows.select("row", "id", "part")
    some = reduce(DataFrame.unionByName, failing.values())
    failed = written(ids.join(some, "row", "left_semi"), "failed")
    clean = ids.join(some, "row", "left_anti").groupBy("part").agg(F.count("*").alias("clean"))
    start = failed.select("row", "part", F.lit("any").alias("kind"))
    for kind, flag in (("good", "quality"), ("toxic", "toxic")):
        have = labels.where(F.col(flag) == 1).select(F.col("doc_id").alias("id"))
        start = start.unionByName(failed.join(have, "id", "left_semi").select("row", "part", F.lit(kind).alias("kind")))
    alive = survivors(start, failing)
    counts = [F.count_if(F.col("kind") == k).alias(k) for k in _KINDS]
    kept = alive.groupBy("part", "prefix").agg(*counts).select("part", F.lit("kept").alias("what"), F.col("prefix").alias("key"), *_KINDS)
    lost = [
        alive.where(F.col("prefix").bitwiseAND(1 << at) == 0).join(failing[letter], "row", "left_semi").groupBy("part", "prefix").agg(*counts)
        .select("part", F.lit("removed").alias("what"), (F.col("prefix") * len(FILTERS) + at).alias("key"), *_KINDS)
        for at, letter in enumerate(FILTERS)]
    # at most 32 + 80 rows of counts a part
    found = reduce(DataFrame.unionByName, lost, kept).groupBy("part").agg(*(
        F.map_from_entries(F.collect_list(F.when(F.col("what") == what, F.struct("key", F.struct(*_KINDS))))).alias(what) for what in ("kept", "removed")))
    return rows.groupBy("part").agg(F.count("*").alias("rows")).join(clean, "part", "left").join(found, "part", "left")


def audit(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", part: str = "source") -> DataFrame:
    """One row per part, order of the five filters and step; see the module's docstring for what is counted."""
    found = interactions(docs, labels, doc_id, text, part)
    letters = len(FILTERS)
    full = (1 << letters) - 1

    def count(what: str, key: Column, kind: str = "any") -> Column:
        return F.coalesce(F.try_element_at(F.col(what), key.cast("int"))[kind], F.lit(0)).cast("long")

    orders = F.array(*(F.lit("".join(o)) for o in itertools.permutations(FILTERS)))
    stepped = found.select("*", F.explode(orders).alias("filter_order")).select("*", F.explode(F.sequence(F.lit(1), F.lit(letters))).alias("step"))
    before = reduce(lambda a, b: a + b, (F.when(F.instr("filter_order", f) < F.col("step"), 1 << i).otherwise(0) for i, f in enumerate(FILTERS)))
    placed = stepped.withColumns({"prefix": before, "at": F.expr(f"instr('{FILTERS}', substring(filter_order, step, 1)) - 1")})
    prefix, at, bit = F.col("prefix"), F.col("at"), F.expr("shiftleft(1, at)")
    shapley = reduce(lambda a, b: a + b, (
        F.when(F.lit(s).bitwiseAND(bit) == 0, count("removed", F.lit(s * letters) + at)).otherwise(0)
        * (factorial(bin(s).count("1")) * factorial(max(0, letters - 1 - bin(s).count("1")))) for s in range(full)))
    removed = count("removed", prefix * letters + at)
    return placed.select(
        "part", "filter_order", "step",
        (F.coalesce("clean", F.lit(0)) + count("kept", prefix + bit)).alias("kept"), removed.alias("removed"),
        (count("removed", at) - removed).alias("redundant"), count("removed", (F.lit(full) - bit) * letters + at).alias("unique_fails"),
        count("removed", prefix * letters + at, "good").alias("good_lost"), count("removed", prefix * letters + at, "toxic").alias("toxic_lost"),
        shapley.alias("shapley"))


SQL = f"""
WITH doc AS (SELECT doc_id, coalesce(text, '') AS t, coalesce(source, '') AS part,
                    regexp_extract_all(coalesce(text, ''), '[^ \\t\\n\\x0B\\f\\r]+') AS w,
                    min(doc_id) OVER (PARTITION BY coalesce(text, '')) AS first FROM documents),
fails AS (SELECT part, len(w) < {LEAST_WORDS} AS a, 100 * len(list_distinct(w)) < 50 * len(w) AS b,
                 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 2 * length(t) AS c, regexp_matches(t, '[#$%&*|]') AS d, coalesce(doc_id > first, false) AS e,
                 EXISTS (FROM labels l WHERE l.doc_id = doc.doc_id AND quality = 1) AS good,
                 EXISTS (FROM labels l WHERE l.doc_id = doc.doc_id AND toxic = 1) AS toxic FROM doc),
counted AS (SELECT part, a::INT + 2 * b::INT + 4 * c::INT + 8 * d::INT + 16 * e::INT AS mask, count(*) AS n,
                   count_if(good) AS good, count_if(toxic) AS toxic FROM fails GROUP BY ALL),
letter AS (SELECT substr('{FILTERS}', i + 1, 1) AS f, 1 << i AS bit FROM range({len(FILTERS)}) r(i)),
orders AS (SELECT l1.f || l2.f || l3.f || l4.f || l5.f AS filter_order, [0, l1.bit, l1.bit + l2.bit, l1.bit + l2.bit + l3.bit, 31 - l5.bit] AS prefixes,
                  [l1.bit, l2.bit, l3.bit, l4.bit, l5.bit] AS bits
           FROM letter l1, letter l2, letter l3, letter l4, letter l5 WHERE l1.bit | l2.bit | l3.bit | l4.bit | l5.bit = 31),
steps AS (SELECT filter_order, s::INT AS step, prefixes[s] AS prefix, bits[s] AS bit FROM orders, range(1, {len(FILTERS) + 1}) r(s)),
found AS (SELECT part, filter_order, step, any_value(bit) AS bit, sum(n) FILTER (mask & (prefix | bit) = 0) AS kept,
                 sum(n) FILTER (mask & prefix = 0 AND mask & bit > 0) AS removed, sum(n) FILTER (mask & prefix > 0 AND mask & bit > 0) AS redundant,
                 sum(n) FILTER (mask = bit) AS unique_fails, sum(good) FILTER (mask & prefix = 0 AND mask & bit > 0) AS good_lost,
                 sum(toxic) FILTER (mask & prefix = 0 AND mask & bit > 0) AS toxic_lost
          FROM counted, steps GROUP BY part, filter_order, step)
SELECT part, filter_order, step, coalesce(kept, 0)::BIGINT AS kept, coalesce(removed, 0)::BIGINT AS removed, coalesce(redundant, 0)::BIGINT AS redundant,
       coalesce(unique_fails, 0)::BIGINT AS unique_fails, coalesce(good_lost, 0)::BIGINT AS good_lost, coalesce(toxic_lost, 0)::BIGINT AS toxic_lost,
       coalesce(sum(removed) OVER (PARTITION BY part, bit), 0)::BIGINT AS shapley
FROM found"""
