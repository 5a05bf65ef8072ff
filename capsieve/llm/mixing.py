"""Mixing sources to target weights: equal-token blocks are apportioned to sources and their shards, then chosen by a seed.

A source's target is its share, by weight, of all words; it stops at a number of passes over the source, and what it leaves is
shared again by weight. All words of the mix make blocks of equal size. Blocks go to sources by Sainte-Lague: to the
highest quotients target / (2 k + 1), k being the blocks that a source has already. Every source has the same number of
shards (documents dealt by a seeded hash), and its blocks go to them in the same way by the shards' sizes, so that each shard has an
integer quota. Quotients are compared only near the boundary: seats lie within half the number of parties, in
proportion, of the exact share, so that about four quotients a party decide exactly.

A shard's documents stand in a line in the order of their hashes. Whole passes over the line come first; the rest of the
quota is blocks of the line at even steps from a seeded phase, the last of them cut where the quota ends. The words taken of
a document are what passes and blocks take of its stretch. Everything is built-in functions; running sums have two levels (stretches of hashes, then
documents in a stretch), and rankings too, so no window holds a source or a table.

Defined results: a null or empty text has size 0 and takes nothing; sources of size 0 have target 0. The null source comes last and is a source of
its own, apart from ''. Repeated rows are documents each (copies of a row are dealt in hundreds). Null ids are dealt like others. Ties of quotients go to the source of lower code points and
the lower shard. Fewer words than a block: nothing is taken. An empty table gives no rows. Further columns are not read.
"""

from __future__ import annotations

from math import isqrt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from capsieve.llm.store import written

WEIGHTS = (5, 2, 1)
PASSES = 3
BLOCK = 16
SHARDS = 8
SEED = 13
#: Copies of one row that are dealt together.
TOGETHER = 100


def _wide(x: Column) -> Column:
    return x.cast("decimal(38,0)")


def documents(docs: DataFrame, doc_id: str, text: str, source: str, seed: int) -> DataFrame:
    """(source, doc_id, size, copies, h, shard): equal rows together, up to TOGETHER of them; h orders a shard."""
    words = F.size(F.array_remove(F.split(F.col(text), r"[\x20\x09-\x0D]+"), ""))
    sized = docs.select(F.col(source).alias("source"), F.col(doc_id).alias("doc_id"), F.when(F.col(text).isNull(), 0).otherwise(words).cast("long").alias("size"))
    some = sized.groupBy("source", "doc_id", "size").agg(F.count("*").alias("n"))
    dealt = some.select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1, F.lit(TOGETHER).cast("long"))).alias("first"))
    return dealt.select(
        "source", "doc_id", "size", F.least(F.col("n") - F.col("first"), F.lit(TOGETHER)).alias("copies"),
        F.md5(F.concat_ws(":", F.lit(str(seed)), "doc_id", F.when(F.col("first") > 0, F.col("first"))).cast("binary")).alias("h"),
    ).withColumn("shard", F.conv(F.substring("h", 25, 8), 16, 10).cast("long") % SHARDS)


def ranked(df: DataFrame, *order: Column) -> DataFrame:
    """`df` with `rank` (from 0) in the whole order, which must be strict: rows are ranked in ranges, ranges by their counts."""
    ranges = written(df.repartitionByRange(*order).withColumn("range", F.spark_partition_id()), "ranges")
    upto = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    counts = ranges.groupBy("range").agg(F.count("*").alias("n"))  # a row for each partition
    before = counts.select("range", F.coalesce(F.sum("n").over(upto), F.lit(0)).alias("before"))
    inside = F.row_number().over(Window.partitionBy("range").orderBy(*order))
    return ranges.join(before, "range").withColumn("rank", F.col("before") + inside - 1).drop("range", "before")


def targets(sources: DataFrame, weights: tuple[int, ...] = WEIGHTS, passes: int = PASSES) -> DataFrame:
    """sources (source, size) -> (source, size, rank, target). The driver holds sums only; each round caps one source or more."""
    by_source = F.col("source").asc_nulls_last()
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("rank") % len(weights) + 1).cast("int")).cast("long")
    table = written(ranked(sources, by_source).withColumn("weight", weight), "weighted")
    total, shared, capped = table.agg(F.sum("size"), F.sum("weight"), F.lit(0).cast("long")).first()
    if total is None:
        return table.select("source", "size", "rank", F.lit(0.0).alias("target"))
    while True:
        above = _wide(passes * F.col("size")) * F.lit(shared) < _wide(F.col("weight")) * F.lit(total - capped)
        now = table.agg(F.coalesce(F.sum(F.when(~above, F.col("weight"))), F.lit(0)), F.coalesce(F.sum(F.when(above, passes * F.col("size"))), F.lit(0))).first()
        if tuple(now) == (shared, capped):
            break
        shared, capped = now
    even = F.col("weight") * F.lit(total - capped) / F.lit(float(shared))
    return table.select("source", "size", "rank", F.when(above, (passes * F.col("size")).cast("double")).otherwise(even).alias("target"))


def _quotients(df: DataFrame, votes: str, seats: Column, total: Column, parties: Column) -> DataFrame:
    """`low` seats that a party has in any case, and a row for each further seat that it may get, with its quotient."""
    share, reach = F.col(votes) * seats / total, F.col(votes) * parties / total / 2
    low = F.greatest(F.lit(0), F.floor(share - reach) - 1).cast("long")
    bounded = df.where(F.col(votes) > 0).withColumns({"low": low, "high": (F.ceil(share + reach) + 1).cast("long")})
    each = bounded.select("*", F.explode(F.sequence("low", "high")).alias("k"))
    return each.withColumn("quotient", F.col(votes) / (2 * F.col("k") + 1))


def source_quotas(goals: DataFrame, seats: int, total: int) -> DataFrame:
    """(source, quota): blocks of each source by the highest quotients of all sources."""
    goals = written(goals, "goals")
    parties = goals.where("target > 0").count()
    each = _quotients(goals, "target", F.lit(float(seats)), F.lit(float(total)), F.lit(float(parties)))
    each = each.withColumnRenamed("rank", "number")
    row = written(ranked(each, F.col("quotient").desc(), F.col("number"), F.col("k")).select("source", "low", "k", "rank"), "quotients")
    sure = row.where("k = low").agg(F.coalesce(F.sum("low"), F.lit(0))).first()[0]
    return row.groupBy("source").agg((F.first("low") + F.count_if(F.col("rank") < seats - sure)).alias("quota"))


def shard_quotas(shards: DataFrame, quotas: DataFrame) -> DataFrame:
    """shards (source, shard, length) -> with `quota`: blocks of each shard by the highest quotients of its source."""
    of_source = Window.partitionBy("source")
    named = quotas.select(F.col("source").alias("of"), F.col("quota").alias("seats"))
    whole = shards.join(named, F.col("source").eqNullSafe(F.col("of")), "left").select("source", "shard", "length", F.coalesce("seats", F.lit(0)).alias("seats"))
    whole = whole.withColumns({"total": F.sum("length").over(of_source), "parties": F.count_if(F.col("length") > 0).over(of_source)})
    each = _quotients(whole, "length", F.col("seats"), F.col("total"), F.col("parties"))
    sure = F.sum(F.when(F.col("k") == F.col("low"), F.col("low"))).over(of_source)
    place = F.row_number().over(of_source.orderBy(F.col("quotient").desc(), "shard", "k"))
    won = each.select("source", "shard", "low", (place <= F.col("seats") - sure).alias("won"))
    quota = won.groupBy("source", "shard").agg((F.first("low") + F.count_if("won")).alias("quota"))
    quota = quota.select(F.col("source").alias("of"), F.col("shard").alias("at"), "quota")
    return shards.join(quota, F.col("source").eqNullSafe(F.col("of")) & (F.col("shard") == F.col("at")), "left").select(
        "source", "shard", "length", F.coalesce("quota", F.lit(0)).alias("quota"))


def lines(shards: DataFrame, block: int, passes: int, seed: int) -> DataFrame:
    """What is taken of each shard's line: whole passes, then `rest` words in `chosen` of `blocks` blocks from `phase` on."""
    words = shards.withColumn("want", F.least(F.col("quota") * block, passes * F.col("length")))
    words = words.withColumn("whole", F.coalesce(F.expr("try_divide(want - want % length, length)").cast("long"), F.lit(0)))
    words = words.withColumns({"rest": F.col("want") - F.col("whole") * F.col("length"), "blocks": F.greatest(F.lit(1), F.expr(f"length div {block}"))})
    phase = F.conv(F.substring(F.md5(F.concat_ws(":", F.lit(str(seed)), F.col("shard"), "source").cast("binary")), 1, 8), 16, 10).cast("long") % F.col("blocks")
    return words.withColumns({"chosen": F.least(F.col("blocks"), F.expr(f"(rest + {block - 1}) div {block}")), "phase": phase})


def _taken_upto(x: Column, block: int) -> Column:
    """Words that the chosen blocks take of the first x words of a line."""
    j = F.least(F.floor(x / block), F.col("blocks") - 1)

    def chosen(n: Column) -> Column:
        return F.call_function("div", _wide(n) * _wide(F.col("chosen")) + _wide(F.col("phase")), _wide(F.col("blocks")))

    return F.least(F.col("rest"), block * chosen(j) + (chosen(j + 1) - chosen(j)) * (x - block * j))


def mix(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", weights: tuple[int, ...] = WEIGHTS,
        passes: int = PASSES, block: int = BLOCK, seed: int = SEED) -> DataFrame:
    """(doc_id, source, size, source_size, target, taken): the words that the mix takes of each document."""
    units = written(documents(docs, doc_id, text, source, seed), "units")
    units = units.withColumn("words", F.col("size") * F.col("copies"))
    bins = 1 + isqrt(units.count())
    units = units.withColumn("bin", F.floor(F.conv(F.substring("h", 1, 8), 16, 10).cast("long") * bins / 2**32).cast("long"))
    stretches = written(units.groupBy("source", "shard", "bin").agg(F.sum("words").alias("words")), "stretches")
    shards = written(stretches.groupBy("source", "shard").agg(F.sum("words").alias("length")), "shards")
    goals = written(targets(shards.groupBy("source").agg(F.sum("length").alias("size")), weights, passes), "targets")
    total = goals.agg(F.sum("size")).first()[0] or 0
    quotas = written(shard_quotas(shards, source_quotas(goals, total // block, total)), "quotas")
    source_of = F.col("source").eqNullSafe(F.col("of"))
    line = lines(quotas, block, passes, seed).join(goals.select(F.col("source").alias("of"), F.col("size").alias("source_size"), "target"), source_of).drop("of")
    before = F.coalesce(F.sum("words").over(Window.partitionBy("source", "shard").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    line = line.select(*(F.col(c).alias("of" if c == "source" else "of_shard" if c == "shard" else c) for c in line.columns))
    starts = stretches.select("source", "shard", "bin", before.alias("before")).join(line, source_of & (F.col("shard") == F.col("of_shard")))
    starts = written(starts.select(F.col("source").alias("of"), F.col("shard").alias("of_shard"), F.col("bin").alias("of_bin"), "before", *(c for c in line.columns if c not in ("of", "of_shard"))), "starts")
    inside = Window.partitionBy("source", "shard", "bin").orderBy("h", F.col("doc_id").asc_nulls_last(), "size").rowsBetween(Window.unboundedPreceding, -1)
    placed = units.withColumn("inside", F.coalesce(F.sum("words").over(inside), F.lit(0))).join(
        starts, source_of & (F.col("shard") == F.col("of_shard")) & (F.col("bin") == F.col("of_bin")))
    each = placed.select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1)).alias("copy"))
    x = F.col("before") + F.col("inside") + F.col("copy") * F.col("size")
    taken = F.col("whole") * F.col("size") + _taken_upto(x + F.col("size"), block) - _taken_upto(x, block)
    return each.select("doc_id", "source", "size", "source_size", "target", taken.cast("long").alias("taken"))


def sql(weights: tuple[int, ...] = WEIGHTS, passes: int = PASSES, block: int = BLOCK, seed: int = SEED) -> str:
    """The same mix in DuckDB: every quotient of every party is ranked, and lines are summed in one piece."""
    def upto(x: str) -> str:
        j = f"least({x} // {block}, blocks - 1)::HUGEINT"
        now, then = f"(({j} * chosen + phase) // blocks)", f"((({j} + 1) * chosen + phase) // blocks)"
        return f"least(rest, {block} * {now} + ({then} - {now}) * ({x} - {block} * {j}))"

    return f"""
WITH sized AS (SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^ \\t\\n\\x0B\\f\\r]+')), 0)::BIGINT AS size FROM documents),
copy AS (SELECT *, row_number() OVER (PARTITION BY source, doc_id, size) - 1 AS c FROM sized),
doc AS (SELECT *, md5(concat_ws(':', '{seed}', doc_id, CASE WHEN c >= {TOGETHER} THEN c // {TOGETHER} * {TOGETHER} END)) AS h FROM copy),
dealt AS (SELECT *, ('0x' || substr(h, 25, 8))::BIGINT % {SHARDS} AS shard FROM doc),
line AS (SELECT *, (sum(size) OVER (PARTITION BY source, shard ORDER BY h, doc_id NULLS LAST, size, c ROWS UNBOUNDED PRECEDING) - size)::HUGEINT AS x FROM dealt),
src AS (SELECT source, sum(size)::BIGINT AS size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS rank FROM sized GROUP BY source),
weighted AS (SELECT *, {list(weights)}[rank % {len(weights)} + 1] AS w FROM src),
sorted AS (SELECT *, row_number() OVER o AS i, coalesce(sum({passes} * size) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS capped,
                  sum(w) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS shared, sum(size) OVER () AS total
           FROM weighted WINDOW o AS (ORDER BY size::DOUBLE / w, rank)),
stop AS (SELECT i AS till, capped, shared FROM sorted WHERE {passes} * size * shared >= w * (total - capped) ORDER BY i LIMIT 1),
goal AS (SELECT source, size, rank, total, CASE WHEN i < till THEN ({passes} * size)::DOUBLE ELSE (w * (total - stop.capped))::DOUBLE / stop.shared::DOUBLE END AS target
         FROM sorted, stop),
won AS (SELECT source, row_number() OVER (ORDER BY target / (2 * k + 1) DESC, rank, k) <= total // {block} AS won
        FROM goal, generate_series(0, (total // {block})::BIGINT) s(k) WHERE target > 0),
quota AS (SELECT source, count_if(won)::BIGINT AS seats FROM won GROUP BY source),
shard AS (SELECT source, shard, sum(size)::BIGINT AS length FROM dealt GROUP BY ALL),
part AS (SELECT s.source, shard, row_number() OVER (PARTITION BY s.source ORDER BY length / (2 * k + 1) DESC, shard, k) <= seats AS won
         FROM shard s JOIN quota q ON s.source IS NOT DISTINCT FROM q.source, generate_series(0, seats) g(k) WHERE length > 0),
want AS (SELECT s.source, s.shard, length, least({block} * count_if(won), {passes} * length)::BIGINT AS want
         FROM shard s LEFT JOIN part p ON s.source IS NOT DISTINCT FROM p.source AND s.shard = p.shard GROUP BY s.source, s.shard, length),
pass AS (SELECT *, coalesce(want // nullif(length, 0), 0) AS whole, greatest(1, length // {block}) AS blocks FROM want),
rest AS (SELECT *, want - whole * length AS rest, least(blocks, (want - whole * length + {block - 1}) // {block}) AS chosen,
                ('0x' || substr(md5(concat_ws(':', '{seed}', shard, source)), 1, 8))::BIGINT % blocks AS phase FROM pass)
SELECT doc_id, l.source, l.size, g.size AS source_size, target, (whole * l.size + {upto('(x + l.size)')} - {upto('x')})::BIGINT AS taken
FROM line l JOIN rest r ON l.source IS NOT DISTINCT FROM r.source AND l.shard = r.shard JOIN goal g ON l.source IS NOT DISTINCT FROM g.source"""
