"""Keyed building blocks shared by the screening operators.

Two rules keep them safe for keys that hold a large share of all rows:

* "first", "last" and "top n" per key are a ranked window with a filter on the
  rank. Spark turns that into a per-task group limit *before* the shuffle, so a
  hot key sends at most ``n`` rows per map task.
* lists per key are cut into parts of at most twice a given number of lines
  (:func:`text_parts`). Parts are for printing; decisions are aggregations over lines, never over parts.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from capsieve.functions.text import blank_to_null
from capsieve.session import stored_once

LINES_PER_PART = 10_000


def top_rows(df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int = 1,
             rank: str | None = None) -> DataFrame:
    """The first ``n`` rows per key in the given order."""
    name = rank or "__rank"
    window = Window.partitionBy(*keys).orderBy(*order)
    ranked = df.withColumn(name, F.row_number().over(window)).where(F.col(name) <= n)
    return ranked if rank else ranked.drop(name)


def evaluate_once(df: DataFrame, column: str) -> DataFrame:
    """Keep a costly computed column from being copied into later filters.

    The optimizer pushes a filter below the projection that defines its column
    and so computes the column twice. A one-element generator stops that.
    """
    others = [F.col(f"`{c}`") for c in df.columns if c != column]
    return df.select(*others, F.explode(F.array(F.col(f"`{column}`"))).alias(column)).select([F.col(f"`{c}`") for c in df.columns])


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Small rows whose later work is costly, dealt to at least three tasks a core by their keys.

    A small file is read by one or two tasks, however much is computed from each row, and adaptive execution merges
    small partitions; a stated number of them stays.
    """
    return df.repartition(_tasks(df), *keys)


def _tasks(df: DataFrame) -> int:
    spark = df.sparkSession
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), 3 * spark.sparkContext.defaultParallelism)


def numbered(df: DataFrame, order: Sequence[str], name: str = "n", total: str = "total") -> DataFrame:
    """Rows numbered from 1 in a unique order over the whole table, and their total, without one task that sees them all.

    Rows are dealt to tasks by ranges of the order and written, so that ranges and sizes are those of one run;
    they are numbered inside each range, and the sizes of the ranges before it are added.
    """
    ranges = stored_once(df.repartitionByRange(4 * _tasks(df), *order).withColumn("__range", F.spark_partition_id()), "ranges")
    sizes = ranges.groupBy("__range").agg(F.count("*").alias("__size"))
    before = Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    every = Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    sizes = sizes.select("__range", F.coalesce(F.sum("__size").over(before), F.lit(0)).alias("__before"), F.sum("__size").over(every).alias(total))
    inside = Window.partitionBy("__range").orderBy(*order)
    return ranges.withColumn(name, F.row_number().over(inside)).join(sizes, "__range").withColumn(
        name, F.col(name) + F.col("__before")).drop("__range", "__before")


def first_per_key(df: DataFrame, keys: Sequence[str], ordinal: str) -> DataFrame:
    return top_rows(df, keys, [F.asc(ordinal)])


def last_per_key(df: DataFrame, keys: Sequence[str], ordinal: str) -> DataFrame:
    return top_rows(df, keys, [F.desc(ordinal)])


def align(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Reorder to a schema, casting columns and adding missing ones as null."""
    return df.select([
        (F.col(f"`{f.name}`") if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in schema.fields
    ])


def new_rows(old: DataFrame, new: DataFrame, keys: Sequence[str], dedupe: bool = False,
             ordinal: str | None = None) -> DataFrame:
    """Rows of ``new`` whose key is not in ``old``; keys compare as text, null equals null.

    Repeated keys inside ``new`` are kept unless ``dedupe`` asks for one row per
    key (the last one by ``ordinal``, else the greatest row).
    """
    seen = old.select(*[F.col(k).cast("string").alias(f"__old_{k}") for k in keys])
    same = reduce(lambda a, b: a & b, [F.col(k).cast("string").eqNullSafe(F.col(f"__old_{k}")) for k in keys])
    fresh = new.join(seen, same, "left_anti")
    return one_per_key(fresh, keys, ordinal) if dedupe else fresh


def one_per_key(df: DataFrame, keys: Sequence[str], ordinal: str | None = None) -> DataFrame:
    """The last row per key by ``ordinal``; without one the greatest row, so that the choice never depends on the layout."""
    if ordinal:
        return last_per_key(df, keys, ordinal)
    return top_rows(df, keys, [F.desc(f"`{c}`") for c in df.columns if c not in keys] or [F.asc(keys[0])])


def append_new(old: DataFrame, new: DataFrame, keys: Sequence[str], dedupe: bool = False,
               ordinal: str | None = None) -> DataFrame:
    """Accumulated table: all old rows and the new ones; columns may differ."""
    return old.unionByName(new_rows(old, new, keys, dedupe, ordinal), allowMissingColumns=True)


def keep_days(df: DataFrame, date: str, as_of: Column, days: int | None) -> DataFrame:
    """Flat retention window; rows without a date stay."""
    if days is None:
        return df
    return df.where(F.col(date).isNull() | (F.col(date) >= F.date_sub(as_of, days)))


def fill_missing(left: DataFrame, lookup: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """Fill null or blank columns from a lookup holding one row per key; the left value wins."""
    aliased = lookup.select(F.col(key), *[F.col(c).alias(f"__{c}") for c in columns])
    joined = left.join(aliased, key, "left")
    filled = {}
    for c in columns:
        textual = isinstance(left.schema[c].dataType, T.StringType)
        own = blank_to_null(c) if textual else F.col(c)
        filled[c] = F.coalesce(own, F.col(f"__{c}"))
    return joined.withColumns(filled).drop(*[f"__{c}" for c in columns]).select(*left.columns)


def backfill(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    """Left join; where both sides have a column the left value wins, else the right one."""
    keys = [k for k in on if k in left.columns and k in right.columns]
    shared = [c for c in right.columns if c in left.columns and c not in keys]
    renamed = right.select([F.col(f"`{c}`").alias(f"{c}__dup" if c in shared else c) for c in right.columns])
    joined = left.join(renamed, keys, "left")
    merged = [
        (F.coalesce(F.col(f"`{c}`"), F.col(f"`{c}__dup`")) if c in shared else F.col(f"`{c}`")).alias(c)
        for c in left.columns
    ]
    return joined.select(*merged, *[F.col(f"`{c}`") for c in right.columns if c not in keys and c not in shared])


def or_key_join(left: DataFrame, right: DataFrame, keys: Sequence[str], prefix: str = "r_") -> DataFrame:
    """Inner join on "any of the keys is equal" as a union of equi-joins.

    The branch of the n-th key drops the pairs an earlier key already matched,
    so no pair appears twice and nothing has to be made distinct. Blank keys
    never match. Right columns get ``prefix``.
    """
    renamed = right.select([F.col(f"`{c}`").alias(f"{prefix}{c}") for c in right.columns])
    branches = []
    for i, key in enumerate(keys):
        cond = (F.col(key) == F.col(f"{prefix}{key}")) & (F.col(key) != "")
        for earlier in keys[:i]:
            matched = (F.col(earlier) == F.col(f"{prefix}{earlier}")) & (F.col(earlier) != "")
            cond = cond & ~F.coalesce(matched, F.lit(False))
        branches.append(left.join(renamed, cond, "inner"))
    return reduce(DataFrame.unionByName, branches)


def text_parts(lines: DataFrame, keys: Sequence[str], ordinal: str, text: str, name: str, day: str | None = None,
               lines_per_part: int = LINES_PER_PART, separator: str = "\n", age: str | None = None,
               dealt: Sequence[str] | None = None) -> DataFrame:
    """Join the lines of each key into cells of bounded length.

    Lines are ordered newest ``day`` first (undated last), or by a number ``age``, then by ``ordinal``,
    which must be unique within a key. Returns ``(*keys, EvidencePart, name)``.
    A key with up to ``lines_per_part`` lines has exactly one cell, part 0. A
    bigger key gets several of at most twice as many lines, and reading the parts
    in order gives the whole text: nothing is cut off.

    Lines are counted per key first. Only keys with more lines than a part are counted further, in bins of
    ``lines_per_part`` consecutive ordinals of a day, which cannot hold more lines than that; a part is a run of whole
    bins. The windows run over the counts only: bins of a (key, day), and days of a key. Where no key is that long,
    adaptive execution finds the bins empty and the text is shuffled once.

    ``dealt`` is for lines that are read from a written table and names the keys by which the cells are used next. Long keys and
    their parts are then written first, so that lines meet them where they are read, and lines are shuffled once only, by
    these keys and their part.
    """
    order = F.col(age) if age else F.coalesce(-F.unix_date(day), F.lit(1 << 30)) if day else F.lit(0)
    rows = lines.withColumn("__age", order)
    rows = rows.withColumn("__bin", F.call_function("div", F.col(ordinal), F.lit(lines_per_part)))
    counted = rows if dealt is None else _crowded(rows, keys, lines_per_part)
    long = counted.groupBy(*keys).agg(F.count("*").alias("__n")).where(F.col("__n") > lines_per_part).select(*keys)
    if dealt is not None:
        long = stored_once(long, "long-keys")
    counts = rows.select(*keys, "__age", "__bin").join(long, list(keys), "left_semi").groupBy(*keys, "__age", "__bin").agg(F.count("*").alias("__n"))
    in_day = Window.partitionBy(*keys, "__age").orderBy("__bin").rowsBetween(Window.unboundedPreceding, -1)
    in_key = Window.partitionBy(*keys).orderBy("__age").rowsBetween(Window.unboundedPreceding, -1)
    days = counts.groupBy(*keys, "__age").agg(F.sum("__n").alias("__n")).withColumn(
        "__days", F.coalesce(F.sum("__n").over(in_key), F.lit(0))).drop("__n")
    bins = counts.withColumn("__bins", F.coalesce(F.sum("__n").over(in_day), F.lit(0))).drop("__n").join(days, [*keys, "__age"])
    part = F.floor((F.col("__days") + F.col("__bins")) / F.lit(lines_per_part)).cast("bigint")
    bins = bins.select(*keys, "__age", "__bin", part.alias("__part"))
    if dealt is not None:
        bins = stored_once(bins, "long-bins")
    entry = F.struct(F.col("__age").alias("age"), F.col(ordinal).alias("o"), F.col(text).alias("t"))
    placed = rows.join(bins, [*keys, "__age", "__bin"], "left").withColumn("EvidencePart", F.coalesce("__part", F.lit(0)).cast("bigint"))
    if dealt is not None:
        placed = placed.select(*keys, "EvidencePart", "__age", ordinal, text).repartition(*dealt, "EvidencePart")
    return (
        placed.groupBy(*keys, "EvidencePart")
        .agg(F.array_sort(F.collect_list(entry)).alias("__cell"))
        .select(*keys, "EvidencePart",
                F.array_join(F.transform("__cell", lambda x: x["t"]), separator).alias(name))
    )


def _crowded(rows: DataFrame, keys: Sequence[str], least: int, buckets: int = 1 << 16) -> DataFrame:
    """Rows whose keys share a bucket with more than ``least`` rows: all rows of any key with that many, and few others.

    Counts per bucket shrink before they are shuffled, which counts per key don't when a key has few rows.
    """
    bucket = F.pmod(F.xxhash64(*keys), F.lit(buckets))
    full = rows.groupBy(bucket.alias("__bucket")).agg(F.count("*").alias("__n")).where(F.col("__n") > least).select("__bucket")
    return rows.withColumn("__bucket", bucket).join(stored_once(full, "full-buckets"), "__bucket", "left_semi")


def cells_by_part(lines: DataFrame, keys: Sequence[str], column: str, names: Sequence[str], ordinal: str, text: str,
                  day: str | None = None, lines_per_part: int | None = None, separators: dict[str, str] | None = None) -> DataFrame:
    """``(*keys, EvidencePart, *names)``: the lines of several named cells, told apart by ``column``, joined in one pass.

    Cells of a key that are shorter than others have null in the later parts.
    """
    size = {} if lines_per_part is None else {"lines_per_part": lines_per_part}
    mark = "\x1f"
    found = text_parts(lines, [*keys, column], ordinal, text, "__text", day, separator=mark, **size)
    cell = {n: F.replace(F.col("__text"), F.lit(mark), F.lit((separators or {}).get(n, "\n"))) for n in names}
    return found.groupBy(*keys, "EvidencePart").agg(*[F.max(F.when(F.col(column) == n, cell[n])).alias(n) for n in names])


def one_row_each(df: DataFrame, cells: Sequence[str]) -> DataFrame:
    """Rows without their evidence cells and part numbers: what is decided once, however many parts the cells have."""
    return df.drop("EvidencePart", *cells).distinct()


def with_parts(rows: DataFrame, cells: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Cells of all parts beside the row of their key; a row without cells has the single part 0."""
    renamed = cells.select(*[F.col(k).alias(f"__{k}") for k in keys], "EvidencePart", *columns)
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys])
    joined = rows.drop("EvidencePart", *columns).join(renamed, same, "left")
    return joined.withColumn("EvidencePart", F.coalesce("EvidencePart", F.lit(0))).drop(*[f"__{k}" for k in keys])


def with_all_parts(rows: DataFrame, key: str, *tables: tuple[DataFrame, Sequence[str]]) -> DataFrame:
    """:func:`with_parts` with cells of several tables (key, EvidencePart, cells), whose numbers of parts may differ."""
    cells = reduce(lambda a, b: a.join(b, [key, "EvidencePart"], "full"), (df.select(key, "EvidencePart", *names).distinct() for df, names in tables))
    return with_parts(rows, cells, [key], [n for _, names in tables for n in names])
