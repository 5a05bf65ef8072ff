"""Evidence as lines: cells back to lines, and the few lines of a company that decide its verdicts.

Cells in parts are a printed form. Whatever is decided about a company is decided from lines of all its parts:
by aggregates per company, or, for rules written for one row, from the lines that can change their outcome.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from capsieve import rules as R
from capsieve.functions.text import clean_text, quote, strip
from capsieve.functions.urls import url_matches_form
from capsieve.operators import evidence as ev
from capsieve.operators.keyed import text_parts

PLACE = "struct<a:bigint,b:bigint>"


def place_of(day: str, ordinal: str) -> Column:
    """Place of a line in the order of evidence: newest day first, undated last, then by ordinal."""
    return F.struct(F.coalesce(-F.unix_date(day), F.lit(1 << 30)).cast("bigint").alias("a"), F.col(ordinal).cast("bigint").alias("b"))


def pieces(cell: Column) -> Column:
    """Entries of a cell or line: trimmed, separated by semicolons or line ends."""
    return F.filter(F.transform(F.split(clean_text(cell), r"[;\r\n]+"), strip), lambda x: x != "")


def split_cells(df: DataFrame, keys: Sequence[str], cells: Sequence[str]) -> DataFrame:
    """``(*keys, Cell, place, Text)``: the entries of the named cells of all parts, in the order of the parts."""
    have = [c for c in cells if c in df.columns]
    part = F.col("EvidencePart") if "EvidencePart" in df.columns else F.lit(0)
    each = F.array(*[F.struct(F.lit(c).alias("Cell"), pieces(F.col(c)).alias("__lines")) for c in have])
    rows = df.select(*keys, part.cast("bigint").alias("__a"), F.inline(each))
    rows = rows.select(*keys, "Cell", "__a", F.posexplode("__lines").alias("__b", "Text"))
    return rows.select(*keys, "Cell", F.struct(F.col("__a").alias("a"), F.col("__b").cast("bigint").alias("b")).alias("place"), "Text")


def placed_cells(lines: DataFrame, keys: Sequence[str], names: Sequence[str], separators: dict[str, str] | None = None,
                 lines_per_part: int | None = None, written: bool = False) -> DataFrame:
    """Lines (keys, Cell, place, Text) as cells beside each other: ``(*keys, EvidencePart, *names)``.

    Lines that are read from a written table (``written``) are shuffled once, by key and part, for their cells and for the rows made of these.
    """
    size = {} if lines_per_part is None else {"lines_per_part": lines_per_part}
    rows = lines.select(*keys, "Cell", F.col("place.a").alias("__age"), F.col("place.b").alias("__seq"), "Text")
    mark = "\x1f"
    found = text_parts(rows, [*keys, "Cell"], "__seq", "Text", "__text", age="__age", separator=mark, dealt=keys if written else None, **size)
    cell = {n: F.replace(F.col("__text"), F.lit(mark), F.lit((separators or {}).get(n, "; "))) for n in names}
    return found.groupBy(*keys, "EvidencePart").agg(*[F.max(F.when(F.col("Cell") == n, cell[n])).alias(n) for n in names])


def first_seen(lines: DataFrame, keys: Sequence[str], value: str = "Text") -> DataFrame:
    """Distinct values of each key and cell at the place where they are first seen."""
    return lines.groupBy(*keys, "Cell", value).agg(F.min("place").alias("place"))


#: Whatever rules look for in the text of evidence, as patterns over lower-case text.
_PATTERNS = tuple(dict.fromkeys((
    *(quote(w) for w in (*R.WATCH_DILUTION_WORDS, *R.NEGATIVE_DILUTION_TERMS, "going concern", "material weakness", "watch")),
    *(f"item {quote(i)}" for i, _ in R.CATALYST_ITEM_LABELS), *(p for p, _ in R.CATALYST_KEYWORD_LABELS), *(p for _, p in R.TIER1_TRIGGERS))))


def deciding_lines(lines: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Lines (keys, Cell, place, Text) that can decide a verdict, at most a few for each form of a company.

    Kept for every form: its first line, its newest one (linked before unlinked, the earlier on a tie), the first one whose link fits
    the form, and the first one for each pattern that a rule looks for. Any rule that takes the first or the newest entry
    with such a property, or asks whether there is one, gives the same answer on these lines as on all.
    """
    e = F.col("e")
    parsed = lines.withColumn("e", F.try_element_at(ev.entries("Text"), F.lit(1))).where(e.isNotNull())
    hit = F.struct("place", "Text")
    newest = F.max(F.struct(
        e["date"].isNotNull().alias("dated"), e["date"].alias("date"), (e["url"] != "").alias("linked"),
        (-F.col("place.a")).alias("a"), (-F.col("place.b")).alias("b"), F.col("Text").alias("Text")))
    fits = (e["form"] != "") & (e["url"] != "") & url_matches_form(e["form"], e["url"])
    found = parsed.groupBy(*keys, "Cell", e["form"].alias("__form")).agg(
        F.min(hit).alias("h0"), newest.alias("n"), F.min(F.when(fits, hit)).alias("h1"),
        *[F.min(F.when(e["lower"].rlike(p), hit)).alias(f"p{i}") for i, p in enumerate(_PATTERNS)])
    best = F.struct(F.struct((-F.col("n.a")).alias("a"), (-F.col("n.b")).alias("b")).alias("place"), F.col("n.Text").alias("Text"))
    every = F.array_compact(F.array(F.col("h0"), best, F.col("h1"), *[F.col(f"p{i}") for i in range(len(_PATTERNS))]))
    return found.select(*keys, "Cell", F.inline(every)).distinct()


def deciding_cells(lines: DataFrame, keys: Sequence[str], names: Sequence[str]) -> DataFrame:
    """:func:`deciding_lines` as one cell each: ``(*keys, *names)``."""
    few = deciding_lines(lines, keys).groupBy(*keys, "Cell").agg(F.array_sort(F.collect_list(F.struct("place", "Text"))).alias("__l"))
    text = F.array_join(F.transform("__l", lambda x: x["Text"]), "; ")
    return few.groupBy(*keys).agg(*[F.max(F.when(F.col("Cell") == n, text)).alias(n) for n in names])


def full_lists(lines: DataFrame, keys: Sequence[str], names: dict[str, str], lines_per_part: int | None = None) -> DataFrame:
    """Complete entries of the named cells, first of each (date, form, link), in parts under their report names."""
    e = F.col("e")
    parsed = lines.where(F.col("Cell").isin(*names)).withColumn("e", F.try_element_at(ev.entries("Text"), F.lit(1)))
    whole = parsed.where(ev.is_complete(e)).withColumn("__core", ev.entry_core(e))
    first = whole.groupBy(*keys, "Cell", "__core").agg(F.min(F.struct("place", ev.entry_text(e).alias("t"))).alias("f"))
    rows = first.select(*keys, F.col("Cell"), F.col("f.place").alias("place"), F.col("f.t").alias("Text"))
    cells = placed_cells(rows, keys, list(names), None, lines_per_part)
    return cells.withColumnsRenamed(names)
