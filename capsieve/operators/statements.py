"""Financial statements in filing HTML.

A document is one row and is parsed inside that row: tables, rows and cells are
nested arrays, so parsing is a map-only step that never shuffles the documents.
Only the small results leave it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from capsieve import rules as R
from capsieve.functions.numbers import parse_number
from capsieve.functions.text import (
    col, contains_any, empty, match_form, match_form_literal, once, quote, string_array, strip, strip_tags, unescape_entities,
)
from capsieve.operators.keyed import evaluate_once
from capsieve.operators.runway_rules import months_in_text, scale_in, scale_in_lines

TABLE = r"(?is)<table[^>]*>.*?</table>"
ROW = r"(?is)<tr[^>]*>.*?</tr>"
CELL = r"(?is)<t[hd][^>]*>.*?</t[hd]>"
REACH_CHARS, REACH_TOKENS = 8000, 200   # how far a number may stand from its caption


def _all(text: Column, pattern: str) -> Column:
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(0))


def table_rows(table: Column) -> Column:
    """``array<array<string>>``: the non-empty rows of one HTML table as plain text cells."""
    rows = F.transform(_all(table, ROW), lambda r: F.transform(_all(r, CELL), strip_tags))
    return F.filter(rows, lambda r: F.size(r) > 0)


def html_cells(docs: DataFrame, doc_id: str, html: str = "html", element: str = TABLE) -> DataFrame:
    """Long table ``(doc_id, table_idx, row_idx, col_idx, text)`` of all tables of all documents."""
    tables = docs.select(doc_id, F.posexplode(_all(F.coalesce(F.col(html), empty()), element)).alias("table_idx", "t"))
    rows = tables.select(doc_id, "table_idx", F.posexplode(table_rows(F.col("t"))).alias("row_idx", "r"))
    return rows.select(doc_id, "table_idx", "row_idx", F.posexplode("r").alias("col_idx", "text"))


def html_elements(docs: DataFrame, doc_id: str, tag: str, html: str = "html") -> DataFrame:
    """Long table ``(doc_id, pos, text)`` of the stripped texts of one kind of element."""
    pattern = rf"(?is)<{tag}(?:\s[^>]*)?>.*?</{tag}>"
    found = docs.select(doc_id, F.posexplode(_all(F.coalesce(F.col(html), empty()), pattern)).alias("pos", "t"))
    return found.select(doc_id, "pos", strip_tags("t").alias("text"))


# ---------------------------------------------------------------- number after a caption

def caption_number(text: Column | str, captions: Sequence[str]) -> Column:
    """The number that belongs to the first caption which has one.

    Numbers after the caption are scored: footnote marks, years and counts in
    prose lose; negative, grouped or currency-marked numbers win; then position.
    """
    keys = string_array([match_form_literal(c).lower() for c in captions])

    def first(norm: Column, low: Column) -> Column:
        def after(k: Column) -> Column:
            return _best_token(F.substr(norm, F.call_function("instr", low, k) + F.length(k), F.lit(REACH_CHARS)))

        # captions after the first one with a number are not read
        return F.aggregate(F.filter(keys, lambda k: F.contains(low, k)), F.lit(None).cast("double"),
                           lambda found, k: F.when(found.isNotNull(), found).otherwise(after(k)))

    return once(match_form(F.coalesce(col(text), empty())), lambda norm: once(F.lower(norm), lambda low: first(norm, low)))


def _best_token(after: Column) -> Column:
    tokens = F.filter(F.split(after, r"\s+"), lambda t: t != "")
    return once(tokens, _best_of)


def _best_of(tokens: Column) -> Column:
    markers = [m for m in {"".join(ch for ch in x.upper() if ch.isalpha() or ch in "$€£¥") for x in R.CURRENCY_MARKERS} if m]

    def at(i: Column) -> Column:
        return F.coalesce(F.get(tokens, i), empty())

    def wordy(t: Column) -> Column:
        return t.rlike("[A-Za-z]") & ~t.rlike("^&[A-Za-z]+;$")

    def currency(t: Column) -> Column:
        return F.upper(F.regexp_replace(t, r"[^A-Za-z$€£¥₹₩₽]", "")).isin(*sorted(markers))

    def read(x: Column) -> Column:
        i, t = x["i"], x["t"]
        before, after, after2 = at(i - 1), at(i + 1), at(i + 2)
        opened = t.rlike(r"[(\[]") | before.rlike(r"^[(\[]")
        closed = t.rlike(r"[)\]]") | after.rlike(r"[)\]]$")
        group = F.regexp_replace(t, r"[^0-9,.'’]", "")
        return F.struct(
            i.alias("i"), x["v"].alias("v"), F.length(F.regexp_replace(t, "[^0-9]", "")).alias("digits"),
            (t.rlike(r"[-−]") | (opened & closed)).alias("neg"),
            t.rlike(r"[.,  '’]").alias("sep"), t.rlike("[$€£¥₹₩₽]").alias("cur"),
            group.rlike(r"^\d{1,3}([,.'’]\d{3})+").alias("grouped"),
            (wordy(before) & (wordy(after) | wordy(after2)) & ~(currency(before) | currency(after))).alias("prose"),
            F.when(t.startswith("(") | t.endswith(")"), 1).otherwise(0).alias("block"))

    parsed = F.transform(F.slice(tokens, 1, REACH_TOKENS), lambda t, i: F.struct(i.alias("i"), t.alias("t"), parse_number(t).alias("v")))
    numbers = F.transform(F.filter(parsed, lambda x: x["v"].isNotNull()), read)

    def strong(x: Column) -> Column:
        return (x["digits"] >= 3) | x["sep"] | x["cur"] | x["neg"] | (x["block"] == 1)

    def score(nums: Column) -> Column:
        def one(x: Column, i: Column) -> Column:
            later = F.size(F.filter(F.slice(nums, i + 2, REACH_TOKENS), strong))
            bare, size = ~x["neg"] & ~x["sep"] & ~x["cur"], F.abs(x["v"])
            note = (
                ((x["digits"] <= 2) & (size < 100))
                | ((x["digits"] == 3) & bare & (size < 200) & (later >= 2))
                | ((x["digits"] == 4) & bare & size.between(1900, 2100) & (later >= 1)) | x["prose"])
            big = (x["digits"] >= 4) | x["sep"] | x["cur"] | x["grouped"]
            return F.struct(note.cast("int").alias("note"), (~x["neg"]).cast("int").alias("n"),
                            (~big).cast("int").alias("b"), x["i"].alias("i"), x["v"].alias("v"), x["block"].alias("block"))
        return F.transform(nums, one)

    def choose(scored: Column) -> Column:
        def some(block: int, real: bool) -> Column:
            return F.exists(scored, lambda s: (s["block"] == block) & ((s["note"] == 0) if real else F.lit(True)))

        block = F.when(some(0, True), 0).when(some(1, True), 1).when(some(0, False), 0).otherwise(1)
        return F.array_min(F.filter(scored, lambda s: s["block"] == block))["v"]

    # single-element arrays let each intermediate list be computed once
    scored = F.transform(F.array(numbers), score)
    return F.element_at(F.transform(scored, choose), 1)


# ---------------------------------------------------------------- sections and scale

def section(html: Column, headers: Sequence[str], window: int, patterns: Sequence[str] = ()) -> Column:
    """Text from the first heading that is followed by a table: ``window`` characters, and to the
    end of that table when it is longer. Null without such a heading.

    A heading that contains an earlier one never decides, so it is left out.
    """
    return section_of(from_heading(html, headers, patterns), window)


def section_of(rest: Column, window: int) -> Column:
    closing = F.regexp_extract(rest, r"(?is)^.*?</table[^>]*>", 0)
    return F.substr(rest, F.lit(1), F.greatest(F.length(closing), F.lit(window)))


def from_heading(html: Column, headers: Sequence[str], patterns: Sequence[str] = ()) -> Column:
    """The document from the first heading on; its place is the document's length less its own."""
    decisive = [h for i, h in enumerate(headers) if not any(e in h for e in headers[:i])]
    regexes = [quote(h) for h in decisive] + list(patterns)
    rests = [F.regexp_extract(html, rf"(?is){p}(?=.*?<t(?:able|r)).*", 0) for p in regexes]
    return F.coalesce(*[F.nullif(r, F.lit("")) for r in rests])


def placed_tables(text: Column, start: Column) -> Column:
    """``array<struct(at, t)>``: the tables of a text and their places in the document, in which the text begins at ``start``."""
    tables = _all(text, TABLE)
    sizes = F.zip_with(F.slice(F.split(text, TABLE, -1), F.lit(1), F.size(tables)), tables, lambda g, t: F.struct(F.length(g).alias("g"), F.length(t).alias("t")))
    none = F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("all"))
    places = F.aggregate(sizes, none, lambda acc, x: F.struct(
        (acc["at"] + x["g"] + x["t"]).alias("at"), F.array_append(acc["all"], acc["at"] + x["g"]).alias("all")))["all"]
    return F.zip_with(places, tables, lambda a, t: F.struct((a + start).alias("at"), t.alias("t")))


def scale_near(fragment: Column, html: Column, place: Column) -> Column:
    """Multiplier printed near a fragment at a place of the document: its head, above its table, before it (up to 5,000
    characters), after it (2,000), or the document head."""
    before_table = F.regexp_extract(fragment, r"(?is)^(.+?)<table", 1)
    prior = F.substr(html, F.lit(1), place - 1)
    near = F.substr(html, F.greatest(place - 5000, F.lit(1)), F.least(place - 1, F.lit(5000)))
    return F.coalesce(
        scale_in_lines(F.substring_index(fragment, "\n", 5)),
        scale_in_lines(F.substring_index(before_table, "\n", -5)),
        scale_in_lines(F.substring_index(prior, "\n", -5)),
        scale_in(near), scale_in(F.substr(html, place, F.lit(2000))),
        scale_in_lines(F.substring_index(html, "\n", 5)), F.lit(1))


# ---------------------------------------------------------------- rows of a statement

def latest_year_column(rows: Column) -> Column:
    """Value column (0-based, after the label) of the latest year in the first row naming years, else -1."""
    def years(r: Column) -> Column:
        cells = F.transform(F.slice(r, 2, F.greatest(F.size(r) - 1, F.lit(0))), lambda c, i: F.struct(
            # a failed cast is costly
            F.nullif(F.regexp_extract(match_form(c), r"((?:19|20)\d{2})", 1), empty()).try_cast("int").alias("y"), (-i).alias("i")))
        return F.filter(cells, lambda c: c["y"].isNotNull())

    headed = F.filter(F.transform(rows, years), lambda r: F.size(r) > 0)
    return F.coalesce(-F.array_max(F.try_element_at(headed, F.lit(1)))["i"], F.lit(-1))


def row_numbers(row: Column) -> Column:
    """``array<struct(i, v)>`` of the value cells; brackets split over neighbouring cells count as minus."""
    cells = F.slice(row, 2, F.greatest(F.size(row) - 1, F.lit(0)))

    def read(c: Column, i: Column) -> Column:
        before, after = strip(F.coalesce(F.get(cells, i - 1), empty())), strip(F.coalesce(F.get(cells, i + 1), empty()))
        opened = strip(c).startswith("(") | (before.startswith("(") & ~before.contains(")"))
        closes = strip(c).endswith(")") & strip(c).contains("(")
        minus = opened | closes | (after.endswith(")") & ~after.contains("("))
        return F.struct(i.alias("i"), once(parse_number(c), lambda v: F.when((v >= 0) & minus, -v).otherwise(v)).alias("v"))

    return F.filter(F.transform(cells, read), lambda x: x["v"].isNotNull())


def pick_column(numbers: Column, column: Column) -> Column:
    """Number nearest to the chosen column, or the last one when none is chosen."""
    near = F.transform(numbers, lambda x: F.struct(F.abs(x["i"] - column).alias("d"), x["i"].alias("i"), x["v"].alias("v")))
    return F.when(column >= 0, F.array_min(near)["v"]).otherwise(F.try_element_at(numbers, F.lit(-1))["v"])


def _labelled(rows: Column) -> Column:
    """``array<struct(text, n)>``: normalised lower-case text and numbers of each row, computed once."""
    return F.transform(rows, lambda r: F.struct(
        F.lower(match_form(F.array_join(r, " "))).alias("text"), row_numbers(r).alias("n")))


def _lower_literals(captions: Sequence[str]) -> list[str]:
    return list(dict.fromkeys(match_form_literal(c).lower() for c in captions))


def cash_from_rows(rows: Column, column: Column) -> Column:
    """End-of-period cash from labelled rows: the first cash row with a number; a label row may hand over to the next
    row when that is the restricted-cash line."""
    def facts(x: Column) -> Column:
        text = x["text"]
        ends = text.contains("end of") | text.contains("period end") | text.contains("end-of")
        skip = contains_any(text, ("net decrease", "net increase", "beginning", "start of", "opening"))
        known = contains_any(text, _lower_literals(R.CASH_CAPTIONS_FLOW))
        simple = text.contains("cash") & ends & ~text.contains("cash flows")
        label = ~skip & (known | text.contains("cash and cash equivalents") | simple)
        value = pick_column(x["n"], column)
        return F.struct(
            label.alias("label"), (label & (ends | known | simple)).alias("closing"),
            (~skip & ~label & contains_any(text, ("cash & restricted cash", "cash and restricted cash"))).alias("restricted"),
            value.alias("v"))

    def hits(seen: Column) -> Column:
        def kept(x: Column, i: Column) -> Column:
            previous = F.coalesce(F.get(seen, i - 1)["label"], F.lit(False))
            return x["v"].isNotNull() & (x["closing"] | (x["restricted"] & previous))
        return F.try_element_at(F.filter(seen, kept), F.lit(1))["v"]

    return F.element_at(F.transform(F.array(F.transform(rows, facts)), hits), 1)


def cash_flow_from_rows(rows: Column, column: Column, sign: str = "reported") -> Column:
    """``array<double>``: operating cash flow of every matching labelled row in order.

    The printed sign is kept. ``sign='flip_provided'`` negates rows whose caption
    says "provided", as the published rule does.
    """
    burn, provided = _lower_literals(R.OCF_CAPTIONS_BURN), _lower_literals(R.OCF_CAPTIONS_PROVIDED)

    matching = F.filter(rows, lambda x: contains_any(x["text"], [*burn, *provided]))

    def read(x: Column) -> Column:
        value = pick_column(x["n"], column)
        return F.when(contains_any(x["text"], burn), value).otherwise(-value) if sign == "flip_provided" else value

    return F.filter(F.transform(matching, read), lambda v: v.isNotNull())


def _first_key(text: Column, keys: Column) -> Column:
    """Position (1-based) of the first caption found in a text, 0 without one."""
    return once(text, lambda low: F.array_position(F.transform(keys, lambda k: F.contains(low, k)), True))


def _read_tables(tables: Column, html: Column, sign: str) -> Column:
    """``array<struct(scale, cash, flows)>`` of a list of placed HTML tables."""
    def unpack(x: Column) -> Column:
        rows = table_rows(x["t"])
        return F.struct(scale_near(x["t"], html, x["at"]).alias("scale"), rows.alias("rows"))

    def label(t: Column) -> Column:
        return F.struct(t["scale"].alias("scale"), _labelled(t["rows"]).alias("rows"), latest_year_column(t["rows"]).alias("column"))

    def read(t: Column) -> Column:
        return F.struct(
            t["scale"].alias("scale"), (cash_from_rows(t["rows"], t["column"]) * t["scale"]).alias("cash"),
            F.transform(cash_flow_from_rows(t["rows"], t["column"], sign), lambda v: v * t["scale"]).alias("flows"))

    return F.transform(F.transform(F.transform(tables, unpack), label), read)


def parse_statements(docs: DataFrame, html: str = "html", sign: str = "reported") -> DataFrame:
    """Add ``statement``: cash, ocf, months, units, header, evidence of each document.

    Cash comes from the balance sheet text, else from a cash-flow table. Operating
    cash flow comes from the tables of the cash-flow section, else from other
    tables with such a caption, else from the section text.
    """
    flow_captions = [*R.OCF_CAPTIONS_BURN, *R.OCF_CAPTIONS_PROVIDED]
    keys = string_array(_lower_literals(flow_captions))
    out = docs.withColumn("__html", unescape_entities(F.coalesce(F.col(html), empty())))
    page = F.col("__html")
    out = out.withColumns({
        "__balance_on": from_heading(page, R.BALANCE_HEADERS), "__flow_on": from_heading(page, R.CASHFLOW_HEADERS, [R.CASHFLOW_HEADER_PATTERN])})
    out = out.withColumns({
        "__balance": section_of(F.col("__balance_on"), 60_000), "__balance_at": F.length(page) - F.length("__balance_on") + 1,
        "__flow": section_of(F.col("__flow_on"), 120_000), "__flow_at": F.length(page) - F.length("__flow_on") + 1}).drop("__balance_on", "__flow_on")
    flow_tables = F.coalesce(placed_tables(F.col("__flow"), F.col("__flow_at")), F.array().cast("array<struct<at:int,t:string>>"))
    known = F.transform(placed_tables(page, F.lit(1)), lambda x: F.struct(_first_key(F.lower(x["t"]), keys).alias("key"), x["at"].alias("at"), x["t"].alias("t")))
    out = out.withColumns({"__inside": flow_tables, "__known": F.array_sort(F.filter(known, lambda x: x["key"] > 0))})
    outside = F.filter(F.transform("__known", lambda x: F.struct(x["at"].alias("at"), x["t"].alias("t"))),
                       lambda x: ~F.exists("__inside", lambda y: y["at"] == x["at"]))
    out = out.withColumn("__read", _read_tables(F.concat("__inside", outside), page, sign))
    balance_cash = caption_number(strip_tags("__balance"), R.CASH_CAPTIONS_BALANCE) * scale_near(F.col("__balance"), page, F.col("__balance_at"))
    flow_text = F.when(F.col("__flow").isNotNull(), strip_tags("__flow"))
    out = out.withColumns({
        "__own": F.slice("__read", 1, F.size("__inside")), "__balance_cash": F.when(F.col("__balance").isNotNull(), balance_cash),
        "__text": flow_text, "__scale": F.when(F.col("__flow").isNotNull(), scale_near(F.col("__flow"), page, F.col("__flow_at")))})

    def first_cash(c: str) -> Column:
        return F.try_element_at(F.filter(F.transform(c, lambda t: t["cash"]), lambda v: v.isNotNull()), F.lit(1))

    def last_flow(c: str) -> Column:
        return F.try_element_at(F.flatten(F.transform(c, lambda t: t["flows"])), F.lit(-1))

    # tables outside the section only count while something is missing inside it
    found_inside = F.coalesce("__balance_cash", first_cash("__own")).isNotNull() & last_flow("__own").isNotNull()
    out = out.withColumn("__used", F.when(found_inside, F.col("__own")).otherwise(F.col("__read")))
    spoken = caption_number("__text", flow_captions) * F.col("__scale")
    out = out.withColumns({
        "__cash": F.coalesce("__balance_cash", first_cash("__used")), "__ocf": F.coalesce(last_flow("__used"), spoken),
        "__months": F.coalesce(months_in_text("__text"), months_in_text(strip_tags(page))),
        "__units": F.coalesce("__scale", F.lit(1)).cast("bigint")})
    evidence = F.concat_ws(
        "; ", F.when(F.col("__flow").isNotNull(), "cash flow table located"),
        F.concat(F.lit("cash="), F.col("__cash").cast("string")), F.concat(F.lit("ocf="), F.col("__ocf").cast("string")),
        F.concat(F.lit("period="), F.col("__months").cast("string")))
    found = F.struct(
        F.col("__cash").alias("cash"), F.col("__ocf").alias("ocf"), F.col("__months").alias("months"),
        F.col("__units").alias("units"), F.col("__flow").isNotNull().alias("header"), evidence.alias("evidence"))
    return evaluate_once(out.withColumn("statement", found).select(*docs.columns, "statement"), "statement")
