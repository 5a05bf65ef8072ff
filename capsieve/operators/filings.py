"""Filings: lookback windows, coverage gate, key repair, latest filing, evidence, hydration."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from capsieve import rules as R
from capsieve.functions.dates import age_days, as_date, iso
from capsieve.functions.text import (
    blank_to_null, cik, cik_raw, country, detail_text, empty, lookup, starts_any, strip, ticker, upper_key,
)
from capsieve.operators.keyed import cells_by_part, evaluate_once, fill_missing, first_per_key, last_per_key, top_rows
from capsieve.rules import RULES, Rules
from capsieve.session import stored_once

AsOf = dt.date | str | Column


def by_longest_prefix(form: Column, values: dict[str, int]) -> Column:
    """Value of the longest listed prefix of the form, null when none fits.

    The table is configuration, so the prefix join becomes one pattern (longest
    alternative first) and one literal map lookup.
    """
    pattern = "^(" + "|".join(sorted(values, key=len, reverse=True)) + ")"
    return lookup(F.regexp_extract(form, pattern, 1), values)


def _after_cutoff(date: Column, days: Column, as_of: AsOf) -> Column:
    return (days <= 0) | (date >= F.date_sub(as_date(as_of), days))


def whitelisted(filings: DataFrame, as_of: AsOf, rules: Rules = RULES, exact: bool = False) -> DataFrame:
    """Dated filings of a listed form inside the lookback of that form.

    A form belongs to the longest listed prefix (``exact`` asks for equality).
    """
    form = upper_key("Form")
    lookbacks, longest = rules.form_lookbacks(), rules.max_lookback()
    days = {f: lookbacks.get(f, longest) for f in rules.whitelist}
    limit = lookup(form, days) if exact else by_longest_prefix(form, days)
    return filings.where(limit.isNotNull() & F.col("FiledAt").isNotNull() & _after_cutoff(F.col("FiledAt"), limit, as_of))


def within_retention(as_of: AsOf, rules: Rules = RULES, undated: str = "keep",
                     form: str = "Form", date: str = "FiledAt") -> Column:
    """Inside the lookback of the form; forms of no group use the longest lookback."""
    limit = F.coalesce(by_longest_prefix(upper_key(form), rules.form_lookbacks()), F.lit(rules.max_lookback()))
    inside = _after_cutoff(F.col(date), limit, as_of)
    return F.coalesce(inside, F.lit(undated == "keep"))


def purge(filings: DataFrame, as_of: AsOf, rules: Rules = RULES) -> DataFrame:
    """Retention: old filings go, undated ones stay so they can be inspected."""
    return filings.where(within_retention(as_of, rules))


# ---------------------------------------------------------------- coverage gate

def coverage(filings: DataFrame, profiles: DataFrame | None = None) -> DataFrame:
    """``(Ticker, Country, Eligible, Reason)`` for every ticker of either table.

    A ticker needs a quarterly or annual report, or a foreign annual report
    together with an interim one. One aggregation with map-side combine over the
    union of both tables; no list of forms is ever collected.
    """
    form = upper_key("Form")
    rows = filings.select(
        ticker("Ticker").alias("Ticker"), empty().alias("Country"),
        (form != "").alias("any"), starts_any(form, R.CORE_FORMS).alias("core"),
        starts_any(form, R.FOREIGN_ANNUAL_FORMS).alias("annual"),
        starts_any(form, R.FOREIGN_INTERIM_FORMS).alias("interim"),
    )
    if profiles is not None:
        no = F.lit(False)
        rows = rows.unionByName(profiles.select(
            ticker("Ticker").alias("Ticker"), country("Country").alias("Country"),
            no.alias("any"), no.alias("core"), no.alias("annual"), no.alias("interim")))
    flags = rows.where(F.col("Ticker") != "").groupBy("Ticker").agg(
        F.max("Country").alias("Country"),
        *[F.bool_or(c).alias(c) for c in ("any", "core", "annual", "interim")])
    passed = F.col("core") | (F.col("annual") & F.col("interim"))
    reason = (
        F.when(passed, "").when(~F.col("any"), "no filings in lookback window")
        .when(F.col("annual"), "missing 6-K alongside annual FPI filing")
        .when(F.col("interim"), "missing 20-F/40-F alongside 6-K")
        .otherwise("no qualifying core filing forms")
    )
    return flags.select("Ticker", "Country", passed.alias("Eligible"), reason.alias("Reason"))


def eligible_tickers(gate: DataFrame) -> DataFrame:
    return gate.where("Eligible").select("Ticker")


def keep_eligible(df: DataFrame, gate: DataFrame) -> DataFrame:
    """Rows whose normalised ticker passed the coverage gate."""
    return df.withColumn("Ticker", ticker("Ticker")).join(eligible_tickers(gate), "Ticker", "left_semi")


def drop_details(filings: DataFrame, gate: DataFrame, ordinal: str, note_columns: Sequence[str] = ()) -> DataFrame:
    """Why a ticker was dropped: up to five forms, five links and three notes.

    Each list is cut to its reported length by a ranked window over distinct
    values before it is collected.
    """
    dropped = gate.where(~F.col("Eligible")).select("Ticker", "Reason", "Country")
    rows = filings.withColumn("Ticker", ticker("Ticker")).join(dropped.select("Ticker"), "Ticker", "left_semi")

    forms = rows.select("Ticker", strip(F.coalesce("Form", empty())).alias("Form")).where("Form != ''").distinct()
    forms = top_rows(forms, ["Ticker"], [F.asc("Form")], 5).groupBy("Ticker").agg(
        F.array_sort(F.collect_list("Form")).alias("Forms"))

    links = rows.select("Ticker", strip(F.coalesce("URL", empty())).alias("URL"), ordinal).where("URL != ''")
    links = links.groupBy("Ticker", "URL").agg(F.min(ordinal).alias("o"))
    links = top_rows(links, ["Ticker"], [F.asc("o")], 5).groupBy("Ticker").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("o", "URL"))), lambda x: x["URL"]).alias("URLs"))

    missing = F.when(upper_key("Form") == "", "missing form code")
    pairs = [F.struct(F.lit("FormStatus").alias("c"), missing.alias("v"))]
    pairs += [F.struct(F.lit(c).alias("c"), detail_text(c).alias("v")) for c in note_columns]
    notes = rows.select("Ticker", F.inline(F.array(*pairs))).where("v IS NOT NULL").distinct()
    size = notes.groupBy("Ticker", "c").agg(F.count("*").alias("n"))
    notes = top_rows(notes, ["Ticker", "c"], [F.asc("v")], 2).groupBy("Ticker", "c").agg(
        F.array_join(F.array_sort(F.collect_list("v")), "; ").alias("v"))
    more = F.when(F.col("n") > 2, F.concat(F.lit(" (+"), F.col("n") - 2, F.lit(" more)"))).otherwise("")
    notes = notes.join(size, ["Ticker", "c"]).select("Ticker", F.concat("c", F.lit("="), "v", more).alias("note"))
    notes = top_rows(notes, ["Ticker"], [F.asc("note")], 3).groupBy("Ticker").agg(
        F.array_sort(F.collect_list("note")).alias("Notes"))

    out = dropped.join(forms, "Ticker", "left").join(links, "Ticker", "left").join(notes, "Ticker", "left")
    none = F.array().cast("array<string>")
    return out.withColumns({c: F.coalesce(F.col(c), none) for c in ("Forms", "URLs", "Notes")})


def _shown(values: Column, limit: int) -> Column:
    more = F.when(F.size(values) > limit, F.concat(F.lit(" (+"), F.size(values) - limit, F.lit(" more)"))).otherwise("")
    return F.when(F.size(values) == 0, "none").otherwise(
        F.concat(F.array_join(F.slice(values, 1, limit), ", "), more))


def drop_message() -> Column:
    """One-line explanation of a row of :func:`drop_details`."""
    def part(name: str, values: str, limit: int) -> Column:
        return F.when(F.size(values) > 0, F.concat(F.lit(f"{name}="), _shown(F.col(values), limit)))

    return F.concat_ws(
        "; ", F.coalesce(blank_to_null("Reason"), F.lit("filtered out by runway gate")),
        F.when(F.col("Country") != "", F.concat(F.lit("country="), "Country")),
        F.concat(F.lit("forms="), _shown(F.col("Forms"), 4)),
        part("url", "URLs", 1), part("notes", "Notes", 2))


# ---------------------------------------------------------------- key repair

def fill_ticker(filings: DataFrame, profiles: DataFrame, ordinal: str) -> DataFrame:
    """Blank tickers from the first profile of the CIK."""
    known = profiles.select(cik_raw("CIK").alias("CIK"), ticker("Ticker").alias("Ticker"), ordinal)
    known = first_per_key(known.where("CIK != '' AND Ticker != ''"), ["CIK"], ordinal)
    keyed = filings.withColumns({"Ticker": ticker("Ticker"), "CIK": cik_raw("CIK")})
    return fill_missing(keyed, known, "CIK", ["Ticker"]).withColumn("Ticker", F.coalesce("Ticker", empty()))


def fill_company(filings: DataFrame, profiles: DataFrame, ordinal: str) -> DataFrame:
    """Blank companies from the last named profile of the ticker, then of the CIK."""
    named = profiles.select(
        ticker("Ticker").alias("Ticker"), cik_raw("CIK").alias("CIK"), strip("Company").alias("Company"), ordinal)
    named = named.where("Company != ''")
    out = filings.withColumns({"Ticker": ticker("Ticker"), "CIK": cik_raw("CIK")})
    for key in ("Ticker", "CIK"):
        lookup = last_per_key(named.where(F.col(key) != ""), [key], ordinal)
        out = fill_missing(out, lookup, key, ["Company"])
    return out.withColumn("Company", F.coalesce("Company", empty()))


def with_age(filings: DataFrame, as_of: AsOf) -> DataFrame:
    return filings.withColumn("Age", age_days(as_of, "FiledAt"))


# ---------------------------------------------------------------- evidence and hydration

def latest_per_cik(df: DataFrame, date: str, ordinal: str, undated: str = "last") -> DataFrame:
    """Newest row per CIK; equal dates go to the later input row.

    ``undated='win'`` lets rows without a date win, ``'last'`` ranks them last.
    """
    newest = F.desc_nulls_first(date) if undated == "win" else F.desc_nulls_last(date)
    return top_rows(df, ["CIK"], [newest, F.desc(ordinal)])


def filing_line(filings: DataFrame) -> Column:
    """``date | form | url | description`` with empty pieces left out; '' when nothing but a description exists."""
    pieces = [blank_to_null(iso("FiledAt")), blank_to_null(strip("Form")), blank_to_null(strip("URL"))]
    base = F.concat_ws(" | ", *pieces)
    note = blank_to_null(strip("Desc")) if "Desc" in filings.columns else F.lit(None).cast("string")
    return F.when(base == "", "").otherwise(F.concat_ws(" | ", base, note))


def fda_line(pieces: Sequence[str] = ("EventType", "Product", "URL")) -> Column:
    return F.concat_ws(" | ", blank_to_null(iso("DecisionDate")), *[blank_to_null(strip(p)) for p in pieces])


def evidence_lines(df: DataFrame, line: Column, date: str, url: str, ordinal: str, summary: str, links: str,
                   every_link: bool = False) -> DataFrame:
    """``(CIK, Cell, Day, Seq, Text, Form)``: evidence as a long table, one row per line and per distinct link.

    `Cell` names the cell that a row is printed in. A link stands where it is seen first, newest day first. One pass: a
    window per (CIK, link) marks the first row of each link.

    ``every_link`` leaves a link at all its places, for callers that look for first places themselves: nothing is
    shuffled, and a caller that reads one cell computes no other.
    """
    rows = df.where(F.col("CIK").isNotNull()).select(
        "CIK", F.col(date).alias("Day"), F.col(ordinal).alias("Seq"), line.alias("__line"), strip(F.col(url)).alias("__url"),
        (upper_key("Form") if "Form" in df.columns else empty()).alias("Form"))
    if every_link:
        cells = [evaluate_once(rows.select("CIK", F.lit(c).alias("Cell"), F.col(t).alias("Text"), "Day", "Seq", "Form"), "Text")
                 for c, t in ((summary, "__line"), (links, "__url"))]
        return cells[0].unionByName(cells[1]).where(F.coalesce("Text", empty()) != "")
    # rows without a link need not meet each other
    apart = F.when(F.coalesce("__url", empty()) == "", F.col("Seq"))
    first = Window.partitionBy("CIK", "__url", apart).orderBy(F.desc_nulls_last("Day"), F.asc("Seq"))
    rows = rows.withColumn("__first", (F.row_number().over(first) == 1) & (F.col("__url") != ""))
    both = F.array(F.struct(F.lit(summary).alias("Cell"), F.col("__line").alias("Text")),
                   F.struct(F.lit(links).alias("Cell"), F.when(F.col("__first"), F.col("__url")).alias("Text")))
    return rows.select("CIK", F.inline(both), "Day", "Seq", "Form").where(F.coalesce("Text", empty()) != "")


FILING_CELLS = ("FilingsSummary", "FilingURLsAll")
FDA_CELLS = ("FDA_Summary", "FDA_URLsAll")


def company_evidence(filings: DataFrame, fda: DataFrame | None = None, ordinal: str = "ord", every_link: bool = False) -> DataFrame:
    """:func:`evidence_lines` of filings and clearances."""
    rows = evidence_lines(filings, filing_line(filings), "FiledAt", "URL", ordinal, *FILING_CELLS, every_link)
    if fda is not None:
        rows = rows.unionByName(evidence_lines(fda, fda_line(), "DecisionDate", "URL", ordinal, *FDA_CELLS, every_link))
    return rows


def hydrate_core(profiles: DataFrame, latest_prices: DataFrame, filings: DataFrame, fda: DataFrame | None = None,
                 ordinal: str = "ord", undated: str = "last") -> DataFrame:
    """One row per ticker: profile, latest price, filing and clearance. All gates decide on these columns."""
    out = profiles.withColumns({"Ticker": strip("Ticker"), "CIK": cik_raw("CIK")}).where("Ticker != ''")
    out = out.join(latest_prices, "Ticker", "left")
    last = latest_per_cik(filings, "FiledAt", ordinal, undated).select(
        "CIK", F.col("Form").alias("LatestForm"), "FiledAt", F.col("URL").alias("FilingURL"))
    out = out.join(last, "CIK", "left")
    if fda is None:
        out = out.withColumns({c: F.lit(None).cast("string") for c in ("FDA_EventType", "FDA_URL")})
        out = out.withColumn("FDA_Date", F.lit(None).cast("date"))
    else:
        event = latest_per_cik(fda, "DecisionDate", ordinal, undated).select(
            "CIK", F.col("EventType").alias("FDA_EventType"), F.col("DecisionDate").alias("FDA_Date"),
            F.col("URL").alias("FDA_URL"))
        out = out.join(event, "CIK", "left")
    return out.select(
        "Ticker", "Company", "Sector", "CIK", "MarketCap", "PriceDate", "Close", "ADV20", "LatestForm", "FiledAt", "FilingURL",
        "FDA_EventType", "FDA_Date", "FDA_URL")


def hydrate(profiles: DataFrame, latest_prices: DataFrame, filings: DataFrame, fda: DataFrame | None = None,
            ordinal: str = "ord", undated: str = "last", lines_per_part: int | None = None) -> DataFrame:
    """:func:`hydrate_core` with the evidence cells: one row per ticker and evidence part.

    Nearly every ticker has the single part 0. See :func:`keyed.text_parts`.
    """
    core = hydrate_core(profiles, latest_prices, filings, fda, ordinal, undated)
    return with_evidence(core, company_evidence(filings, fda, ordinal), lines_per_part)


def with_evidence(core: DataFrame, lines: DataFrame, lines_per_part: int | None = None) -> DataFrame:
    """The printed form of hydrated rows: evidence cells beside every row, in parts."""
    stored = stored_once(lines, "evidence-lines")
    cells = cells_by_part(stored, ["CIK"], "Cell", (*FILING_CELLS, *FDA_CELLS), "Seq", "Text", "Day", lines_per_part)
    out = core.join(cells, "CIK", "left").withColumn("EvidencePart", F.coalesce("EvidencePart", F.lit(0)))
    return out.select(
        "Ticker", "EvidencePart", "Company", "Sector", "CIK", "MarketCap", "PriceDate", "Close", "ADV20",
        "LatestForm", "FiledAt", "FilingURL", "FilingsSummary", "FilingURLsAll",
        "FDA_EventType", "FDA_Date", "FDA_URL", "FDA_Summary", "FDA_URLsAll")


# ---------------------------------------------------------------- one filing table per form family

def for_forms(filings: DataFrame, targets: Sequence[str], form: str = "Form") -> DataFrame:
    """Filings whose form starts with a target, blanks ignored."""
    name = upper_key(form)
    squashed = [t.replace(" ", "") for t in targets]
    return filings.where(starts_any(name, targets) | starts_any(F.replace(name, F.lit(" "), F.lit("")), squashed))


def normalise_cik(df: DataFrame) -> DataFrame:
    return df.withColumn("CIK", cik("CIK"))
