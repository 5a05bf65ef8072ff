"""Evidence cells: parse entries, pick the primary one, format, dilution and governance verdicts.

An evidence cell is a text of entries separated by ';' or line ends. Everything
here is row-local: entries are an array of structs inside the row, so no
operator of this module shuffles.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from capsieve import rules as R
from capsieve.functions.dates import age_days, iso, parse_date
from capsieve.functions.forms import is_dilution_only_form, is_manager_form
from capsieve.functions.text import (
    clean_text, col, contains_any, empty, first_url, once, squeeze, starts_any, string_array, strip, urls_in,
)
from capsieve.functions.urls import url_matches_form


# ---------------------------------------------------------------- entries

def entries(cell: Column | str) -> Column:
    """``array<struct(raw, date, form, url, lower)>`` of an evidence cell.

    The date is the first ISO date of the entry, else its leading token when
    that reads as a date. The form is what follows the date, up to a bar or link.
    """
    def parse(raw: Column) -> Column:
        day = F.regexp_extract(raw, r"(20\d{2}-\d{2}-\d{2})", 1)
        after = F.regexp_extract(raw, r"(?s)20\d{2}-\d{2}-\d{2}[ |]*(.*)$", 1)
        rest = once(after, lambda a: F.when(a != "", a).otherwise(raw))
        head = strip(F.regexp_replace(strip(F.regexp_extract(rest, r"^([^|]*)", 1)), "(?is)http.*$", ""))
        return once(head, lambda h: F.struct(
            raw.alias("raw"), F.coalesce(day.try_cast("date"), parse_date(F.regexp_extract(h, r"^(\S+)", 1))).alias("date"),
            squeeze(F.upper(F.regexp_extract(h, r"^([A-Za-z0-9./-]+(?:\s+[A-Za-z0-9.-]+)?)", 1))).alias("form"),
            first_url(raw).alias("url"), F.lower(raw).alias("lower")))

    pieces = F.filter(F.transform(F.split(F.coalesce(col(cell), empty()), r"[;\n]+"), strip), lambda x: x != "")
    return F.transform(pieces, parse)


def without_manager_forms(items: Column) -> Column:
    return F.filter(items, lambda e: ~is_manager_form(e["form"]))


def without_dilution_only_forms(items: Column) -> Column:
    return F.filter(items, lambda e: ~is_dilution_only_form(e["form"]))


def primary_entry(items: Column) -> Column:
    """Newest dated entry, one with a link before one without, the earlier on a tie."""
    ranked = F.transform(items, lambda e, i: F.struct(
        e["date"].isNotNull().cast("int").alias("dated"), e["date"].alias("date"),
        (e["url"] != "").cast("int").alias("linked"), (-i).alias("place"), e.alias("entry")))
    # the whole key is decided before "entry" is ever compared
    return F.array_max(ranked)["entry"]


def is_complete(e: Column) -> Column:
    return e["date"].isNotNull() & (e["form"] != "") & (strip(e["url"]) != "")


def entry_core(e: Column) -> Column:
    return F.concat_ws(" ", iso(e["date"]), e["form"], e["url"])


def entry_text(e: Column) -> Column:
    """``date form link [description]`` of a complete entry, else ''."""
    at = F.call_function("instr", e["raw"], e["url"])
    after = F.substr(e["raw"], at + F.length(e["url"]))
    note = squeeze(F.regexp_replace(after, r"^[ |]+|[ |]+$", ""))
    full = F.when(note != "", F.concat_ws(" ", entry_core(e), note)).otherwise(entry_core(e))
    return F.when(is_complete(e), full).otherwise("")


def format_entries(items: Column) -> Column:
    """Complete entries, first of each (date, form, link), joined by '; '. Equal ones meet by sorting, not in pairs."""
    keyed = F.array_sort(F.transform(F.filter(items, is_complete), lambda e, i: F.struct(entry_core(e).alias("core"), i.alias("i"), entry_text(e).alias("text"))))

    def firsts(s: Column) -> Column:
        return F.filter(s, lambda x, j: (j == 0) | (F.get(s, j - 1)["core"] != x["core"]))

    # a single-element array lets the sorted list be computed once
    kept = F.element_at(F.transform(F.array(keyed), firsts), 1)
    placed = F.array_sort(F.transform(kept, lambda x: F.struct(x["i"].alias("i"), x["text"].alias("text"))))
    return F.array_join(F.transform(placed, lambda x: x["text"]), "; ")


# ---------------------------------------------------------------- summaries

def summary_of(entry: Column, as_of: object) -> Column:
    """Status, form, date, age, link and text of a primary entry (null -> 'Missing' and blanks)."""
    def text(c: Column) -> Column:
        return F.when(entry.isNotNull(), c).otherwise("")

    return F.struct(
        F.when(entry.isNotNull(), "Pass").otherwise("Missing").alias("status"),
        text(entry["form"]).alias("form"), text(iso(entry["date"])).alias("date"),
        text(F.coalesce(age_days(as_of, entry["date"]).cast("string"), empty())).alias("days_ago"),
        text(entry["url"]).alias("url"), text(entry_text(entry)).alias("text"), text(entry["raw"]).alias("raw"))


def guarded_entry(items: Column) -> Column:
    """Primary entry, replaced by the first consistent one when its link does not fit its form."""
    fits = F.filter(items, lambda e: (e["form"] != "") & (e["url"] != "") & url_matches_form(e["form"], e["url"]))

    def guarded(best: Column) -> Column:
        bad = (best["form"] != "") & (best["url"] != "") & ~url_matches_form(best["form"], best["url"])
        return F.when(bad, F.coalesce(F.try_element_at(fits, F.lit(1)), best)).otherwise(best)

    return once(primary_entry(items), guarded)


# ---------------------------------------------------------------- dilution

def dilution_line(raw: Column) -> Column:
    """``struct(form, link, hit)`` of one ``date | form | link`` line."""
    def read(parts: Column, form: Column) -> Column:
        links = F.filter(parts, lambda p: F.lower(p).startswith("http"))
        tokens = F.filter(F.split(F.replace(raw, F.lit("|"), F.lit(" ")), r"\s+"), lambda p: F.lower(p).startswith("http"))
        link = F.coalesce(F.try_element_at(links, F.lit(-1)), F.try_element_at(tokens, F.lit(-1)), empty())
        hit = once(F.upper(form), lambda name: contains_any(name, R.RESEARCH_DILUTION_FORMS) | (
            (name == "8-K") & contains_any(F.lower(raw), R.RESEARCH_DILUTION_WORDS)))
        return F.struct(form.alias("form"), link.alias("link"), hit.alias("hit"))

    return once(F.transform(F.split(raw, r"\|"), strip), lambda parts: once(
        clean_text(F.coalesce(F.try_element_at(parts, F.lit(2)), empty())), lambda form: read(parts, form)))


def dilution_notes(forms: Column) -> Column:
    return F.when(F.size(forms) > 0, F.concat(F.lit("Recent dilution-related filings: "), F.array_join(forms, ", "))).otherwise("")


def research_dilution(cell: Column | str) -> Column:
    """``struct(forms, links, flag, notes)`` from ``date | form | link`` lines."""
    pieces = F.filter(F.transform(F.split(clean_text(cell), r"[;\r\n]+"), strip),
                      lambda x: (x != "") & (F.lower(x) != "nan"))
    hits = F.filter(F.transform(pieces, dilution_line), lambda p: p["hit"])

    def distinct(name: str) -> Column:
        return F.array_distinct(F.filter(F.transform(hits, lambda p: p[name]), lambda x: x != ""))

    forms, links = distinct("form"), distinct("link")
    return F.struct(forms.alias("forms"), links.alias("links"), (F.size(forms) > 0).alias("flag"), dilution_notes(forms).alias("notes"))


def watch_dilution(items: Column) -> Column:
    """``struct(status, flag, forms, keywords)`` from dilution entries.

    An offering form, or an 8-K/6-K with an offering phrase, is a pass; only
    employee-plan forms are an overhang.
    """
    forms = F.array_distinct(F.filter(
        F.transform(items, lambda e: e["form"]), lambda f: (f != "") & starts_any(f, R.WATCH_DILUTION_FORMS)))
    words = string_array(R.WATCH_DILUTION_WORDS)
    found = F.array_distinct(F.flatten(F.transform(
        items, lambda e: F.filter(words, lambda w: F.contains(e["lower"], w)))))
    offering = F.exists(items, lambda e: starts_any(e["form"], R.WATCH_OFFERING_FORMS))
    spoken = F.exists(items, lambda e: starts_any(e["form"], ("8-K", "6-K"))
                      & contains_any(e["lower"], R.WATCH_DILUTION_WORDS))
    plans_only = (F.size(forms) > 0) & F.forall(forms, lambda f: f.startswith("S-8"))
    status = (
        F.when(offering | spoken, "Pass (Offering)").when(plans_only, "Overhang (S-8)")
        .when(F.size(items) > 0, "None").otherwise("Missing")
    )
    return F.struct(status.alias("status"), (offering | spoken | plans_only).alias("flag"),
                    forms.alias("forms"), found.alias("keywords"))


# ---------------------------------------------------------------- small verdicts

def checklist_status(c: Column | str) -> Column:
    """Pass / Missing / Fail from a free-text status."""
    text = F.lower(clean_text(c, ("nan",)))
    return (
        F.when(text == "", "Missing").when(text.startswith("pass") | text.startswith("overhang"), "Pass")
        .when(text.isin("missing", "placeholder", "tbd", "n/a", "na", "not available"), "Missing").otherwise("Fail")
    )


def risk_flag(dilution: Column | str, governance: Column | str) -> Column:
    return (
        F.when(F.lower(col(dilution)).contains("watch"), "Dilution Watch")
        .when(F.lower(col(governance)).contains("watch"), "Governance Watch").otherwise("")
    )


def links_like(cell: Column | str, pattern: str) -> Column:
    """Distinct links of a cell that match a pattern."""
    return F.filter(urls_in(cell), lambda u: u.rlike(pattern))


def count_entries(cell: Column | str) -> Column:
    return F.size(F.filter(F.transform(F.split(F.coalesce(col(cell), empty()), r"[;\n]+"), strip), lambda x: x != ""))


def prefixed(items: Column, prefixes: Sequence[str]) -> Column:
    return F.filter(items, lambda e: starts_any(e["form"], prefixes))
