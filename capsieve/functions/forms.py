"""Filing form names as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from capsieve import rules as R
from capsieve.functions.text import empty, clean_text, col, lookup, once, squeeze, starts_any, upper_key


def form_in_text(c: Column | str) -> Column:
    """First form named in a text or link, in canonical spelling; null when none is."""
    found = F.upper(F.regexp_extract(F.coalesce(col(c), empty()), R.FORM_IN_TEXT, 1))

    def spelled(name: Column) -> Column:
        compact = F.regexp_replace(F.regexp_replace(F.regexp_replace(name, r"[\sX/_-]", ""), "QT", "Q"), "KT", "K")
        return F.when(name != "", once(compact, lambda short: lookup(short, R.FORM_TEXT_NAMES, short)))

    return once(found, spelled)


def canonical_form(c: Column | str) -> Column:
    """Periodic-report family of a form: amendments and transition reports folded in."""
    name = F.regexp_replace(upper_key(c), "/A$", "")
    return (
        F.when(name.startswith("10-Q"), "10-Q").when(name.startswith("10-K"), "10-K")
        .when(name.startswith("20-F"), "20-F").when(name.startswith("40-F"), "40-F")
        .when(name.startswith("6-K"), "6-K").otherwise(name)
    )


def form_priority(canonical: Column) -> Column:
    return (
        F.when(canonical == "10-Q", 0).when(canonical == "10-K", 1)
        .when(canonical.isin("20-F", "40-F"), 2).when(canonical == "6-K", 3).otherwise(9)
    )


def form_name(c: Column | str) -> Column:
    return squeeze(F.upper(clean_text(c, ("nan",))))


def form_key(c: Column | str) -> Column:
    """Letters and digits only, without a leading 'FORM' and a trailing '/A'."""
    name = F.regexp_replace(F.coalesce(col(c), empty()), r"(?i)^\s*(?:FORM\s+|nan\s*$)|\s*/\s*A\s*$", "")
    return F.lower(F.regexp_replace(name, "[^A-Za-z0-9]", ""))


def progress_form(c: Column | str) -> Column:
    """Label under which the progress counters file a form."""
    name = F.regexp_replace(upper_key(c), "/A$", "")
    digit = F.regexp_extract(name, r"^FORM\s*([345])$", 1)
    out = F.when(name.isin("", "UNKNOWN"), "Unknown").when(digit != "", F.concat(F.lit("FORM "), digit))
    for prefix, label in R.PROGRESS_FORMS:
        out = out.when(name.startswith(prefix), label)
    return out.otherwise(name)


def default_months(canonical: Column) -> Column:
    return lookup(canonical, R.FORM_FAMILY_MONTHS)


def form_family(canonical: Column) -> Column:
    return lookup(canonical, R.FORM_FAMILY)


def is_manager_form(c: Column | str) -> Column:
    return starts_any(F.upper(F.ltrim(col(c))), R.MANAGER_FORMS)


def is_dilution_only_form(c: Column | str) -> Column:
    return form_key(c).isin(*R.CATALYST_GUARDED_FORMS)
