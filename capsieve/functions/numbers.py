"""Numbers printed in financial statements."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from capsieve import rules as R
from capsieve.functions.text import col, empty, once


def _quote(marker: str) -> str:
    return "".join("\\" + ch if ch in "$." else ch for ch in marker)


_MARKERS = "|".join(_quote(m) for m in sorted(R.CURRENCY_MARKERS, key=len, reverse=True))
_RUN = r"\d[\d,. '’]*"
_NUMBER = rf"(?i)[(\[]*(?:(?:{_MARKERS})\s*)?[-+]?{_RUN}(?:\s*(?:{_MARKERS}))?[)\]]?"
_MINUS = rf"(?i)\(.*\)|^[(\[]*(?:(?:{_MARKERS})\s*)?-"
_PLAIN = r"^\d+(?:\.\d{1,2})?$"
_GROUPED = r"^\d{1,3}(?:[ ,.'’]\d{3})+"


def parse_number(c: Column | str) -> Column:
    """First number of a token as a double, null when there is none.

    Parentheses or a minus sign (ASCII or U+2212) make it negative. Grouped
    thousands may use any of blank, comma, dot or apostrophe. Without groups a
    single comma followed by one to three digits is a decimal comma.
    """
    text = F.translate(F.coalesce(col(c).cast("string"), empty()), "\u2212\u00a0\u202f\u2009\u2007\u205f", "-     ")
    # most tokens of a text have no digit and need no pattern
    found = once(text, lambda t: F.when(t.rlike("[0-9]"), F.regexp_extract(t, _NUMBER, 0)))
    return once(found, lambda f: F.when(f.isNotNull(), once(F.rtrim(F.regexp_extract(f, _RUN, 0)), lambda run: _value(f, run))))


def _value(found: Column, run: Column) -> Column:
    tight = F.regexp_replace(run, "[ '’]", "")

    def only(mark: str) -> Column:
        """Digits with the first ``mark`` as the decimal point."""
        kept = F.regexp_replace(run, f"[^0-9{mark}]", "")
        return F.replace(F.regexp_replace(kept, rf"^([0-9]*)[{mark}]", "$1."), F.lit(","), empty())

    value = (
        F.when(run.rlike(_PLAIN), run)
        .when(run.rlike(_GROUPED + "$"), F.regexp_replace(run, "[^0-9]", ""))
        .when(run.rlike(_GROUPED + r",\d+$"), only(","))
        .when(run.rlike(_GROUPED + r"\.\d+$"), F.regexp_replace(run, "[^0-9.]", ""))
        # both marks: the later one is the decimal point
        .when(run.rlike(r",.*\.[^,]*$"), F.replace(tight, F.lit(","), empty()))
        .when(run.rlike(r"\..*,[^.]*$"), F.translate(tight, ",.", "."))
        .when(run.rlike(r"^[^,]*,[ '’]*(?:\d[ '’]*){1,3}$"), F.replace(tight, F.lit(","), F.lit(".")))
        .when(run.contains(","), F.replace(tight, F.lit(","), empty()))
        .otherwise(_merge_dots(tight))
    ).try_cast("double")
    return once(value, lambda v: F.when(found.rlike(_MINUS), -v).otherwise(v))


def _merge_dots(tight: Column) -> Column:
    """With several dots the digits are joined and a point is set at the position of the last dot."""
    dots = tight.rlike(r"\..*\.")
    digits = F.replace(tight, F.lit("."), empty())
    at = F.length(tight) - F.length(F.substring_index(tight, ".", -1)) - F.lit(1)
    return F.when(dots, F.concat(F.substr(digits, F.lit(1), at), F.lit("."), F.substr(digits, at + F.lit(1)))).otherwise(tight)


def simple_number(c: Column | str) -> Column:
    """Number of the plain-text runway rule: drop commas, '(' means minus."""
    text = F.translate(F.coalesce(col(c), empty()), ",()", "\u0001-\u0002")
    text = F.regexp_replace(text, "[\u0001\u0002]", "")
    return F.regexp_extract(text, r"-?\d+(?:\.\d+)?", 0).try_cast("double")


def statement_number(c: Column | str) -> Column:
    """Cell of a rendered statement: thousands commas and full parentheses only."""
    text = F.replace(F.trim(F.coalesce(col(c).cast("string"), empty())), F.lit(","), F.lit(""))
    text = F.regexp_replace(text, r"^\((.*)\)$", "-$1")
    return text.try_cast("double")


def half_up(c: Column | str, digits: int = 2) -> Column:
    return F.round(col(c), digits)


def display_number(c: Column | str) -> Column:
    """Two decimals for reports, '' for null."""
    return F.when(col(c).isNotNull(), F.format_string("%.2f", F.round(col(c), 2))).otherwise("")


def raw_number(c: Column | str) -> Column:
    """Six decimals for machine-read report columns, '' for null."""
    return F.when(col(c).isNotNull(), F.format_string("%.6f", col(c))).otherwise("")


def ratio(a: Column, b: Column) -> Column:
    return F.when(b != 0, a / b)
