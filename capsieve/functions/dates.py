"""Dates and ages."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from capsieve.functions.text import col, empty, once, strip


def as_date(as_of: dt.date | str | Column) -> Column:
    """The run date as a Column; the library never reads the clock."""
    return as_of if isinstance(as_of, Column) else F.lit(str(as_of)).cast("date")


def parse_date(c: Column | str) -> Column:
    """Day of a date text: ISO, ISO with a time, else day-first; null when unreadable."""
    return once(strip(F.coalesce(col(c).cast("string"), empty())), lambda text: F.when(text.rlike("^[0-9]"), _read_date(text)))


def _read_date(text: Column) -> Column:
    iso_day = F.regexp_extract(text, r"^(\d{4}-\d{2}-\d{2})(?:[ T]\d{2}:\d{2}(?::\d{2}(?:\.\d+)?)?Z?)?$", 1)
    # only texts of the right shape reach a parser: a failed parse is costly
    day_first = F.translate(F.regexp_extract(text, r"^(\d{1,2}[/.-]\d{1,2}[/.-]\d{4})$", 1), ".-", "//")
    year_first = F.regexp_extract(text, r"^(\d{4}/\d{1,2}/\d{1,2})$", 1)
    named = F.regexp_extract(text, r"^(\d{1,2} [A-Za-z]{3} \d{4})$", 1)

    def read(shaped: Column, pattern: str) -> Column:
        return once(shaped, lambda s: F.when(s != "", F.to_date(F.try_to_timestamp(s, F.lit(pattern)))))

    return F.coalesce(
        iso_day.try_cast("date"), read(day_first, "d/M/yyyy"), read(year_first, "yyyy/M/d"),
        read(named, "d MMM yyyy"))


def age_days(as_of: dt.date | str | Column, c: Column | str) -> Column:
    """Whole days from the date to the run date, null without a date."""
    return F.datediff(as_date(as_of), col(c))


def iso(c: Column | str) -> Column:
    """ISO text of a date, '' for null."""
    return F.coalesce(col(c).cast("date").cast("string"), F.lit(""))


def is_iso(c: Column | str) -> Column:
    return F.coalesce(col(c).rlike(r"^\d{4}-\d{2}-\d{2}$"), F.lit(False))


def months_between_dates(start: Column, end: Column) -> Column:
    """Months covered by a period, snapped to 3/6/9/12 within one month."""
    days = F.datediff(end, start)
    months = F.bround(days / F.lit(30.4375), 0).cast("int")
    snapped = F.when(months.between(2, 4), 3).when(months.between(5, 7), 6)
    snapped = snapped.when(months.between(8, 10), 9).when(months.between(11, 13), 12).otherwise(months)
    return F.when(days > 0, snapped)
