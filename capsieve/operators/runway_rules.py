"""Cash runway as Column rules: text rule, quarterly burn, final verdict, merge of sources."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from capsieve import rules as R
from capsieve.functions.numbers import simple_number
from capsieve.functions.text import any_of, blank_to_null, col, empty, lookup, strip

MONTHS = (3, 6, 9, 12)


def valid_months(months: Column) -> Column:
    return F.coalesce(months.isin(*MONTHS), F.lit(False))


def text_runway(text: Column | str) -> Column:
    """Quarters of cash from the first two captions of a plain text, two decimals."""
    c = F.coalesce(col(text), empty())
    cash = simple_number(F.regexp_extract(c, r"(?i)cash and cash equivalents[:\s]*\$?([\d,.()-]+)", 1))
    burn = simple_number(F.regexp_extract(c, r"(?i)operating activities[:\s]*\$?([\d,.()-]+)", 1))
    return F.bround(F.try_divide(cash, F.abs(burn)), 2)


def scale_in(text: Column) -> Column:
    """Multiplier named in a text such as '(in thousands)', null without one."""
    word = F.lower(F.regexp_extract(text, R.SCALE_PHRASE, 1))
    return F.when(word.startswith("thousand"), 1_000).when(word.startswith("million"), 1_000_000)


def scale_in_lines(text: Column) -> Column:
    """As :func:`scale_in`, but the phrase must stand on one line."""
    found = F.transform(F.split(text, r"\r?\n"), scale_in)
    return F.try_element_at(F.filter(found, lambda x: x.isNotNull()), F.lit(1))


def months_in_text(text: Column | str) -> Column:
    """Most frequent reporting period of a text; the longer one on a tie; null without any."""
    c = F.coalesce(col(text), empty())
    counts: dict[int, Column] = {}
    for months, pattern in R.PERIOD_PHRASES:
        n = F.regexp_count(c, F.lit(pattern))
        counts[months] = counts[months] + n if months in counts else n
    best = F.greatest(*[F.struct(n.alias("n"), F.lit(m).alias("m")) for m, n in counts.items()])
    return F.when(best["n"] > 0, best["m"])


def months_in_column(label: Column | str) -> Column:
    """Reporting period named by a statement column heading."""
    out = F.lit(None).cast("int")
    for months, pattern in reversed(R.PERIOD_COLUMN_PATTERNS):
        out = F.when(col(label).rlike(pattern), months).otherwise(out)
    return out


def months_of_fact(fp: Column, start: Column, end: Column, default: Column) -> Column:
    """Period of a tagged fact: fiscal-period code, else its dates, else the form default."""
    from capsieve.functions.dates import months_between_dates
    coded = lookup(F.upper(F.coalesce(fp, empty())), R.FISCAL_PERIOD_MONTHS)
    return F.coalesce(coded, months_between_dates(start, end), default)


def quarterly(value: Column, months: Column) -> Column:
    """Cash flow of the period brought to one quarter; other periods stay as they are."""
    return F.when(valid_months(months), value / (months / F.lit(3.0))).otherwise(value)


def quarterly_tag(value: Column, months: Column) -> Column:
    tag = F.when(months == 3, "").when(months == 6, "6m/2").when(months == 9, "9m/3").when(months == 12, "annual/4")
    return F.when(value.isNotNull(), tag)


def estimate_kind(form: Column) -> Column:
    name = F.upper(form)
    annual = any_of(name.startswith(p) for p in ("10-K", "20-F", "40-F"))
    return F.when(F.coalesce(strip(form), empty()) == "", "").when(annual, "annual_div4").otherwise("interim")


def finalize(cash: Column, ocf_raw: Column, months: Column, form: Column, ocf_quarterly: Column | None = None,
             assumption: Column | None = None, note: Column | None = None, units: Column | None = None,
             status: Column | None = None, tags: Column | None = None) -> Column:
    """Runway verdict as one struct.

    No cash flow -> 'Missing OCF'; non-negative -> self-funding with zero burn;
    no cash -> 'Missing cash'; else cash divided by the quarterly burn. A status
    given by the caller is kept; 'OK' without all three inputs is 'Incomplete'.
    """
    null_text = F.lit(None).cast("string")
    flow = ocf_raw if ocf_quarterly is None else F.coalesce(ocf_quarterly, ocf_raw)
    flow = flow.cast("double")
    burn = F.when(flow >= 0, F.lit(0.0)).when(flow < 0, F.abs(flow))
    quarters = F.when(flow < 0, cash.cast("double") / F.when(burn > 0, burn))
    derived = (
        F.when(flow.isNull(), "Missing OCF").when(flow >= 0, "OCF positive (self-funding)")
        .when(cash.isNull(), "Missing cash").otherwise("OK")
    )
    verdict = F.coalesce(blank_to_null(status), derived) if status is not None else derived
    complete = cash.isNotNull() & flow.isNotNull() & valid_months(months)
    verdict = F.when(~complete & (verdict == "OK"), "Incomplete").otherwise(verdict)
    return F.struct(
        cash.cast("double").alias("cash_raw"), ocf_raw.cast("double").alias("ocf_raw"),
        flow.alias("ocf_quarterly_raw"), burn.alias("quarterly_burn_raw"), quarters.alias("runway_quarters_raw"),
        F.bround(quarters, 2).alias("runway_quarters_display"), F.bround(quarters * 3, 2).alias("runway_months_display"),
        F.coalesce(note if note is not None else null_text, empty()).alias("note"),
        estimate_kind(form).alias("estimate"), verdict.alias("status"),
        F.coalesce(assumption if assumption is not None else null_text, empty()).alias("assumption"),
        months.cast("int").alias("period_months"),
        F.coalesce(units if units is not None else F.lit(None).cast("bigint"), F.lit(1)).cast("bigint").alias("units_scale"),
        F.round(cash.cast("double"), 2).alias("cash"), F.round(burn, 2).alias("quarterly_burn"),
        F.round(quarters, 2).alias("runway_quarters"), form.alias("form_type"), complete.alias("complete"),
        (F.array_distinct(F.array_compact(tags)) if tags is not None else F.array().cast("array<string>")).alias("source_tags"),
    )


def bucket(quarters: Column) -> Column:
    return (
        F.when(quarters.isNull(), "").when(quarters < 1, "<1q").when(quarters < 3, "1-3q").when(quarters < 6, "3-6q")
        .when(quarters < 12, "6-12q").otherwise(">12q")
    )


def runway_days(quarters: Column) -> Column:
    return F.bround(quarters * 90, 0).cast("int")


def merge_sources(html: Column, xbrl: Column, form: Column, default_months: Column, url: Column,
                  error: Column | None = None, exhibit: Column | None = None) -> Column:
    """One verdict from a parsed statement and tagged facts.

    ``html`` has cash, ocf, months, units, evidence; ``xbrl`` is a verdict of
    :func:`finalize`; ``exhibit`` (status, href, doc_type) is set when the
    statement came from an exhibit. Cash prefers the statement, the cash flow
    prefers the facts, and a complete fact verdict is returned unchanged.
    """
    hc, ho, hm = html["cash"].cast("double"), html["ocf"].cast("double"), html["months"]
    cash = F.coalesce(hc, xbrl["cash_raw"])
    use_x = xbrl["ocf_quarterly_raw"].isNotNull() & xbrl["ocf_raw"].isNotNull()
    use_h = ~use_x & ho.isNotNull()
    xm = F.when(valid_months(xbrl["period_months"]), xbrl["period_months"])
    valid_h = F.when(valid_months(hm), hm)
    months = F.coalesce(xm, valid_h, F.when(valid_months(default_months), default_months))
    months = F.when(use_h & valid_h.isNotNull(), valid_h).otherwise(months)
    cash_x, cash_h = hc.isNull() & xbrl["cash_raw"].isNotNull(), hc.isNotNull()
    used_x = cash_x | use_x | F.coalesce(months == xm, F.lit(False))
    used_h = cash_h | use_h | F.coalesce(months == valid_h, F.lit(False))
    h_units = F.when(cash_h | use_h, F.coalesce(html["units"], F.lit(1)).cast("bigint"))
    x_units = F.when(cash_x | use_x, xbrl["units_scale"])
    units = F.coalesce(F.when(h_units != 1, h_units), F.when(x_units != 1, x_units), F.lit(1))
    head = (
        F.when(used_x & used_h, "values parsed from XBRL and HTML (merged): ")
        .when(used_x, "values parsed from XBRL: ").otherwise("values parsed from filing HTML: ")
    )
    pieces = [F.concat(head, url), F.when(used_h, blank_to_null(html["evidence"]))]
    if exhibit is not None:
        pieces.append(F.when(exhibit["href"].isNotNull(), F.concat(
            F.lit("exhibit source: "), F.concat_ws(" ", blank_to_null(exhibit["doc_type"]), exhibit["href"]))))
    tail = F.regexp_replace(xbrl["note"], r"(?i)^values parsed from XBRL[^:]*:", "")
    pieces.append(F.when(xbrl.isNotNull(), blank_to_null(strip(F.replace(tail, url, F.lit(""))))))
    if error is not None:
        pieces.append(F.when(xbrl.isNull(), error))
    merged = finalize(
        cash, F.when(use_x, xbrl["ocf_raw"]).when(use_h, ho), months, form,
        F.when(use_x, xbrl["ocf_quarterly_raw"]).when(use_h, quarterly(ho, hm)),
        F.when(use_x, xbrl["assumption"]).when(use_h, quarterly_tag(ho, hm)).otherwise(xbrl["assumption"]),
        F.concat_ws("; ", *pieces), units, exhibit["status"] if exhibit is not None else None,
        F.array(F.when(used_x, "XBRL"), F.when(used_h, "HTML")))
    return F.when(F.coalesce(xbrl["complete"], F.lit(False)), xbrl).otherwise(merged)


def needs_exhibit(form: Column, cash: Column, ocf: Column, months: Column, header: Column) -> Column:
    """Annual foreign forms look for an exhibit when anything is missing, others only when all is."""
    some = cash.isNull() | ocf.isNull() | ~valid_months(months) | ~F.coalesce(header, F.lit(False))
    every = cash.isNull() & ocf.isNull() & ~F.coalesce(header, F.lit(False))
    return F.when(form.isin("20-F", "40-F"), some).otherwise(every)


def needs_review(result: Column) -> Column:
    """Rows for the review log: no cash flow, incomplete, or a status that is no success."""
    status = F.upper(strip(F.coalesce(result["status"], empty())))
    failed = (status != "") & ~status.startswith("OK") & (status != "OCF POSITIVE (SELF-FUNDING)")
    no_flow = result["ocf_raw"].isNull() & result["ocf_quarterly_raw"].isNull()
    return no_flow | ~F.coalesce(result["complete"], F.lit(False)) | failed
