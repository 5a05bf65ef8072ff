"""Runway jobs over tables: tagged facts, rendered statements, exhibits, per-company choice."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from capsieve import rules as R
from capsieve.functions.dates import age_days, iso
from capsieve.functions.forms import canonical_form, default_months, form_in_text, form_priority
from capsieve.functions.numbers import display_number, raw_number, statement_number
from capsieve.functions.text import (
    blank_to_null, cik, contains_any, empty, first_nonblank, starts_any, strip_tags,
    unescape_entities, upper_key,
)
from capsieve.functions.urls import filing_ids, form_from_url, is_image, path, url_names_form, with_scheme
from capsieve.operators.keyed import evaluate_once, spread, text_parts, top_rows
from capsieve.operators.runway_rules import (
    finalize, months_in_column, months_of_fact, quarterly, quarterly_tag, text_runway, valid_months,
)
from capsieve.operators.statements import CELL, ROW, parse_statements
from capsieve.session import stored_once

AsOf = dt.date | str | Column


# ---------------------------------------------------------------- tagged facts

def rank_in(value: Column, names: Sequence[str]) -> Column:
    """Position of a value in a fixed list, null when it is not in it."""
    out = F.lit(None).cast("int")
    for i, name in reversed(list(enumerate(names))):
        out = F.when(value == name, i).otherwise(out)
    return out


def best_facts(filings: DataFrame, facts: DataFrame, groups: dict[str, Sequence[str]], ordinal: str = "ord") -> DataFrame:
    """``(URL, one column per group)``: for each filing and group of concepts the fact of the first reported concept.

    Facts: CIK, Taxonomy, Concept, Unit, Val, Accn, Start, End, Fy, Fp, Form and an
    ordinal. Concept, taxonomy and unit are chosen per company. Among those facts
    the one of the filing's own accession wins, then the latest end date and
    fiscal year.

    Facts are read once. A key that ranks the choice first and the place after it
    makes both questions one maximum per (company, accession), for all groups at
    once: the company's best fact is the greatest of these, and an accession
    has facts of the company's choice exactly if its own greatest has that choice.
    """
    taxonomy = F.coalesce(rank_in(F.col("Taxonomy"), ["us-gaap", "ifrs-full"]), F.lit(9))
    unit = F.coalesce(rank_in(F.col("Unit"), R.PREFERRED_UNITS), F.lit(99))
    place = [F.coalesce("End", F.lit("0001-01-01").cast("date")).alias("e"), F.coalesce("Fy", F.lit(0)).alias("f"), (-F.col(ordinal)).alias("o")]
    payload = F.struct("Val", "Concept", "Accn", "Start", "End", "Fp", "Form").alias("fact")

    def best(concepts: Sequence[str]) -> Column:
        concept = rank_in(F.col("Concept"), concepts)
        choice = F.struct((-concept).alias("c"), (-taxonomy).alias("t"), (-unit).alias("u")).alias("choice")
        return F.max(F.when(concept.isNotNull(), F.struct(choice, *place, payload)))

    usable = facts.where(F.col("Concept").isin(*[c for g in groups.values() for c in g]) & F.col("Val").isNotNull())
    by_accession = stored_once(usable.groupBy("CIK", "Accn").agg(*[best(g).alias(n) for n, g in groups.items()]), "facts-by-accession")
    by_company = by_accession.groupBy("CIK").agg(*[F.max(n).alias(f"__any_{n}") for n in groups])
    own = by_accession.where("Accn IS NOT NULL").withColumnsRenamed({n: f"__own_{n}" for n in groups})
    found = filings.select("URL", "CIK", "Accn").distinct().join(own, ["CIK", "Accn"], "left").join(by_company, "CIK", "left")
    return found.select("URL", *[
        F.when(F.col(f"__own_{n}.choice") == F.col(f"__any_{n}.choice"), F.col(f"__own_{n}.fact")).otherwise(F.col(f"__any_{n}.fact")).alias(n)
        for n in groups])


def facts_runway(filings: DataFrame, facts: DataFrame, ordinal: str = "ord", parse_url: bool = True) -> DataFrame:
    """``(URL, Form, result)`` per distinct filing link from tagged facts; null result without any."""
    ids = filings.select("URL", "Form", *([] if parse_url else ["CIK", "Accn"]))
    if parse_url:
        ids = ids.withColumn("__id", filing_ids("URL")).select(
            "URL", "Form", F.col("__id.cik").alias("CIK"), F.col("__id.accession").alias("Accn"))
    ids = ids.groupBy("URL").agg(F.min("Form").alias("Form"), F.min("CIK").alias("CIK"), F.min("Accn").alias("Accn"))
    best = best_facts(ids, facts, {"__cash": R.CASH_CONCEPTS, "__flow": R.OCF_CONCEPTS}, ordinal)
    out = ids.join(best, "URL", "left")
    c, o = F.col("__cash.Val").cast("double"), F.col("__flow.Val").cast("double")
    form = F.coalesce(form_in_text("Form"), form_in_text("__cash.Form"), form_in_text("__flow.Form"))
    months = months_of_fact(F.col("__flow.Fp"), F.col("__flow.Start"), F.col("__flow.End"), default_months(form))
    out = out.withColumns({"__form": form, "__months": F.when(o.isNotNull(), months)})
    months, form = F.col("__months"), F.col("__form")
    partial = F.when(c.isNull() | o.isNull(), " (partial XBRL data)").otherwise("")
    status = F.when(o.isNull(), "Missing OCF").when(~valid_months(months), "Missing OCF period").otherwise("OK")
    result = finalize(c, o, months, form, quarterly(o, months), quarterly_tag(o, months),
                      F.concat(F.lit("values parsed from XBRL: "), "URL", partial), F.lit(1), status, F.array(F.lit("XBRL")))
    return out.select("URL", form.alias("Form"), F.when(c.isNotNull() | o.isNotNull(), result).alias("result"))


# ---------------------------------------------------------------- rendered statements

def statement_values(cells: DataFrame, keys: Sequence[str], labels: Sequence[str], name: str) -> DataFrame:
    """First number of the first row whose label contains a caption, captions in order.

    Cells: keys, row_idx, label, col_idx, value (text or number). Only rows that
    match a caption leave the scan, and both steps aggregate before the shuffle.
    """
    low = F.lower(F.coalesce("label", empty()))
    wanted = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(c.lower()).alias("c")) for i, c in enumerate(labels)])
    hits = F.transform(F.filter(wanted, lambda w: F.contains(low, w["c"])), lambda w: w["i"])
    rows = cells.withColumn("__v", statement_number("value")).select(*keys, "row_idx", "col_idx", "__v", F.explode(hits).alias("__k"))
    numeric = F.when(F.col("__v").isNotNull(), F.struct("row_idx", "col_idx", "__v"))
    per_caption = rows.groupBy(*keys, "__k").agg(F.min("row_idx").alias("__first"), F.min(numeric).alias("__n"))
    good = per_caption.where(F.col("__n.row_idx") == F.col("__first"))
    return good.groupBy(*keys).agg(F.min_by("__n.__v", "__k").alias(name))


def statements_runway(cells: DataFrame, filing: str = "filing_id", sign_labels: tuple[Sequence[str], Sequence[str]] = (
        R.STATEMENT_CASH_LABELS, (*R.OCF_CAPTIONS_PROVIDED, *R.OCF_CAPTIONS_BURN))) -> DataFrame:
    """Runway verdict per filing from long statement tables.

    Cells: filing, form, stmt ('balance' or 'cashflow'), row_idx, label, col_idx, period_label, value.
    """
    cash = statement_values(cells.where("stmt = 'balance'"), [filing], sign_labels[0], "__cash")
    flow_cells = cells.where("stmt = 'cashflow'")
    flow = statement_values(flow_cells, [filing], sign_labels[1], "__ocf")
    named = flow_cells.select(filing, "col_idx", months_in_column("period_label").alias("__m")).where("__m IS NOT NULL")
    months = named.groupBy(filing).agg(F.min_by("__m", "col_idx").alias("__m"))
    out = cells.groupBy(filing).agg(F.min("form").alias("form"))
    out = out.join(cash, filing, "left").join(flow, filing, "left").join(months, filing, "left")
    m = F.coalesce("__m", default_months(form_in_text("form")))
    o = F.col("__ocf")
    status = F.when(o.isNull(), "Missing OCF").otherwise("OK")
    result = finalize(F.col("__cash"), o, m, F.col("form"), quarterly(o, m), quarterly_tag(o, m),
                      F.concat(F.lit("values parsed from EDGAR XBRL: "), F.col(filing).cast("string")), F.lit(1), status,
                      F.array(F.lit("XBRL")))
    return out.select(filing, "form", result.alias("result"))


# ---------------------------------------------------------------- exhibits

def exhibit_index(docs: DataFrame, url: str, html: str, row_pattern: str = ROW, cell_pattern: str = CELL,
                  tokens: Sequence[str] = R.EXHIBIT_TOKENS) -> DataFrame:
    """Rows of a filing index naming an exhibit 99: ``(url, seq, href, doc_type, description, filename, label)``."""
    def every(text: Column, pattern: str) -> Column:
        return F.regexp_extract_all(text, F.lit(pattern), F.lit(0))

    rows = docs.select(url, F.posexplode(every(unescape_entities(F.coalesce(F.col(html), empty())), row_pattern)).alias("seq", "__row"))
    rows = rows.where(contains_any(F.lower("__row"), tokens))
    rows = rows.withColumn("__texts", F.transform(every(F.col("__row"), cell_pattern), strip_tags))
    href = F.regexp_extract("__row", r'(?i)href\s*=\s*"([^"]+)"', 1)
    rows = rows.withColumns({"href": href, "filename": F.substring_index(href, "/", -1)}).where("href != ''")
    kinds = F.filter(F.transform("__texts", lambda t: F.regexp_extract(t, r"(?i)(EX[\s\-_.]*99[\w.\-]*)", 1)), lambda t: t != "")
    named = F.upper(F.replace(F.try_element_at(kinds, F.lit(1)), F.lit(" "), F.lit("")))
    long = F.filter("__texts", lambda t: F.length(t) > 3)
    return rows.select(
        url, "seq", "href", F.coalesce(named, "filename").alias("doc_type"),
        F.coalesce(F.try_element_at(long, F.lit(1)), empty()).alias("description"), "filename",
        F.lower(F.array_join("__texts", " ")).alias("label"))


def exhibit_score(form: Column) -> Column:
    """How likely an index row is the financial exhibit of a form. The published scores and what they are given for."""
    kind, label = F.upper("doc_type"), F.col("label")
    statements, interim = label.contains("financial statements"), label.contains("interim")
    special = (
        F.when((form == "40-F") & kind.startswith("EX-99.2"), 1000)
        .when((form == "40-F") & starts_any(kind, ("EX-99.5", "EX-99.1", "EX-99.3")) & (statements | interim), 900)
        .when((form == "6-K") & kind.startswith("EX-99.1")
              & contains_any(label, ("financial statements", "interim financial report", "condensed consolidated")), 900)
        .when((form == "20-F") & kind.startswith("EX-99") & statements, 800).otherwise(0)
    )
    return (
        F.when(kind.startswith("EX-99"), 50).otherwise(0)
        + F.when(F.lower("filename").rlike(R.EXHIBIT_NAME_HINT), 8).otherwise(0)
        + F.when(contains_any(label, R.EXHIBIT_FINANCIAL_WORDS), 40).otherwise(0)
        + F.when(interim, 10).otherwise(0) + special
    )


def exhibit_candidates(index: DataFrame, url: str, form: Column) -> DataFrame:
    """Scored index rows with absolute links; images are left out."""
    folder = F.regexp_extract(F.regexp_replace(F.col(url), "#.*$", ""), "^(.*/)", 1)
    site = F.regexp_extract(url, r"^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)", 1)
    absolute = (
        F.when(F.col("href").contains("://"), F.col("href"))
        .when(F.col("href").startswith("/"), F.concat(site, "href")).otherwise(F.concat(folder, "href"))
    )
    rows = index.withColumns({"exhibit_url": absolute, "score": exhibit_score(form)})
    own_exhibit = F.lower(F.substring_index(path(F.col(url)), "/", -1)).rlike("(ex|exhibit)99")
    return rows.where(~is_image("exhibit_url") & ~own_exhibit)


def exhibit_rank_order() -> list[Column]:
    return [F.desc("score"), F.desc("doc_type"), F.desc("filename"), F.asc("seq")]


def follow_exhibits(candidates: DataFrame, exhibits: DataFrame, url: str, form: Column) -> DataFrame:
    """Per filing the best-ranked exhibit with cash, cash flow and a period.

    ``exhibits (exhibit_url, html)``. Only exhibits that a candidate names are parsed; they are dealt to all tasks first,
    as adaptive execution cuts the tasks of the join by bytes, and only their small statements are shuffled further. Of
    differing copies the one with the greatest SHA-256 counts.
    """
    wanted = exhibits.join(candidates.select("exhibit_url").distinct(), "exhibit_url", "left_semi")
    wanted = spread(wanted.select("exhibit_url", "html"), "exhibit_url", "html")
    parsed = parse_statements(wanted.select("exhibit_url", "html", F.sha2(F.coalesce("html", empty()), 256).alias("__copy"))).drop("html")
    parsed = parsed.groupBy("exhibit_url").agg(F.max_by("statement", "__copy").alias("statement"))
    found = candidates.withColumn("__form", form).join(parsed, "exhibit_url")
    months = F.coalesce(F.when(valid_months(F.col("statement.months")), F.col("statement.months")), default_months(F.col("__form")))
    found = found.withColumn("months", months)
    good = found.where(F.col("statement.cash").isNotNull() & F.col("statement.ocf").isNotNull() & valid_months(F.col("months")))
    best = top_rows(good, [url], exhibit_rank_order())
    return best.select(
        url, "exhibit_url", "doc_type", F.col("statement.cash").alias("cash"), F.col("statement.ocf").alias("ocf"), "months",
        F.col("statement.units").alias("units"), F.col("statement.header").alias("header"),
        F.concat_ws("; ", blank_to_null("statement.evidence"), F.concat(F.lit("exhibit="), "doc_type")).alias("evidence"),
        F.concat(F.lit("OK (from exhibit "), "doc_type", F.lit(")")).alias("status"))


def exhibit_verdict(best: DataFrame, form: Column) -> DataFrame:
    """Runway verdict of the chosen exhibits."""
    o, m = F.col("ocf"), F.col("months")
    return best.withColumn("result", finalize(
        F.col("cash"), o, m, form, quarterly(o, m), quarterly_tag(o, m), F.col("evidence"), F.col("units"),
        F.col("status"), F.array(F.lit("HTML"))))


# ---------------------------------------------------------------- filings <- runway

def runway_by_url(filings: DataFrame, documents: DataFrame) -> DataFrame:
    """``(URL, Quarters)``: the text rule, for the distinct links of filings that can carry a runway.

    Texts are read where they are stored and only the number is shuffled; of differing copies the largest number counts.
    """
    name = upper_key("Form")
    links = filings.where(starts_any(name, R.RUNWAY_FORMS)).select("URL").where("URL != ''").distinct()
    read = documents.select("URL", text_runway("Text").alias("Quarters")).groupBy("URL").agg(F.max("Quarters").alias("Quarters"))
    return links.join(read, "URL")


def attach_runway(filings: DataFrame, by_url: DataFrame) -> DataFrame:
    """RunwayQuarters, HasRunway and RunwaySourceURL on every filing; other forms stay without."""
    def old(name: str, kind: str) -> Column:
        return F.col(name) if name in filings.columns else F.lit(None).cast(kind)

    carries = starts_any(upper_key("Form"), R.RUNWAY_FORMS)
    found = F.when(carries, F.col("__q"))
    joined = filings.join(by_url.select("URL", F.col("Quarters").alias("__q")), "URL", "left")
    return joined.withColumns({
        "RunwayQuarters": F.coalesce(found, old("RunwayQuarters", "double")),
        "HasRunway": F.coalesce(old("HasRunway", "boolean"), F.lit(False)) | found.isNotNull(),
        "RunwaySourceURL": F.when(found.isNotNull(), F.coalesce(blank_to_null(old("RunwaySourceURL", "string")), F.col("URL")))
        .otherwise(old("RunwaySourceURL", "string")),
    }).drop("__q")


def form_of(url: Column, text: Column | None = None, hint: Column | None = None) -> Column:
    """Form of a document: explicit hint, then its link, then its text."""
    options = [form_in_text(hint)] if hint is not None else []
    options.append(form_from_url(url))
    if text is not None:
        options.append(form_in_text(strip_tags(text)))
    return F.coalesce(*options)


#: Fields of a verdict that the runway columns show.
PRINTED = ("status", "note", "complete", "cash", "cash_raw", "quarterly_burn", "quarterly_burn_raw", "runway_quarters", "runway_quarters_raw",
           "estimate", "form_type", "assumption", "period_months", "ocf_raw", "units_scale")


def extract_runway(companies: DataFrame, filings: DataFrame, results: DataFrame, as_of: AsOf, ordinal: str = "ord",
                   drop_if_incomplete: bool = False) -> DataFrame:
    """Runway columns per company: the newest complete filing, else the best partial one.

    ``results (URL, result)`` holds one verdict per filing link. One aggregation
    picks all filings of interest; the notes of the filings tried, up to the first
    complete one, are joined as bounded cells (``EvidencePart`` as elsewhere).
    """
    filed = filings.where(starts_any(upper_key("Form"), R.RUNWAY_FORMS) & F.col("FiledAt").isNotNull() & F.col("CIK").cast("string").rlike("[0-9]")).select(
        cik("CIK").alias("CIK"), "FiledAt", with_scheme("URL").alias("URL"), canonical_form("Form").alias("form"), F.col(ordinal).alias("ord"))
    # named by verdict, status and note, but computed once, before the join
    filed = filed.withColumns({"priority": form_priority(F.col("form")), "__named": url_names_form("form", "URL")})
    # only what is printed of a verdict is shuffled
    slim = F.when(F.col("result").isNotNull(), F.struct(*[F.col(f"result.{c}").alias(c) for c in PRINTED]))
    rows = filed.join(results.select("URL", slim.alias("result")), "URL", "left")
    linked, named, verdict = F.col("URL") != "", F.col("__named"), F.col("__v")
    rows = rows.withColumn("__v", F.when(linked & named, F.col("result")))
    when = F.concat(iso("FiledAt"), F.lit("T00:00:00"))
    status = (
        F.when(~linked, "Fetch error").when(~named, "Form/URL mismatch").when(verdict.isNull(), "Fetch error")
        .otherwise(first_nonblank(verdict["status"], F.lit("OK"))))
    note = (
        F.when(~linked, F.concat_ws(" ", "form", when, F.lit("missing filing URL")))
        .when(~named, F.concat(F.col("form"), F.lit(" URL mismatch: "), F.col("URL")))
        .when(verdict.isNull(), F.concat(F.col("form"), F.lit(" parser returned no data")))
        .otherwise(first_nonblank(verdict["note"], verdict["status"], F.lit("OK"))))
    rows = rows.withColumns({"__status": status, "__note": note})
    rows = rows.withColumn("__place", F.struct(F.col("FiledAt").alias("d"), (-F.col("priority")).alias("p"), (-F.col("ord")).alias("o")))
    rows = stored_once(rows.select("CIK", "FiledAt", "form", "URL", "priority", "ord", "__v", "__status", "__note", "__place"), "runway-rows")
    info = F.struct("FiledAt", "form", "URL", F.col("__v").alias("v"))
    complete = F.coalesce(F.col("__v.complete"), F.lit(False))
    usable = F.col("__v").isNotNull() & ~complete
    worst_first = F.struct((-F.col("priority")).alias("p"), F.col("FiledAt").alias("d"), (-F.col("ord")).alias("o"))
    picks = rows.groupBy("CIK").agg(
        F.max_by(info, F.when(complete, F.col("__place"))).alias("__final"),
        F.max_by(info, F.when(usable, worst_first)).alias("__partial"),
        F.max_by(info, F.col("__place")).alias("__first"),
        F.min_by("__status", "__place").alias("__last_status"),
        F.max(F.when(complete, F.col("__place"))).alias("__stop"))

    tried = rows.select("CIK", "FiledAt", "__place", "__note", (F.col("priority").cast("bigint") * F.lit(1 << 59) + F.col("ord")).alias("__seq"))
    tried = tried.join(picks.select("CIK", "__stop"), "CIK").where(F.col("__stop").isNull() | (F.col("__place") >= F.col("__stop")))
    tried = top_rows(tried.where("__note != ''"), ["CIK", "__note"], [F.desc("FiledAt"), F.asc("__seq")])
    tried = stored_once(tried.select("CIK", "FiledAt", "__note", "__seq"), "runway-notes")
    notes = text_parts(tried, ["CIK"], "__seq", "__note", "__notes", "FiledAt", separator=" | ")

    kept = [c for c in companies.columns if not c.startswith("Runway") and c != "EvidencePart"]
    out = companies.select([F.col(f"`{c}`") for c in kept]).withColumn("CIK", cik("CIK"))
    out = out.join(picks, "CIK", "left").join(notes, "CIK", "left")
    out = out.withColumn("__use", F.coalesce("__final", "__partial"))
    out = out.withColumn("__src", F.coalesce("__use", "__first"))
    v = F.col("__use.v")
    form = first_nonblank(v["form_type"], F.col("__src.form"))
    date, link = iso("__src.FiledAt"), F.coalesce("__src.URL", empty())
    stub = F.concat_ws(" ", blank_to_null(date), blank_to_null(form), blank_to_null(link))
    part = F.coalesce("EvidencePart", F.lit(0))
    text = F.coalesce("__notes", F.lit("No eligible filing"))
    out = out.select(
        *kept, part.alias("EvidencePart"),
        display_number(v["cash"]).alias("RunwayCash"), raw_number(v["cash_raw"]).alias("RunwayCashRaw"),
        display_number(v["quarterly_burn"]).alias("RunwayQuarterlyBurn"),
        raw_number(v["quarterly_burn_raw"]).alias("RunwayQuarterlyBurnRaw"),
        display_number(v["runway_quarters"]).alias("RunwayQuarters"),
        raw_number(v["runway_quarters_raw"]).alias("RunwayQuartersRaw"),
        F.coalesce(v["estimate"], empty()).alias("RunwayEstimate"),
        F.when((part == 0) & (stub != ""), F.concat_ws(" | ", stub, text)).otherwise(text).alias("RunwayNotes"),
        form.alias("RunwaySourceForm"), date.alias("RunwaySourceDate"), link.alias("RunwaySourceURL"),
        F.coalesce(first_status(v), F.col("__last_status"), F.lit("No eligible filing")).alias("RunwayStatus"),
        F.coalesce(v["assumption"], empty()).alias("RunwayAssumption"),
        F.coalesce(v["period_months"].cast("string"), empty()).alias("RunwayOCFPeriodMonths"),
        raw_number(v["ocf_raw"]).alias("RunwayOCFRaw"),
        F.coalesce(v["units_scale"].cast("string"), empty()).alias("RunwayUnitsScale"),
        F.coalesce(age_days(as_of, "__src.FiledAt").cast("string"), empty()).alias("RunwaySourceDaysAgo"),
        F.coalesce(v["complete"], F.lit(False)).alias("__complete"))
    if drop_if_incomplete:
        out = evaluate_once(out, "__complete").where("__complete")
    return out.drop("__complete")


def first_status(v: Column) -> Column:
    return F.when(v.isNotNull(), first_nonblank(v["status"], F.lit("OK")))


def source_defaults(form: Column, date: Column, url: Column, used: Column, first: Column) -> Column:
    """Source form, date and link, each from the used filing, else the given value, else the first candidate."""
    return F.struct(
        first_nonblank(used["form"], form, first["form"]).alias("form"),
        first_nonblank(iso(used["FiledAt"]), date, iso(first["FiledAt"])).alias("date"),
        first_nonblank(used["URL"], url, first["URL"]).alias("url"))
