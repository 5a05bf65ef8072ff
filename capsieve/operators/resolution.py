"""From filings to runway verdicts: tagged facts, then the document, then exhibits, each read only where still needed.

Every step writes the links that are still open (the frontier), and the next, costlier source is cut to them by a semi-join
before anything of it is parsed: complete facts spare the document, a complete statement spares index page and exhibits.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from capsieve import rules as R
from capsieve.functions.forms import canonical_form, default_months, form_in_text, form_priority
from capsieve.functions.text import blank_to_null, cik, empty, starts_any, strip, upper_key
from capsieve.functions.urls import form_from_url, url_names_form, with_scheme
from capsieve.operators.keyed import top_rows
from capsieve.operators.runway import (
    exhibit_candidates, exhibit_index, facts_runway, follow_exhibits, form_of,
)
from capsieve.operators.runway_rules import finalize, merge_sources, needs_exhibit, valid_months
from capsieve.operators.statements import parse_statements
from capsieve.session import stored_once

#: Filings of a company tried in the first rounds; the last round tries all others.
ROUNDS = (1, 4)


@dataclass(frozen=True)
class Sources:
    """Landed tables that a verdict may come from; each may be absent.

    facts: as :func:`runway.best_facts` takes them. documents (URL, html): the filing itself. index_pages (URL, html): the
    index of the filing, by the filing's link. exhibits (exhibit_url, html).
    """

    facts: DataFrame | None = None
    documents: DataFrame | None = None
    index_pages: DataFrame | None = None
    exhibits: DataFrame | None = None


def _none(like: str) -> Column:
    return F.lit(None).cast(like)


STATEMENT = "struct<cash:double,ocf:double,months:int,units:bigint,header:boolean,evidence:string>"
EXHIBIT = "struct<exhibit_url:string,doc_type:string,cash:double,ocf:double,months:int,units:bigint,header:boolean,evidence:string,status:string>"


def runway_links(filings: DataFrame) -> DataFrame:
    """``(URL, Hint)`` of the distinct links that may carry a runway: by the form, else by the link, else unknown yet."""
    known = F.coalesce(form_in_text("Form"), form_from_url("URL"))
    named = filings.select(with_scheme("URL").alias("URL"), F.when(upper_key("Form") != "", known).otherwise(form_from_url("URL")).alias("Hint"),
                           (upper_key("Form") != "").alias("__given"))
    open_form = F.col("Hint").isNull() & ~F.col("__given")
    rows = named.where((F.coalesce("URL", empty()) != "") & (open_form | F.col("Hint").isin(*R.RUNWAY_FORMS)))
    return rows.groupBy("URL").agg(F.min("Hint").alias("Hint"))


def _from_facts(links: DataFrame, facts: DataFrame | None, ordinal: str) -> DataFrame:
    """links with ``x``: the verdict of the tagged facts, null without any."""
    if facts is None:
        null_verdict = finalize(_none("double"), _none("double"), _none("int"), _none("string"))
        return links.withColumn("x", F.when(F.lit(False), null_verdict))
    found = facts_runway(links.withColumnRenamed("Hint", "Form"), facts, ordinal)
    return links.join(found.select("URL", F.col("result").alias("x")), "URL", "left")


def _from_documents(links: DataFrame, documents: DataFrame | None) -> DataFrame:
    """links with ``s`` (parsed statement), ``landed`` and the form that the text names where nothing else does."""
    if documents is None:
        return links.withColumns({"s": _none(STATEMENT), "landed": F.lit(False), "Text": _none("string")})
    wanted = documents.withColumn("URL", with_scheme("URL")).join(links.select("URL", "Hint"), "URL")
    parsed = parse_statements(wanted.select("URL", "Hint", "html", F.sha2(F.coalesce("html", empty()), 256).alias("__copy")))
    # of differing copies the one with the greatest SHA-256 counts
    small = parsed.select("URL", F.struct(
        F.col("__copy"), F.col("statement").cast(STATEMENT).alias("s"), form_of(F.col("URL"), F.col("html"), F.col("Hint")).alias("Text")).alias("d"))
    best = small.groupBy("URL").agg(F.max_by("d", "d.__copy").alias("d"))
    return links.join(best, "URL", "left").select(*links.columns, F.col("d.s").alias("s"), F.col("d").isNotNull().alias("landed"), F.col("d.Text").alias("Text"))


def _from_exhibits(links: DataFrame, sources: Sources) -> DataFrame:
    """``(URL, e)``: the best exhibit of links (URL, form) that has cash, cash flow and a period."""
    pages = sources.index_pages.withColumn("URL", with_scheme("URL")).join(links, "URL", "left_semi")
    index = exhibit_index(pages.select("URL", "html"), "URL", "html").dropDuplicates(["URL", "href", "doc_type", "filename", "label"])
    candidates = stored_once(exhibit_candidates(index.join(links.select("URL", "form"), "URL"), "URL", F.col("form")), "exhibit-links")
    best = follow_exhibits(candidates, sources.exhibits, "URL", F.col("form"))
    return best.select("URL", F.struct("exhibit_url", "doc_type", "cash", "ocf", "months", "units", "header", "evidence", "status").alias("e"))


def _verdict() -> Column:
    """Verdict of a row (URL, form, x, s, landed, e), null where no source has anything."""
    form, x, s, e = F.col("form"), F.col("x"), F.col("s"), F.col("e")
    whole = (form == "6-K") & e.isNotNull()  # an exhibit replaces the page of a 6-K and completes that of other forms

    def value(name: str) -> Column:
        return F.when(whole, e[name]).otherwise(F.coalesce(s[name], e[name]))

    html = F.struct(
        value("cash").alias("cash"), value("ocf").alias("ocf"),
        F.when(e.isNotNull(), e["months"]).otherwise(s["months"]).cast("int").alias("months"),
        F.coalesce(e["units"], s["units"], F.lit(1)).cast("bigint").alias("units"),
        F.coalesce(e["evidence"], s["evidence"], empty()).alias("evidence"))
    exhibit = F.struct(e["status"].alias("status"), e["exhibit_url"].alias("href"), e["doc_type"].alias("doc_type"))
    merged = merge_sources(html, x, form, default_months(form), F.col("URL"), None, exhibit)
    # a 6-K without a cash flow statement anywhere says so
    rest = blank_to_null(strip(F.replace(F.regexp_replace(x["note"], r"(?i)^values parsed from XBRL[^:]*:", ""), F.col("URL"), empty())))
    bare = finalize(
        x["cash_raw"], _none("double"), F.coalesce(F.when(valid_months(x["period_months"]), x["period_months"]), default_months(form)), form, None,
        x["assumption"], F.concat_ws("; ", F.concat(F.lit("6-K missing operating cash flow statement headers: "), "URL"), rest),
        F.coalesce(x["units_scale"], F.lit(1)), F.lit("6-K missing OCF (exhibits tried)"), F.array(F.when(x["cash_raw"].isNotNull(), "XBRL")))
    no_header = (form == "6-K") & F.col("landed") & e.isNull() & ~F.coalesce(s["header"], F.lit(False))
    return F.when(F.col("landed") | x.isNotNull() | e.isNotNull(), F.when(no_header, bare).otherwise(merged))


def runway_results(filings: DataFrame, sources: Sources, ordinal: str = "ord") -> DataFrame:
    """``(URL, Form, Source, result)`` for every distinct link of filings (Form, URL) that can carry a runway.

    Complete facts are final. Otherwise the document is parsed, and the index page and its exhibits where the form's rule asks
    for them; what was found is merged with the facts. Source is 'facts', 'document', 'exhibit' or '' (nothing landed: null
    result). A filing without a form is kept when its link or its text names a runway form. Links repeated in `filings` count
    once; of differing copies of a document one is taken, whatever their order. Null and blank links are left out.
    """
    links = stored_once(_from_facts(runway_links(filings), sources.facts, ordinal), "runway-facts")
    done = F.coalesce("x.complete", F.lit(False))
    final = links.where(done).select("URL", F.coalesce("Hint", "x.form_type").alias("Form"), F.lit("facts").alias("Source"), F.col("x").alias("result"))

    read = _from_documents(links.where(~done), sources.documents)
    read = read.withColumn("form", F.coalesce("Hint", "Text", "x.form_type")).where(F.col("form").isNull() | F.col("form").isin(*R.RUNWAY_FORMS))
    read = stored_once(read.where("form IS NOT NULL OR NOT landed").drop("Text"), "runway-documents")
    s = F.col("s")
    some = F.when(F.col("form") == "6-K", ~F.coalesce(s["header"], F.lit(False)) | s["cash"].isNull() | s["ocf"].isNull()).otherwise(
        needs_exhibit(F.col("form"), s["cash"], s["ocf"], s["months"], s["header"]))
    if sources.index_pages is None or sources.exhibits is None:
        whole = read.withColumn("e", _none(EXHIBIT))
    else:
        wanted = read.where(some & F.col("form").isNotNull()).select("URL", "form")
        whole = read.join(_from_exhibits(wanted, sources), "URL", "left")
    kind = F.when(F.col("e").isNotNull(), "exhibit").when(F.col("landed"), "document").when(F.col("x").isNotNull(), "facts").otherwise("")
    return final.unionByName(whole.select("URL", F.col("form").alias("Form"), kind.alias("Source"), _verdict().alias("result")))


# ---------------------------------------------------------------- companies

def _runway_filings(filings: DataFrame, ordinal: str) -> DataFrame:
    family = canonical_form("Form")
    rows = filings.where(starts_any(upper_key("Form"), R.RUNWAY_FORMS) & F.col("FiledAt").isNotNull())
    return rows.select(cik("CIK").alias("CIK"), "Form", "FiledAt", with_scheme("URL").alias("URL"), form_priority(family).alias("__priority"), F.col(ordinal).alias("ord")).where("CIK != ''")


def first_results(filings: DataFrame, sources: Sources, ordinal: str = "ord", rounds: tuple[int, ...] = ROUNDS) -> DataFrame:
    """:func:`runway_results` of as few filings as decide: newest first, and only companies without a complete verdict go on.

    The first rounds rank a few filings per company (Spark cuts the groups before the shuffle), the last one takes
    all other filings of the companies that are still open, without ranking them. `runway.extract_runway` gives the same
    verdicts with these results as with those of all filings.
    """
    left = stored_once(_runway_filings(filings, ordinal), "runway-filings")
    newest = [F.desc("FiledAt"), F.asc("__priority"), F.asc("ord")]
    found = []
    for size in (*rounds, None):
        batch = left if size is None else stored_once(top_rows(left, ["CIK"], newest, size), "runway-batch")
        found.append(stored_once(runway_results(batch, sources, "ord"), "runway-results"))
        if size is None:
            break
        complete = found[-1].where("result.complete").select("URL")
        # only a link that names its form, or a viewer link, counts for its company
        own = batch.where(url_names_form(canonical_form("Form"), "URL"))
        resolved = own.join(complete, "URL", "left_semi").select("CIK").distinct()
        left = stored_once(left.join(resolved, "CIK", "left_anti").join(batch, ["CIK", "ord"], "left_anti"), "runway-open")
        if left.isEmpty():
            break
    # a link of several companies may have been tried in several rounds, with the same verdict
    return top_rows(reduce(DataFrame.unionByName, found), ["URL"], [F.asc("Source"), F.asc("Form")])
