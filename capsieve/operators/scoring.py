"""Shortlist, deep research, validation, and the older research tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from capsieve import rules as R
from capsieve.functions.dates import age_days, iso
from capsieve.functions.text import (
    any_of, blank_to_null, cik, clean_text, empty, first_nonblank, split_evidence, starts_any, strip, ticker, upper_key,
)
from capsieve.functions.urls import is_primary_source
from capsieve.operators.events import catalyst_by_form, catalyst_event, primary_event, tier_rank
from capsieve.operators.evidence import dilution_line, dilution_notes
from capsieve.operators.filings import FDA_CELLS, FILING_CELLS, fda_line, latest_per_cik, within_retention
from capsieve.operators.keyed import backfill, evaluate_once, one_per_key, one_row_each, or_key_join, text_parts, top_rows, with_parts
from capsieve.operators.lines import first_seen, pieces, place_of, placed_cells, split_cells
from capsieve.operators.runway_rules import text_runway
from capsieve.rules import RULES, Rules
from capsieve.session import stored_once

AsOf = dt.date | str | Column
EXCLUDE = "TBD — exclude"
NO_VALUE = ("", "nan", "TBD", "Unknown")
EVIDENCE_CELLS = (*FILING_CELLS, *FDA_CELLS)


# ---------------------------------------------------------------- candidate shortlist

def notes_status(price: Column, cap: Column, adv: Column) -> Column:
    return F.when(price.isNull() | cap.isNull() | adv.isNull(), EXCLUDE).otherwise("Pass")


def candidate_shortlist(universe: DataFrame, events: DataFrame, hydrated: DataFrame | None = None,
                        legacy: DataFrame | None = None, ordinal: str = "ord", rules: Rules = RULES) -> DataFrame:
    """The best-ranked candidates having an event, with units and aliases of the report."""
    columns = {"Ticker": "string", "Company": "string", "CIK": "string", "Sector": "string", "Industry": "string",
               "Exchange": "string", "MarketCap": "double", "ADV20": "double", "Close": "double", "Price": "double"}
    base = universe.select([
        (F.col(c) if c in universe.columns else F.lit(None)).cast(t).alias(c) for c, t in columns.items()])
    for source, tag in ((hydrated, "hyd"), (legacy, "legacy")):
        present = [] if source is None else [c for c in ("Close", "ADV20", "MarketCap") if c in source.columns]
        if present:
            base = base.join(source.select("Ticker", *[F.col(c).alias(f"{c}_{tag}") for c in present]), "Ticker", "left")
        base = base.withColumns({f"{c}_{tag}": F.lit(None).cast("double")
                                 for c in ("Close", "ADV20", "MarketCap") if c not in present})
    picked = primary_event(events, ordinal).select(
        "Ticker", F.col("event_type").alias("CatalystType"), F.col("event_date").cast("string").alias("EventDate"),
        F.col("event_tier").alias("EventTier"), F.col("primary_source_url").alias("PrimarySource"),
        (F.col("secondary_source_url") if "secondary_source_url" in events.columns else empty()).alias("SecondarySource"))
    price = F.coalesce("Price", "Close_hyd", "Close_legacy", "Close")
    cap = F.coalesce("MarketCap", "MarketCap_hyd", "MarketCap_legacy")
    adv = F.coalesce("ADV20", "ADV20_hyd", "ADV20_legacy")
    status = notes_status(price, cap, adv)
    rows = base.join(picked, "Ticker").select(
        "Ticker", "Company", "CIK", "Sector", "Industry", F.col("Exchange").alias("Venue"),
        price.alias("Price"), price.alias("Price($)"), cap.alias("MarketCap"), (cap / 1e6).alias("Cap($M)"),
        (cap / 1e6).alias("Cap_Musd"), adv.alias("ADV20"), (adv / 1e3).alias("ADV20(k)"), (adv / 1e3).alias("ADV20_k"),
        F.col("CatalystType").alias("PrimaryCatalystType"), "CatalystType",
        F.col("EventDate").alias("PrimaryCatalystDate"), "EventDate", "EventTier",
        F.col("PrimarySource").alias("PrimaryFilingURL"), "PrimarySource", "SecondarySource",
        status.alias("NotesStatus"), status.alias("Notes/Status"))
    return rows.orderBy(
        F.desc(tier_rank("EventTier")), F.desc_nulls_last("EventDate"), F.asc_nulls_last("Cap_Musd"), F.asc("Ticker"),
    ).limit(rules.shortlist_size)


# ---------------------------------------------------------------- decision tables

def materiality(count: Column, catalyst: Column, mandatory: Column) -> Column:
    text = F.lower(strip(F.coalesce(catalyst, empty())))
    return (
        F.when(~mandatory, "FAIL - mandatory subscore missing")
        .when(text.startswith("tier-1") & (count >= 4), "PASS - Tier1 catalyst")
        .when(~text.isin("", "none", "tbd", "nan") & (count >= 4),
              F.when(text.startswith("tier-2"), "PASS - Tier2").otherwise("PASS - catalyst"))
        .otherwise("FAIL - weak profile")
    )


def materiality_passed(text: Column) -> Column:
    return F.upper(strip(F.coalesce(text, empty()))).startswith("PASS")


def conviction(count: Column, catalyst: Column, materiality_text: Column) -> Column:
    strong = F.lower(F.coalesce(catalyst, empty())).startswith("tier-1")
    return (
        F.when(~materiality_passed(materiality_text), "Low").when((count >= 4) & strong, "High")
        .when(count >= 4, "Medium").otherwise("Low")
    )


def research_status(mandatory: Column, count: Column, materiality_text: Column, peer: Column) -> Column:
    good = mandatory & (count >= 4) & materiality_passed(materiality_text) & ~peer.startswith("TBD")
    return F.when(good, "Validated").otherwise(EXCLUDE)


def is_biotech(sector: Column, industry: Column) -> Column:
    return F.lower(F.concat_ws(" ", sector, industry)).contains("biotech")


def dilution_score(form: Column) -> Column:
    """Aggregate: High with any dilution form, Low with any form, TBD with none."""
    return (
        F.when(F.bool_or(starts_any(form, R.WEEKLY_DILUTION_FORMS)), "High")
        .when(F.bool_or(form != ""), "Low").otherwise("TBD")
    )


def governance_score(form: Column) -> Column:
    """Aggregate: OK with a proxy or core form, Concern with any form, TBD with none."""
    good = form.contains("DEF 14A") | starts_any(form, R.RUNWAY_FORMS)
    return F.when(F.bool_or(good), "OK").when(F.bool_or(form != ""), "Concern").otherwise("TBD")


def is_governance_form(form: Column) -> Column:
    return form.rlike("DEF 14A|10-K|10-Q|20-F|40-F")


def is_insider_form(form: Column) -> Column:
    return form.isin("3", "5") | form.startswith("4")


def insider_score(form: Column, ordinal: Column) -> Column:
    """Aggregate: the last insider row decides; forms starting with 4 are strong (so is 424B)."""
    value = F.when(form.startswith("4"), "Strong").otherwise("Weak")
    return F.coalesce(F.max_by(F.when(is_insider_form(form), value), F.when(is_insider_form(form), ordinal)), F.lit("TBD"))


def score_columns(form: str, date: str, ordinal: str, text: str | None = None) -> list[Column]:
    """Aggregates: dilution, governance and insider scores with their dates, and the going-concern flag."""
    name, o, d = upper_key(form), F.col(ordinal), F.col(date)
    dilutive = starts_any(name, R.WEEKLY_DILUTION_FORMS)
    concern = F.lit(False) if text is None else F.coalesce(
        is_governance_form(name) & F.col(text).rlike("(?i)going concern"), F.lit(False))
    return [
        dilution_score(name).alias("DilutionScore"),
        F.max_by(F.when(dilutive, d), F.when(dilutive & d.isNotNull(), o)).alias("LastDilutionEventDate"),
        governance_score(name).alias("GovernanceScore"),
        F.when(F.bool_or(concern), "Y").otherwise("N").alias("GoingConcernFlag"),
        insider_score(name, o).alias("InsiderScore"),
        F.max(F.when(is_insider_form(name), d)).alias("LastInsiderBuyDate"),
    ]


def scores_per_key(rows: DataFrame, keys: list[str], form: str, date: str, ordinal: str,
                   text: str | None = None) -> DataFrame:
    """Scores per key in one map-side-combined aggregation."""
    return rows.groupBy(*keys).agg(*score_columns(form, date, ordinal, text))


def runway_filing(rows: DataFrame, keys: list[str], form: str, date: str, as_of: AsOf, ordinal: str,
                  age: str | None = None, quarters: str = "RunwayQuarters") -> DataFrame:
    """The filing that speaks for the runway: rows with a number first, then the youngest."""
    days = age_days(as_of, date)
    days = F.coalesce(F.col(age), days, F.lit(1_000_000)) if age else F.coalesce(days, F.lit(1_000_000))
    core = rows.where(starts_any(upper_key(form), R.RUNWAY_FORMS)).withColumn("__age", days)
    order = [F.asc(F.col(quarters).isNull()), F.asc_nulls_last("__age"), F.asc(ordinal)]
    return top_rows(core, keys, order).drop("__age")


# ---------------------------------------------------------------- deep research

_KINDS = ("Runway", "Dilution", "Catalyst", "Governance", "Insider")


def _link_kinds(form: Column) -> dict[str, Column]:
    return {"Dilution": starts_any(form, R.WEEKLY_DILUTION_FORMS), "Governance": is_governance_form(form), "Insider": is_insider_form(form)}


def _evidence_cells(hits: DataFrame, keys: list[str], form: Column, link: str, ordinal: str) -> DataFrame:
    """Distinct filing links per candidate as bounded cells, one row per (candidate, part).

    Besides the three lists, ``__Rest`` holds the governance and insider links that
    are no dilution links, in this order.
    """
    seq = F.col(ordinal)
    first = hits.where(F.coalesce(link, empty()) != "").groupBy(*keys, F.col(link).alias("Link")).agg(
        *[F.min(F.when(cond, seq)).alias(kind) for kind, cond in _link_kinds(form).items()])
    rest = F.when(F.col("Dilution").isNull(), F.coalesce("Governance", F.lit(1 << 60) + F.col("Insider")))
    lists = [(kind, F.col(kind)) for kind in ("Dilution", "Governance", "Insider")] + [("Rest", rest)]
    rows = first.select(*keys, "Link", F.inline(F.array(*[F.struct(F.lit(n).alias("List"), v.alias("Seq")) for n, v in lists])))
    cells = text_parts(rows.where("Seq IS NOT NULL"), [*keys, "List"], "Seq", "Link", "Cell", separator=";")
    return cells.groupBy(*keys, "EvidencePart").agg(*[F.max(F.when(F.col("List") == n, F.col("Cell"))).alias(f"__{n}") for n, _ in lists])


def deep_research(shortlist: DataFrame, filings: DataFrame, events: DataFrame, as_of: AsOf, ordinal: str = "ord",
                  documents: DataFrame | None = None, peers: DataFrame | None = None) -> DataFrame:
    """Five evidence-backed subscores per shortlisted company.

    Filings need Ticker, CIK, Form, FiledAt, URL, RunwayQuarters and optionally
    Age, RunwaySourceURL, FilingText. Events are the canonical table.
    ``documents (URL, Text)`` supplies a cash runway where the picked filing has
    no number. ``peers (Industry, Ticker, Tier)`` turns on the peer check.

    One row per candidate and evidence part (see :func:`keyed.text_parts`);
    ordinary candidates have the single part 0.
    """
    keys = ["Ticker", "CIK"]
    cand = shortlist.select(*keys)
    own = [c for c in ("Form", "FiledAt", "URL", "RunwayQuarters", "RunwaySourceURL", "Age", "FilingText", ordinal)
           if c in filings.columns]
    hits = or_key_join(cand, filings.select(*keys, *own), keys, "f_")
    form, seq = upper_key("f_Form"), f"f_{ordinal}"
    # one pass over the filings: scores, the filing that speaks for the runway, and proven subscores
    quarters = F.col("f_RunwayQuarters").cast("double")
    age = F.coalesce(*([F.col("f_Age")] if "Age" in own else []), age_days(as_of, "f_FiledAt"), F.lit(1_000_000))
    source = first_nonblank(*[F.col(f"f_{c}") for c in ("RunwaySourceURL", "URL") if c in own])
    young = F.struct(quarters.isNull().alias("none"), age.alias("age"), F.col(seq).alias("seq"))
    proof = is_primary_source(F.coalesce("f_URL", empty()))
    per_company = hits.groupBy(*keys).agg(
        *score_columns("f_Form", "f_FiledAt", seq, "f_FilingText" if "FilingText" in own else None),
        F.min_by(F.struct(quarters.alias("q"), source.alias("url")), F.when(starts_any(form, R.RUNWAY_FORMS), young)).alias("__run"),
        *[F.bool_or(cond & proof).alias(f"__has_{kind}") for kind, cond in _link_kinds(form).items()])
    per_company = per_company.withColumns({
        "RunwayQuarters": F.col("__run.q"), "__runway_url": F.coalesce("__run.url", empty())}).drop("__run")
    if documents is not None:
        read = documents.select(F.col("URL").alias("__runway_url"), text_runway("Text").alias("__from_text"))
        read = read.where("__from_text IS NOT NULL").groupBy("__runway_url").agg(F.max("__from_text").alias("__from_text"))
        per_company = per_company.join(read, "__runway_url", "left").withColumn(
            "RunwayQuarters", F.coalesce("RunwayQuarters", "__from_text")).drop("__from_text")

    dates = [c for c in ("EventDate", "event_date", "FilingDate") if c in events.columns]
    hit_events = or_key_join(cand, events, keys, "e_").withColumnsRenamed(
        {"e_event_tier": "event_tier", f"e_{ordinal}": "__eord"})
    best = catalyst_event(hit_events, keys, [f"e_{c}" for c in dates], "__eord")
    kinds = [c for c in ("event_type", "EventType", "ItemsNormalized", "ItemsPresent") if c in events.columns]
    urls = [c for c in ("PrimarySource", "primary_source_url", "FilingURL", "URL") if c in events.columns]

    def first_text(names: list[str]) -> Column:
        return F.coalesce(*[blank_to_null(F.col(f"e_{c}").cast("string")) for c in names])

    catalyst = best.select(*keys, "CatalystScore", first_text(dates).alias("PrimaryCatalystDate"),
                           first_text(kinds).alias("PrimaryCatalystType"), first_text(urls).alias("PrimaryCatalystURL"))

    cells = _evidence_cells(hits, keys, form, "f_URL", seq)

    # the shortlist's own catalyst is the latest one; research scores the earliest Tier-1 event instead
    out = shortlist.drop("PrimaryCatalystDate", "PrimaryCatalystType", "PrimaryCatalystURL")
    for part in (per_company, catalyst, cells):
        out = out.join(part, keys, "left")
    out = out.withColumns({
        "__runway_url": F.coalesce("__runway_url", empty()), "__catalyst_url": F.coalesce("PrimaryCatalystURL", empty())})
    out = out.withColumns({
        "__has_Runway": is_primary_source(F.col("__runway_url")), "__has_Catalyst": is_primary_source(F.col("__catalyst_url")),
        **{f"__has_{k}": F.coalesce(f"__has_{k}", F.lit(False)) for k in ("Dilution", "Governance", "Insider")}})
    out = out.withColumns({
        "EvidencePart": F.coalesce("EvidencePart", F.lit(0)),
        **{c: F.coalesce(c, F.lit("TBD")) for c in ("DilutionScore", "GovernanceScore", "InsiderScore")},
        "CatalystScore": F.coalesce("CatalystScore", F.lit("None")),
        "GoingConcernFlag": F.coalesce("GoingConcernFlag", F.lit("N"))})
    out = out.withColumn("Catalyst", F.concat_ws(": ", "CatalystScore", "PrimaryCatalystType"))
    evidenced = {
        "Runway": F.col("RunwayQuarters").isNotNull(), "Dilution": F.col("DilutionScore") != "TBD",
        "Catalyst": F.lit(True), "Governance": F.col("GovernanceScore") != "TBD",
        "Insider": F.col("InsiderScore") != "TBD"}
    out = out.withColumns({f"__ok_{k}": v & F.col(f"__has_{k}") for k, v in evidenced.items()})
    out = out.withColumns({
        "__count": reduce(lambda a, b: a + b, [F.col(f"__ok_{k}").cast("int") for k in _KINDS]),
        "__must": F.col("__ok_Dilution") & F.col("__ok_Runway") & F.col("__ok_Catalyst")})
    out = out.withColumn("Materiality", materiality(F.col("__count"), F.col("Catalyst"), F.col("__must")))

    def given(name: str) -> Column:
        return F.col(name) if name in shortlist.columns else F.lit(None).cast("string")

    biotech = is_biotech(given("Sector"), given("Industry"))
    peer_note = F.lit("Peer: stub")
    if peers is not None:
        best_peer = peers.where(tier_rank("Tier") == 3).select(F.lower("Industry").alias("__ind"), F.col("Ticker").alias("__peer"))
        # two smallest peers per industry are enough to find one that is not the company itself
        two = top_rows(best_peer.distinct(), ["__ind"], [F.asc("__peer")], 2).groupBy("__ind").agg(
            F.min("__peer").alias("__p1"), F.max("__peer").alias("__p2"))
        out = out.withColumn("__ind", F.lower(given("Industry"))).join(two, "__ind", "left")
        other = F.when(F.col("__p1") != F.col("Ticker"), F.col("__p1")).when(F.col("__p2") != F.col("Ticker"), F.col("__p2"))
        peer_note = F.coalesce(F.concat(F.lit("Peer: "), other), empty())
    field = F.when(~biotech, "N").when(peer_note == "", "TBD").otherwise(F.concat(F.lit("Y:"), peer_note))
    count, must, mat = F.col("__count"), F.col("__must"), F.col("Materiality")
    price = F.coalesce(*[given(c).cast("double") for c in ("Price", "Close") if c in shortlist.columns], F.lit(None).cast("double"))

    def cell(name: str) -> Column:
        return F.coalesce(f"__{name}", empty())

    def listed(name: str, *known: str) -> Column:
        """Links of a cell without the ones already named."""
        return F.filter(F.split(cell(name), ";"), lambda x: (x != "") & ~x.isin(*[F.col(c) for c in known]))

    start = F.col("EvidencePart") == 0
    later_dilution = F.when(start, listed("Dilution", "__runway_url")).otherwise(listed("Dilution", "__runway_url", "__catalyst_url"))
    single = {c: F.when(start, F.array(F.col(c))).otherwise(F.array().cast("array<string>")) for c in ("__runway_url", "__catalyst_url")}
    every = F.array_distinct(F.concat(
        single["__runway_url"], later_dilution, single["__catalyst_url"], listed("Rest", "__runway_url", "__catalyst_url")))
    out = out.withColumn("__links", F.filter(every, lambda x: x != ""))
    out = out.withColumns({
        "__Primary": F.array_join(F.filter("__links", is_primary_source), ";"),
        "__Secondary": F.array_join(F.filter("__links", lambda x: ~is_primary_source(x)), ";")})

    return out.select(
        "Ticker", "EvidencePart", "Company", "CIK", given("Sector").alias("Sector"), given("Industry").alias("Industry"),
        price.alias("Price"), given("MarketCap").cast("double").alias("MarketCap"),
        given("ADV20").cast("double").alias("ADV20"), "RunwayQuarters",
        F.coalesce(F.col("RunwayQuarters").cast("string"), F.lit("TBD")).alias("Runway (qtrs)"),
        "DilutionScore", F.col("DilutionScore").alias("Dilution"), "CatalystScore", "Catalyst",
        "GovernanceScore", F.col("GovernanceScore").alias("Governance"), "InsiderScore",
        F.col("InsiderScore").alias("Insider"),
        F.col("__runway_url").alias("RunwayEvidencePrimary"), cell("Dilution").alias("DilutionEvidencePrimary"),
        F.col("__catalyst_url").alias("CatalystEvidencePrimary"), cell("Governance").alias("GovernanceEvidencePrimary"),
        cell("Insider").alias("InsiderEvidencePrimary"),
        cell("Primary").alias("Evidence (Primary links)"), cell("Secondary").alias("Evidence (Secondary links)"),
        cell("Primary").alias("EvidencePrimary"), cell("Secondary").alias("EvidenceSecondary"),
        "PrimaryCatalystDate",
        "PrimaryCatalystType", "PrimaryCatalystURL", "LastDilutionEventDate", "LastInsiderBuyDate", "GoingConcernFlag",
        F.when(biotech, "Y").otherwise("N").alias("BiotechPeerRead"),
        field.alias("Biotech Peer Read-Through (Y/N + link)"),
        F.when(biotech, peer_note).otherwise("").alias("BiotechPeerEvidence"),
        count.alias("SubscoresEvidencedCount"), count.alias("Subscores Evidenced (x/5)"),
        "Materiality", mat.alias("Materiality (pass/fail + note)"),
        conviction(count, F.col("Catalyst"), mat).alias("ConvictionScore"),
        research_status(must, count, mat, field).alias("Status"))


def runway_coverage(research: DataFrame) -> DataFrame:
    """Candidates in total, with a runway number, without one, and with evidence only."""
    one = research.select("Ticker", "CIK", "RunwayQuarters", "RunwayEvidencePrimary").distinct()
    has = F.col("RunwayQuarters").isNotNull()
    return one.agg(
        F.count("*").alias("Total"), F.count_if(has).alias("WithQuarters"), F.count_if(~has).alias("Missing"),
        F.count_if(~has & (F.col("RunwayEvidencePrimary") != "")).alias("EvidenceOnly"))


# ---------------------------------------------------------------- validation

def _has(df: DataFrame, name: str) -> Column:
    if name not in df.columns:
        return F.lit(False)
    text = strip(F.col(f"`{name}`").cast("string"))
    return F.coalesce(~text.isin(*NO_VALUE), F.lit(False))


def validate(df: DataFrame) -> DataFrame:
    """Re-check the research row; adds Status and Reason (null and blank count as absent).

    Evidence counts for a candidate in whichever part of its cells it stands, so all parts get the same verdict.
    """
    candidate = Window.partitionBy("Ticker", "CIK")

    def shown(name: str) -> Column:
        here = _has(df, name)
        return F.max(here).over(candidate) if "EvidencePart" in df.columns and name in df.columns else here

    def first(*names: str) -> Column:
        found = [F.col(f"`{n}`").cast("string") for n in names if n in df.columns]
        return F.coalesce(*found, empty())

    dilution = (_has(df, "Dilution") | _has(df, "DilutionScore")) & shown("DilutionEvidencePrimary")
    runway = (_has(df, "RunwayQuarters") | _has(df, "Runway (qtrs)")) & shown("RunwayEvidencePrimary")
    catalyst = (_has(df, "Catalyst") | _has(df, "CatalystScore")) & shown("CatalystEvidencePrimary")
    count = F.coalesce(first("Subscores Evidenced (x/5)", "SubscoresEvidencedCount").try_cast("int"), F.lit(0))
    material = materiality_passed(first("Materiality (pass/fail + note)", "Materiality"))
    peer = ~F.upper(strip(first("BiotechPeerRead", "Biotech Peer Read-Through (Y/N + link)"))).startswith("TBD")
    reasons = F.array_compact(F.array(
        F.when(~runway, "Mandatory subscore missing: Runway"),
        F.when(~dilution, "Mandatory subscore missing: Dilution"),
        F.when(~catalyst, "Mandatory subscore missing: Catalyst"),
        F.when(count < 4, "Subscores <4/5"), F.when(~peer, "Biotech peer missing"),
        F.when(~material, "Materiality fail")))
    checked = df.withColumn("__reasons", reasons)
    good = F.size("__reasons") == 0
    return checked.withColumns({
        "Status": F.when(good, "Validated").otherwise(EXCLUDE),
        "Reason": F.array_join("__reasons", "; ")}).drop("__reasons")


def complete_research(research: DataFrame, universe: DataFrame, shortlist: DataFrame) -> DataFrame:
    """Research rows with gaps filled from the universe, then from the shortlist."""
    return backfill(backfill(research, universe, ["Ticker", "CIK"]), shortlist, ["Ticker", "CIK"])


def validated_selections(checked: DataFrame) -> DataFrame:
    """Report of the validated candidates; a candidate whose cells continue has a row for each part."""
    def first(*names: str) -> Column:
        found = [F.col(f"`{n}`") for n in names if n in checked.columns]
        return F.coalesce(*found) if found else F.lit(None).cast("string")

    parts = "EvidencePart" in checked.columns
    in_order = Window.partitionBy("Ticker", "CIK").orderBy("EvidencePart").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)

    def first_link(cell: str, other: str) -> Column:
        link = blank_to_null(F.split(first(cell).cast("string"), ";")[0])
        return F.coalesce(F.first(link, ignorenulls=True).over(in_order) if parts else link, first(other))

    rows = checked.where("Status = 'Validated'")
    return rows.select(
        "Ticker", "Company", "CIK", first("Sector").alias("Sector"), first("Industry").alias("Industry"),
        first("Venue", "Exchange").alias("Venue") if "Venue" in checked.columns else F.lit(None).cast("string").alias("Venue"),
        first("Price", "DiscoveryPrice", "Close").alias("Price"),
        first("MarketCap", "Cap_Musd", "Cap($M)").alias("MarketCap"), first("ADV20", "ADV20_k").alias("ADV20"),
        F.coalesce(first("Runway (qtrs)").cast("string"), first("RunwayQuarters").cast("string")).alias("Runway (qtrs)"),
        first("RunwayQuarters").alias("RunwayQuarters"), first("RunwayEvidencePrimary").alias("RunwayEvidencePrimary"),
        first("Dilution", "DilutionScore").alias("DilutionScore"),
        first("DilutionEvidencePrimary").alias("DilutionEvidencePrimary"),
        first("Catalyst", "CatalystScore").alias("CatalystScore"),
        first("CatalystEvidencePrimary").alias("CatalystEvidencePrimary"),
        first("Governance", "GovernanceScore").alias("GovernanceScore"),
        first("Insider", "InsiderScore").alias("InsiderScore"),
        first("BiotechPeerRead", "Biotech Peer Read-Through (Y/N + link)").alias("BiotechPeerRead"),
        first("SubscoresEvidencedCount", "Subscores Evidenced (x/5)").alias("SubscoresEvidencedCount"),
        first("Materiality", "Materiality (pass/fail + note)").alias("Materiality"),
        first("ConvictionScore").alias("ConvictionScore"), first("PrimaryCatalystDate").alias("PrimaryCatalystDate"),
        first("PrimaryCatalystType").alias("PrimaryCatalystType"),
        first_link("Evidence (Primary links)", "RunwayEvidencePrimary").alias("PrimarySource"),
        first_link("Evidence (Secondary links)", "EvidenceSecondary").alias("SecondarySource"),
        "Status", F.col("Status").alias("ValidationStatus"), *(["EvidencePart"] if parts else []))


def exclusions(checked: DataFrame) -> DataFrame:
    """Report of the rejected candidates and why."""
    rows = checked.where("Status <> 'Validated'")
    names = ("Ticker", "Company", "CIK", "Sector", "Industry", "Reason", "Materiality", "Status")
    report = rows.select([(F.col(n) if n in checked.columns else F.lit(None).cast("string")).alias(n) for n in names])
    return report.distinct() if "EvidencePart" in checked.columns else report


def reason_counts(excluded: DataFrame) -> DataFrame:
    return excluded.where("Reason <> ''").groupBy("Reason").agg(F.count("*").alias("Rows"))


# ---------------------------------------------------------------- older research tables

BUNDLE_CELLS = ("CatalystEvidencePrimaryLinks", "DilutionLinks", "FilingsSummary", "FilingURLsAll", "FDA_URLsAll", "FDA_Summary")
_BUNDLE_CORE = ("Ticker", "Company", "CIK", "Sector", "LatestForm", "FiledAt", "FilingURL", "FDA_EventType", "FDA_Date", "FDA_URL")


def research_bundle(hydrated: DataFrame) -> DataFrame:
    """Catalyst choice, link union and dilution reading of hydrated rows (with evidence cells, in any number of parts)."""
    key = hydrated.withColumn("Ticker", clean_text("Ticker"))
    return bundle(one_row_each(key, EVIDENCE_CELLS), split_cells(key, ["Ticker"], EVIDENCE_CELLS), "Ticker")


def bundle(core: DataFrame, lines: DataFrame, key: str = "CIK", lines_per_part: int | None = None,
           cells: Sequence[str] = BUNDLE_CELLS) -> DataFrame:
    """:func:`research_bundle` from core rows and evidence lines ``(key, Cell, place, Text)``.

    Flag, forms and notes are aggregates over all lines of a company. The cells, which may continue over several rows
    (EvidencePart), are made last. Without the cells that print lines as they are, these may hold a link at several places
    (``every_link`` of :func:`filings.evidence_lines`), are read once for each use and not written.
    """
    def text(name: str) -> Column:
        return clean_text(F.col(name).cast("string")) if name in core.columns else empty()

    fda = text("FDA_EventType")
    primary = F.when(fda != "", text("FDA_URL")).otherwise(text("FilingURL"))
    core = stored_once(core.select(*[c for c in dict.fromkeys((key, *_BUNDLE_CORE)) if c in core.columns]), "bundle-core")
    plain = [c for c in cells if c not in BUNDLE_CELLS[:2]]
    lines = lines.select(key, "Cell", "place", "Text")
    if plain:
        lines = stored_once(lines, "bundle-lines")
    summary = lines.where("Cell = 'FilingsSummary'").select(key, "place", F.explode(pieces(F.col("Text"))).alias("Text")).where("lower(Text) <> 'nan'")
    hits = evaluate_once(summary.select(key, "place", dilution_line(F.col("Text")).alias("d")), "d").where("d.hit").select(key, "place", "d.form", "d.link")
    hits = stored_once(hits, "bundle-hits")
    forms = hits.where("form <> ''").groupBy(key, "form").agg(F.min("place").alias("place"))
    forms = forms.groupBy(key).agg(F.transform(F.array_sort(F.collect_list(F.struct("place", "form"))), lambda x: x["form"]).alias("__forms"))

    # links: the primary one, then clearances, then filings, each once; a cell's lines keep their order
    def moved(cell: str, rank: int) -> DataFrame:
        at = F.struct((F.col("place.a") + F.lit(rank << 40)).alias("a"), F.col("place.b").alias("b"))
        return lines.where(F.col("Cell") == cell).select(key, at.alias("place"), F.explode(split_evidence("Text")).alias("Text"))

    first = core.select(key, F.struct(F.lit(0).cast("bigint").alias("a"), F.lit(0).cast("bigint").alias("b")).alias("place"), primary.alias("Text"))
    union = first.where("Text <> ''").unionByName(moved("FDA_URLsAll", 1)).unionByName(moved("FilingURLsAll", 2))
    links = union.withColumn("Cell", F.lit(BUNDLE_CELLS[0])).unionByName(
        hits.where("link <> ''").select(key, "place", F.col("link").alias("Text"), F.lit("DilutionLinks").alias("Cell")))
    # counted, then joined: two passes over what is printed
    printed = first_seen(links.where(F.col("Cell").isin(*cells)), [key])
    if plain:
        printed = printed.unionByName(lines.where(F.col("Cell").isin(*plain)).select(key, "Cell", "Text", "place"))
    printed = stored_once(printed, "bundle-printed")
    found = placed_cells(printed, [key], cells, {"FilingsSummary": "\n", "FDA_Summary": "\n"}, lines_per_part, written=True)

    rows = with_parts(core.join(forms, key, "left"), found, [key], cells)
    none = F.coalesce("__forms", F.array().cast("array<string>"))
    cell = {c: [F.coalesce(c, empty()).alias(c)] if c in cells else [] for c in BUNDLE_CELLS}
    return rows.select(
        text("Ticker").alias("Ticker"), "EvidencePart",
        text("Company").alias("Company"), text("CIK").alias("CIK"), text("Sector").alias("Sector"),
        catalyst_by_form(text("LatestForm"), fda).alias("CatalystType"),
        first_nonblank(text("FDA_Date"), text("FiledAt")).alias("CatalystDate"),
        primary.alias("CatalystPrimaryLink"), *cell["CatalystEvidencePrimaryLinks"],
        empty().alias("CatalystEvidenceSecondaryLinks"),
        F.when(F.size(none) > 0, "TRUE").otherwise("FALSE").alias("HasDilutionFlag"),
        F.array_join(none, "; ").alias("DilutionForms"), *cell["DilutionLinks"], dilution_notes(none).alias("DilutionNotes"),
        *[empty().alias(c) for c in ("RunwayCash", "RunwayQuarterlyBurn", "RunwayQuarters")],
        F.lit("TODO: parse 10-Q/10-K to compute runway").alias("RunwayNotes"),  # fixed value: the next step fills it
        text("LatestForm").alias("LatestForm"), text("FiledAt").alias("FiledAt"), text("FilingURL").alias("FilingURL"),
        *cell["FilingsSummary"], *cell["FilingURLsAll"], fda.alias("FDA_EventType"), text("FDA_Date").alias("FDA_Date"),
        text("FDA_URL").alias("FDA_URL"), *cell["FDA_URLsAll"], *cell["FDA_Summary"])


_CATEGORIES = {
    "Dilution": R.CATEGORY_DILUTION, "Catalyst": R.CATEGORY_CATALYST,
    "Governance": R.CATEGORY_GOVERNANCE, "Insider": R.CATEGORY_INSIDER,
}

CATEGORIES = tuple(_CATEGORIES)


def category_lines(filings: DataFrame, as_of: AsOf, ordinal: str = "ord", rules: Rules = RULES) -> DataFrame:
    """``(CIK, Cell, place, Text)``: the filings of each category as ``date form link`` lines.

    Repeated texts are listed once, except for catalysts.
    """
    form = upper_key("Form")
    recent = filings.where(F.col("FiledAt").isNotNull() & (form != "") & within_retention(as_of, rules, "drop"))
    hits = F.array_compact(F.array(*[F.when(starts_any(form, p), n) for n, p in _CATEGORIES.items()]))
    line = F.concat_ws(" ", iso("FiledAt"), form, blank_to_null(strip("URL")))
    rows = recent.select(
        cik("CIK").alias("CIK"), place_of("FiledAt", ordinal).alias("place"), line.alias("Text"), F.explode(hits).alias("Cell"))
    rows = rows.where("CIK != ''")
    once = first_seen(rows.where("Cell <> 'Catalyst'"), ["CIK"])
    return once.unionByName(rows.where("Cell = 'Catalyst'"))


def category_evidence(filings: DataFrame, as_of: AsOf, ordinal: str = "ord", rules: Rules = RULES,
                      lines_per_part: int | None = None) -> DataFrame:
    """:func:`category_lines` as cells per CIK and part, newest first."""
    return placed_cells(category_lines(filings, as_of, ordinal, rules), ["CIK"], tuple(_CATEGORIES), None, lines_per_part)


def legacy_materiality(catalyst: Column, dilution: Column, governance: Column) -> Column:
    return (
        F.when(catalyst & dilution, "High").when(catalyst, "Medium").when(dilution | governance, "Low").otherwise("")
    )


def legacy_status(catalyst: Column, dilution: Column, governance: Column) -> Column:
    return (
        F.when(catalyst, "Active").when(dilution, "Dilution Watch").when(governance, "Governance Watch").otherwise("Stale")
    )


SCORE_COLUMNS = ("Materiality", "SubscoresEvidenced", "Status")


def manual_scores(tables: list[DataFrame], key: str, columns: tuple[str, ...] = SCORE_COLUMNS,
                  ordinal: str = "ord") -> DataFrame:
    """Manual values per key: a later table, then a later row, overrides column by column.

    Rows with a CIK are only found by CIK, rows without one by ticker.
    """
    parts = []
    for i, table in enumerate(tables):
        own = cik("CIK") if "CIK" in table.columns else empty()
        name = ticker("Ticker") if "Ticker" in table.columns else empty()
        value = own if key == "CIK" else F.when(own == "", name).otherwise("")
        parts.append(table.select(
            value.alias(key), F.struct(F.lit(i).alias("t"), F.col(ordinal).alias("o")).alias("__at"),
            *[(blank_to_null(F.col(c).cast("string")) if c in table.columns else F.lit(None).cast("string")).alias(c)
              for c in columns]))
    rows = reduce(DataFrame.unionByName, parts).where(F.col(key) != "")
    return rows.groupBy(key).agg(*[
        F.max_by(F.when(F.col(c).isNotNull(), F.col(c)), F.when(F.col(c).isNotNull(), F.col("__at"))).alias(c)
        for c in columns])


def with_manual_scores(df: DataFrame, tables: list[DataFrame], columns: tuple[str, ...] = SCORE_COLUMNS,
                       ordinal: str = "ord") -> DataFrame:
    """Attach ``seed_<column>``: by CIK when that has any manual value, else by ticker."""
    out = df.withColumns({"__cik": cik("CIK"), "__tkr": ticker("Ticker")})
    for key, own, tag in (("CIK", "__cik", "c"), ("Ticker", "__tkr", "t")):
        table = manual_scores(tables, key, columns, ordinal)
        table = table.where(any_of(F.col(c).isNotNull() for c in columns))
        out = out.join(table.select(F.col(key).alias(own), F.lit(True).alias(f"__hit_{tag}"),
                                    *[F.col(c).alias(f"__{tag}_{c}") for c in columns]), own, "left")
    hit = F.coalesce("__hit_c", F.lit(False))
    out = out.withColumns({f"seed_{c}": F.when(hit, F.col(f"__c_{c}")).otherwise(F.col(f"__t_{c}")) for c in columns})
    return out.drop("__cik", "__tkr", "__hit_c", "__hit_t", *[f"__{t}_{c}" for t in "ct" for c in columns])


def populate_research(research: DataFrame, filings: DataFrame, as_of: AsOf, fda: DataFrame | None = None,
                      manual: list[DataFrame] | None = None, ordinal: str = "ord", rules: Rules = RULES,
                      lines_per_part: int | None = None) -> DataFrame:
    """Category evidence, materiality, subscores and status of the older research table.

    `research` has one row per company; what is decided comes from the lines of all its filings. The result has one row per
    company and part of its category cells; ordinary companies have part 0 only.
    """
    lines = stored_once(category_lines(filings, as_of, ordinal, rules), "category-lines")
    cells = placed_cells(lines, ["CIK"], tuple(_CATEGORIES), None, lines_per_part)
    flags = lines.groupBy("CIK").agg(*[F.bool_or(F.col("Cell") == n).alias(f"__has_{n}") for n in _CATEGORIES])
    base = research.drop(*[c for c in (*_CATEGORIES, "EvidencePart") if c in research.columns])
    out = with_manual_scores(base, manual, ordinal=ordinal) if manual else base.withColumns(
        {f"seed_{c}": F.lit(None).cast("string") for c in SCORE_COLUMNS})
    for c in SCORE_COLUMNS:
        if c not in out.columns:
            out = out.withColumn(c, F.lit(None).cast("string"))
    out = out.withColumn("CIK", cik("CIK")).join(flags, "CIK", "left").join(cells, "CIK", "left")
    if fda is None:
        out = out.withColumn("__fda", F.lit(None).cast("string"))
    else:
        pieces = [c for c in ("EventType", "Product", "Status", "URL") if c in fda.columns]
        keyed = fda.withColumn("CIK", cik("CIK")).where("CIK != ''")
        latest = latest_per_cik(keyed, "DecisionDate", ordinal)
        out = out.join(latest.select("CIK", fda_line(pieces).alias("__fda")), "CIK", "left")
    has = {n: F.coalesce(f"__has_{n}", F.lit(False)) for n in _CATEGORIES}
    has["Catalyst"] = has["Catalyst"] | F.coalesce(F.col("__fda") != "", F.lit(False))
    trio = (has["Catalyst"], has["Dilution"], has["Governance"])
    subs = F.concat(
        split_evidence("seed_SubscoresEvidenced"), split_evidence("SubscoresEvidenced"),
        *[F.when(has[n], F.array(F.lit(n))).otherwise(F.array().cast("array<string>"))
          for n in ("Catalyst", "Dilution", "Governance", "Insider")])
    return out.withColumns({
        "EvidencePart": F.coalesce("EvidencePart", F.lit(0)),
        "Catalyst": F.coalesce(blank_to_null("__fda"), F.col("Catalyst"), empty()),
        **{n: F.coalesce(n, empty()) for n in ("Dilution", "Governance", "Insider")},
        "Materiality": F.coalesce(blank_to_null("seed_Materiality"), blank_to_null("Materiality"), legacy_materiality(*trio)),
        "SubscoresEvidenced": F.array_join(F.array_distinct(subs), "; "),
        "Status": F.coalesce(blank_to_null("seed_Status"), blank_to_null("Status"), legacy_status(*trio)),
    }).drop("__fda", *[f"__has_{n}" for n in _CATEGORIES], *[f"seed_{c}" for c in SCORE_COLUMNS])


# ---------------------------------------------------------------- clearance look-up targets

def usable_entities(entities: DataFrame, ordinal: str = "ord") -> DataFrame:
    """Mapped regulator entities above low confidence, first row per entity name."""
    good = entities.where(F.lower(F.coalesce("Confidence", empty())) != "low")
    named = good.withColumn("FDA_EntityName", strip("FDA_EntityName")).where("FDA_EntityName != ''")
    return top_rows(named, ["FDA_EntityName"], [F.asc(ordinal)])


def upsert_entities(current: DataFrame, incoming: DataFrame, ordinal: str | None = None) -> DataFrame:
    """Add the pairs (entity, ticker) not stored yet; of repeated ones the last by ``ordinal``, else the greatest row."""
    keys = ["FDA_EntityName", "Ticker"]
    fresh = one_per_key(incoming, keys, ordinal).join(current.select(*keys), keys, "left_anti")
    return current.unionByName(fresh.select(*current.columns))


def entity_targets(filings: DataFrame, entities: DataFrame, ordinal: str = "ord") -> DataFrame:
    """Names to look up: mapped entities of the filing tickers, else the company's own name; each name once."""
    companies = filings.select(
        strip("Company").alias("Company"), strip(F.coalesce("CIK", empty())).alias("CIK"),
        strip(F.coalesce("Ticker", empty())).alias("Ticker"), ordinal)
    tickers = companies.where("Ticker != ''").select(F.upper("Ticker").alias("__t")).distinct()
    mapped = usable_entities(entities.join(tickers, F.upper("Ticker") == F.col("__t"), "left_semi"), ordinal)
    mapped = mapped.select(F.col("FDA_EntityName").alias("Company"), strip("CIK").alias("CIK"), strip("Ticker").alias("Ticker"))
    own = top_rows(companies.where("Company != ''"), ["Company", "CIK", "Ticker"], [F.asc(ordinal)])
    own = own.join(mapped.select("Ticker").where("Ticker != ''").distinct(), "Ticker", "left_anti")
    own = own.join(mapped.select("Company"), "Company", "left_anti")
    own = top_rows(own, ["Company"], [F.asc(ordinal)]).select("Company", "CIK", "Ticker")
    return mapped.withColumn("Mapped", F.lit(True)).unionByName(own.withColumn("Mapped", F.lit(False)))
