"""Validated watchlist: the ordered drop chain and the report columns."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from capsieve import rules as R
from capsieve.functions.dates import age_days, as_date, is_iso, iso, parse_date
from capsieve.functions.forms import form_name, is_manager_form
from capsieve.functions.text import (
    blank_to_null, cik, clean_text, contains_any, empty, first_nonblank, first_url, to_bool, to_number,
    urls_in,
)
from capsieve.functions.urls import url_matches_form
from capsieve.operators import evidence as ev
from capsieve.operators.events import catalyst_label, match_events, tier1_trigger
from capsieve.operators.gates import watchlist_market_gate
from capsieve.operators.keyed import evaluate_once, one_row_each
from capsieve.operators.lines import deciding_cells, full_lists, split_cells
from capsieve.operators.market import merge_market
from capsieve.operators.runway_rules import bucket, runway_days
from capsieve.rules import RULES, Rules
from capsieve.schemas import WATCHLIST_COLUMNS

AsOf = dt.date | str | Column

CHECKS = ("Catalyst", "Dilution", "Runway", "Governance", "Insider", "Ownership")


def event_override(summary: Column, event: Column, as_of: AsOf) -> Column:
    """A matched catalyst event replaces the primary evidence."""
    is_catalyst = F.coalesce(event["IsCatalyst"], F.lit(False))
    label = event_text(event)
    date = first_nonblank(event["FilingDate"], summary["date"])
    days = F.coalesce(age_days(as_of, parse_date(event["FilingDate"])).cast("string"), empty())
    replaced = F.struct(
        F.lit("Pass").alias("status"), F.lit("8-K").alias("form"), date.alias("date"), days.alias("days_ago"),
        F.coalesce(event["FilingURL"], empty()).alias("url"), label.alias("text"), label.alias("raw"))
    return F.when(is_catalyst, replaced).otherwise(summary)


def event_text(event: Column) -> Column:
    label = F.concat_ws(" ", event["CatalystType"], F.when(event["CatalystType"] == "Tier-1", blank_to_null(event["Tier1Type"])))
    return F.when(F.coalesce(event["IsCatalyst"], F.lit(False)), label).otherwise("")


#: Cells that may continue in later parts, the ones that verdicts are read from, and those whose links lead to events.
CELLS = ("Catalyst", "Dilution", "Governance", "Insider", "Ownership", "FilingsSummary", "FilingURLsAll", "FDA_URLsAll", "FDA_Summary",
         "CatalystEvidencePrimaryLinks", "DilutionLinks", "RunwayNotes")
DECIDING = ("Catalyst", "Dilution", "Governance", "FilingsSummary")
LINKED = ("CatalystPrimaryLink", "CatalystPrimaryURL", "Catalyst", "Dilution", "DilutionLinks", "FilingsSummary")


def _of(df: DataFrame, name: str) -> Column:
    return clean_text(F.col(name), ("nan",)) if name in df.columns else empty()


def _one_row_each(research: DataFrame) -> tuple[DataFrame, DataFrame]:
    """One row per company, and the rows of those whose cells continue.

    A company with continued cells is judged on the lines that can decide (:func:`lines.deciding_lines`), taken from all
    its parts; its other cells are those of the first part.
    """
    more = research.where("EvidencePart > 0").select("__row").distinct()
    long = research.join(more, "__row", "left_semi")
    held = [c for c in CELLS if c in research.columns]
    few = deciding_cells(split_cells(long, ["__row"], DECIDING), ["__row"], [c for c in DECIDING if c in held])
    rest = [c for c in held if c not in DECIDING]
    first = long.groupBy("__row").agg(F.min("EvidencePart").alias("__p"), *[F.min_by(c, "EvidencePart").alias(c) for c in rest]).drop("__p")
    core = one_row_each(long, held).join(few, "__row", "left").join(first, "__row", "left")
    short = research.join(more, "__row", "left_anti").drop("EvidencePart")
    return short.unionByName(core), long


def _continued(checked: DataFrame, long: DataFrame) -> DataFrame:
    """Verdicts with the whole lists of evidence again: a row for each part of a company's cells."""
    own = long.select("__row", "EvidencePart", *[_of(long, c).alias(f"__{c}") for c in ("Dilution", "Governance", "Insider", "Ownership", "RunwayNotes")])
    lists = full_lists(split_cells(long, ["__row"], ("Dilution", "Governance")), ["__row"], {"Dilution": "__dil", "Governance": "__gov"})
    parts = own.join(lists, ["__row", "EvidencePart"], "full")
    whole = Window.partitionBy("__row")
    parts = parts.withColumns({
        "__dil": F.when(F.max("__dil").over(whole).isNull(), F.col("__Dilution")).otherwise(F.col("__dil")),
        "__gov": F.when(F.max("__gov").over(whole).isNull(), F.col("__Governance")).otherwise(F.col("__gov"))})
    out = checked.join(parts, "__row", "left")
    later, has = F.coalesce(F.col("EvidencePart") > 0, F.lit(False)), F.col("EvidencePart").isNotNull()

    def shown(name: str, value: Column) -> Column:
        return F.when(has, F.coalesce(value, empty())).otherwise(F.col(name))

    cells = {
        "DilutionEvidenceAll": F.when(F.col("__on_dilution"), F.when(later, empty()).otherwise(F.col("DilutionEvidenceAll"))).otherwise(
            shown("DilutionEvidenceAll", F.col("__dil"))),
        "GovernanceEvidenceAll": shown("GovernanceEvidenceAll", F.col("__gov")), "RunwayNotes": shown("RunwayNotes", F.col("__RunwayNotes")),
        "Insider": shown("Insider", F.col("__Insider")), "Ownership": shown("Ownership", F.col("__Ownership")),
        "InsiderForms345Links": shown("InsiderForms345Links", F.array_join(ev.links_like("__Insider", R.INSIDER_LINK), "; ")),
        "OwnershipLinks": shown("OwnershipLinks", F.array_join(ev.links_like("__Ownership", R.OWNERSHIP_LINK), "; ")),
        "EvidencePart": F.coalesce("EvidencePart", F.lit(0))}
    return out.withColumns(cells).select("EvidencePart", *checked.columns)


def check_research(research: DataFrame, market: DataFrame, events: DataFrame, as_of: AsOf, rules: Rules = RULES,
                   ordinal: str = "ord") -> DataFrame:
    """Every research row with its report columns and ``DropReason`` ('' for survivors).

    A company gets one verdict however many parts its evidence cells have (EvidencePart): every part shows the same verdict, and
    its parts together list all evidence. Companies are told apart by Ticker and CIK.
    """
    keyed = research.withColumn("__row", F.concat_ws("|", F.coalesce("Ticker", empty()), F.coalesce("CIK", empty())))
    order = F.array(*[urls_in(_of(keyed, c)) for c in LINKED])
    part = F.col("EvidencePart") if "EvidencePart" in keyed.columns else F.lit(0)
    links = keyed.select("__row", part.cast("bigint").alias("__part"), F.posexplode(order).alias("__cell", "__urls"))
    links = links.select("__row", "__part", "__cell", F.posexplode("__urls").alias("__i", "link"))
    links = links.select("__row", F.struct("__cell", "__part", "__i").alias("pos"), "link")
    if "EvidencePart" not in keyed.columns:
        return _judge(keyed, links, market, events, as_of, rules, ordinal).drop("__row", "__on_dilution")
    rows, long = _one_row_each(keyed)
    checked = _continued(_judge(rows, links, market, events, as_of, rules, ordinal), long)
    return checked.drop("__row", "__on_dilution")


def _judge(research: DataFrame, links: DataFrame, market: DataFrame, events: DataFrame, as_of: AsOf, rules: Rules, ordinal: str) -> DataFrame:
    """Verdicts of rows with one row per company. Apart from the look-ups of market data and events everything is row-local."""
    given = set(research.columns)

    def text(name: str) -> Column:
        return _of(research, name)

    def number(name: str) -> Column:
        return to_number(name) if name in given else F.lit(None).cast("double")

    rows = merge_market(research, market, ordinal)
    rows = match_events(rows, events, "__row", links, ordinal)
    event = F.col("event")
    on_catalyst = F.coalesce(event["IsCatalyst"], F.lit(False))
    on_dilution = F.coalesce(event["IsDilution"], F.lit(False))
    label = event_text(event)

    # runway
    quarters_raw = F.coalesce(number("RunwayQuartersRaw"), number("RunwayQuarters"))
    cash_raw = F.coalesce(number("RunwayCashRaw"), number("RunwayCash"))
    burn_raw = F.coalesce(number("RunwayQuarterlyBurnRaw"), number("RunwayQuarterlyBurn"))
    cash_own = number("RunwayCash") if "RunwayCash" in given else cash_raw
    burn_own = number("RunwayQuarterlyBurn") if "RunwayQuarterlyBurn" in given else burn_raw
    rows = rows.withColumns({
        "q_raw": quarters_raw, "c_raw": cash_raw, "b_raw": burn_raw, "q": F.round(quarters_raw, 2),
        "c": F.round(cash_own, 2), "b": F.round(burn_own, 2),
        "src_form": form_name(text("RunwaySourceForm")), "src_date": parse_date(text("RunwaySourceDate")),
        "src_url": text("RunwaySourceURL"), "estimate": text("RunwayEstimate"),
        "cat_text": F.when((text("Catalyst") == "") & on_catalyst, label).otherwise(text("Catalyst")),
        "dil_text": text("Dilution"), "gov_text": text("Governance")})
    has = F.col("q").isNotNull() & F.col("c").isNotNull() & F.col("b").isNotNull()
    no_burn = ~F.coalesce(F.col("b_raw") > 0, F.lit(False)) & ~F.coalesce(F.col("b") > 0, F.lit(False))
    stale = F.datediff(as_date(as_of), "src_date") > rules.runway_stale_days
    no_source = (F.col("src_form") == "") | F.col("src_date").isNull() | (F.col("src_url") == "")

    # evidence
    rows = rows.withColumns({
        "has_runway": has, "cat_e": ev.without_dilution_only_forms(ev.entries("cat_text")), "dil_e": ev.entries("dil_text"),
        "gov_e": ev.entries("gov_text"), "fil_e": ev.without_manager_forms(ev.entries(text("FilingsSummary")))})
    rows = rows.withColumns({f"{k}_p": ev.guarded_entry(F.col(f"{k}_e")) for k in ("cat", "dil", "gov")})
    rows = rows.withColumns({"latest": ev.primary_entry(F.col("fil_e")), "dil_w": ev.watch_dilution(F.col("dil_e"))})
    rows = rows.withColumns({
        "cat_s": event_override(ev.summary_of(F.col("cat_p"), as_of), event, as_of),
        "dil_s": ev.summary_of(F.col("dil_p"), as_of), "gov_s": ev.summary_of(F.col("gov_p"), as_of)})
    own_type = catalyst_label(F.transform("cat_e", lambda e: e["lower"]), F.col("cat_s.form"), F.col("cat_text"))
    own_type = first_nonblank(own_type, text("CatalystType"))
    rows = rows.withColumn("cat_type", F.upper(F.when(on_catalyst, event["CatalystType"]).otherwise(own_type)))
    tiered = F.col("cat_type").isin("TIER-1", "TIER-2")
    cat_field = F.when(on_catalyst & (label != ""), label).otherwise(first_nonblank("cat_s.text", "cat_text"))
    cat_all = F.when(on_catalyst & (label != ""), label).otherwise(
        first_nonblank(ev.format_entries(F.col("cat_e")), F.col("cat_text")))
    dil_status = F.when(on_dilution, "Pass (Offering)").otherwise(F.col("dil_w.status"))
    gov_bad = (F.col("gov_s.form") != "") & ~F.col("gov_s.form").isin(*R.GOVERNANCE_FORMS)

    def gov(name: str) -> Column:
        return F.when(gov_bad, "Missing" if name == "status" else "").otherwise(F.col(f"gov_s.{name}"))

    def cat(c: Column) -> Column:
        return F.when(tiered, c).otherwise("")

    rows = rows.withColumns({
        "CatalystType": F.when(F.col("cat_type") == "TIER-1", "Tier-1").when(F.col("cat_type") == "TIER-2", "Tier-2").otherwise("NONE"),
        "Catalyst": cat(cat_field), "CatalystStatus": F.when(tiered, F.col("cat_s.status")).otherwise("Missing"),
        "CatalystPrimaryForm": cat(F.col("cat_s.form")), "CatalystPrimaryDate": cat(F.col("cat_s.date")),
        "CatalystPrimaryDaysAgo": cat(F.col("cat_s.days_ago")),
        "CatalystPrimaryURL": cat(first_nonblank("cat_s.url", text("CatalystPrimaryLink"))),
        "__cat_all": cat_all,
        "DilutionFlag": F.col("dil_w.flag") | on_dilution, "DilutionStatus": dil_status,
        "DilutionFormsHit": F.when(on_dilution, "8-K").otherwise(F.array_join("dil_w.forms", "; ")),
        "DilutionKeywordsHit": F.when(on_dilution & (event["DilutionTags"] != ""), F.array_join(
            F.array_distinct(F.split(event["DilutionTags"], ";")), "; ")).otherwise(F.array_join("dil_w.keywords", "; ")),
        "DilutionPrimaryForm": F.when(on_dilution, "8-K").otherwise(F.col("dil_s.form")),
        "DilutionPrimaryDate": F.when(on_dilution, first_nonblank(event["FilingDate"], "dil_s.date")).otherwise(F.col("dil_s.date")),
        "DilutionPrimaryDaysAgo": F.col("dil_s.days_ago"),
        "DilutionPrimaryURL": F.when(on_dilution & (event["FilingURL"] != ""), event["FilingURL"]).otherwise(
            first_nonblank("dil_s.url", first_url(text("DilutionLinks")))),
        "DilutionEvidenceAll": F.when(on_dilution, F.concat(F.lit("8-K "), event["FilingURL"])).otherwise(
            first_nonblank(ev.format_entries(F.col("dil_e")), F.col("dil_text"))),
        "Dilution": F.when(on_dilution, "Pass (Offering)").otherwise(first_nonblank("dil_s.text", "dil_text")),
        "GovernanceStatus": gov("status"), "GovernancePrimaryForm": gov("form"), "GovernancePrimaryDate": gov("date"),
        "GovernancePrimaryDaysAgo": gov("days_ago"),
        "GovernancePrimaryURL": F.when(gov_bad, "").otherwise(first_nonblank("gov_s.url", first_url("gov_text"))),
        "Governance": first_nonblank(gov("text"), F.col("gov_text")),
        "GovernanceEvidenceAll": first_nonblank(ev.format_entries(F.col("gov_e")), F.col("gov_text")),
        "GovernanceNotes": first_nonblank("gov_s.raw", "gov_text"),
        "__gov_bad": gov_bad,
        "RunwayStatus": F.when(~F.col("has_runway"), "Missing").when(F.col("q") > 0, "Pass").otherwise("Fail"),
        "RunwaySourceURL": F.when(F.col("has_runway"), F.col("src_url")).otherwise(""),
    })
    statuses = {
        "Catalyst": ev.checklist_status("CatalystStatus"), "Dilution": ev.checklist_status("DilutionStatus"),
        "Runway": ev.checklist_status("RunwayStatus"), "Governance": ev.checklist_status("GovernanceStatus"),
        "Insider": ev.checklist_status(text("InsiderStatus")), "Ownership": ev.checklist_status(text("OwnershipStatus"))}
    rows = rows.withColumns({f"Checklist{k}": v for k, v in statuses.items()})
    errors = F.array_compact(F.array(
        F.when(~is_iso("CatalystPrimaryDate") | ~url_matches_form("CatalystPrimaryForm", "CatalystPrimaryURL"), "CatalystPrimary"),
        F.when((F.col("DilutionPrimaryForm") != "") & ~is_iso("DilutionPrimaryDate"), "DilutionPrimaryDate"),
        F.when((F.col("DilutionPrimaryForm") != "") & ~url_matches_form("DilutionPrimaryForm", "DilutionPrimaryURL"), "DilutionPrimaryURL"),
        F.when(F.col("__gov_bad"), "GovernancePrimaryForm"),
        F.when(F.col("DilutionFlag") & ~F.col("DilutionStatus").isin("Pass (Offering)", "Overhang (S-8)"), "DilutionStatus"),
        F.when(F.col("q").isNull() & ((F.col("RunwayStatus") != "Missing") | (F.col("RunwaySourceURL") != "")), "RunwayMissing")))
    rows = rows.withColumn("__errors", errors)
    no_catalyst = F.upper("cat_text").isin("", "TBD") & ~on_catalyst
    # fixed values: the wording of the published drop reasons
    reason = F.coalesce(
        F.when(~watchlist_market_gate(rules=rules), "Market gate"),
        F.when(no_burn | (F.col("estimate") == ""), "Missing runway burn metrics"),
        F.when(F.col("has_runway") & no_source, "Missing runway source details"),
        F.when(F.col("has_runway") & stale, "Runway filing stale"),
        F.when(no_catalyst, "Catalyst evidence missing"),
        F.when(contains_any(F.lower("dil_text"), R.NEGATIVE_DILUTION_TERMS), "Negative dilution terms"),
        F.when(F.col("gov_text") == "", "Governance text missing"),
        F.when(F.col("cat_s.status") != "Pass", "Catalyst evidence missing"),
        F.when(~F.col("DilutionFlag"), "Dilution filing missing"),
        F.when(F.size("__errors") > 0, F.concat(F.lit("Validation failed: "), F.array_join("__errors", "; "))), empty())

    passed = sum((F.col(f"Checklist{k}") == "Pass").cast("int") for k in CHECKS)
    must = (F.col("ChecklistCatalyst") == "Pass") & (F.col("ChecklistDilution") == "Pass") & (F.col("ChecklistRunway") == "Pass")
    status = F.regexp_replace(text("Status"), "[—–]", "-")
    trigger = tier1_trigger(F.concat_ws(" ", "__cat_all", "DilutionEvidenceAll"))
    strong = on_catalyst & (event["CatalystType"] == "Tier-1")
    fallback = form_name(text("LatestForm"))
    latest_form = first_nonblank("latest.form", F.when(~is_manager_form(fallback), fallback))
    latest_date = F.coalesce("latest.date", parse_date(F.col("FiledAt").cast("string")) if "FiledAt" in given else F.lit(None).cast("date"))
    keep = F.col("has_runway")
    blank = empty()
    checked = rows.select(
        "__row", on_dilution.alias("__on_dilution"), "Ticker",
        text("Company").alias("Company"), text("Sector").alias("Sector"), cik("CIK").alias("CIK"), "Price", "MarketCap", "ADV20",
        latest_form.alias("LatestForm"), iso(latest_date).alias("LatestFiledAt"),
        F.coalesce(age_days(as_of, latest_date).cast("string"), blank).alias("LatestFiledAgeDays"),
        "CatalystType", "Catalyst", "CatalystStatus", "CatalystPrimaryForm", "CatalystPrimaryDate", "CatalystPrimaryDaysAgo",
        "CatalystPrimaryURL", F.col("q_raw").alias("RunwayQuartersRaw"), F.col("q").alias("RunwayQuarters"),
        F.col("c_raw").alias("RunwayCashRaw"), F.col("c").alias("RunwayCash"), F.col("b_raw").alias("RunwayQuarterlyBurnRaw"),
        F.col("b").alias("RunwayQuarterlyBurn"), F.when(keep, F.col("estimate")).otherwise("").alias("RunwayEstimate"),
        text("RunwayNotes").alias("RunwayNotes"), F.when(keep, runway_days(F.col("q"))).alias("RunwayDays"),
        F.when(keep, bucket(F.col("q"))).otherwise("").alias("RunwayBucket"),
        F.when(keep, F.col("src_form")).otherwise("").alias("RunwaySourceForm"),
        F.when(keep, iso("src_date")).otherwise("").alias("RunwaySourceDate"),
        F.when(keep, F.coalesce(age_days(as_of, "src_date").cast("string"), blank)).otherwise("").alias("RunwaySourceDaysAgo"),
        "RunwaySourceURL", "RunwayStatus", "DilutionFlag", "Dilution", "DilutionStatus", "DilutionFormsHit", "DilutionKeywordsHit",
        "DilutionPrimaryForm", "DilutionPrimaryDate", "DilutionPrimaryDaysAgo", "DilutionPrimaryURL", "DilutionEvidenceAll",
        "Governance", "GovernanceStatus", "GovernancePrimaryForm", "GovernancePrimaryDate", "GovernancePrimaryDaysAgo",
        "GovernancePrimaryURL", "GovernanceEvidenceAll", "GovernanceNotes",
        F.lower("gov_text").contains("going concern").alias("HasGoingConcern"),
        F.lower("gov_text").contains("material weakness").alias("HasMaterialWeakness"),
        text("Auditor").alias("Auditor"), text("Insider").alias("Insider"), F.col("ChecklistInsider").alias("InsiderStatus"),
        F.array_join(ev.links_like(text("Insider"), R.INSIDER_LINK), "; ").alias("InsiderForms345Links"),
        F.coalesce(number("InsiderBuyCount").cast("int"), F.lit(0)).alias("InsiderBuyCount"),
        (to_bool("HasInsiderCluster") if "HasInsiderCluster" in given else F.lit(False)).alias("HasInsiderCluster"),
        text("Ownership").alias("Ownership"), F.col("ChecklistOwnership").alias("OwnershipStatus"),
        F.array_join(ev.links_like(text("Ownership"), R.OWNERSHIP_LINK), "; ").alias("OwnershipLinks"),
        text("Materiality").alias("Materiality"), text("SubscoresEvidenced").alias("SubscoresEvidenced"),
        ev.count_entries(text("SubscoresEvidenced")).alias("SubscoresEvidencedCount"),
        F.when(must, status).otherwise("TBD - exclude").alias("Status"),
        F.concat(passed.cast("string"), F.lit(f"/{len(CHECKS)}")).alias("ChecklistPassed"),
        *[f"Checklist{k}" for k in CHECKS], ev.risk_flag("dil_text", "gov_text").alias("RiskFlag"),
        F.when(strong, first_nonblank(event["Tier1Type"], trigger)).when(on_catalyst, "").otherwise(trigger).alias("Tier1Type"),
        F.when(strong, first_nonblank(event["Tier1Trigger"], F.when(trigger != "None", "Detected")))
        .when(on_catalyst, "").otherwise(F.when(trigger != "None", "Detected").otherwise("")).alias("Tier1Trigger"),
        reason.alias("DropReason"))
    return evaluate_once(checked, "DropReason")


def watchlist(checked: DataFrame) -> DataFrame:
    """Survivors with the report columns; a company whose cells continue has a row for each part."""
    part = ["EvidencePart"] if "EvidencePart" in checked.columns else []
    return checked.where("DropReason = ''").select(*WATCHLIST_COLUMNS, *part)


def drop_counts(checked: DataFrame) -> DataFrame:
    """Companies per reason, each once."""
    dropped = checked.where("DropReason <> ''").select("Ticker", "CIK", "DropReason")
    return (dropped.distinct() if "EvidencePart" in checked.columns else dropped).groupBy("DropReason").agg(F.count("*").alias("Rows"))
