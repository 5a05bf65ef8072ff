"""8-K events: parsing, classification, canonical table, picking and matching."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from capsieve import rules as R
from capsieve.functions.dates import iso, parse_date
from capsieve.functions.text import (
    blank_to_null, cik, clean_text, col, contains_any, empty, first_nonblank, once, quote, starts_any,
    strip, strip_tags, ticker, upper_key, url_key, urls_in,
)
from capsieve.functions.urls import accession_token
from capsieve.operators.keyed import last_per_key, top_rows
from capsieve.session import stored_once

Lexicon = Sequence[tuple[str, Sequence[str]]]
ITEM = r"(?i)item\s+(\d+\.\d{2})"


# ---------------------------------------------------------------- classification

def _mentions(text: Column, words: Sequence[str], match: str) -> Column:
    if match == "word":
        quoted = "|".join(quote(w) for w in words)
        return text.rlike(rf"(?<![a-z0-9])(?:{quoted})(?![a-z0-9])")
    return contains_any(text, words)


def classify(text: Column | str, items: Column, lexicon: Lexicon = R.EVENT_LEXICON,
             match: str = "substring") -> Column:
    """``struct(type, tier)`` of an event: first lexicon group found, else by item.

    ``match='substring'`` also finds short words inside longer ones ("atm" in
    "treatment"), which is the published behaviour; ``'word'`` does not.
    """
    return once(F.lower(F.coalesce(col(text), empty())), lambda low: _classified(low, items, lexicon, match))


def _classified(low: Column, items: Column, lexicon: Lexicon, match: str) -> Column:
    kind, tier = F.when(F.lit(False), ""), F.when(F.lit(False), "")
    for name, words in lexicon:
        found = _mentions(low, words, match)
        kind, tier = kind.when(found, name), tier.when(found, "Tier-1")
    for item, name in R.EVENT_ITEMS:
        found = F.exists(items, lambda x: x.startswith(item))  # noqa: B023 - used at once
        kind, tier = kind.when(found, name), tier.when(found, "Tier-2")
    kind = kind.otherwise("OtherEvent")
    tier = tier.when(F.size(items) > 0, "Tier-2").otherwise("Other")
    return F.struct(kind.alias("type"), tier.alias("tier"))


def tier_rank(tier: Column | str) -> Column:
    """3 for Tier-1, 2 for Tier-2, 1 for other text, 0 for none."""
    text = F.lower(F.coalesce(col(tier), empty()))
    return F.when(text.contains("1"), 3).when(text.contains("2"), 2).when(text != "", 1).otherwise(0)


def best_tier(*tiers: Column) -> Column:
    """Tier-1 over Tier-2 over Other; unknown spellings count as Other."""
    def rank(t: Column) -> Column:
        low = F.lower(F.coalesce(t, empty()))
        return F.when(low.isin("tier-1", "tier1"), 3).when(low.isin("tier-2", "tier2"), 2).otherwise(1)

    best = F.greatest(*[rank(t) for t in tiers]) if len(tiers) > 1 else rank(tiers[0])
    return F.when(best == 3, "Tier-1").when(best == 2, "Tier-2").otherwise("Other")


def dilution_tags(text: Column) -> Column:
    """Tags of the dilution phrases in a lower-case text, in lexicon order."""
    pairs = F.array(*[F.struct(F.lit(w).alias("w"), F.lit(t).alias("t")) for w, t in R.DILUTION_TAGS])
    return once(text, lambda low: F.transform(F.filter(pairs, lambda p: F.contains(low, p["w"])), lambda p: p["t"]))


def _has_item(items: Column, prefixes: Sequence[str]) -> Column:
    return F.exists(items, lambda x: starts_any(x, prefixes))


# ---------------------------------------------------------------- 8-K text -> event row

def select_8k(filings: DataFrame, ordinal: str) -> DataFrame:
    """8-K filings and amendments, last row per link."""
    return last_per_key(filings.where(upper_key("Form").startswith("8-K")), ["URL"], ordinal)


def parse_8k(filings: DataFrame, text: str = "Text") -> DataFrame:
    """Add ItemsRaw, Items, EventText, HasPressRelease, HasExhibits and exhibit document lists.

    Optional inputs: ``PressReleases array<string>`` and
    ``Exhibits array<struct<document_type, document>>``.
    """
    def optional(name: str, kind: str) -> Column:
        own = F.col(name) if name in filings.columns else F.lit(None)
        return F.coalesce(own.cast(kind), F.array().cast(kind))

    press = optional("PressReleases", "array<string>")
    exhibits = optional("Exhibits", "array<struct<document_type:string,document:string>>")
    sections = once(strip_tags(text), lambda body: F.zip_with(
        F.regexp_extract_all(body, F.lit(ITEM), F.lit(1)), F.slice(F.split(body, ITEM), 2, 1 << 30),
        lambda i, t: F.struct(i.alias("item"), strip(t).alias("text"))))
    parsed = filings.withColumns({"__sections": sections, "__press": press, "__exhibits": exhibits})
    spoken = F.transform(F.filter("__sections", lambda s: ~s["item"].startswith("9.01")), lambda s: s["text"])
    spoken = F.concat(spoken, F.transform("__press", strip))

    def documents(prefixes: Sequence[str]) -> Column:
        kept = F.filter("__exhibits", lambda e: starts_any(F.upper(e["document_type"]), prefixes) & (e["document"] != ""))
        return F.array_join(F.transform(kept, lambda e: strip(e["document"])), "; ")

    items = F.array_distinct(F.transform("__sections", lambda s: s["item"]))
    return parsed.withColumns({
        "Items": items,
        "EventText": F.array_join(F.filter(spoken, lambda x: x != ""), "\n\n"),
        "HasPressRelease": F.size("__press") > 0,
        "HasExhibits": F.size("__exhibits") > 0,
        "PrimaryEx99Docs": documents(["EX-99"]),
        "PrimaryEx10Docs": documents(["EX-10", "EX-1", "EX-2"]),
    }).drop("__sections", "__press", "__exhibits")


def build_events(parsed: DataFrame, match: str = "substring") -> DataFrame:
    """One event row per parsed 8-K, with IgnoreReason where it is not actionable.

    Needs Items, EventText and HasPressRelease (see :func:`parse_8k`).
    """
    low = F.lower(F.coalesce("EventText", empty()))
    rows = parsed.withColumns({
        "__tags": dilution_tags(low),
        "__act": F.filter("Items", lambda x: ~x.startswith("9.01")),
        "__guess": classify("EventText", F.col("Items"), match=match),
    })
    rows = rows.withColumn("IsDilution", _has_item(F.col("__act"), R.DILUTION_ITEMS) | (F.size("__tags") > 0))
    rows = rows.withColumn("IsCatalyst", F.col("IsDilution") | _has_item(F.col("__act"), R.CATALYST_ITEMS)
                           | F.col("HasPressRelease"))
    tier = F.when(F.col("IsDilution"), "Tier-1").when(F.col("IsCatalyst"), "Tier-2")
    kind = F.when(F.col("IsDilution") & (F.col("__guess.type") == "OtherEvent"), "Financing")
    reason = (
        F.when(F.size("Items") == 0, "no_items")
        .when((F.size("__act") == 0) & ~F.col("HasPressRelease"), "no_actionable_items")
        .when(~F.col("IsCatalyst"), "non_actionable").otherwise("")
    )

    def given(name: str) -> Column:
        return clean_text(name, ("nan",)) if name in parsed.columns else empty()

    def flag(name: str) -> Column:
        return F.coalesce(F.col(name), F.lit(False)) if name in parsed.columns else F.lit(False)

    filed = iso("FiledAt") if dict(parsed.dtypes)["FiledAt"] == "date" else iso(parse_date("FiledAt"))
    items = F.array_join("Items", "; ")
    return rows.select(
        cik("CIK").alias("CIK"), given("Company").alias("Company"), ticker("Ticker").alias("Ticker"),
        F.coalesce(blank_to_null("Form"), F.lit("8-K")).alias("Form"),
        first_nonblank(given("FilingDate"), filed).alias("FilingDate"),
        first_nonblank(given("DateOfReport"), given("FilingDate"), filed).alias("EventDate"),
        given("DateOfReport").alias("DateOfReport"), given("AccessionNo").alias("AccessionNo"),
        given("URL").alias("FilingURL"), given("FilingUrlTxt").alias("FilingUrlTxt"),
        given("PeriodOfReport").alias("PeriodOfReport"), given("AcceptanceDateTime").alias("AcceptanceDateTime"),
        given("HomepageURL").alias("HomepageURL"),
        items.alias("ItemsPresent"), items.alias("ItemsNormalized"),
        "HasPressRelease", flag("HasExhibits").alias("HasExhibits"),
        given("PrimaryEx99Docs").alias("PrimaryEx99Docs"), given("PrimaryEx10Docs").alias("PrimaryEx10Docs"),
        flag("HasXBRL").alias("HasXBRL"),
        F.coalesce(kind, F.col("__guess.type")).alias("EventType"),
        F.when(F.col("IsDilution"), "Tier-1").otherwise(best_tier(tier, F.col("__guess.tier"))).alias("EventTier"),
        given("URL").alias("PrimarySourceURL"), empty().alias("SecondarySourceURL"),
        "IsCatalyst", F.coalesce(tier, F.lit("NONE")).alias("CatalystType"),
        F.when(F.col("IsDilution"), "Financing").otherwise("").alias("Tier1Type"), empty().alias("Tier1Trigger"),
        "IsDilution", F.array_join("__tags", ";").alias("DilutionTags"), reason.alias("IgnoreReason"),
    )


def actionable(events: DataFrame) -> DataFrame:
    return events.where("IgnoreReason = ''")


def event_label() -> Column:
    """'Tier-1 Financing' / 'Tier-2' for a catalyst event row, else ''."""
    label = F.concat_ws(" ", F.col("CatalystType"), F.when(F.col("CatalystType") == "Tier-1", blank_to_null("Tier1Type")))
    return F.when(F.col("IsCatalyst"), label).otherwise("")


def canonical(events: DataFrame) -> DataFrame:
    """Canonical event table: first non-blank date, links, type and tier, plus the source columns."""
    kept = ("Form", "FilingDate", "EventDate", "DateOfReport", "AccessionNo", "FilingURL", "FilingUrlTxt",
            "PeriodOfReport", "AcceptanceDateTime", "HomepageURL", "ItemsPresent", "ItemsNormalized",
            "EventType", "EventTier", "PrimarySourceURL", "SecondarySourceURL")

    def text(name: str) -> Column:
        return F.col(name).cast("string") if name in events.columns else F.lit(None).cast("string")

    def first(*names: str) -> Column:
        return first_nonblank(*[text(n) for n in names])

    raw_tier = strip(first("EventTier", "Tier", "CatalystType"))
    upper = F.upper(raw_tier)
    tier = F.when(upper.contains("1"), "Tier-1").when(upper.contains("2"), "Tier-2")
    tier = tier.when(upper.startswith("TIER"), raw_tier).otherwise("Other")
    date = first("EventDate", "DateOfReport", "FilingDate")
    primary = first("PrimarySourceURL", "FilingURL", "FilingUrlTxt", "URL")
    secondary = first("SecondarySourceURL", "HomepageURL")
    return events.select(
        *[F.coalesce(text(c), empty()).alias(c) for c in ("Ticker", "Company", "CIK")],
        date.alias("event_date"), first("EventType", "CatalystType", "ItemsNormalized", "ItemsPresent").alias("event_type"),
        tier.alias("event_tier"), primary.alias("primary_source_url"), secondary.alias("secondary_source_url"),
        *[F.coalesce(text(c), empty()).alias(c) for c in kept],
        tier.alias("Tier"), date.alias("EventDate_canonical"), primary.alias("PrimarySource"),
        secondary.alias("SecondarySource"))


# ---------------------------------------------------------------- picking

def primary_event(events: DataFrame, ordinal: str, key: str = "Ticker") -> DataFrame:
    """Best tier first, then the latest date: the event the shortlist shows."""
    order = [F.desc(tier_rank("event_tier")), F.desc_nulls_last(F.col("event_date").try_cast("date")),
             F.desc_nulls_last("event_date"), F.asc(ordinal)]
    return top_rows(events, [key], order)


def catalyst_event(events: DataFrame, keys: Sequence[str], dates: Sequence[str], ordinal: str) -> DataFrame:
    """Tier-1 events before others, then the *earliest* date: the event the research stage scores."""
    tier1 = F.coalesce(F.lower("event_tier").contains("1"), F.lit(False))
    order = [F.desc(tier1), *[F.asc_nulls_last(d) for d in dates], F.asc(ordinal)]
    picked = top_rows(events, list(keys), order)
    return picked.withColumn("CatalystScore", F.when(tier1, "Tier-1").otherwise("Tier-2"))


# ---------------------------------------------------------------- labels from free text

def tier1_trigger(text: Column | str) -> Column:
    """First matching Tier-1 trigger of an evidence text, 'None' without one."""
    low = F.lower(F.coalesce(col(text), empty()))
    out = F.lit("None")
    for name, pattern in reversed(R.TIER1_TRIGGERS):
        out = F.when(low.rlike(pattern), name).otherwise(out)
    return out


def keyword_label(text: Column) -> Column:
    out = F.lit(None).cast("string")
    for pattern, label in reversed(R.CATALYST_KEYWORD_LABELS):
        out = F.when(text.rlike(pattern), label).otherwise(out)
    return out


def entry_label(text: Column) -> Column:
    """Catalyst label of one lower-case evidence entry: items first, then key words."""
    out = keyword_label(text)
    for item, label in reversed(R.CATALYST_ITEM_LABELS):
        out = F.when(text.contains(f"item {item}"), label).otherwise(out)
    return out


def catalyst_label(entries: Column, form: Column, text: Column) -> Column:
    """Label of the first entry that has one, else by form, else by the whole text, else ''."""
    labels = F.filter(F.transform(entries, entry_label), lambda x: x.isNotNull())
    by_form = F.when(form.isin("10-Q", "10-K", "20-F", "40-F"), "Earnings/Financial update")
    return F.coalesce(F.try_element_at(labels, F.lit(1)), by_form, keyword_label(F.lower(text)), empty())


def catalyst_by_form(form: Column, fda_event: Column) -> Column:
    """Catalyst wording of the research bundle."""
    name = F.upper(F.coalesce(form, empty()))
    return (
        F.when(F.coalesce(fda_event, empty()) != "", fda_event)
        .when(name.contains("8-K"), "Corporate event / guidance / financing")
        .when(name.contains("10-Q") | name.contains("10-K"), "Earnings / financial update").otherwise("TBD")
    )


# ---------------------------------------------------------------- matching events to rows

def candidate_links(*cells: Column | str) -> Column:
    """Links of several cells in order, cell by cell."""
    return F.flatten(F.array(*[urls_in(c) for c in cells]))


def match_events(rows: DataFrame, events: DataFrame, row_id: str, links: Column | DataFrame, ordinal: str) -> DataFrame:
    """Attach ``event`` (a struct, null when nothing fits): same link, else newest of the CIK,
    else newest of the ticker, else same filing folder.

    ``links`` is an array of the row, or a table (row_id, pos, link).

    The events are written once, as four lookups are made of them. Every lookup is reduced to one row per key before
    it is joined, those by link and folder to keys that a row names, and the link steps run on exploded links
    reduced to the first hit per row.
    """
    fields = [c for c in events.columns if c != ordinal]
    packed = stored_once(events.select(
        F.struct(*fields).alias("event"), url_key("FilingURL").alias("k_url"), cik("CIK").alias("k_cik"),
        ticker("Ticker").alias("k_ticker"), accession_token("FilingURL").alias("k_acc"),
        F.coalesce("FilingDate", empty()).alias("o_date"), F.coalesce("FilingURL", empty()).alias("o_url"),
        F.col(ordinal).alias("o_ord")), "events")
    newest = [F.desc("o_date"), F.desc("o_url"), F.asc("o_ord")]

    def table(key: str, order: Sequence[Column], name: str, asked: DataFrame | None = None) -> DataFrame:
        known = packed.where(F.col(key) != "")
        if asked is not None:
            known = known.join(asked.select(key).distinct(), key, "left_semi")
        return top_rows(known, [key], order).select(key, F.col("event").alias(name))

    by_cik = table("k_cik", newest, "e_cik")
    by_ticker = table("k_ticker", newest, "e_ticker")

    exploded = links if isinstance(links, DataFrame) else rows.select(row_id, F.posexplode(links).alias("pos", "link"))

    def first_hit(keyed: DataFrame, order: Sequence[Column], key: str, name: str) -> DataFrame:
        keyed = keyed.where(F.col(key) != "")
        hits = keyed.join(table(key, order, name, keyed), key)
        return top_rows(hits, [row_id], [F.asc("pos")]).select(row_id, name)

    out = rows.withColumns({"k_cik": cik("CIK"), "k_ticker": ticker("Ticker")})
    out = out.join(first_hit(exploded.withColumn("k_url", url_key("link")), [F.asc("o_ord")], "k_url", "e_url"), row_id, "left")
    by_folder = first_hit(exploded.withColumn("k_acc", accession_token("link")), [F.desc("o_date"), F.asc("o_ord")], "k_acc", "e_acc")
    out = out.join(by_folder, row_id, "left")
    out = out.join(by_cik, "k_cik", "left").join(by_ticker, "k_ticker", "left")
    event = F.coalesce("e_url", "e_cik", "e_ticker", "e_acc")
    return out.withColumn("event", event).drop("k_cik", "k_ticker", "e_url", "e_acc", "e_cik", "e_ticker")


# ---------------------------------------------------------------- text scans

def ownership_scan(text: Column | str) -> Column:
    """``struct(beneficial_percent, total_shares, group_flag)``, null when neither number is found."""
    c = F.coalesce(col(text), empty())
    percent = F.regexp_extract(c, r"(\d+\.\d+)%", 1).try_cast("double")
    shares = F.replace(F.regexp_extract(c, r"(?i)(\d[\d,]+)\s+shares", 1), F.lit(","), F.lit("")).try_cast("bigint")
    found = F.struct(percent.alias("beneficial_percent"), shares.alias("total_shares"),
                     c.rlike("(?i)group").alias("group_flag"))
    return F.when(percent.isNotNull() | shares.isNotNull(), found)


def governance_scan(text: Column | str) -> Column:
    c = F.coalesce(col(text), empty())
    return F.struct(c.rlike("(?i)going concern").alias("going_concern"),
                    c.rlike("(?i)material weakness").alias("material_weakness"),
                    c.rlike("(?i)at[- ]the[- ]market").alias("is_atm"))


def insider_activity(transactions: DataFrame, filer: str, code: str = "Code", shares: str = "Shares") -> DataFrame:
    """Buys, sells, net shares and the cluster flag per filer."""
    kind = F.upper(F.coalesce(code, empty()))
    buy, sell = kind.startswith("P"), kind.startswith("S")
    amount = F.coalesce(F.col(shares).cast("double"), F.lit(0.0))
    signed = F.when(buy, amount).when(sell, -amount).otherwise(F.lit(0.0))
    return transactions.groupBy(filer).agg(
        F.count_if(buy).alias("BuyCount"), F.count_if(sell).alias("SellCount"),
        F.sum(signed).alias("NetSharesBought"), (F.count_if(buy | sell) > 1).alias("ClusterFlag"))


