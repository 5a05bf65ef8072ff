"""Queries: event classification, evidence cells, links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from capsieve.catalog.base import query
from capsieve.functions import text, urls
from capsieve.operators import events as evt
from capsieve.operators import evidence as ev
from capsieve.operators import scoring
from capsieve.plans.standins import Tables

# a lexicon of letter groups that do occur in the sample prose
LEXICON = (("GroupA", ("schheit", "iekeit")), ("GroupB", ("ciónque", "adoci")), ("GroupC", ("thtion", "ingand", "atm")))


@query("classify_events", sql="""
WITH d AS (SELECT doc_id, lower(text) AS x, CASE lang WHEN 'en' THEN '2.02' WHEN 'de' THEN '5.02' WHEN 'es' THEN '8.01' ELSE '' END AS item FROM documents),
c AS (SELECT doc_id, item, contains(x, 'schheit') OR contains(x, 'iekeit') AS a, contains(x, 'ciónque') OR contains(x, 'adoci') AS b,
  contains(x, 'thtion') OR contains(x, 'ingand') OR contains(x, 'atm') AS c FROM d)
SELECT doc_id AS DocId, CASE WHEN a THEN 'GroupA' WHEN b THEN 'GroupB' WHEN c THEN 'GroupC' WHEN item = '2.02' THEN 'Earnings'
    WHEN item = '5.02' THEN 'ManagementChange' ELSE 'OtherEvent' END AS EventType,
  CASE WHEN a OR b OR c THEN 'Tier-1' WHEN item <> '' THEN 'Tier-2' ELSE 'Other' END AS EventTier,
  CASE WHEN a OR b OR c THEN 'Tier-1' WHEN item <> '' THEN 'Tier-2' ELSE 'Tier-2' END AS BestTier
FROM c
""")
def classify_events(t: Tables) -> DataFrame:
    item = F.when(F.col("lang") == "en", "2.02").when(F.col("lang") == "de", "5.02").when(F.col("lang") == "es", "8.01")
    docs = t.base("documents").withColumn("items", F.array_compact(F.array(item)))
    docs = docs.withColumn("c", evt.classify("text", F.col("items"), LEXICON))
    return docs.select(F.col("doc_id").alias("DocId"), F.col("c.type").alias("EventType"), F.col("c.tier").alias("EventTier"),
                       evt.best_tier(F.col("c.tier"), F.lit("tier2")).alias("BestTier"))


@query("classify_events_by_word", sql=r"""
SELECT doc_id AS DocId, CASE WHEN regexp_matches(lower(text), '(^|[^a-z0-9])(?:the|and|of)($|[^a-z0-9])') THEN 'English'
  WHEN regexp_matches(lower(text), '(^|[^a-z0-9])(?:der|und)($|[^a-z0-9])') THEN 'German' ELSE 'OtherEvent' END AS EventType FROM documents
""")
def classify_events_by_word(t: Tables) -> DataFrame:
    words = (("English", ("the", "and", "of")), ("German", ("der", "und")))
    none = F.array().cast("array<string>")
    return t.base("documents").select(
        F.col("doc_id").alias("DocId"), evt.classify("text", none, words, match="word")["type"].alias("EventType"))


EIGHT_K_SQL = """
WITH last AS (SELECT *, row_number() OVER (PARTITION BY url ORDER BY ord DESC) AS rn FROM v_8k),
x AS (SELECT *, CASE kind WHEN 'purchase' THEN '1.01; 9.01' WHEN 'signup' THEN '8.01' WHEN 'error' THEN '2.02; 5.02' WHEN 'view' THEN '9.01' ELSE '' END AS items,
   press IS NOT NULL AS pr FROM last WHERE rn = 1),
y AS (SELECT *, CASE WHEN pr THEN 'registered_direct' || CASE WHEN kind = 'purchase' THEN ';purchase_agreement;offering' ELSE '' END
     WHEN kind = 'purchase' THEN 'purchase_agreement;offering' ELSE '' END AS tags, pr OR kind = 'purchase' AS dil FROM x),
z AS (SELECT *, CASE WHEN items = '' THEN 'no_items' WHEN kind = 'view' AND NOT pr THEN 'no_actionable_items' ELSE '' END AS ignore,
   dil OR kind IN ('signup', 'error') AS cat,
   CASE WHEN pr OR kind = 'purchase' THEN 'ATM' WHEN kind = 'signup' THEN 'FDA' WHEN kind = 'error' THEN 'Earnings' ELSE 'OtherEvent' END AS etype FROM y)
"""


@query("eightk_items_and_flags", "v_8k", sql=EIGHT_K_SQL + """
SELECT ord AS EventId, lpad(cik, 10, '0') AS CIK, url AS FilingURL, CAST(filed_at AS VARCHAR) AS EventDate, items AS ItemsPresent,
  etype AS EventType, CASE WHEN dil OR etype IN ('ATM', 'FDA') THEN 'Tier-1' WHEN cat OR items <> '' THEN 'Tier-2' ELSE 'Other' END AS EventTier,
  cat AS IsCatalyst, dil AS IsDilution, CASE WHEN dil THEN 'Tier-1' WHEN cat THEN 'Tier-2' ELSE 'NONE' END AS CatalystType,
  tags AS DilutionTags, ignore AS IgnoreReason FROM z
""")
def eightk_items_and_flags(t: Tables) -> DataFrame:
    rows = t.eight_k().withColumn("PressReleases", F.array_compact(F.array("press")))
    parsed = evt.parse_8k(evt.select_8k(rows, "ord")).withColumn("AccessionNo", F.col("ord").cast("string"))
    return evt.build_events(parsed).select(
        F.col("AccessionNo").cast("bigint").alias("EventId"), "CIK", "FilingURL", "EventDate", "ItemsPresent", "EventType", "EventTier",
        "IsCatalyst", "IsDilution", "CatalystType", "DilutionTags", "IgnoreReason")


@query("actionable_events", "v_8k", sql=EIGHT_K_SQL + """
SELECT lpad(cik, 10, '0') AS CIK, url AS FilingURL, CASE WHEN dil THEN 'Tier-1 Financing' ELSE 'Tier-2' END AS Label FROM z WHERE ignore = ''
""")
def actionable_events(t: Tables) -> DataFrame:
    rows = t.eight_k().withColumn("PressReleases", F.array_compact(F.array("press")))
    events = evt.build_events(evt.parse_8k(evt.select_8k(rows, "ord")))
    return evt.actionable(events).select("CIK", "FilingURL", evt.event_label().alias("Label"))


@query("canonical_events", "v_events8k", sql="""
SELECT ord AS EventId, ticker AS Ticker, CASE WHEN ord % 3 = 0 THEN CAST(event_date AS VARCHAR) ELSE '2024-02-02' END AS event_date,
  CASE WHEN event_tier = 'Other' THEN items ELSE 'Given' END AS event_type,
  CASE WHEN event_tier = 'Tier-1' THEN 'Tier-1' WHEN event_tier = 'Tier-2' THEN 'Tier-2' ELSE 'Other' END AS event_tier,
  primary_source_url FROM v_events8k
""")
def canonical_events(t: Tables) -> DataFrame:
    raw = t.events8k().select(
        "Ticker", F.lit("c").alias("Company"), F.col("ord").cast("string").alias("CIK"),
        F.when(F.col("ord") % 3 == 0, F.col("event_date").cast("string")).otherwise(" ").alias("EventDate"),
        F.lit("2024-02-02").alias("FilingDate"), F.when(F.col("event_tier") != "Other", "Given").alias("EventType"),
        F.col("items").alias("ItemsPresent"), F.lower("event_tier").alias("EventTier"), F.col("primary_source_url").alias("FilingURL"))
    return evt.canonical(raw).select(F.col("CIK").cast("bigint").alias("EventId"), "Ticker", "event_date", "event_type", "event_tier",
                                     "primary_source_url")


PRIMARY_SQL = """
WITH pe AS (SELECT *, row_number() OVER (PARTITION BY ticker ORDER BY CASE event_tier WHEN 'Tier-1' THEN 3 WHEN 'Tier-2' THEN 2 ELSE 1 END DESC,
  event_date DESC, ord) AS rn FROM v_events8k)
"""


@query("primary_event", "v_events8k", sql=PRIMARY_SQL + """
SELECT ticker AS Ticker, ord AS EventId, CAST(event_date AS VARCHAR) AS EventDate, event_tier AS EventTier FROM pe WHERE rn = 1
""")
def primary_event(t: Tables) -> DataFrame:
    events = t.events8k().withColumn("event_date", F.col("event_date").cast("string"))
    return evt.primary_event(events, "ord").select(
        "Ticker", F.col("ord").alias("EventId"), F.col("event_date").alias("EventDate"), F.col("event_tier").alias("EventTier"))


@query("catalyst_pick", "v_events8k", sql="""
SELECT Ticker, EventId, EventDate, CatalystScore FROM (
  SELECT ticker AS Ticker, ord AS EventId, CAST(event_date AS VARCHAR) AS EventDate, CASE WHEN event_tier = 'Tier-1' THEN 'Tier-1' ELSE 'Tier-2' END AS CatalystScore,
    row_number() OVER (PARTITION BY ticker ORDER BY event_tier = 'Tier-1' DESC, event_date, ord) AS rn FROM v_events8k) x WHERE rn = 1
""")
def catalyst_pick(t: Tables) -> DataFrame:
    return evt.catalyst_event(t.events8k(), ["Ticker"], ["event_date"], "ord").select(
        "Ticker", F.col("ord").alias("EventId"), F.col("event_date").cast("string").alias("EventDate"), "CatalystScore")


SPOKEN = """
SELECT doc_id, lang, concat(text, CASE lang WHEN 'en' THEN ' The company raises guidance for item 2.02.' WHEN 'de' THEN ' An award was obligated for $5 million.'
  WHEN 'es' THEN ' It terminates the sales agreement and starts a buyback.' ELSE ' Received 510(k) clearance.' END) AS spoken FROM documents
"""


@query("tier1_trigger", sql=rf"""
WITH s AS ({SPOKEN})
SELECT doc_id AS DocId, CASE
  WHEN regexp_matches(lower(spoken), '(510\(k\)|de ?novo|pdufa|approval|cleared|clearance|crl|complete response letter|adcom vote|ind (accepted|cleared))') THEN 'FDA'
  WHEN regexp_matches(lower(spoken), '(raises|increases|hikes)\s+guidance|guidance.*(raised|increased)') THEN 'GuidanceUp'
  WHEN regexp_matches(lower(spoken), '(award|contract).*(obligated|obligation).*\$[0-9]') THEN 'FundedAward'
  WHEN regexp_matches(lower(spoken), '(terminate(d|s)?|withdraw(n|s)?)\s.*(atm|shelf|sales agreement|equity distribution)') THEN 'OverhangRemoval'
  ELSE 'None' END AS Tier1Type FROM s
""")
def tier1_trigger(t: Tables) -> DataFrame:
    return t.sql(SPOKEN).select(F.col("doc_id").alias("DocId"), evt.tier1_trigger("spoken").alias("Tier1Type"))


@query("catalyst_label", sql=f"""
WITH s AS ({SPOKEN}), k AS (SELECT doc_id, lang, CASE WHEN contains(lower(spoken), 'item 2.02') THEN 'Earnings Results'
  WHEN contains(lower(spoken), 'guidance') THEN 'Guidance' WHEN regexp_matches(lower(spoken), 'contract|award|partnership') THEN 'Commercial Update'
  WHEN regexp_matches(lower(spoken), 'regulatory|approval|clearance|adcom|pdufa') THEN 'Regulatory'
  WHEN regexp_matches(lower(spoken), 'bankruptcy|restructuring') THEN 'Restructuring' WHEN contains(lower(spoken), 'buyback') THEN 'Buyback'
  WHEN regexp_matches(lower(spoken), 'uplist|downlist') THEN 'Listing Change' END AS label FROM s)
SELECT doc_id AS DocId, coalesce(label, '') AS Label,
  CASE WHEN lang = 'en' THEN 'Earnings / financial update' WHEN lang = 'de' THEN 'Corporate event / guidance / financing' WHEN lang = 'es' THEN '510k' ELSE 'TBD' END AS CatalystType FROM k
""")
def catalyst_label(t: Tables) -> DataFrame:
    form = F.when(F.col("lang") == "en", "10-Q").when(F.col("lang") == "de", "8-K/A")
    fda = F.when(F.col("lang") == "es", "510k")
    return t.sql(SPOKEN).select(
        F.col("doc_id").alias("DocId"),
        evt.catalyst_label(F.array(F.lower("spoken")), F.lit(""), F.lit("")).alias("Label"),
        evt.catalyst_by_form(form, fda).alias("CatalystType"))


GOVERNED = """
SELECT doc_id, source, concat(text, CASE lang WHEN 'en' THEN ' substantial doubt as a Going Concern' WHEN 'de' THEN ' a material weakness in controls'
  WHEN 'es' THEN ' an At-the-Market program; owns 1,250,000 shares or 9.75% as a group' ELSE ' holds 12.5%' END) AS spoken FROM documents
"""


@query("governance_text_scan", sql=rf"""
WITH s AS ({GOVERNED}), o AS (SELECT *, try_cast(nullif(regexp_extract(spoken, '(\d+\.\d+)%', 1), '') AS DOUBLE) AS pct,
  try_cast(replace(nullif(regexp_extract(spoken, '(?i)(\d[\d,]+)\s+shares', 1), ''), ',', '') AS BIGINT) AS sh FROM s)
SELECT doc_id AS DocId, regexp_matches(spoken, '(?i)going concern') AS GoingConcern, regexp_matches(spoken, '(?i)material weakness') AS Weakness,
  regexp_matches(spoken, '(?i)at[- ]the[- ]market') AS IsAtm, pct AS Percent, sh AS Shares,
  CASE WHEN pct IS NOT NULL OR sh IS NOT NULL THEN regexp_matches(spoken, '(?i)group') END AS IsGroup FROM o
""")
def governance_text_scan(t: Tables) -> DataFrame:
    rows = t.sql(GOVERNED).withColumns({"g": evt.governance_scan("spoken"), "o": evt.ownership_scan("spoken")})
    return rows.select(
        F.col("doc_id").alias("DocId"), F.col("g.going_concern").alias("GoingConcern"), F.col("g.material_weakness").alias("Weakness"),
        F.col("g.is_atm").alias("IsAtm"), F.col("o.beneficial_percent").alias("Percent"), F.col("o.total_shares").alias("Shares"),
        F.col("o.group_flag").alias("IsGroup"))


@query("going_concern_any", sql=f"""
WITH s AS ({GOVERNED}) SELECT source AS Source, bool_or(regexp_matches(spoken, '(?i)going concern')) AS GoingConcern, count(*) AS Docs FROM s GROUP BY source
""")
def going_concern_any(t: Tables) -> DataFrame:
    return t.sql(GOVERNED).groupBy(F.col("source").alias("Source")).agg(
        F.bool_or(evt.governance_scan("spoken")["going_concern"]).alias("GoingConcern"), F.count("*").alias("Docs"))


# ---------------------------------------------------------------- evidence cells

# filing dates moved into this century, where evidence entries live
CELLS = """
SELECT ord, form, day, url, concat_ws(' | ', strftime(day, '%Y-%m-%d'), nullif(form, ''), url) AS line1,
  strftime(coalesce(day, DATE '2008-01-01') - 30, '%Y-%m-%d') AS d2, url || '?2' AS u2
FROM (SELECT *, filed_at + 4000 AS day FROM v_filings) q
"""
CELLS_AS_OF = "2012-08-01"


def cells(t: Tables) -> DataFrame:
    """Two-entry evidence cells made of each filing."""
    f = t.filings().withColumn("day", F.date_add("FiledAt", 4000)).withColumnsRenamed({"Form": "form", "URL": "url"})
    line1 = F.concat_ws(" | ", F.col("day").cast("string"), "form", "url")
    before = F.date_sub(F.coalesce("day", F.lit("2008-01-01").cast("date")), 30).cast("string")
    line2 = F.concat_ws(" | ", before, F.lit("8-K"), F.concat("url", F.lit("?2")), F.lit("new atm program"))
    cell = F.concat(F.col("url"), F.lit(";"), F.col("url"), F.lit("\r\n nan ;"), F.replace("url", F.lit("doc"), F.lit("alt")),
                    F.lit("; "), F.col("form"))
    return f.withColumns({"line1": line1, "line2": line2, "cell": cell})


@query("evidence_split_dedupe", "v_filings", sql=f"""
WITH c AS (SELECT *, day IS NOT NULL AND form IN ('S-3', '424B5', 'S-8') AS hit FROM ({CELLS}) x)
SELECT ord AS FilingId, concat_ws(';', url, replace(url, 'doc', 'alt'), nullif(form, '')) AS Joined, url AS FirstUrl,
  CAST(3 AS BIGINT) AS Links, CAST(3 + CASE WHEN form = '' THEN 0 ELSE 1 END AS BIGINT) AS Entries,
  CASE WHEN hit THEN form || '; 8-K' ELSE '8-K' END AS DilutionForms, CASE WHEN hit THEN url || '; ' || u2 ELSE u2 END AS DilutionLinks FROM c
""")
def evidence_split_dedupe(t: Tables) -> DataFrame:
    rows = cells(t).withColumns({"e": text.split_evidence("cell"), "d": ev.research_dilution(F.concat("line1", F.lit("\n"), "line2"))})
    spaced = F.replace("cell", F.lit(";"), F.lit(" ; "))
    return rows.select(
        F.col("ord").alias("FilingId"), text.join_distinct(F.col("e")).alias("Joined"), text.first_url(spaced).alias("FirstUrl"),
        F.size(text.urls_in(F.concat(spaced, F.lit(" "), "line2"))).cast("bigint").alias("Links"),
        F.size("e").cast("bigint").alias("Entries"), F.array_join("d.forms", "; ").alias("DilutionForms"),
        F.array_join("d.links", "; ").alias("DilutionLinks"))


@query("evidence_parse_summary", "v_filings", sql=f"""
WITH p AS (SELECT *, day IS NOT NULL AND form <> 'SC 13G' AS one FROM ({CELLS}) x)
SELECT ord AS FilingId, CASE WHEN one THEN form ELSE '8-K' END AS Form, CASE WHEN one THEN strftime(day, '%Y-%m-%d') ELSE d2 END AS Date,
  CAST(date_diff('day', CASE WHEN one THEN day ELSE CAST(d2 AS DATE) END, DATE '{CELLS_AS_OF}') AS VARCHAR) AS DaysAgo,
  CASE WHEN one THEN url ELSE u2 END AS Url,
  CASE WHEN NOT one THEN concat_ws(' ', d2, '8-K', u2, 'new atm program') WHEN form = '' THEN ''
       ELSE concat_ws(' ', strftime(day, '%Y-%m-%d'), form, url) END AS Text,
  concat(CASE WHEN one AND form <> '' THEN concat_ws(' ', strftime(day, '%Y-%m-%d'), form, url) || '; ' ELSE '' END,
    concat_ws(' ', d2, '8-K', u2, 'new atm program')) AS Formatted,
  NOT (CASE WHEN one THEN form ELSE '8-K' END IN ('DEF 14A', '10-K', '20-F', '40-F')) AS BadGovernanceForm FROM p
""")
def evidence_parse_summary(t: Tables) -> DataFrame:
    twice = F.concat("line1", F.lit("\n"), "line2", F.lit(";"), "line2")
    rows = cells(t).withColumn("e", ev.without_manager_forms(ev.entries(twice)))
    rows = rows.withColumn("p", ev.primary_entry(F.col("e")))
    rows = rows.withColumn("s", ev.summary_of(F.col("p"), CELLS_AS_OF))
    return rows.select(
        F.col("ord").alias("FilingId"), F.col("s.form").alias("Form"), F.col("s.date").alias("Date"), F.col("s.days_ago").alias("DaysAgo"),
        F.col("s.url").alias("Url"), F.col("s.text").alias("Text"), ev.format_entries(F.col("e")).alias("Formatted"),
        (~F.col("s.form").isin("DEF 14A", "10-K", "20-F", "40-F")).alias("BadGovernanceForm"))


@query("form_url_guard", "v_filings", sql="""
WITH u AS (SELECT *, CASE ord % 4 WHEN 0 THEN replace(url, 'doc', 'form10-q') WHEN 1 THEN replace(url, 'doc', 'd8k') WHEN 2 THEN url
    ELSE 'https://example.com/a/page.htm' END AS link FROM v_filings)
SELECT ord AS FilingId, CASE WHEN form IN ('', '4', 'S-8', 'SC 13G') THEN TRUE
   WHEN ord % 4 = 0 THEN form = '10-Q' WHEN ord % 4 = 1 THEN form LIKE '8-K%' WHEN ord % 4 = 2 THEN TRUE ELSE FALSE END AS Fits,
  CASE WHEN form IN ('', '4') THEN FALSE WHEN ord % 4 = 0 THEN form = '10-Q' WHEN ord % 4 = 1 THEN form LIKE '8-K%' ELSE FALSE END AS Named FROM u
""")
def form_url_guard(t: Tables) -> DataFrame:
    k = F.col("ord") % 4
    link = (F.when(k == 0, F.replace("URL", F.lit("doc"), F.lit("form10-q"))).when(k == 1, F.replace("URL", F.lit("doc"), F.lit("d8k")))
            .when(k == 2, F.col("URL")).otherwise("https://example.com/a/page.htm"))
    rows = t.filings().withColumn("link", link)
    return rows.select(F.col("ord").alias("FilingId"), urls.url_matches_form("Form", "link").alias("Fits"),
                       urls.url_names_form("Form", "link").alias("Named"))


@query("sec_url_and_accession", "v_filings", sql="""
SELECT ord AS FilingId, CASE ord % 3 WHEN 0 THEN concat('https://www.sec.gov/ix?doc=', substr(url, 20)) WHEN 1 THEN url
    ELSE concat('https://www.sec.gov', '/Archives/edgar/data/x/', ord, '-index.htm') END AS SecUrl,
  lpad(CAST(CAST(cik AS BIGINT) AS VARCHAR), 10, '0') AS Cik, concat_ws('-', substr(a, 1, 10), substr(a, 11, 2), substr(a, 13)) AS Accession, a AS Folder,
  url AS Document, substr(url, 9) AS Bare
FROM (SELECT *, lpad(CAST(ord AS VARCHAR), 18, '0') AS a FROM v_filings) q
""")
def sec_url_and_accession(t: Tables) -> DataFrame:
    k, url = F.col("ord") % 3, F.col("URL")
    written = (F.when(k == 0, F.regexp_replace(url, "^https://www", "http://")).when(k == 1, F.concat(
        F.lit("https://www.sec.gov/ix?doc="), F.substr(url, F.lit(20))))
        .otherwise(F.concat(F.lit("https://sec.gov/Archives/edgar/data/x/"), "ord", F.lit("-index.htm"))))
    written = F.when(k == 0, F.regexp_replace(url, "^https://www\\.", "http://")).otherwise(written)
    rows = t.filings().withColumns({"ids": urls.filing_ids("URL")})
    viewer = F.concat(F.lit("https://www.sec.gov/ix?doc="), F.substr("URL", F.lit(20)))
    return rows.select(
        F.col("ord").alias("FilingId"), urls.sec_url(written).alias("SecUrl"), F.col("ids.cik").alias("Cik"),
        F.col("ids.accession").alias("Accession"), urls.accession_token("URL").alias("Folder"),
        urls.viewer_document(viewer).alias("Document"),
        F.regexp_replace(urls.with_scheme(F.substr("URL", F.lit(9))), "^https://", "").alias("Bare"))


@query("page_links", sql=r"""
SELECT page_id AS PageId, CASE WHEN url LIKE 'http://%' THEN 'https://' || substr(url, 8) ELSE url END AS SecUrl,
  regexp_matches(lower(regexp_replace(url, '[?#].*$', '')), '\.(jpg|jpeg|png|gif|bmp|webp|tif|tiff|svg)$') AS IsImage,
  contains(lower(url), 'edgar') OR contains(lower(url), 'sec.gov') AS IsPrimary FROM pages
""")
def page_links(t: Tables) -> DataFrame:
    return t.base("pages").select(
        F.col("page_id").alias("PageId"), urls.sec_url("url").alias("SecUrl"), urls.is_image("url").alias("IsImage"),
        urls.is_primary_source(F.col("url")).alias("IsPrimary"))


SCORES_SQL = """
SELECT cik AS CIK, CASE WHEN bool_or(f IN ('S-3', 'S-8') OR f LIKE '424B%') THEN 'High' WHEN bool_or(f <> '') THEN 'Low' ELSE 'TBD' END AS DilutionScore,
  CAST(arg_max(filed_at, ord) FILTER (f IN ('S-3', 'S-8') OR f LIKE '424B%') AS VARCHAR) AS LastDilutionEventDate,
  CASE WHEN bool_or(contains(f, 'DEF 14A') OR regexp_matches(f, '^(10-Q|10-K|20-F|6-K|40-F)')) THEN 'OK' WHEN bool_or(f <> '') THEN 'Concern' ELSE 'TBD' END AS GovernanceScore,
  CASE arg_max(f LIKE '4%', ord) FILTER (f LIKE '4%' OR f IN ('3', '5')) WHEN TRUE THEN 'Strong' WHEN FALSE THEN 'Weak' ELSE 'TBD' END AS InsiderScore,
  CAST(max(filed_at) FILTER (f LIKE '4%' OR f IN ('3', '5')) AS VARCHAR) AS LastInsiderBuyDate
FROM (SELECT *, upper(trim(form)) AS f FROM v_filings) x GROUP BY cik
"""


@query("dilution_governance_insider_scores", "v_filings", sql=SCORES_SQL)
def dilution_governance_insider_scores(t: Tables) -> DataFrame:
    out = scoring.scores_per_key(t.filings(), ["CIK"], "Form", "FiledAt", "ord").drop("GoingConcernFlag")
    return out.withColumns({c: F.col(c).cast("string") for c in ("LastDilutionEventDate", "LastInsiderBuyDate")})


@query("filings_for_forms", "v_filings", sql="""
SELECT ord AS FilingId, form AS Form FROM v_filings WHERE form IN ('DEF 14A', '4', '40-F', '424B5')
""")
def filings_for_forms(t: Tables) -> DataFrame:
    from capsieve.operators.filings import for_forms
    return for_forms(t.filings(), ["DEF14A", "3", "4", "5"]).select(F.col("ord").alias("FilingId"), "Form")


@query("watchlist_dilution", "v_filings", sql="""
SELECT ord AS FilingId, CASE WHEN form IN ('S-3', '424B5') THEN 'Pass (Offering)' WHEN form IN ('8-K', '6-K', '8-K/A') THEN 'Pass (Offering)'
    WHEN form = 'S-8' THEN 'Overhang (S-8)' ELSE 'None' END AS Status, form IN ('S-3', '424B5', '8-K', '6-K', '8-K/A', 'S-8') AS Flag,
  CASE WHEN form IN ('S-3', '424B5', 'S-8') THEN form ELSE '' END AS Forms, 'atm; shelf' AS Keywords,
  CASE WHEN form = 'S-8' THEN 'Pass' WHEN form IN ('S-3', '424B5', '8-K', '6-K', '8-K/A') THEN 'Pass' ELSE 'Fail' END AS Checklist,
  CASE WHEN form = 'S-8' THEN 'Dilution Watch' WHEN form = '10-K' THEN 'Governance Watch' ELSE '' END AS Risk FROM v_filings
""")
def watchlist_dilution(t: Tables) -> DataFrame:
    line = F.concat_ws(" ", F.coalesce(F.date_add("FiledAt", 4000).cast("string"), F.lit("2000-01-01")), F.col("Form"), F.col("URL"),
                       F.lit("shelf and atm"))
    rows = t.filings().withColumn("w", ev.watch_dilution(ev.entries(line)))
    mark = F.when(F.col("Form") == "S-8", "on Watch").otherwise("")
    other = F.when(F.col("Form") == "10-K", "under watch").otherwise("")
    return rows.withColumns({"m": mark, "o": other}).select(
        F.col("ord").alias("FilingId"), F.col("w.status").alias("Status"), F.col("w.flag").alias("Flag"),
        F.array_join("w.forms", "; ").alias("Forms"), F.array_join("w.keywords", "; ").alias("Keywords"),
        ev.checklist_status("w.status").alias("Checklist"), ev.risk_flag("m", "o").alias("Risk"))


@query("insider_aggregate", "v_txn", sql="""
SELECT filer AS Filer, count(*) FILTER (code = 'P') AS BuyCount, count(*) FILTER (code = 'S') AS SellCount,
  sum(CASE code WHEN 'P' THEN shares WHEN 'S' THEN -shares ELSE 0 END) AS NetSharesBought, count(*) FILTER (code IN ('P', 'S')) > 1 AS ClusterFlag
FROM v_txn GROUP BY filer
""")
def insider_aggregate(t: Tables) -> DataFrame:
    return evt.insider_activity(t.view("v_txn"), "filer", "code", "shares").withColumnRenamed("filer", "Filer")
