"""Queries: shortlist, deep research, validation, older research tables, watchlist."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from capsieve.catalog.base import query
from capsieve.catalog.events import PRIMARY_SQL
from capsieve.catalog.hydration import HYDRATE_SQL, HYDRATE_VIEWS, company_prices
from capsieve.catalog.universe import ADV_SQL, LOOKBACK_SQL
from capsieve.operators import events as evt
from capsieve.operators import filings as fil
from capsieve.operators import scoring, watchlist
from capsieve.operators.lines import place_of
from capsieve.plans.standins import EVENTS_AS_OF, FILINGS_AS_OF, Tables
from capsieve.session import stored_once

# ---------------------------------------------------------------- decision tables

DECISION = """
SELECT c_custkey AS k, c_custkey % 6 AS n, c_custkey % 5 <> 0 AS must, CASE c_custkey % 7 WHEN 0 THEN 'Tier-1: ATM' WHEN 1 THEN 'Tier-2'
  WHEN 2 THEN 'None' WHEN 3 THEN '' WHEN 4 THEN 'Other news' ELSE 'tier-1' END AS cat,
  CASE c_custkey % 4 WHEN 0 THEN 'Biotechnology' WHEN 1 THEN 'Banks' ELSE 'Health' END AS sector,
  CASE c_custkey % 3 WHEN 0 THEN 'biotech tools' ELSE 'x' END AS industry FROM customer
"""


@query("subscore_materiality_conviction", sql=f"""
WITH d AS ({DECISION}), m AS (SELECT *, lower(cat) AS c FROM d),
a AS (SELECT *, CASE WHEN NOT must THEN 'FAIL - mandatory subscore missing' WHEN c LIKE 'tier-1%' AND n >= 4 THEN 'PASS - Tier1 catalyst'
   WHEN c NOT IN ('', 'none') AND n >= 4 THEN CASE WHEN c LIKE 'tier-2%' THEN 'PASS - Tier2' ELSE 'PASS - catalyst' END ELSE 'FAIL - weak profile' END AS mat,
   contains(lower(sector), 'biotech') OR contains(industry, 'biotech') AS bio FROM m)
SELECT k AS Id, mat AS Materiality, CASE WHEN mat LIKE 'FAIL%' THEN 'Low' WHEN n >= 4 AND c LIKE 'tier-1%' THEN 'High' WHEN n >= 4 THEN 'Medium' ELSE 'Low' END AS Conviction,
  bio AS IsBiotech, CASE WHEN must AND n >= 4 AND mat LIKE 'PASS%' AND NOT bio THEN 'Validated' ELSE 'TBD — exclude' END AS Status FROM a
""")
def subscore_materiality_conviction(t: Tables) -> DataFrame:
    d = t.sql(DECISION)
    n, cat, must = F.col("n"), F.col("cat"), F.col("must")
    d = d.withColumns({"mat": scoring.materiality(n, cat, must), "bio": scoring.is_biotech(F.col("sector"), F.col("industry"))})
    peer = F.when(F.col("bio"), "TBD").otherwise("N")
    return d.select(F.col("k").alias("Id"), F.col("mat").alias("Materiality"), scoring.conviction(n, cat, F.col("mat")).alias("Conviction"),
                    F.col("bio").alias("IsBiotech"), scoring.research_status(must, n, F.col("mat"), peer).alias("Status"))


@query("legacy_materiality_status", sql="""
SELECT c_custkey AS Id, CASE WHEN c AND d THEN 'High' WHEN c THEN 'Medium' WHEN d OR g THEN 'Low' ELSE '' END AS Materiality,
  CASE WHEN c THEN 'Active' WHEN d THEN 'Dilution Watch' WHEN g THEN 'Governance Watch' ELSE 'Stale' END AS Status
FROM (SELECT c_custkey, c_custkey % 2 = 0 AS c, c_custkey % 3 = 0 AS d, c_custkey % 5 = 0 AS g FROM customer) x
""")
def legacy_materiality_status(t: Tables) -> DataFrame:
    k = F.col("c_custkey")
    flags = (k % 2 == 0, k % 3 == 0, k % 5 == 0)
    return t.base("customer").select(k.alias("Id"), scoring.legacy_materiality(*flags).alias("Materiality"),
                                     scoring.legacy_status(*flags).alias("Status"))


VALIDATION = """
SELECT c_custkey AS k, CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE 4.5 END AS q, CASE c_custkey % 5 WHEN 0 THEN 'TBD' ELSE '4.5' END AS shown,
  CASE WHEN c_custkey % 7 = 0 THEN ' ' ELSE 'https://r' END AS rl, CASE WHEN c_custkey % 4 = 0 THEN 'TBD' ELSE 'High' END AS dil,
  CASE WHEN c_custkey % 11 = 0 THEN NULL ELSE 'https://d' END AS dl, CASE WHEN c_custkey % 13 = 0 THEN '' ELSE 'Tier-1' END AS cat, 'https://c' AS cl,
  c_custkey % 6 AS n, CASE WHEN c_custkey % 2 = 0 THEN 'pass - x' ELSE 'PASS - y' END AS mat, CASE WHEN c_custkey % 9 = 0 THEN 'TBD' ELSE 'Y' END AS bio FROM customer
"""
VALID_SQL = f"""
WITH v AS ({VALIDATION}), r AS (SELECT *, concat_ws('; ',
  CASE WHEN (q IS NULL AND shown = 'TBD') OR trim(rl) = '' THEN 'Mandatory subscore missing: Runway' END,
  CASE WHEN dil = 'TBD' OR dl IS NULL THEN 'Mandatory subscore missing: Dilution' END, CASE WHEN cat = '' THEN 'Mandatory subscore missing: Catalyst' END,
  CASE WHEN n < 4 THEN 'Subscores <4/5' END, CASE WHEN bio = 'TBD' THEN 'Biotech peer missing' END) AS reason FROM v)
"""


def checked(t: Tables) -> DataFrame:
    names = {"q": "RunwayQuarters", "shown": "Runway (qtrs)", "rl": "RunwayEvidencePrimary", "dil": "Dilution", "dl": "DilutionEvidencePrimary",
             "cat": "Catalyst", "cl": "CatalystEvidencePrimary", "n": "SubscoresEvidencedCount", "mat": "Materiality", "bio": "BiotechPeerRead"}
    return scoring.validate(t.sql(VALIDATION.replace("4.5 END AS q", "4.5D END AS q")).withColumnsRenamed(names))


@query("validation_reasons", sql=VALID_SQL + """
SELECT k AS Id, CASE WHEN reason = '' THEN 'Validated' ELSE 'TBD — exclude' END AS Status, reason AS Reason FROM r
""")
def validation_reasons(t: Tables) -> DataFrame:
    return checked(t).select(F.col("k").alias("Id"), "Status", "Reason")


@query("exclusion_reason_counts", sql=VALID_SQL + "SELECT reason AS Reason, count(*) AS Rows FROM r WHERE reason <> '' GROUP BY reason")
def exclusion_reason_counts(t: Tables) -> DataFrame:
    return scoring.reason_counts(checked(t))


# ---------------------------------------------------------------- shortlist -> research -> selections

CAND_SQL = ADV_SQL + ",\n" + PRIMARY_SQL.strip()[5:] + """,
cpx AS (SELECT 'C' || substr(Ticker, 2) AS Ticker, Close, ADV20 FROM px),
cand AS (SELECT p.ticker AS Ticker, p.company AS Company, p.cik AS CIK, p.sector AS Sector, p.exchange AS Venue, coalesce(p.price, cpx.Close) AS Price,
    p.market_cap AS MarketCap, p.market_cap / 1000000.0 AS Cap_Musd, cpx.ADV20, cpx.ADV20 / 1000.0 AS ADV20_k, pe.items AS CatalystType,
    CAST(pe.event_date AS VARCHAR) AS EventDate, pe.event_tier AS EventTier, pe.primary_source_url AS PrimarySource,
    CASE WHEN coalesce(p.price, cpx.Close) IS NULL OR p.market_cap IS NULL OR cpx.ADV20 IS NULL THEN 'TBD — exclude' ELSE 'Pass' END AS NotesStatus
  FROM v_profiles p JOIN pe ON pe.ticker = p.ticker AND pe.rn = 1 LEFT JOIN cpx ON cpx.Ticker = p.ticker
  ORDER BY CASE pe.event_tier WHEN 'Tier-1' THEN 3 WHEN 'Tier-2' THEN 2 ELSE 1 END DESC, CAST(pe.event_date AS VARCHAR) DESC, p.market_cap / 1000000.0 ASC NULLS LAST, p.ticker
  LIMIT 40)
"""
CAND_VIEWS = ("v_prices", "v_profiles", "v_events8k")


def weekly_events(t: Tables) -> DataFrame:
    e = t.events8k().withColumn("event_date", F.col("event_date").cast("string"))
    return e.withColumnRenamed("items", "event_type").withColumn("CIK", F.lit(""))


def shortlist(t: Tables) -> DataFrame:
    return scoring.candidate_shortlist(t.profiles(), weekly_events(t), company_prices(t).select("Ticker", "Close", "ADV20"), ordinal="ord")


@query("candidate_shortlist", *CAND_VIEWS, sql=CAND_SQL + "SELECT * FROM cand")
def candidate_shortlist(t: Tables) -> DataFrame:
    return shortlist(t).select(
        "Ticker", "Company", "CIK", "Sector", "Venue", "Price", "MarketCap", "Cap_Musd", "ADV20", "ADV20_k", "CatalystType", "EventDate",
        "EventTier", "PrimarySource", "NotesStatus")


RESEARCH_SQL = CAND_SQL + f""",
f AS (SELECT c.Ticker, v.*, upper(v.form) AS fm, CASE WHEN v.ord % 3 = 0 THEN NULL ELSE CAST((v.ord % 40) / 4.0 AS DOUBLE) END AS quarters
      FROM cand c JOIN v_filings v ON v.ticker = c.Ticker),
sc AS (SELECT Ticker, CASE WHEN bool_or(fm IN ('S-3', 'S-8') OR fm LIKE '424B%') THEN 'High' WHEN bool_or(fm <> '') THEN 'Low' ELSE 'TBD' END AS dil,
    CAST(arg_max(filed_at, ord) FILTER (fm IN ('S-3', 'S-8') OR fm LIKE '424B%') AS VARCHAR) AS ddate,
    CASE WHEN bool_or(contains(fm, 'DEF 14A') OR regexp_matches(fm, '^(10-Q|10-K|20-F|6-K|40-F)')) THEN 'OK' WHEN bool_or(fm <> '') THEN 'Concern' ELSE 'TBD' END AS gov,
    CASE WHEN bool_or(fm LIKE '4%') THEN 'Strong' ELSE 'TBD' END AS ins, CAST(max(filed_at) FILTER (fm LIKE '4%') AS VARCHAR) AS idate FROM f GROUP BY Ticker),
rp AS (SELECT Ticker, quarters, url, row_number() OVER (PARTITION BY Ticker ORDER BY quarters IS NULL, coalesce(date_diff('day', filed_at, DATE '{FILINGS_AS_OF}'), 1000000), ord) AS rn
       FROM f WHERE regexp_matches(fm, '^(10-Q|10-K|20-F|6-K|40-F)')),
ct AS (SELECT c.Ticker, e.ord, CAST(e.event_date AS VARCHAR) AS d, e.items, e.primary_source_url AS url, CASE WHEN e.event_tier = 'Tier-1' THEN 'Tier-1' ELSE 'Tier-2' END AS score,
    row_number() OVER (PARTITION BY c.Ticker ORDER BY e.event_tier = 'Tier-1' DESC, e.event_date, e.ord) AS rn FROM cand c JOIN v_events8k e ON e.ticker = c.Ticker),
lk AS (SELECT Ticker, 1 AS kind, 0 AS o, url FROM rp WHERE rn = 1 UNION ALL SELECT Ticker, 2, ord, url FROM f WHERE fm IN ('S-3', 'S-8') OR fm LIKE '424B%'
  UNION ALL SELECT Ticker, 3, 0, url FROM ct WHERE rn = 1 UNION ALL SELECT Ticker, 4, ord, url FROM f WHERE regexp_matches(fm, 'DEF 14A|10-K|10-Q|20-F|40-F')
  UNION ALL SELECT Ticker, 5, ord, url FROM f WHERE fm LIKE '4%'),
ev AS (SELECT Ticker, coalesce(string_agg(url, ';' ORDER BY o) FILTER (kind = 1), '') AS l1, coalesce(string_agg(url, ';' ORDER BY o) FILTER (kind = 2), '') AS l2,
  coalesce(string_agg(url, ';' ORDER BY o) FILTER (kind = 3), '') AS l3, coalesce(string_agg(url, ';' ORDER BY o) FILTER (kind = 4), '') AS l4,
  coalesce(string_agg(url, ';' ORDER BY o) FILTER (kind = 5), '') AS l5 FROM lk GROUP BY Ticker),
pl AS (SELECT Ticker, string_agg(url, ';' ORDER BY p) AS links FROM (SELECT Ticker, url, min(kind * 1000000000000 + o) AS p FROM lk GROUP BY Ticker, url) x GROUP BY Ticker),
dr0 AS (SELECT c.Ticker, c.CIK, c.Company, c.Price, rp.quarters, coalesce(sc.dil, 'TBD') AS dil, coalesce(ct.score, 'None') AS cats, concat_ws(': ', coalesce(ct.score, 'None'), ct.items) AS cat,
    coalesce(sc.gov, 'TBD') AS gov, coalesce(sc.ins, 'TBD') AS ins, ev.l1, ev.l2, ev.l3, ev.l4, ev.l5, pl.links, ct.d, sc.ddate, sc.idate
  FROM cand c LEFT JOIN sc ON sc.Ticker = c.Ticker LEFT JOIN rp ON rp.Ticker = c.Ticker AND rp.rn = 1 LEFT JOIN ct ON ct.Ticker = c.Ticker AND ct.rn = 1
  LEFT JOIN ev ON ev.Ticker = c.Ticker LEFT JOIN pl ON pl.Ticker = c.Ticker),
dr1 AS (SELECT *, quarters IS NOT NULL AND coalesce(l1, '') <> '' AS ok1, dil <> 'TBD' AND coalesce(l2, '') <> '' AS ok2, coalesce(l3, '') <> '' AS ok3, gov <> 'TBD' AND coalesce(l4, '') <> '' AS ok4,
   ins <> 'TBD' AND coalesce(l5, '') <> '' AS ok5 FROM dr0),
dr2 AS (SELECT *, ok1::INT + ok2::INT + ok3::INT + ok4::INT + ok5::INT AS n, ok1 AND ok2 AND ok3 AS must FROM dr1),
dr AS (SELECT *, CASE WHEN NOT must THEN 'FAIL - mandatory subscore missing' WHEN cat LIKE 'Tier-1%' AND n >= 4 THEN 'PASS - Tier1 catalyst'
   WHEN n >= 4 AND cats <> 'None' THEN 'PASS - Tier2' ELSE 'FAIL - weak profile' END AS mat FROM dr2)
"""
RESEARCH_VIEWS = (*CAND_VIEWS, "v_filings")


def research(t: Tables, picked: DataFrame | None = None) -> DataFrame:
    f = t.filings().withColumn("RunwayQuarters", F.when(F.col("ord") % 3 != 0, (F.col("ord") % 40) / F.lit(4.0)))
    picked = stored_once(shortlist(t), "shortlist") if picked is None else picked
    return scoring.deep_research(picked, f, weekly_events(t), FILINGS_AS_OF, "ord")


@query("deep_research", *RESEARCH_VIEWS, sql=RESEARCH_SQL + """
SELECT Ticker, CIK, quarters AS RunwayQuarters, dil AS DilutionScore, cat AS Catalyst, gov AS GovernanceScore, ins AS InsiderScore,
  coalesce(l1, '') AS RunwayEvidencePrimary, coalesce(l2, '') AS DilutionEvidencePrimary, coalesce(l3, '') AS CatalystEvidencePrimary, coalesce(l4, '') AS GovernanceEvidencePrimary,
  coalesce(l5, '') AS InsiderEvidencePrimary, coalesce(links, '') AS EvidencePrimary, d AS PrimaryCatalystDate, ddate AS LastDilutionEventDate, idate AS LastInsiderBuyDate,
  n AS SubscoresEvidencedCount, mat AS Materiality, CASE WHEN mat LIKE 'FAIL%' THEN 'Low' WHEN n >= 4 AND cat LIKE 'Tier-1%' THEN 'High' WHEN n >= 4 THEN 'Medium' ELSE 'Low' END AS ConvictionScore,
  CASE WHEN must AND n >= 4 AND mat LIKE 'PASS%' THEN 'Validated' ELSE 'TBD — exclude' END AS Status FROM dr
""")
def deep_research(t: Tables) -> DataFrame:
    out = research(t)
    return out.select(
        "Ticker", "CIK", "RunwayQuarters", "DilutionScore", "Catalyst", "GovernanceScore", "InsiderScore", "RunwayEvidencePrimary",
        "DilutionEvidencePrimary", "CatalystEvidencePrimary", "GovernanceEvidencePrimary", "InsiderEvidencePrimary", "EvidencePrimary",
        "PrimaryCatalystDate", F.col("LastDilutionEventDate").cast("string").alias("LastDilutionEventDate"),
        F.col("LastInsiderBuyDate").cast("string").alias("LastInsiderBuyDate"), "SubscoresEvidencedCount", "Materiality", "ConvictionScore", "Status")


@query("runway_coverage", *RESEARCH_VIEWS, sql=RESEARCH_SQL + """
SELECT count(*) AS Total, count(quarters) AS WithQuarters, count(*) - count(quarters) AS Missing, count(*) FILTER (quarters IS NULL AND coalesce(l1, '') <> '') AS EvidenceOnly FROM dr
""")
def runway_coverage(t: Tables) -> DataFrame:
    return scoring.runway_coverage(research(t))


SPLIT_SQL = RESEARCH_SQL + """,
vr AS (SELECT *, concat_ws('; ', CASE WHEN NOT ok1 THEN 'Mandatory subscore missing: Runway' END, CASE WHEN NOT ok2 THEN 'Mandatory subscore missing: Dilution' END,
  CASE WHEN NOT ok3 THEN 'Mandatory subscore missing: Catalyst' END, CASE WHEN n < 4 THEN 'Subscores <4/5' END, CASE WHEN mat NOT LIKE 'PASS%' THEN 'Materiality fail' END) AS reason FROM dr)
"""


def selections(t: Tables) -> DataFrame:
    picked = stored_once(shortlist(t), "shortlist")
    return scoring.validate(scoring.complete_research(research(t, picked), t.profiles().select("Ticker", "CIK", "Sector", "Country"), picked))


@query("validated_selections", *RESEARCH_VIEWS, sql=SPLIT_SQL + """
SELECT vr.Ticker, vr.CIK, c.Venue, vr.Price, CAST(quarters AS VARCHAR) AS "Runway (qtrs)", dil AS DilutionScore, cat AS CatalystScore, n AS SubscoresEvidencedCount,
  split_part(links, ';', 1) AS PrimarySource, '' AS SecondarySource, 'Validated' AS ValidationStatus FROM vr JOIN cand c ON c.Ticker = vr.Ticker WHERE reason = ''
""")
def validated_selections(t: Tables) -> DataFrame:
    return scoring.validated_selections(selections(t)).select(
        "Ticker", "CIK", "Venue", "Price", "Runway (qtrs)", "DilutionScore", "CatalystScore", "SubscoresEvidencedCount", "PrimarySource",
        "SecondarySource", "ValidationStatus")


@query("tbd_exclusions", *RESEARCH_VIEWS, sql=SPLIT_SQL + """
SELECT Ticker, Company, CIK, reason AS Reason, mat AS Materiality, 'TBD — exclude' AS Status FROM vr WHERE reason <> ''
""")
def tbd_exclusions(t: Tables) -> DataFrame:
    return scoring.exclusions(selections(t)).select("Ticker", "Company", "CIK", "Reason", "Materiality", "Status")


# ---------------------------------------------------------------- older research tables

@query("research_bundle", *HYDRATE_VIEWS, sql=HYDRATE_SQL + """,
hits AS (SELECT cik, form, min(row_number) AS p, string_agg(url, '; ' ORDER BY row_number) AS urls FROM (
    SELECT cik, form, url, row_number() OVER (PARTITION BY cik ORDER BY filed_at DESC NULLS LAST, ord) AS row_number FROM v_filings WHERE filed_at IS NOT NULL AND form IN ('S-3', 'S-8', '424B5')) x GROUP BY cik, form),
df AS (SELECT cik, string_agg(form, '; ' ORDER BY p) AS forms, string_agg(form, ', ' ORDER BY p) AS names FROM hits GROUP BY cik),
dl AS (SELECT cik, string_agg(url, '; ' ORDER BY filed_at DESC, ord) AS links FROM v_filings WHERE filed_at IS NOT NULL AND form IN ('S-3', 'S-8', '424B5') GROUP BY cik),
al AS (SELECT CIK AS cik, -1 AS s, coalesce(FDA_URL, FilingURL) AS url FROM hyd
  UNION ALL SELECT cik, row_number() OVER (PARTITION BY cik ORDER BY decision_date DESC, ord), url FROM v_fda
  UNION ALL SELECT cik, 1000000 + row_number() OVER (PARTITION BY cik ORDER BY filed_at DESC NULLS LAST, ord), url FROM v_filings),
ll AS (SELECT cik, string_agg(url, '; ' ORDER BY s) AS links FROM (SELECT cik, url, min(s) AS s FROM al WHERE url IS NOT NULL GROUP BY cik, url) x GROUP BY cik)
SELECT h.Ticker, CASE WHEN FDA_EventType IS NOT NULL THEN FDA_EventType WHEN contains(LatestForm, '8-K') THEN 'Corporate event / guidance / financing'
    WHEN contains(LatestForm, '10-Q') OR contains(LatestForm, '10-K') THEN 'Earnings / financial update' ELSE 'TBD' END AS CatalystType,
  coalesce(FDA_Date, FiledAt, '') AS CatalystDate, coalesce(FDA_URL, FilingURL, '') AS CatalystPrimaryLink, coalesce(ll.links, '') AS CatalystEvidencePrimaryLinks,
  CASE WHEN df.cik IS NULL THEN 'FALSE' ELSE 'TRUE' END AS HasDilutionFlag, coalesce(df.forms, '') AS DilutionForms, coalesce(dl.links, '') AS DilutionLinks,
  CASE WHEN df.cik IS NULL THEN '' ELSE 'Recent dilution-related filings: ' || df.names END AS DilutionNotes
FROM hyd h LEFT JOIN df ON df.cik = h.CIK LEFT JOIN dl ON dl.cik = h.CIK LEFT JOIN ll ON ll.cik = h.CIK
""")
def research_bundle(t: Tables) -> DataFrame:
    lines = fil.company_evidence(t.filings(), t.fda(), every_link=True).withColumn("place", place_of("Day", "Seq"))
    core = fil.hydrate_core(t.profiles(), company_prices(t), t.filings(), t.fda(), "ord")
    return scoring.bundle(core, lines, cells=("CatalystEvidencePrimaryLinks", "DilutionLinks")).select(
        "Ticker", "CatalystType", "CatalystDate", "CatalystPrimaryLink", "CatalystEvidencePrimaryLinks", "HasDilutionFlag", "DilutionForms",
        "DilutionLinks", "DilutionNotes")


@query("populate_research", "v_filings", "v_profiles", "v_fda", sql=LOOKBACK_SQL + f""",
r AS (SELECT *, concat_ws(' ', strftime(filed_at, '%Y-%m-%d'), form, url) AS line FROM k WHERE rn = 1 AND form <> '' AND filed_at >= DATE '{FILINGS_AS_OF}' - coalesce(d, 400)),
c AS (SELECT cik, string_agg(line, '; ' ORDER BY filed_at DESC, ord) FILTER (form IN ('S-3', 'S-8') OR form LIKE '424B%') AS dil,
  string_agg(line, '; ' ORDER BY filed_at DESC, ord) FILTER (regexp_matches(form, '^(8-K|6-K|10-Q|10-K|S-4|S-3|S-1)')) AS cat,
  string_agg(line, '; ' ORDER BY filed_at DESC, ord) FILTER (form = 'DEF 14A') AS gov FROM r GROUP BY cik),
fd AS (SELECT cik, concat_ws(' | ', strftime(decision_date, '%Y-%m-%d'), event_type, product, url) AS line, row_number() OVER (PARTITION BY cik ORDER BY decision_date DESC, ord DESC) AS rn FROM v_fda),
o AS (SELECT p.ticker, c.dil, coalesce(fd.line, c.cat) AS cat, c.gov FROM v_profiles p LEFT JOIN c ON c.cik = p.cik LEFT JOIN fd ON fd.cik = p.cik AND fd.rn = 1)
SELECT ticker AS Ticker, coalesce(dil, '') AS Dilution, coalesce(cat, '') AS Catalyst, coalesce(gov, '') AS Governance,
  CASE WHEN cat IS NOT NULL AND dil IS NOT NULL THEN 'High' WHEN cat IS NOT NULL THEN 'Medium' WHEN dil IS NOT NULL OR gov IS NOT NULL THEN 'Low' ELSE '' END AS Materiality,
  concat_ws('; ', CASE WHEN cat IS NOT NULL THEN 'Catalyst' END, CASE WHEN dil IS NOT NULL THEN 'Dilution' END, CASE WHEN gov IS NOT NULL THEN 'Governance' END) AS SubscoresEvidenced,
  CASE WHEN cat IS NOT NULL THEN 'Active' WHEN dil IS NOT NULL THEN 'Dilution Watch' WHEN gov IS NOT NULL THEN 'Governance Watch' ELSE 'Stale' END AS Status FROM o
""")
def populate_research(t: Tables) -> DataFrame:
    base = t.profiles().select("Ticker", "CIK", "Company")
    return scoring.populate_research(base, t.filings(), FILINGS_AS_OF, t.fda()).select(
        "Ticker", "Dilution", "Catalyst", "Governance", "Materiality", "SubscoresEvidenced", "Status")


# ---------------------------------------------------------------- watchlist

WATCH = """
SELECT c_custkey AS k, concat('C', CAST(c_custkey AS STRING)) AS Ticker, CAST(c_custkey AS STRING) AS CIK, c_name AS Company, c_mktsegment AS Sector,
  CASE WHEN c_custkey % 7 = 0 THEN 0.5 ELSE 5.0 END AS Price, c_acctbal * 10000.0 + 20000000.0 AS MarketCap, CASE WHEN c_custkey % 11 = 0 THEN NULL ELSE 50000.0 END AS ADV20,
  CAST(c_custkey % 50 + 1 AS STRING) AS RunwayQuartersRaw, '1000' AS RunwayCash, CASE WHEN c_custkey % 13 = 0 THEN '0' ELSE '250' END AS RunwayQuarterlyBurn, 'interim' AS RunwayEstimate,
  '10-Q' AS RunwaySourceForm, CASE WHEN c_custkey % 17 = 0 THEN '2020-01-01' ELSE '2023-12-31' END AS RunwaySourceDate, 'https://www.sec.gov/Archives/edgar/data/1/x/10q.htm' AS RunwaySourceURL,
  CASE c_custkey % 5 WHEN 0 THEN 'TBD' WHEN 1 THEN '2024-01-05 8-K https://www.sec.gov/Archives/edgar/data/1/a/d8k.htm guidance' WHEN 2 THEN '2024-01-05 424B5 https://www.sec.gov/Archives/edgar/data/1/a/424b5.htm'
    ELSE '2023-11-01 10-Q https://www.sec.gov/Archives/edgar/data/1/a/form10q.htm' END AS Catalyst,
  CASE c_custkey % 3 WHEN 0 THEN '2023-10-01 S-3 https://www.sec.gov/Archives/edgar/data/1/b/s3.htm' WHEN 1 THEN '2023-10-01 S-8 https://www.sec.gov/Archives/edgar/data/1/b/s8.htm; 2023-09-01 S-8 https://www.sec.gov/Archives/edgar/data/1/c/s8.htm'
    ELSE CASE WHEN c_custkey % 2 = 0 THEN 'toxic note' ELSE '2023-10-01 10-Q https://www.sec.gov/Archives/edgar/data/1/b/form10q.htm' END END AS Dilution,
  CASE WHEN c_custkey % 19 = 0 THEN '' WHEN c_custkey % 4 = 0 THEN '2023-08-01 8-K https://www.sec.gov/Archives/edgar/data/1/g/d8k.htm going concern' ELSE '2023-08-01 DEF 14A https://www.sec.gov/Archives/edgar/data/1/g/def14a.htm' END AS Governance,
  'Pass' AS InsiderStatus, 'n/a' AS OwnershipStatus, 'Catalyst; Dilution' AS SubscoresEvidenced, 'Active' AS Status FROM customer
"""
WATCH_SQL = f"""
WITH w AS ({WATCH.replace('CAST(c_custkey AS STRING)', 'CAST(c_custkey AS VARCHAR)')}),
e0 AS (SELECT *, row_number() OVER (PARTITION BY url ORDER BY ord DESC) AS dup FROM v_8k),
e1 AS (SELECT lpad(cik, 10, '0') AS cik, strftime(filed_at, '%Y-%m-%d') AS d, 'https://www.sec.gov/Archives/edgar/data/' || CAST(CAST(cik AS BIGINT) AS VARCHAR) || '/e' || regexp_extract(url, '[0-9]+$', 0) || '/d8k.htm' AS url,
    press IS NOT NULL OR kind = 'purchase' AS dil, kind, press IS NOT NULL AS pr FROM e0 WHERE dup = 1),
e2 AS (SELECT *, row_number() OVER (PARTITION BY cik ORDER BY d DESC, url DESC) AS rn FROM e1 WHERE kind <> 'click' AND (kind <> 'view' OR pr)),
j AS (SELECT w.*, e.cik IS NOT NULL AS has_e, coalesce(e.dil, FALSE) AS edil, e.d AS ed, e.url AS eurl FROM w LEFT JOIN e2 e ON e.cik = lpad(w.CIK, 10, '0') AND e.rn = 1),
x AS (SELECT *, CASE WHEN has_e THEN CASE WHEN edil THEN 'Tier-1 Financing' ELSE 'Tier-2' END END AS label,
   CASE WHEN k % 3 = 0 THEN 'Pass (Offering)' WHEN k % 3 = 1 THEN 'Overhang (S-8)' WHEN k % 2 = 0 THEN 'None' ELSE 'None' END AS own_dil FROM j),
y AS (SELECT *, CASE WHEN edil THEN 'Pass (Offering)' ELSE own_dil END AS dstat FROM x),
z AS (SELECT *, CASE WHEN Price < 1 OR MarketCap >= 350000000 OR coalesce(ADV20, CASE WHEN k % 2 = 0 THEN 60000.0 END) IS NULL THEN 'Market gate'
   WHEN k % 13 = 0 THEN 'Missing runway burn metrics' WHEN k % 17 = 0 THEN 'Runway filing stale' WHEN k % 5 = 0 AND NOT has_e THEN 'Catalyst evidence missing'
   WHEN k % 3 = 2 AND k % 2 = 0 THEN 'Negative dilution terms' WHEN k % 19 = 0 THEN 'Governance text missing' WHEN k % 5 = 2 AND NOT has_e THEN 'Catalyst evidence missing'
   WHEN dstat = 'None' THEN 'Dilution filing missing'
   WHEN NOT has_e OR k % 4 = 0 THEN 'Validation failed: ' || concat_ws('; ', CASE WHEN NOT has_e THEN 'CatalystPrimary' END, CASE WHEN k % 4 = 0 THEN 'GovernancePrimaryForm' END) ELSE '' END AS reason FROM y)
"""


def watch_rows(t: Tables) -> DataFrame:
    rows = t.sql(WATCH.replace("0.5 ELSE 5.0", "0.5D ELSE 5.0D").replace("10000.0 + 20000000.0", "10000.0D + 20000000.0D").replace("50000.0", "50000.0D"))
    market = t.base("customer").select(
        F.concat(F.lit("C"), F.col("c_custkey")).alias("Ticker"), F.lit("").alias("CIK"), F.lit(None).cast("double").alias("Price"),
        F.lit(None).cast("double").alias("MarketCap"), F.when(F.col("c_custkey") % 2 == 0, 60000.0).alias("ADV20"), F.col("c_custkey").alias("ord"))
    eight = t.eight_k().withColumn("PressReleases", F.array_compact(F.array("press")))
    events = evt.actionable(evt.build_events(evt.parse_8k(evt.select_8k(eight, "ord"))))
    link = F.concat(F.lit("https://www.sec.gov/Archives/edgar/data/"), F.col("CIK").cast("bigint"), F.lit("/e"),
                    F.regexp_extract("FilingURL", "([0-9]+)$", 1), F.lit("/d8k.htm"))
    events = events.withColumns({"FilingURL": link, "ord": F.regexp_extract("FilingURL", "([0-9]+)$", 1).cast("bigint")})
    return watchlist.check_research(rows, market, events, EVENTS_AS_OF, ordinal="ord")


@query("watchlist_drop_reasons", "v_8k", sql=WATCH_SQL + "SELECT Ticker, reason AS DropReason FROM z")
def watchlist_drop_reasons(t: Tables) -> DataFrame:
    return watch_rows(t).select("Ticker", "DropReason")


@query("watchlist", "v_8k", sql=WATCH_SQL + """
SELECT Ticker, lpad(CIK, 10, '0') AS CIK, CASE WHEN edil THEN 'Tier-1' ELSE 'Tier-2' END AS CatalystType, label AS Catalyst, '8-K' AS CatalystPrimaryForm, ed AS CatalystPrimaryDate,
  eurl AS CatalystPrimaryURL, CAST(k % 50 + 1 AS DOUBLE) AS RunwayQuarters, CAST((k % 50 + 1) * 90 AS INTEGER) AS RunwayDays,
  CASE WHEN k % 50 + 1 < 3 THEN '1-3q' WHEN k % 50 + 1 < 6 THEN '3-6q' WHEN k % 50 + 1 < 12 THEN '6-12q' ELSE '>12q' END AS RunwayBucket, '31' AS RunwaySourceDaysAgo,
  dstat AS DilutionStatus, CASE WHEN edil THEN '8-K' WHEN k % 3 = 0 THEN 'S-3' ELSE 'S-8' END AS DilutionFormsHit, CASE WHEN edil THEN '8-K' WHEN k % 3 = 0 THEN 'S-3' ELSE 'S-8' END AS DilutionPrimaryForm,
  'Pass' AS GovernanceStatus, '183' AS GovernancePrimaryDaysAgo, '5/6' AS ChecklistPassed, 'Active' AS Status, 2 AS SubscoresEvidencedCount,
  CASE WHEN edil THEN 'Financing' ELSE '' END AS Tier1Type FROM z WHERE reason = ''
""")
def watchlist_report(t: Tables) -> DataFrame:
    return watchlist.watchlist(watch_rows(t)).select(
        "Ticker", "CIK", "CatalystType", "Catalyst", "CatalystPrimaryForm", "CatalystPrimaryDate", "CatalystPrimaryURL", "RunwayQuarters",
        "RunwayDays", "RunwayBucket", "RunwaySourceDaysAgo", "DilutionStatus", "DilutionFormsHit", "DilutionPrimaryForm", "GovernanceStatus",
        "GovernancePrimaryDaysAgo", "ChecklistPassed", "Status", "SubscoresEvidencedCount", "Tier1Type")
