"""Queries: hydration, shortlist gate and the keyed joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from capsieve.catalog.base import query
from capsieve.catalog.universe import ADV_SQL
from capsieve.operators import events as evt
from capsieve.operators import filings as fil
from capsieve.operators import gates, keyed, market, scoring
from capsieve.plans.standins import Tables
from capsieve.rules import Rules

HYDRATE_SQL = ADV_SQL + """,
cpx AS (SELECT 'C' || substr(Ticker, 2) AS Ticker, PriceDate, Close, ADV20 FROM px),
lf AS (SELECT cik, form, filed_at, url, row_number() OVER (PARTITION BY cik ORDER BY filed_at DESC NULLS LAST, ord DESC) AS rn FROM v_filings),
fe AS (SELECT cik, string_agg(line, chr(10) ORDER BY filed_at DESC NULLS LAST, ord) AS FilingsSummary,
              string_agg(url, chr(10) ORDER BY filed_at DESC NULLS LAST, ord) AS FilingURLsAll
       FROM (SELECT *, concat_ws(' | ', strftime(filed_at, '%Y-%m-%d'), nullif(form, ''), url) AS line FROM v_filings) GROUP BY cik),
ld AS (SELECT cik, event_type, decision_date, url, row_number() OVER (PARTITION BY cik ORDER BY decision_date DESC, ord DESC) AS rn FROM v_fda),
de AS (SELECT cik, string_agg(concat_ws(' | ', strftime(decision_date, '%Y-%m-%d'), event_type, product, url), chr(10) ORDER BY decision_date DESC, ord) AS FDA_Summary,
              string_agg(url, chr(10) ORDER BY decision_date DESC, ord) AS FDA_URLsAll FROM v_fda GROUP BY cik),
hyd AS (SELECT p.ticker AS Ticker, CAST(0 AS BIGINT) AS EvidencePart, p.company AS Company, p.sector AS Sector, p.cik AS CIK, p.market_cap AS MarketCap,
    CAST(cpx.PriceDate AS VARCHAR) AS PriceDate, cpx.Close, cpx.ADV20, lf.form AS LatestForm, CAST(lf.filed_at AS VARCHAR) AS FiledAt,
    lf.url AS FilingURL, fe.FilingsSummary, fe.FilingURLsAll, ld.event_type AS FDA_EventType, CAST(ld.decision_date AS VARCHAR) AS FDA_Date,
    ld.url AS FDA_URL, de.FDA_Summary, de.FDA_URLsAll
  FROM v_profiles p LEFT JOIN cpx ON cpx.Ticker = p.ticker LEFT JOIN lf ON lf.cik = p.cik AND lf.rn = 1
    LEFT JOIN fe ON fe.cik = p.cik LEFT JOIN ld ON ld.cik = p.cik AND ld.rn = 1 LEFT JOIN de ON de.cik = p.cik)
"""
HYDRATE_VIEWS = ("v_prices", "v_profiles", "v_filings", "v_fda")


def company_prices(t: Tables) -> DataFrame:
    """Latest bars with part tickers read as company tickers."""
    latest = market.latest_with_adv(t.prices(), [F.desc(c) for c in ("o1", "o2", "o3")])
    return latest.withColumn("Ticker", F.regexp_replace("Ticker", "^P", "C"))


def hydrated(t: Tables) -> DataFrame:
    out = fil.hydrate(t.profiles(), company_prices(t), t.filings(), t.fda(), "ord")
    return out.withColumns({c: F.col(c).cast("string") for c in ("PriceDate", "FiledAt", "FDA_Date")})


@query("hydrate", *HYDRATE_VIEWS, sql=HYDRATE_SQL + "SELECT * FROM hyd")
def hydrate(t: Tables) -> DataFrame:
    return hydrated(t)


@query("shortlist_gate", *HYDRATE_VIEWS, sql=HYDRATE_SQL + """
SELECT Ticker, Company, CIK, Close, ADV20, MarketCap, LatestForm FROM hyd
WHERE Close >= 1 AND MarketCap BETWEEN 25000000 AND 350000000 AND ADV20 >= 25 AND LatestForm <> ''
""")
def shortlist_gate(t: Tables) -> DataFrame:
    core = fil.hydrate_core(t.profiles(), company_prices(t), t.filings(), t.fda(), "ord")
    return gates.shortlist_gate(core, Rules(adv_min=25)).select(
        "Ticker", "Company", "CIK", "Close", "ADV20", "MarketCap", "LatestForm").orderBy("Ticker")


@query("filings_evidence_parts", "v_filings", sql="""
SELECT cik AS CIK, count(*) AS Lines, string_agg(concat_ws(' | ', strftime(filed_at, '%Y-%m-%d'), nullif(form, ''), url), chr(10)
  ORDER BY filed_at DESC NULLS LAST, ord) AS Text FROM v_filings GROUP BY cik
""")
def filings_evidence_parts(t: Tables) -> DataFrame:
    """Evidence cut into cells of about three lines; put back together they are the whole text."""
    f = t.filings()
    rows = f.withColumn("line", fil.filing_line(f))
    cells = keyed.text_parts(rows, ["CIK"], "ord", "line", "cell", "FiledAt", lines_per_part=3)
    return cells.groupBy("CIK").agg(
        F.array_sort(F.collect_list(F.struct("EvidencePart", "cell"))).alias("c")).select(
        "CIK", F.aggregate("c", F.lit(0), lambda a, x: a + F.size(F.split(x["cell"], "\n"))).cast("bigint").alias("Lines"),
        F.array_join(F.transform("c", lambda x: x["cell"]), "\n").alias("Text"))


@query("market_two_key_merge", "v_profiles", sql="""
WITH bt AS (SELECT p_partkey AS k, p_retailprice AS price, NULL::DOUBLE AS cap, p_size * 1000.0::DOUBLE AS adv FROM part),
bc AS (SELECT o_custkey AS k, arg_max(o_totalprice, o_orderkey) AS price FROM orders GROUP BY o_custkey)
SELECT p.ticker AS Ticker, coalesce(p.price, bt.price, bc.price) AS Price, coalesce(p.market_cap, bt.cap, bc.price) AS MarketCap, bt.adv AS ADV20
FROM v_profiles p LEFT JOIN bt ON bt.k = p.ord LEFT JOIN bc ON bc.k = p.ord
""")
def market_two_key_merge(t: Tables) -> DataFrame:
    by_ticker = t.sql("SELECT concat('c', CAST(p_partkey AS STRING)) AS Ticker, p_retailprice AS Last, p_size * 1000.0D AS AverageVolume20,"
                      " p_partkey AS ord FROM part")
    by_cik = t.sql("SELECT o_custkey AS CIK, o_totalprice AS Close, o_totalprice AS Market_Cap, o_orderkey AS ord FROM orders")
    tables = [market.market_table(x, "ord") for x in (by_ticker, by_cik)]
    whole = tables[0].unionByName(tables[1])
    return market.merge_market(t.profiles(), whole, "ord").select("Ticker", "Price", "MarketCap", "ADV20")


@query("or_key_join", "v_profiles", "v_filings", sql="""
WITH r AS (SELECT ord, CASE WHEN ord % 3 = 0 THEN '' ELSE ticker END AS ticker, CASE WHEN ord % 3 = 1 THEN '' ELSE cik END AS cik FROM v_filings)
SELECT p.ticker AS Ticker, r.ord AS FilingId FROM v_profiles p JOIN r ON p.ticker = r.ticker
UNION SELECT p.ticker, r.ord FROM v_profiles p JOIN r ON p.cik = r.cik
""")
def or_key_join(t: Tables) -> DataFrame:
    right = t.filings().withColumns({
        "Ticker": F.when(F.col("ord") % 3 == 0, "").otherwise(F.col("Ticker")),
        "CIK": F.when(F.col("ord") % 3 == 1, "").otherwise(F.col("CIK"))})
    joined = keyed.or_key_join(t.profiles().select("Ticker", "CIK"), right, ["Ticker", "CIK"], "f_")
    return joined.select("Ticker", F.col("f_ord").alias("FilingId"))


MATCH_EVENTS = """
SELECT event_id AS EventId, event_id AS ord, CAST(CAST(ts AS DATE) AS STRING) AS FilingDate,
  CASE WHEN event_type = 'click' THEN '' ELSE CAST(user_id AS STRING) END AS CIK,
  CASE WHEN event_type = 'view' THEN '' ELSE concat('C', CAST(user_id AS STRING)) END AS Ticker,
  CASE WHEN event_type = 'error' THEN concat('https://www.sec.gov/Archives/edgar/data/', CAST(user_id AS STRING), '/ACC', CAST(event_id % 1000 AS STRING), '/d.htm')
    ELSE concat('https://www.sec.gov/e/', CAST(event_id % 3000 AS STRING)) END AS FilingURL FROM events
"""
MATCH_ROWS = """
SELECT c_custkey AS id, CAST(c_custkey AS STRING) AS CIK, concat('C', CAST(c_custkey AS STRING)) AS Ticker,
  concat('text https://x.org/', CAST(c_custkey AS STRING), ' ', CASE WHEN c_acctbal > 5000 THEN concat('https://www.sec.gov/e/', CAST(c_custkey AS STRING), '; ')
    ELSE '' END, 'https://www.sec.gov/Archives/edgar/data/9/acc', CAST(c_custkey AS STRING), '/other.htm') AS Catalyst FROM customer
"""


@query("cascading_event_match", sql=f"""
WITH e AS ({MATCH_EVENTS}), r AS ({MATCH_ROWS}),
u AS (SELECT FilingURL, min(EventId) AS id FROM e GROUP BY FilingURL),
c AS (SELECT lpad(CIK, 10, '0') AS k, EventId, row_number() OVER (PARTITION BY CIK ORDER BY FilingDate DESC, FilingURL DESC, EventId) AS rn FROM e WHERE CIK <> ''),
t AS (SELECT Ticker AS k, EventId, row_number() OVER (PARTITION BY Ticker ORDER BY FilingDate DESC, FilingURL DESC, EventId) AS rn FROM e WHERE Ticker <> ''),
a AS (SELECT lower(regexp_extract(FilingURL, 'data/[0-9]+/([^/]+)/', 1)) AS k, EventId,
        row_number() OVER (PARTITION BY lower(regexp_extract(FilingURL, 'data/[0-9]+/([^/]+)/', 1)) ORDER BY FilingDate DESC, EventId) AS rn
      FROM e WHERE FilingURL LIKE '%/Archives/%')
SELECT r.id AS RowId, coalesce(u.id, c.EventId, t.EventId, a.EventId) AS EventId FROM r
LEFT JOIN u ON strpos(r.Catalyst, '/e/') > 0 AND u.FilingURL = 'https://www.sec.gov/e/' || r.id
LEFT JOIN c ON c.k = lpad(r.CIK, 10, '0') AND c.rn = 1 LEFT JOIN t ON t.k = r.Ticker AND t.rn = 1
LEFT JOIN a ON a.k = 'acc' || r.id AND a.rn = 1
""")
def cascading_event_match(t: Tables) -> DataFrame:
    rows = t.sql(MATCH_ROWS)
    matched = evt.match_events(rows, t.sql(MATCH_EVENTS), "id", evt.candidate_links("Catalyst"), "ord")
    return matched.select(F.col("id").alias("RowId"), F.col("event.EventId").alias("EventId"))


@query("backfill_join", "v_profiles", sql="""
SELECT ticker AS Ticker, cik AS CIK, coalesce(price, CAST(ord AS DOUBLE)) AS Price, coalesce(market_cap, 1000000.0) AS MarketCap,
  sector AS Sector, exchange AS Venue FROM v_profiles
""")
def backfill_join(t: Tables) -> DataFrame:
    left = t.profiles().select("Ticker", "CIK", "Price", "MarketCap", "Sector")
    right = t.profiles().select("Ticker", "CIK", F.col("ord").cast("double").alias("Price"), F.lit(1e6).alias("MarketCap"),
                                F.lit("other").alias("Sector"), F.col("Exchange").alias("Venue"))
    return keyed.backfill(left, right, ["Ticker", "CIK"])


ENTITY_SQL = """
WITH m AS (SELECT *, row_number() OVER (PARTITION BY entity ORDER BY ord) AS rn FROM v_entities WHERE confidence <> 'low'),
mapped AS (SELECT entity AS Company, cik AS CIK, ticker AS Ticker FROM m WHERE rn = 1)
"""


@query("entity_targets", "v_entities", "v_profiles", sql=ENTITY_SQL + """
SELECT Company, CIK, Ticker, TRUE AS Mapped FROM mapped
UNION ALL SELECT company, cik, ticker, FALSE FROM v_profiles p ANTI JOIN mapped m ON m.Ticker = p.ticker
""")
def entity_targets(t: Tables) -> DataFrame:
    return scoring.entity_targets(t.profiles(), t.entities(), "ord")


@query("entity_upsert", "v_entities", sql="""
WITH cur AS (SELECT entity, ticker, cik, confidence FROM v_entities WHERE confidence = 'low')
SELECT entity AS FDA_EntityName, ticker AS Ticker, cik AS CIK, confidence AS Confidence FROM cur
UNION ALL SELECT v.entity, v.ticker, v.cik, v.confidence FROM v_entities v ANTI JOIN cur c ON c.entity = v.entity AND c.ticker = v.ticker
""")
def entity_upsert(t: Tables) -> DataFrame:
    every = t.entities().select("FDA_EntityName", "Ticker", "CIK", "Confidence")
    return scoring.upsert_entities(every.where("Confidence = 'low'"), every)


@query("manual_score_lookup", "v_profiles", sql="""
WITH t1 AS (SELECT ord, CASE WHEN ord % 4 = 0 THEN '' ELSE cik END AS cik, ticker, sector AS m, CASE WHEN price > 5 THEN 'Active' END AS s FROM v_profiles),
t2 AS (SELECT ord, CASE WHEN ord % 4 = 0 THEN '' ELSE cik END AS cik, ticker, CASE WHEN market_cap > 100000000 THEN 'Big' END AS m, CASE WHEN price > 9 THEN 'Hot' END AS s FROM v_profiles)
SELECT p.ticker AS Ticker, coalesce(t2.m, t1.m) AS Materiality, coalesce(t2.s, t1.s) AS Status
FROM v_profiles p JOIN t1 ON t1.ord = p.ord JOIN t2 ON t2.ord = p.ord
""")
def manual_score_lookup(t: Tables) -> DataFrame:
    p = t.profiles().withColumn("CIK2", F.when(F.col("ord") % 4 == 0, "").otherwise(F.col("CIK")))
    first = p.select("ord", F.col("CIK2").alias("CIK"), "Ticker", F.col("Sector").alias("Materiality"),
                     F.when(F.col("Price") > 5, "Active").alias("Status"))
    second = p.select("ord", F.col("CIK2").alias("CIK"), "Ticker", F.when(F.col("MarketCap") > 1e8, "Big").alias("Materiality"),
                      F.when(F.col("Price") > 9, "Hot").alias("Status"))
    out = scoring.with_manual_scores(p.select("Ticker", "CIK"), [first, second])
    return out.select("Ticker", F.col("seed_Materiality").alias("Materiality"), F.col("seed_Status").alias("Status"))
