"""Queries: payload readers, funnel counts, progress log, call rate."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from capsieve.catalog.base import query
from capsieve.catalog.universe import COVERAGE_SQL, recent
from capsieve.operators import filings as fil
from capsieve.operators import gates
from capsieve.plans.standins import FILINGS_AS_OF, Tables
from capsieve.sources import payloads as pay
from capsieve.sources import tables as tab
from capsieve.streaming import call_rate, progress


def _json(*fields: Column) -> Column:
    return F.to_json(F.struct(*fields))


def _text(c: str) -> Column:
    return F.col(c).cast("string")


@query("company_list", sql="""
WITH n AS (SELECT upper('t' || c_custkey) AS Ticker, lpad(CAST(c_custkey AS VARCHAR), 10, '0') AS CIK,
  c_name || CASE WHEN c_custkey % 9 = 4 THEN ' Trust' WHEN c_custkey % 9 = 5 THEN ' Units' ELSE ' Inc' END AS Company FROM customer)
SELECT * FROM n WHERE NOT regexp_matches(upper(Company), 'TRUST|\\bUNITS\\b')
""")
def company_list(t: Tables) -> DataFrame:
    k = F.col("c_custkey")
    name = F.concat("c_name", F.when(k % 9 == 4, " Trust").when(k % 9 == 5, " Units").otherwise(" Inc"))
    entry = F.struct(F.concat(F.lit("t"), k, F.lit(".us")).alias("ticker"), k.alias("cik_str"), name.alias("title"))
    return pay.company_list(t.base("customer").select(F.to_json(F.create_map(F.lit("0"), entry)).alias("payload")))


@query("profile_payloads", "v_profiles", sql="""
SELECT ticker AS Ticker, cik AS CIK, company AS Company, exchange AS Exchange, market_cap AS MarketCap, price AS Price FROM v_profiles
WHERE upper(exchange) IN ('NASDAQGS', 'NASDAQCM', 'NYSE', 'AMEX', 'NYSE AMERICAN')
  AND coalesce(price >= 1, TRUE) AND coalesce(market_cap >= 25000000, TRUE) AND coalesce(market_cap <= 350000000, TRUE)
""")
def profile_payloads(t: Tables) -> DataFrame:
    even = F.col("ord") % 2 == 0
    doc = F.concat(F.lit("["), _json(
        F.concat(F.lower("Ticker"), F.lit(".US")).alias("symbol"), F.col("ord").alias("cik"), F.col("Company").alias("companyName"),
        F.when(even, F.col("Exchange")).alias("exchangeShortName"), F.col("Exchange").alias("exchange"), F.col("Country").alias("country"),
        F.when(even, F.col("MarketCap")).alias("mktCap"), F.col("MarketCap").alias("marketCap"), F.col("Price").alias("price")), F.lit("]"))
    return pay.profiles(t.profiles().select(doc.alias("payload"))).select("Ticker", "CIK", "Company", "Exchange", "MarketCap", "Price")


@query("quote_payloads", "v_quotes", sql="""
SELECT ticker AS Ticker, CASE WHEN ord % 5 = 0 THEN NULL ELSE bid END AS BidPrice, CASE WHEN ord % 5 = 0 THEN NULL ELSE ask END AS AskPrice,
  CASE WHEN ord % 5 = 0 THEN NULL ELSE strftime(make_timestamp(1700000000000000 + ord * 1000000), '%Y-%m-%d %H:%M:%S') END AS QuotedAt FROM v_quotes
""")
def quote_payloads(t: Tables) -> DataFrame:
    one = _json(F.lower("Ticker").alias("symbol"), F.col("BidPrice").alias("bidPrice"), F.col("AskPrice").alias("askPrice"),
                (F.lit(1700000000000) + F.col("ord") * 1000).alias("timestamp"))
    error = _json(F.lit("limit reached").alias("Error Message"))
    doc = F.when(F.col("ord") % 5 == 0, error).when(F.col("ord") % 2 == 0, one).otherwise(F.concat(F.lit("["), one, F.lit(","), one, F.lit("]")))
    quotes = t.quotes()
    out = pay.quotes(quotes.select("ord", doc.alias("payload")), quotes.select("Ticker"), "ord")
    return out.select("Ticker", "BidPrice", "AskPrice", F.date_format("QuoteTimestamp", "yyyy-MM-dd HH:mm:ss").alias("QuotedAt"))


@query("filing_payloads", "v_filings", sql=f"""
SELECT ord AS FilingId, form AS Form, CAST(filed_at AS VARCHAR) AS FiledAt, concat('https://www.sec.gov/ix?doc=', substr(url, 20)) AS URL,
  CASE ord % 3 WHEN 0 THEN 'Item 1 Item 2' WHEN 1 THEN 'spaced title' ELSE '' END AS Note FROM v_filings
WHERE form IN ('10-Q', '8-K', '6-K', '20-F', 'S-3', '424B5', 'DEF 14A', '8-K/A', '10-K', 'S-8', '40-F')
  AND filed_at >= DATE '{FILINGS_AS_OF}' - CASE WHEN form IN ('10-Q', '6-K', '8-K/A') THEN 180 ELSE 400 END
""")
def filing_payloads(t: Tables) -> DataFrame:
    k = F.col("ord") % 3
    doc = _json(
        F.concat(F.col("Ticker")).alias("symbol"), F.col("ord").alias("cik"), F.when(k != 1, F.col("Form")).alias("type"), F.col("Form").alias("form"),
        F.concat(_text("FiledAt"), F.lit(" 00:00:00")).alias("fillingDate"), F.regexp_replace("URL", "^https", "http").alias("link"),
        F.when(k == 0, F.array(F.lit("Item 1"), F.lit(" Item 2 "))).alias("items"), F.when(k == 1, "  spaced\n title").alias("documentTitle"))
    rows = pay.filing_index(t.filings().select(doc.alias("payload")), FILINGS_AS_OF)
    return rows.select(F.col("CIK").cast("bigint").alias("FilingId"), "Form", _text("FiledAt").alias("FiledAt"), "URL", F.col("Desc").alias("Note"))


@query("price_payloads", "v_prices", sql="""
SELECT ticker AS Ticker, CAST(dt AS VARCHAR) AS Date, close AS Close, volume AS Volume FROM v_prices
UNION ALL SELECT ticker, CAST(dt + 1 AS VARCHAR), NULL, volume FROM v_prices
""")
def price_payloads(t: Tables) -> DataFrame:
    bars = F.array(F.struct(_text("Date").alias("date"), F.col("Close").alias("close"), F.col("Volume").alias("volume")),
                   F.struct(F.date_add("Date", 1).cast("string").alias("date"), F.lit(None).cast("double").alias("close"), F.col("Volume").alias("volume")))
    doc = _json(F.concat("Ticker", F.lit(".US")).alias("symbol"), bars.alias("historical"))
    return pay.price_history(t.prices().select(doc.alias("payload"))).select("Ticker", _text("Date").alias("Date"), "Close", "Volume")


@query("device_and_drug_flatten", sql="""
SELECT '510k:K' || p_partkey AS EventID, p_name AS ApplicantName, '510k' AS EventType, '2024-01-02' AS DecisionDate, p_type AS Product, CASE WHEN p_size % 2 = 0 THEN 'https://l' ELSE 'text' END AS URL, CAST(p_partkey AS VARCHAR) AS Ticker FROM part
UNION ALL SELECT 'drug:A' || p_partkey || ':' || b, CASE WHEN p_size % 3 = 0 THEN p_name ELSE 'Sponsor' END, 'drug_approval', CASE WHEN p_size % 2 = 0 THEN '2023-03-03' ELSE '2022-02-02' END, b, '', CAST(p_partkey AS VARCHAR)
FROM part, (VALUES ('one'), ('two')) v(b)
""")
def device_and_drug_flatten(t: Tables) -> DataFrame:
    even, base = F.col("p_size") % 2 == 0, t.base("part")
    who = [F.col("p_name").alias("Company"), F.lit("").alias("CIK"), _text("p_partkey").alias("Ticker")]
    device = F.concat(F.lit("["), _json(
        F.concat(F.lit("K"), "p_partkey").alias("k_number"), F.lit("2024-01-02").alias("decision_date"), F.col("p_type").alias("device_name"),
        F.when(even, "https://l").alias("link"), F.lit("text").alias("decision_description")), F.lit("]"))
    app = F.struct(
        F.concat(F.lit("A"), "p_partkey").alias("application_number"), F.when(F.col("p_size") % 3 != 0, "Sponsor").alias("sponsor_name"),
        F.when(even, "2023-03-03").alias("approval_date"), F.lit("2022-02-02").alias("original_approval_date"),
        F.array(F.struct(F.lit("one").alias("brand_name")), F.struct(F.lit("two").alias("brand_name"))).alias("products"))
    bare = F.struct(*[F.lit("none").alias(c) for c in ("application_number", "sponsor_name", "approval_date", "original_approval_date")],
                    F.array().cast("array<struct<brand_name:string>>").alias("products"))
    drug = _json(F.array(app, bare).alias("applications"))
    rows = pay.device_clearances(base.select(*who, device.alias("payload"))).unionByName(pay.drug_approvals(base.select(*who, drug.alias("payload"))))
    return rows.drop("CIK")


@query("concept_facts", "v_facts", sql="""
SELECT cik AS CIK, concept AS Concept, 'USD' AS Unit, val AS Val, accn AS Accn, CAST(end_dt AS VARCHAR) AS "End", 'Q2' AS Fp FROM v_facts
UNION ALL SELECT cik, concept, 'shares', 1.0, accn, CAST(end_dt AS VARCHAR), 'FY' FROM v_facts
""")
def concept_facts(t: Tables) -> DataFrame:
    def value(v: Column, fp: str, day: str) -> Column:
        return F.array(F.struct(v.alias("val"), F.col("accn").alias("accn"), _text("end_dt").alias(day), F.lit(fp).alias("fp")))

    usd, shares = value(F.col("val"), "Q2", "end"), value(F.lit(1.0), "FY", "end")
    doc = _json(F.col("cik").cast("bigint").alias("cik"), F.lit("us-gaap").alias("taxonomy"), F.col("concept").alias("tag"),
                F.create_map(F.lit("USD"), usd, F.lit("shares"), shares).alias("units"))
    return pay.concept_facts(t.view("v_facts").select(doc.alias("payload"))).select(
        "CIK", "Concept", "Unit", "Val", "Accn", _text("End").alias("End"), "Fp")


@query("insider_and_holdings", "v_txn", sql="""
SELECT 'txn' AS Source, filer AS Filer, code AS Code, shares AS Shares, CAST(txn_date AS VARCHAR) AS Day, '' AS Kind FROM v_txn
UNION ALL SELECT 'holding', filer, code, shares, CAST(txn_date AS VARCHAR), 'SH' FROM v_txn
""")
def insider_and_holdings(t: Tables) -> DataFrame:
    v = t.view("v_txn")
    txn = _json(F.array(F.struct(_text("txn_date").alias("transaction_date"), F.col("code").alias("transaction_code"),
                                 F.col("shares").alias("shares"))).alias("transactions"))
    held = F.concat(F.lit("["), _json(F.col("code").alias("nameOfIssuer"), _text("txn_date").alias("cusip"), F.col("shares").alias("sshPrnamt"),
                                      F.lit("SH").alias("sshPrnamtType")), F.lit("]"))
    one = pay.insider_transactions(v.select("filer", txn.alias("payload")), "filer").select(
        F.lit("txn").alias("Source"), F.col("filer").alias("Filer"), "Code", "Shares", F.col("TransactionDate").alias("Day"), F.lit("").alias("Kind"))
    two = pay.holdings(v.select("filer", held.alias("payload")), "filer").select(
        F.lit("holding").alias("Source"), F.col("filer").alias("Filer"), F.col("issuer").alias("Code"), F.col("shares").alias("Shares"),
        F.col("cusip").alias("Day"), F.col("ticker").alias("Kind"))
    return one.unionByName(two)


@query("stage_funnel", "v_filings", "v_profiles", sql=COVERAGE_SQL + """
SELECT 'profiles' AS Stage, count(*) AS Rows FROM v_profiles UNION ALL SELECT 'gated', count(*) FROM v_profiles
  WHERE upper(exchange) IN ('NASDAQGS', 'NASDAQCM', 'NYSE', 'AMEX', 'NYSE AMERICAN') AND coalesce(price >= 1, TRUE) AND coalesce(market_cap >= 25000000, TRUE) AND coalesce(market_cap <= 350000000, TRUE)
UNION ALL SELECT 'eligible', count(*) FROM gate WHERE Eligible UNION ALL SELECT 'validated', 0
""")
def stage_funnel(t: Tables) -> DataFrame:
    profiles = t.profiles()
    return tab.stage_counts({
        "profiles": profiles, "gated": gates.universe_gate(profiles),
        "eligible": fil.eligible_tickers(fil.coverage(recent(t), profiles)), "validated": None}, t.spark)


@query("log_tail", "v_log", sql="SELECT ord AS LineId, message AS Message FROM v_log ORDER BY ts DESC, ord DESC LIMIT 500")
def log_tail(t: Tables) -> DataFrame:
    return tab.tail(t.view("v_log"), 500, "ts", "ord").select(F.col("ord").alias("LineId"), F.col("message").alias("Message"))


@query("progress_counts", "v_log", sql="""
WITH p AS (SELECT ts, ord, regexp_extract(message, '(T[0-9]+)', 1) AS tk, regexp_extract(message, 'fetching (.+) filed', 1) AS form,
    regexp_extract(message, 'filed ([0-9-]+)', 1) AS day, contains(message, ' runway status ') AS outcome, contains(message, 'status OK') AS ok FROM v_log),
c AS (SELECT *, last_value(CASE WHEN NOT outcome THEN form END IGNORE NULLS) OVER w AS f, last_value(CASE WHEN NOT outcome THEN form || '/' || day END IGNORE NULLS) OVER w AS key FROM p
   WINDOW w AS (PARTITION BY tk ORDER BY ts, ord ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
o AS (SELECT tk, coalesce(key, 'Unspecified/') AS key, coalesce(f, 'Unspecified') AS f, ok, row_number() OVER (PARTITION BY tk, coalesce(key, 'Unspecified/') ORDER BY ts, ord) AS rn FROM c WHERE outcome),
n AS (SELECT f, count(*) FILTER (ok) AS valid, count(*) FILTER (NOT ok) AS missing FROM o WHERE rn = 1 GROUP BY f
  UNION ALL SELECT form, 0, 0 FROM p WHERE NOT outcome GROUP BY form UNION ALL SELECT x, 0, 0 FROM (VALUES ('S-3'), ('S-8'), ('424B'), ('DEF 14A'), ('FORM 3'), ('FORM 4'), ('FORM 5')) v(x))
SELECT f AS Form, CAST(sum(valid + missing) AS BIGINT) AS Parsed, CAST(sum(valid) AS BIGINT) AS Valid, CAST(sum(missing) AS BIGINT) AS Missing,
  CASE WHEN f IN ('S-3', 'S-8', '424B', 'FORM 3', 'FORM 4', 'FORM 5') THEN 'NI' WHEN f = 'Unspecified' THEN 'Missing form detail' ELSE '' END AS Note FROM n GROUP BY f
""")
def progress_counts(t: Tables) -> DataFrame:
    return progress.progress(t.view("v_log")).select(
        F.col("form").alias("Form"), F.col("parsed").alias("Parsed"), F.col("valid").alias("Valid"), F.col("missing").alias("Missing"),
        F.col("note").alias("Note"))


@query("call_rate_60s", sql="""
SELECT DISTINCT event_type AS Host, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS At,
  count(*) OVER (PARTITION BY event_type ORDER BY ts RANGE BETWEEN INTERVAL 60 SECONDS PRECEDING AND CURRENT ROW) AS Calls FROM events
""")
def call_rate_60s(t: Tables) -> DataFrame:
    calls = t.base("events").select(F.col("event_type").alias("host"), "ts")
    return call_rate.trailing_calls(calls, bin_seconds=90).select(
        F.col("host").alias("Host"), F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("At"), F.col("calls").alias("Calls"))


@query("call_rate_one_hour", sql="""
SELECT DISTINCT event_type AS Host, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS At,
  count(*) OVER (PARTITION BY event_type ORDER BY ts RANGE BETWEEN INTERVAL 3600 SECONDS PRECEDING AND CURRENT ROW) AS Calls FROM events
""")
def call_rate_one_hour(t: Tables) -> DataFrame:
    """The same count with a window long enough to span several calls of the sample log."""
    calls = t.base("events").select(F.col("event_type").alias("host"), "ts")
    return call_rate.trailing_calls(calls, seconds=3600, bin_seconds=7200).select(
        F.col("host").alias("Host"), F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("At"), F.col("calls").alias("Calls"))
