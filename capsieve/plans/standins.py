"""Stand-in tables: the screener's inputs projected from the sample star schema.

The text is plain SQL that Spark and DuckDB both read. Every view covers its
whole source table; arithmetic on keys only assigns categories.
"""

from __future__ import annotations

import os
import re

from pyspark.sql import DataFrame, SparkSession

FILINGS_AS_OF = "2001-08-01"
EVENTS_AS_OF = "2024-01-31"

BASE_TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
    "embeddings", "pages", "benchmark", "labels", "conversations",
)

VIEWS: dict[str, str] = {
    "v_prices": """
SELECT concat('P', CAST(l_partkey AS STRING)) AS ticker, CAST(l_shipdate AS DATE) AS dt,
  l_extendedprice / l_quantity AS close, l_quantity AS volume,
  l_orderkey AS o1, l_linenumber AS o2, l_suppkey AS o3 FROM lineitem""",
    "v_profiles": """
SELECT concat('C', CAST(c_custkey AS STRING)) AS ticker, lpad(CAST(c_custkey AS STRING), 10, '0') AS cik,
  c_name AS company, c_mktsegment AS sector, n_name AS country,
  CASE c_custkey % 7 WHEN 0 THEN 'NASDAQGS' WHEN 1 THEN 'NYSE' WHEN 2 THEN 'AMEX' WHEN 3 THEN 'NASDAQCM'
    WHEN 4 THEN 'OTCQB' WHEN 5 THEN 'NYSE American' ELSE NULL END AS exchange,
  CASE WHEN c_custkey % 17 = 0 THEN NULL ELSE c_acctbal * 40000 END AS market_cap,
  CASE WHEN c_custkey % 23 = 0 THEN NULL ELSE CAST(c_custkey % 40 AS DOUBLE) / 4 END AS price,
  c_custkey AS ord
FROM customer JOIN nation ON c_nationkey = n_nationkey""",
    "v_quotes": """
SELECT ticker, CASE WHEN k % 19 = 0 THEN NULL ELSE mid - half END AS bid,
  CASE WHEN k % 13 = 0 THEN mid - half ELSE mid + half END AS ask, k AS ord
FROM (SELECT concat('P', CAST(p_partkey AS STRING)) AS ticker, p_partkey AS k,
  p_retailprice / CAST(100 + 100 * (p_partkey % 5) AS DOUBLE) AS mid, CAST(p_size AS DOUBLE) / 400 AS half FROM part) t""",
    "v_filings": """
SELECT lpad(CAST(o_custkey AS STRING), 10, '0') AS cik, concat('C', CAST(o_custkey AS STRING)) AS ticker,
  CASE o_orderkey % 14 WHEN 0 THEN '10-Q' WHEN 1 THEN '8-K' WHEN 2 THEN '6-K' WHEN 3 THEN '20-F' WHEN 4 THEN 'S-3'
    WHEN 5 THEN '424B5' WHEN 6 THEN 'DEF 14A' WHEN 7 THEN '4' WHEN 8 THEN '8-K/A' WHEN 9 THEN '10-K'
    WHEN 10 THEN 'S-8' WHEN 11 THEN 'SC 13G' WHEN 12 THEN '40-F' ELSE '' END AS form,
  CASE WHEN o_orderkey % 97 = 0 THEN NULL ELSE CAST(o_orderdate AS DATE) END AS filed_at,
  concat('https://www.sec.gov/Archives/edgar/data/', CAST(o_custkey AS STRING), '/', lpad(CAST(o_orderkey AS STRING), 18, '0'), '/doc.htm') AS url,
  o_orderkey AS ord FROM orders""",
    "v_events8k": """
SELECT concat('C', CAST(user_id AS STRING)) AS ticker, CAST(ts AS DATE) AS event_date, event_id AS ord,
  CASE event_type WHEN 'purchase' THEN '1.01;9.01' WHEN 'signup' THEN '8.01' WHEN 'error' THEN '2.02'
    WHEN 'view' THEN '5.02;9.01' ELSE '9.01' END AS items,
  CASE WHEN value > 20 THEN 'Tier-1' WHEN value > 8 THEN 'Tier-2' ELSE 'Other' END AS event_tier,
  concat('https://www.sec.gov/e/', CAST(event_id AS STRING)) AS primary_source_url FROM events""",
    "v_facts": """
SELECT lpad(CAST(o_custkey AS STRING), 10, '0') AS cik, CASE WHEN o_orderkey % 2 = 0 THEN 'Cash' ELSE 'OCF' END AS concept,
  CASE WHEN o_orderkey % 2 = 0 THEN o_totalprice ELSE o_totalprice - 250000 END AS val,
  CAST(o_orderdate AS DATE) AS end_dt, concat('A', CAST(o_orderkey % 3 AS STRING)) AS accn, o_orderkey AS ord FROM orders""",
    "v_txn": """
SELECT l_suppkey AS filer, CASE l_returnflag WHEN 'A' THEN 'P' WHEN 'R' THEN 'S' ELSE 'M' END AS code,
  l_quantity AS shares, CAST(l_shipdate AS DATE) AS txn_date FROM lineitem""",
    "v_fda": """
SELECT lpad(CAST(user_id AS STRING), 10, '0') AS cik, event_type, CAST(ts AS DATE) AS decision_date,
  concat('Device ', CAST(user_id AS STRING)) AS product, concat('https://www.fda.gov/d/', CAST(event_id AS STRING)) AS url,
  event_id AS ord FROM events""",
    "v_entities": """
SELECT concat('ENT ', CAST(c_custkey - c_custkey % 3 AS STRING)) AS entity, concat('C', CAST(c_custkey AS STRING)) AS ticker,
  lpad(CAST(c_custkey AS STRING), 10, '0') AS cik, CASE c_custkey % 5 WHEN 0 THEN 'low' WHEN 1 THEN 'medium' WHEN 2 THEN 'high' ELSE 'low' END AS confidence,
  c_custkey AS ord FROM customer""",
    "v_8k": """
SELECT concat('C', CAST(user_id AS STRING)) AS ticker, CAST(user_id AS STRING) AS cik, '8-K' AS form, CAST(ts AS DATE) AS filed_at,
  concat('https://www.sec.gov/e/', CAST(event_id - event_id % 2 AS STRING)) AS url,
  CASE event_type
    WHEN 'purchase' THEN '<p>Item 1.01 Material agreement.</p> A <b>purchase agreement</b> for the offering. Item 9.01 Exhibits.'
    WHEN 'signup' THEN 'Item 8.01 Other Events. The FDA granted clearance.'
    WHEN 'error' THEN 'ITEM 2.02 Results. Revenue was flat. Item 5.02 Changes.'
    WHEN 'view' THEN 'Item 9.01 Exhibits only.' ELSE 'Nothing to report' END AS txt,
  CASE WHEN value > 50 THEN 'Closing of a registered direct placement' END AS press, event_type AS kind, event_id AS ord FROM events""",
    "v_log": """
SELECT ts, CASE event_type WHEN 'click' THEN concat('parse_q10 [INFO] T', CAST(user_id AS STRING), ' fetching 10-Q filed ', CAST(CAST(ts AS DATE) AS STRING))
  WHEN 'view' THEN concat('parse_q10 [INFO] T', CAST(user_id AS STRING), ' fetching 6-K filed ', CAST(CAST(ts AS DATE) AS STRING))
  WHEN 'error' THEN concat('parse_q10 [WARN] T', CAST(user_id AS STRING), ' runway status Missing OCF')
  WHEN 'purchase' THEN concat('parse_q10 [OK] T', CAST(user_id AS STRING), ' runway status OK')
  ELSE concat('dr_forms [INFO] T', CAST(user_id AS STRING), ' fetching DEF 14A filed ', CAST(CAST(ts AS DATE) AS STRING)) END AS message,
  event_id AS ord FROM events""",
}

_TABLE = re.compile(r"\b(FROM|JOIN) (" + "|".join(BASE_TABLES) + r")\b")


class Tables:
    """The sample tables and the stand-in views of one folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def base(self, name: str) -> DataFrame:
        return self.spark.read.parquet(os.path.join(self.folder, f"{name}.parquet"))

    def sql(self, text: str, **frames: DataFrame) -> DataFrame:
        """Run SQL that names sample tables, views or the given frames."""
        names = {m.group(2) for m in _TABLE.finditer(text)}
        frames = {**{n: self.base(n) for n in names}, **frames}
        for name in frames:
            text = re.sub(rf"\b(FROM|JOIN) {name}\b", rf"\1 {{{name}}}", text)
        return self.spark.sql(text, **frames)

    def view(self, name: str) -> DataFrame:
        return self.sql(VIEWS[name])

    def prices(self) -> DataFrame:
        return self.view("v_prices").withColumnsRenamed(
            {"ticker": "Ticker", "dt": "Date", "close": "Close", "volume": "Volume"})

    def profiles(self) -> DataFrame:
        return self.view("v_profiles").withColumnsRenamed({
            "ticker": "Ticker", "cik": "CIK", "company": "Company", "sector": "Sector", "country": "Country",
            "exchange": "Exchange", "market_cap": "MarketCap", "price": "Price"})

    def quotes(self) -> DataFrame:
        return self.view("v_quotes").withColumnsRenamed({"ticker": "Ticker", "bid": "BidPrice", "ask": "AskPrice"})

    def filings(self) -> DataFrame:
        return self.view("v_filings").withColumnsRenamed(
            {"cik": "CIK", "ticker": "Ticker", "form": "Form", "filed_at": "FiledAt", "url": "URL"})

    def fda(self) -> DataFrame:
        return self.view("v_fda").withColumnsRenamed({
            "cik": "CIK", "event_type": "EventType", "decision_date": "DecisionDate", "product": "Product", "url": "URL"})

    def entities(self) -> DataFrame:
        return self.view("v_entities").withColumnsRenamed(
            {"entity": "FDA_EntityName", "ticker": "Ticker", "cik": "CIK", "confidence": "Confidence"})

    def eight_k(self) -> DataFrame:
        return self.view("v_8k").withColumnsRenamed(
            {"ticker": "Ticker", "cik": "CIK", "form": "Form", "filed_at": "FiledAt", "url": "URL", "txt": "Text"})

    def events8k(self) -> DataFrame:
        return self.view("v_events8k").withColumnRenamed("ticker", "Ticker")


def with_views(body: str, *names: str) -> str:
    """DuckDB text of a query over the named views."""
    parts = [f"{n} AS ({VIEWS[n].strip()})" for n in names]
    body = body.strip()
    if not parts:
        return body
    if body.upper().startswith("WITH "):
        return "WITH " + ",\n".join(parts) + ",\n" + body[5:]
    return "WITH " + ",\n".join(parts) + "\n" + body
