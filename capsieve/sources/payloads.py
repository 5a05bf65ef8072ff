"""Landed vendor payloads -> tables.

Every reader takes a DataFrame with one JSON document per row in ``payload``
(for example ``spark.read.text(path, wholetext=True)``) and parses it with a
fixed schema. Parsing and exploding are map-only.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from capsieve.functions.text import (
    blank_to_null, cik_raw, description, empty, first_nonblank, strip, ticker, upper_key,
)
from capsieve.functions.urls import sec_url
from capsieve.operators.filings import whitelisted
from capsieve.operators.gates import is_excluded_instrument, universe_gate
from capsieve.operators.keyed import last_per_key
from capsieve.rules import RULES, Rules

_TICKER_LIST = "map<string, struct<ticker:string, cik_str:string, title:string>>"
_PROFILES = (
    "array<struct<symbol:string, cik:string, companyName:string, exchangeShortName:string, exchange:string,"
    " country:string, currency:string, sector:string, industry:string, mktCap:double, marketCap:double, price:double>>")
_QUOTES = (
    "array<struct<symbol:string, ticker:string, bidPrice:double, askPrice:double, bidSize:double, askSize:double,"
    " volume:double, timestamp:double, error:string, message:string, `Error Message`:string>>")
_FILINGS = (
    "array<struct<symbol:string, cik:string, companyName:string, type:string, form:string, filingDate:string,"
    " fillingDate:string, finalLink:string, linkToFilingDetails:string, reportUrl:string, link:string, items:string,"
    " documentTitle:string, primaryDocDescription:string, primaryDocumentDescription:string, description:string>>")
_PRICES = (
    "struct<symbol:string, ticker:string, historical:array<struct<date:string, open:double, high:double, low:double,"
    " close:double, volume:double>>>")
_DEVICES = (
    "array<struct<k_number:string, decision_date:string, device_name:string, link:string, decision_description:string>>")
_DRUGS = (
    "array<struct<applications:array<struct<application_number:string, sponsor_name:string, approval_date:string,"
    " original_approval_date:string, products:array<struct<brand_name:string>>>>>>")
_FACTS = (
    "struct<cik:string, taxonomy:string, tag:string, units:map<string, array<struct<val:double, accn:string,"
    " start:string, `end`:string, filed:string, fy:int, fp:string, form:string>>>>")
_TRANSACTIONS = (
    "struct<transactions:array<struct<transaction_date:string, transaction_code:string, is_derivative:boolean,"
    " shares:double, price:double, value:double, ownership_type:string>>>")
_HOLDINGS = (
    "array<struct<nameOfIssuer:string, cusip:string, sshPrnamt:double, sshPrnamtType:string, value:double, putCall:string>>")


def _records(schema: str) -> Column:
    """Payload as an array of records; a single object counts as a list of one."""
    text = strip("payload")
    listed = F.when(text.startswith("{"), F.concat(F.lit("["), text, F.lit("]"))).otherwise(text)
    return F.from_json(listed, schema)


def _text(c: str) -> Column:
    return F.coalesce(F.col(c), empty())


def company_list(payloads: DataFrame, rules: Rules = RULES) -> DataFrame:
    """Ticker, CIK, Company from the keyed ticker list; instruments that are no shares are left out."""
    rows = payloads.select(F.explode(F.map_values(F.from_json("payload", _TICKER_LIST))).alias("r"))
    rows = rows.select(ticker("r.ticker", True).alias("Ticker"), cik_raw("r.cik_str").alias("CIK"),
                       strip(_text("r.title")).alias("Company"))
    return rows.where((F.col("Ticker") != "") & ~is_excluded_instrument("Company", "Ticker", rules))


def profiles(payloads: DataFrame, rules: Rules = RULES, updated_at: Column | None = None, gated: bool = True) -> DataFrame:
    """Company profiles with their name aliases resolved, gated by default."""
    rows = payloads.select(F.explode(_records(_PROFILES)).alias("r")).select(
        ticker("r.symbol", True).alias("Ticker"), cik_raw("r.cik").alias("CIK"), _text("r.companyName").alias("Company"),
        first_nonblank("r.exchangeShortName", "r.exchange").alias("Exchange"), _text("r.country").alias("Country"),
        _text("r.currency").alias("Currency"), _text("r.sector").alias("Sector"), _text("r.industry").alias("Industry"),
        F.coalesce(F.nullif("r.mktCap", F.lit(0.0)), "r.marketCap").alias("MarketCap"), F.col("r.price").alias("Price"),
        (updated_at if updated_at is not None else F.lit(None)).cast("timestamp").alias("UpdatedAt"))
    return universe_gate(rows, rules) if gated else rows


def quotes(payloads: DataFrame, requested: DataFrame, ordinal: str) -> DataFrame:
    """One row per requested ticker: its last quote, or nulls. Error objects give no quote."""
    rows = payloads.select(ordinal, F.explode(_records(_QUOTES)).alias("r"))
    failed = F.coalesce(*[blank_to_null(f"r.`{c}`") for c in ("error", "message", "Error Message")])
    rows = rows.where(failed.isNull()).select(
        ordinal, ticker(first_nonblank("r.symbol", "r.ticker"), True).alias("Ticker"), F.col("r.bidPrice").alias("BidPrice"),
        F.col("r.askPrice").alias("AskPrice"), F.col("r.bidSize").alias("BidSize"), F.col("r.askSize").alias("AskSize"),
        F.col("r.volume").alias("AfterHoursVolume"),
        F.timestamp_millis(F.col("r.timestamp").cast("bigint")).alias("QuoteTimestamp"))
    last = last_per_key(rows.where("Ticker != ''"), ["Ticker"], ordinal).drop(ordinal)
    return requested.select(ticker("Ticker").alias("Ticker")).distinct().join(last, "Ticker", "left")


def filing_index(payloads: DataFrame, as_of: dt.date | str | Column, rules: Rules = RULES) -> DataFrame:
    """Listed filings inside their lookback, with canonical links and a short description."""
    items = F.when(F.col("r.items").startswith("["), F.array_join(F.from_json("r.items", "array<string>"), " ")).otherwise(F.col("r.items"))
    others = [F.col(f"r.{c}") for c in ("documentTitle", "primaryDocDescription", "primaryDocumentDescription", "description")]
    day = F.substring(first_nonblank("r.filingDate", "r.fillingDate"), 1, 10)
    rows = payloads.select(F.explode(_records(_FILINGS)).alias("r")).select(
        cik_raw("r.cik").alias("CIK"), upper_key("r.symbol").alias("Ticker"), _text("r.companyName").alias("Company"),
        first_nonblank("r.type", "r.form").alias("Form"), day.try_cast("date").alias("FiledAt"),
        sec_url(first_nonblank("r.finalLink", "r.linkToFilingDetails", "r.reportUrl", "r.link")).alias("URL"),
        description(items, *others).alias("Desc"))
    return whitelisted(rows, as_of, rules)


def price_history(payloads: DataFrame) -> DataFrame:
    """One row per bar."""
    doc = payloads.select(F.from_json("payload", _PRICES).alias("d"))
    rows = doc.select(ticker(first_nonblank("d.symbol", "d.ticker"), True).alias("Ticker"), F.explode("d.historical").alias("h"))
    return rows.select(
        F.col("h.date").try_cast("date").alias("Date"), "Ticker", F.col("h.open").alias("Open"), F.col("h.high").alias("High"),
        F.col("h.low").alias("Low"), F.col("h.close").alias("Close"), F.col("h.volume").alias("Volume"))


def device_clearances(payloads: DataFrame) -> DataFrame:
    """Device clearances; payload rows carry the Company, CIK and Ticker asked for."""
    rows = payloads.select("Company", "CIK", "Ticker", F.explode(_records(_DEVICES)).alias("r"))
    return rows.select(
        F.concat(F.lit("510k:"), _text("r.k_number")).alias("EventID"), F.col("Company").alias("ApplicantName"),
        F.lit("510k").alias("EventType"), _text("r.decision_date").alias("DecisionDate"), _text("r.device_name").alias("Product"),
        first_nonblank("r.link", "r.decision_description").alias("URL"), "CIK", "Ticker")


def drug_approvals(payloads: DataFrame) -> DataFrame:
    """Drug approvals, one row per product; applications without products give none."""
    apps = payloads.select("Company", "CIK", "Ticker", F.explode(_records(_DRUGS)).alias("r"))
    apps = apps.select("Company", "CIK", "Ticker", F.explode("r.applications").alias("a"))
    rows = apps.select("Company", "CIK", "Ticker", "a", F.explode("a.products").alias("p"))
    return rows.select(
        F.concat(F.lit("drug:"), _text("a.application_number"), F.lit(":"), _text("p.brand_name")).alias("EventID"),
        first_nonblank("a.sponsor_name", "Company").alias("ApplicantName"), F.lit("drug_approval").alias("EventType"),
        first_nonblank("a.approval_date", "a.original_approval_date").alias("DecisionDate"),
        _text("p.brand_name").alias("Product"), empty().alias("URL"), "CIK", "Ticker")


def concept_facts(payloads: DataFrame) -> DataFrame:
    """Tagged facts of company-concept documents, one row per value."""
    doc = payloads.select(F.from_json("payload", _FACTS).alias("d"))
    units = doc.select("d", F.explode("d.units").alias("Unit", "vals"))
    rows = units.select("d", "Unit", F.explode("vals").alias("v"))

    def day(*names: str) -> Column:
        return F.coalesce(*[F.substring(F.col(f"v.{n}"), 1, 10).try_cast("date") for n in names])

    return rows.select(
        cik_raw("d.cik").alias("CIK"), F.col("d.taxonomy").alias("Taxonomy"), F.col("d.tag").alias("Concept"), "Unit",
        F.col("v.val").alias("Val"), strip(_text("v.accn")).alias("Accn"), day("start").alias("Start"),
        day("end", "filed").alias("End"), F.col("v.fy").alias("Fy"), F.col("v.fp").alias("Fp"), F.col("v.form").alias("Form"))


def insider_transactions(payloads: DataFrame, *keep: str) -> DataFrame:
    """Transactions of ownership filings with the ``keep`` columns of their payload row."""
    rows = payloads.select(*keep, F.explode(F.from_json("payload", _TRANSACTIONS)["transactions"]).alias("t"))
    return rows.select(
        *keep, F.col("t.transaction_date").alias("TransactionDate"), F.col("t.transaction_code").alias("Code"),
        F.col("t.is_derivative").alias("IsDerivative"), F.col("t.shares").alias("Shares"), F.col("t.price").alias("PricePerShare"),
        F.col("t.value").alias("Value"), F.col("t.ownership_type").alias("OwnershipType"))


def holdings(payloads: DataFrame, *keep: str) -> DataFrame:
    """Holdings of a manager report. ``ticker`` repeats the amount type, as published."""
    rows = payloads.select(*keep, F.explode(_records(_HOLDINGS)).alias("h"))
    return rows.select(
        *keep, F.col("h.nameOfIssuer").alias("issuer"), F.col("h.sshPrnamtType").alias("ticker"), F.col("h.cusip").alias("cusip"),
        F.col("h.sshPrnamt").alias("shares"), F.col("h.value").alias("value"), F.col("h.sshPrnamtType").alias("type"),
        F.col("h.putCall").alias("put_call"))
