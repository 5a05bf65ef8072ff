"""Queries: market data, universe gates, filings gates, key repair."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from capsieve.catalog.base import query
from capsieve.functions import forms, text
from capsieve.operators import filings as fil
from capsieve.operators import gates, keyed, market
from capsieve.plans.standins import FILINGS_AS_OF, Tables
from capsieve.rules import RULES, Rules, lookback_per_form


def _ties() -> list:
    return [F.desc(c) for c in ("o1", "o2", "o3")]


ADV_SQL = """
WITH r AS (SELECT *, row_number() OVER (PARTITION BY ticker ORDER BY dt DESC, o1 DESC, o2 DESC, o3 DESC) AS rn
           FROM v_prices WHERE dt IS NOT NULL),
px AS (SELECT ticker AS Ticker, max(CASE WHEN rn = 1 THEN dt END) AS PriceDate,
              max(CASE WHEN rn = 1 THEN close END) AS Close,
              CASE WHEN count(CASE WHEN rn <= 20 THEN volume END) = 20
                   THEN avg(CASE WHEN rn <= 20 THEN volume END) END AS ADV20
       FROM r GROUP BY ticker)
"""


@query("adv20_latest", "v_prices", sql=ADV_SQL + """
SELECT Ticker, CAST(PriceDate AS VARCHAR) AS PriceDate, Close, ADV20 FROM px WHERE coalesce(ADV20, 0) >= 25
""")
def adv20_latest(t: Tables) -> DataFrame:
    latest = market.latest_with_adv(t.prices(), _ties())
    return market.adv_gate(latest, Rules(adv_min=25)).withColumn("PriceDate", F.col("PriceDate").cast("string"))


@query("universe_normalize", "v_profiles", sql="""
SELECT ticker AS Ticker, upper(trim(ticker)) AS TickerKey, regexp_replace(upper(concat(ticker, '.us')), '\\.US$', '') AS TickerBare,
  CASE WHEN length(digits) < 10 THEN lpad(digits, 10, '0') ELSE digits END AS CikDigits,
  CASE WHEN length(short) < 10 THEN lpad(short, 10, '0') ELSE short END AS CikShort,
  coalesce(CASE upper(trim(exchange)) WHEN 'NASDAQGS' THEN 'NASDAQ' WHEN 'NASDAQGM' THEN 'NASDAQ'
    WHEN 'NASDAQCM' THEN 'NASDAQ' WHEN 'NYSE AMERICAN' THEN 'NYSEAM' WHEN 'AMEX' THEN 'NYSEAM'
    ELSE upper(trim(exchange)) END, '') AS ExchangeKey,
  upper(trim(country)) AS CountryKey,
  upper(trim(country)) IN ('', 'US', 'USA', 'UNITED STATES', 'UNITED STATES OF AMERICA') AS IsUS
FROM (SELECT *, regexp_replace(concat('CIK-', cik), '[^0-9]', '', 'g') AS digits, CAST(ord AS VARCHAR) AS short FROM v_profiles) p
""")
def universe_normalize(t: Tables) -> DataFrame:
    p = t.profiles()
    return p.select(
        "Ticker", text.ticker("Ticker").alias("TickerKey"),
        text.ticker(F.concat("Ticker", F.lit(".us")), drop_us_suffix=True).alias("TickerBare"),
        text.cik(F.concat(F.lit("CIK-"), "CIK")).alias("CikDigits"),
        text.cik_keep_missing(F.concat(F.col("ord").cast("string"), F.lit(".0"))).alias("CikShort"),
        text.exchange("Exchange").alias("ExchangeKey"), text.country("Country").alias("CountryKey"),
        text.is_us("Country").alias("IsUS"))


@query("drop_patterns", sql="""
SELECT p_partkey AS PartKey, p_name AS Company, p_brand AS Ticker FROM part
WHERE NOT (contains(upper(p_name || ' ' || p_brand), 'OLD') OR contains(upper(p_name || ' ' || p_brand), '#5')
  OR regexp_matches(upper(p_name || ' ' || p_brand), '\\b(?:GADGET|SMALL)\\b'))
""")
def drop_patterns(t: Tables) -> DataFrame:
    rules = Rules(drop_substrings=("OLD", "#5"), drop_words=("GADGET", "SMALL"))
    p = t.base("part").select(
        F.col("p_partkey").alias("PartKey"), F.col("p_name").alias("Company"), F.col("p_brand").alias("Ticker"))
    return p.where(~gates.is_excluded_instrument("Company", "Ticker", rules))


@query("exchange_price_cap_gate", "v_profiles", sql="""
SELECT ticker AS Ticker, exchange AS Exchange, price AS Price, market_cap AS MarketCap FROM v_profiles
WHERE upper(exchange) IN ('NASDAQ', 'NASDAQGS', 'NASDAQGM', 'NASDAQCM', 'NYSE', 'AMEX', 'NYSE AMERICAN')
  AND coalesce(price >= 1, TRUE) AND coalesce(market_cap >= 25000000, TRUE) AND coalesce(market_cap <= 350000000, TRUE)
""")
def exchange_price_cap_gate(t: Tables) -> DataFrame:
    return t.profiles().where(gates.on_allowed_exchange("Exchange") & gates.price_and_cap_in_range()).select(
        "Ticker", "Exchange", "Price", "MarketCap")


@query("completeness_filter", "v_profiles", sql="""
SELECT ticker AS Ticker, cik AS CIK, exchange AS Exchange, price AS Price, market_cap AS MarketCap,
  CASE WHEN lower(country) IN ('nan', 'none', 'null') THEN '' ELSE trim(country) END AS Clean,
  CASE WHEN ord % 4 = 1 THEN TRUE ELSE FALSE END AS Flag
FROM v_profiles WHERE exchange IS NOT NULL AND trim(exchange) <> '' AND price IS NOT NULL AND market_cap IS NOT NULL
""")
def completeness_filter(t: Tables) -> DataFrame:
    p = t.profiles().withColumn("FlagText", F.when(F.col("ord") % 4 == 1, " Yes ").when(F.col("ord") % 4 == 2, "no")
                                .otherwise("?"))
    return gates.complete_rows(p).select(
        "Ticker", "CIK", "Exchange", "Price", "MarketCap", text.clean_text("Country").alias("Clean"),
        text.to_bool("FlagText").alias("Flag"))


@query("quote_spread_gate", "v_quotes", sql="""
WITH m AS (SELECT ticker, bid, ask, ask - bid AS spread, (ask + bid) / 2.0 AS mid,
             CASE WHEN (ask + bid) / 2.0 > 0 THEN (ask - bid) / ((ask + bid) / 2.0) * 100.0 END AS pct FROM v_quotes),
rules(lo, hi, cap) AS (VALUES (1.0, 2.0, 5.0), (2.0, 5.0, 3.0), (5.0, NULL, 2.0))
SELECT ticker AS Ticker, bid AS BidPrice, ask AS AskPrice, spread AS Spread, pct AS SpreadPct FROM m
WHERE bid > 0 AND ask > 0 AND ask > bid AND NOT EXISTS (
  SELECT 1 FROM rules WHERE m.mid >= lo AND (hi IS NULL OR m.mid < hi) AND (m.pct IS NULL OR m.pct >= cap))
""")
def quote_spread_gate(t: Tables) -> DataFrame:
    tickers = t.base("part").select(F.concat(F.lit("P"), F.col("p_partkey")).alias("Ticker"))
    quoted = market.with_quotes(tickers, t.quotes(), "ord")
    return gates.quote_gate(quoted).select("Ticker", "BidPrice", "AskPrice", "Spread", "SpreadPct")


_GROUP_VALUES = ", ".join(
    f"('{f}', {days})" for forms_, days in RULES.form_groups.values() for f in forms_)
_LISTED = ", ".join(f"('{f}')" for f in RULES.whitelist)


@query("lookback_per_form", "v_filings", sql=f"""
WITH g AS (SELECT f, max(d) AS d FROM (VALUES {_GROUP_VALUES}) g(f, d) GROUP BY f)
SELECT v.ord AS FilingId, v.form AS Form, g.d AS LookbackDays FROM v_filings v JOIN g ON g.f = v.form
""")
def lookback_table(t: Tables) -> DataFrame:
    """Every filing of a grouped form with the longest lookback any group gives that form."""
    table = lookback_per_form(RULES.form_group_table(t.spark))
    return t.filings().join(table, "Form").select(F.col("ord").alias("FilingId"), "Form", "LookbackDays")


LOOKBACK_SQL = f"""
WITH g AS (SELECT f, max(d) AS d FROM (VALUES {_GROUP_VALUES}) g(f, d) GROUP BY f),
listed AS (SELECT w.f, coalesce(g.d, 400) AS d FROM (VALUES {_LISTED}) w(f) LEFT JOIN g ON g.f = w.f),
m AS (SELECT v.*, l.d, row_number() OVER (PARTITION BY v.ord ORDER BY length(l.f) DESC) AS rn
      FROM v_filings v JOIN listed l ON starts_with(upper(trim(v.form)), l.f)),
k AS (SELECT v.*, g.d, row_number() OVER (PARTITION BY v.ord ORDER BY length(g.f) DESC NULLS LAST) AS rn
      FROM v_filings v LEFT JOIN g ON starts_with(upper(trim(v.form)), g.f))
"""


@query("form_lookback_longest_prefix", "v_filings", sql=LOOKBACK_SQL + f"""
SELECT ord AS FilingId, form AS Form, CAST(filed_at AS VARCHAR) AS FiledAt FROM m
WHERE rn = 1 AND filed_at >= DATE '{FILINGS_AS_OF}' - d
""")
def form_lookback_longest_prefix(t: Tables) -> DataFrame:
    return fil.whitelisted(t.filings(), FILINGS_AS_OF).select(
        F.col("ord").alias("FilingId"), "Form", F.col("FiledAt").cast("string").alias("FiledAt"))


@query("retention_purge", "v_filings", sql=LOOKBACK_SQL + f"""
SELECT ord AS FilingId, form AS Form, CAST(filed_at AS VARCHAR) AS FiledAt FROM k
WHERE rn = 1 AND (filed_at IS NULL OR filed_at >= DATE '{FILINGS_AS_OF}' - coalesce(d, 400))
""")
def retention_purge(t: Tables) -> DataFrame:
    return fil.purge(t.filings(), FILINGS_AS_OF).select(
        F.col("ord").alias("FilingId"), "Form", F.col("FiledAt").cast("string").alias("FiledAt"))


@query("form_canonical", "v_filings", sql=r"""
SELECT ord AS FilingId,
  CASE WHEN form = '' OR form = '4' OR form = 'SC 13G' THEN CASE WHEN form = 'SC 13G' THEN '13G' END
       WHEN form = '8-K/A' THEN '8-K' ELSE form END AS FormInText,
  CASE WHEN form = '8-K/A' THEN '8-K' ELSE form END AS Canonical,
  CASE WHEN form = '10-Q' THEN 0 WHEN form = '10-K' THEN 1 WHEN form IN ('20-F', '40-F') THEN 2 WHEN form = '6-K' THEN 3 ELSE 9 END AS Priority,
  lower(regexp_replace(regexp_replace(replace(form, ' ', ''), '/A$', ''), '[^A-Za-z0-9]', '', 'g')) AS GuardKey,
  CASE WHEN form = '' THEN 'Unknown' WHEN form = '4' THEN 'FORM 4' WHEN form LIKE '424B%' THEN '424B' WHEN form = '8-K/A' THEN '8-K' ELSE form END AS ProgressForm,
  CASE WHEN form = '10-Q' OR form = '6-K' THEN 3 WHEN form IN ('10-K', '20-F', '40-F') THEN 12 END AS Months,
  CASE WHEN form = '10-Q' THEN 'US_Quarterly' WHEN form = '10-K' THEN 'US_Annual' WHEN form IN ('20-F', '40-F') THEN 'Foreign_Annual'
       WHEN form = '6-K' THEN 'SixK' END AS Family,
  CASE WHEN form IN ('', '4') THEN NULL WHEN form = 'SC 13G' THEN '13G' WHEN form = '8-K/A' THEN '8-K' ELSE form END AS FormFromUrl
FROM v_filings
""")
def form_canonical(t: Tables) -> DataFrame:
    canonical = forms.canonical_form("Form")
    from capsieve.functions import urls
    link = F.concat(F.lit("https://www.sec.gov/x/doc.htm?form="), F.replace("Form", F.lit(" "), F.lit("")))
    return t.filings().select(
        F.col("ord").alias("FilingId"), forms.form_in_text("Form").alias("FormInText"), canonical.alias("Canonical"),
        forms.form_priority(canonical).alias("Priority"), forms.form_key("Form").alias("GuardKey"),
        forms.progress_form("Form").alias("ProgressForm"), forms.default_months(canonical).alias("Months"),
        forms.form_family(canonical).alias("Family"), urls.form_from_url(link).alias("FormFromUrl"))


COVERAGE_SQL = f"""
WITH x AS (SELECT ticker, upper(trim(form)) AS f FROM v_filings WHERE filed_at >= DATE '2001-01-01'
           UNION ALL SELECT ticker, '' FROM v_profiles),
c AS (SELECT ticker, max(f <> '') AS a, max(f LIKE '10-Q%' OR f LIKE '10-K%') AS core,
             max(f LIKE '20-F%' OR f LIKE '40-F%') AS ann, max(f LIKE '6-K%') AS inter FROM x GROUP BY ticker),
gate AS (SELECT ticker AS Ticker, core OR (ann AND inter) AS Eligible,
  CASE WHEN core OR (ann AND inter) THEN '' WHEN NOT a THEN 'no filings in lookback window'
       WHEN ann THEN 'missing 6-K alongside annual FPI filing' WHEN inter THEN 'missing 20-F/40-F alongside 6-K'
       ELSE 'no qualifying core filing forms' END AS Reason FROM c)
"""


def recent(t: Tables) -> DataFrame:
    return t.filings().where(F.col("FiledAt") >= F.lit("2001-01-01").cast("date"))


@query("coverage_gate", "v_filings", "v_profiles", sql=COVERAGE_SQL + "SELECT Ticker, Eligible, Reason FROM gate")
def coverage_gate(t: Tables) -> DataFrame:
    return fil.coverage(recent(t), t.profiles()).select("Ticker", "Eligible", "Reason")


@query("coverage_drop_detail", "v_filings", "v_profiles", sql=COVERAGE_SQL + """,
d AS (SELECT g.Ticker, g.Reason, upper(trim(p.country)) AS Country FROM gate g LEFT JOIN v_profiles p ON p.ticker = g.Ticker WHERE NOT g.Eligible),
rf AS (SELECT * FROM v_filings WHERE filed_at >= DATE '2001-01-01'),
f AS (SELECT ticker, list(form ORDER BY form)[1:5] AS fs FROM (SELECT DISTINCT ticker, form FROM rf WHERE form <> '') GROUP BY ticker),
u AS (SELECT ticker, list(url ORDER BY ord)[1:5] AS us FROM rf GROUP BY ticker),
n AS (SELECT ticker, 'FormStatus=missing form code' AS note FROM rf WHERE form = '' GROUP BY ticker)
SELECT d.Ticker, d.Reason, d.Country, coalesce(array_to_string(f.fs, ', '), '') AS Forms,
  coalesce(array_to_string(u.us, ' '), '') AS URLs, coalesce(n.note, '') AS Notes,
  concat(d.Reason, '; country=', d.Country, '; forms=', coalesce(array_to_string(f.fs[1:4], ', ') || CASE WHEN len(f.fs) > 4 THEN ' (+' || (len(f.fs) - 4) || ' more)' ELSE '' END, 'none'),
    CASE WHEN u.us IS NULL THEN '' ELSE '; url=' || u.us[1] || CASE WHEN len(u.us) > 1 THEN ' (+' || (len(u.us) - 1) || ' more)' ELSE '' END END,
    CASE WHEN n.note IS NULL THEN '' ELSE '; notes=' || n.note END) AS Message
FROM d LEFT JOIN f ON f.ticker = d.Ticker LEFT JOIN u ON u.ticker = d.Ticker LEFT JOIN n ON n.ticker = d.Ticker
""")
def coverage_drop_detail(t: Tables) -> DataFrame:
    filings = recent(t)
    details = fil.drop_details(filings, fil.coverage(filings, t.profiles()), "ord")
    return details.select(
        "Ticker", "Reason", "Country", F.array_join("Forms", ", ").alias("Forms"),
        F.array_join("URLs", " ").alias("URLs"), F.array_join("Notes", ", ").alias("Notes"),
        fil.drop_message().alias("Message"))


@query("restrict_profiles", "v_filings", "v_profiles", sql=COVERAGE_SQL + """
SELECT p.ticker AS Ticker, p.cik AS CIK, p.company AS Company FROM v_profiles p SEMI JOIN (SELECT * FROM gate WHERE Eligible) e ON e.Ticker = p.ticker
""")
def restrict_profiles(t: Tables) -> DataFrame:
    profiles = t.profiles()
    return fil.keep_eligible(profiles, fil.coverage(recent(t), profiles)).select("Ticker", "CIK", "Company")


@query("eligible_filings", "v_filings", "v_profiles", sql=COVERAGE_SQL + """
SELECT v.ord AS FilingId, v.ticker AS Ticker FROM v_filings v SEMI JOIN (SELECT * FROM gate WHERE Eligible) e ON e.Ticker = v.ticker
""")
def eligible_filings(t: Tables) -> DataFrame:
    filings = t.filings()
    return fil.keep_eligible(filings, fil.coverage(recent(t), t.profiles())).select(
        F.col("ord").alias("FilingId"), "Ticker")


@query("tickers_without_profile", "v_filings", "v_profiles", sql="""
SELECT DISTINCT o.ticker AS Ticker FROM v_filings o
ANTI JOIN (SELECT ticker FROM v_profiles WHERE market_cap IS NOT NULL) p ON p.ticker = o.ticker
""")
def tickers_without_profile(t: Tables) -> DataFrame:
    known = t.profiles().where("MarketCap IS NOT NULL").select("Ticker")
    return t.filings().select("Ticker").distinct().join(known, "Ticker", "left_anti")


@query("company_and_ticker_fill", "v_filings", "v_profiles", sql="""
SELECT f.ord AS FilingId, CASE WHEN f.ord % 3 = 0 THEN coalesce(p.ticker, '') ELSE f.ticker END AS Ticker,
  CASE WHEN f.ord % 5 = 0 THEN f.form ELSE coalesce(p.company, '') END AS Company
FROM v_filings f LEFT JOIN v_profiles p ON p.cik = f.cik
""".replace("CASE WHEN f.ord % 5 = 0 THEN f.form", "CASE WHEN f.ord % 5 = 0 AND f.form <> '' THEN f.form"))
def company_and_ticker_fill(t: Tables) -> DataFrame:
    f = t.filings().withColumns({
        "Ticker": F.when(F.col("ord") % 3 == 0, " ").otherwise(F.col("Ticker")),
        "Company": F.when(F.col("ord") % 5 == 0, F.col("Form"))})
    p = t.profiles()
    repaired = fil.fill_company(fil.fill_ticker(f, p, "ord"), p, "ord")
    return repaired.select(F.col("ord").alias("FilingId"), "Ticker", "Company")


@query("filing_age", "v_filings", sql=f"""
SELECT ord AS FilingId, CAST(date_diff('day', filed_at, DATE '{FILINGS_AS_OF}') AS BIGINT) AS Age,
  CAST(filed_at AS VARCHAR) AS Parsed FROM v_filings
""")
def filing_age(t: Tables) -> DataFrame:
    from capsieve.functions import dates
    f = fil.with_age(t.filings(), FILINGS_AS_OF)
    day_first = F.date_format("FiledAt", "dd/MM/yyyy")
    stamped = F.concat(F.date_format("FiledAt", "yyyy-MM-dd"), F.lit(" 10:11:12"))
    written = F.when(F.col("ord") % 2 == 0, day_first).otherwise(stamped)
    return f.select(F.col("ord").alias("FilingId"), F.col("Age").cast("bigint").alias("Age"),
                    dates.parse_date(written).cast("string").alias("Parsed"))


APPEND_SQL = """
WITH old AS (SELECT * FROM v_filings WHERE filed_at < DATE '2000-06-01' OR filed_at IS NULL),
new AS (SELECT * FROM v_filings WHERE filed_at >= DATE '2000-01-01'),
added AS (SELECT n.* FROM new n ANTI JOIN old o ON o.cik = n.cik AND o.url = n.url),
whole AS (SELECT *, FALSE AS IsNew FROM old UNION ALL SELECT *, TRUE FROM added)
"""


def appended(t: Tables) -> DataFrame:
    """An accumulated table and an overlapping newer delivery."""
    f, day = t.filings(), F.col("FiledAt")
    old = f.where((day < "2000-06-01") | day.isNull()).withColumn("IsNew", F.lit(False))
    new = f.where(day >= "2000-01-01").withColumn("IsNew", F.lit(True))
    return keyed.append_new(old, new, ["CIK", "URL"])


@query("append_antijoin_purge", "v_filings", sql=APPEND_SQL + f"""
SELECT ord AS FilingId, cik AS CIK, IsNew FROM whole WHERE filed_at IS NULL OR filed_at >= DATE '{FILINGS_AS_OF}' - 500
""")
def append_antijoin_purge(t: Tables) -> DataFrame:
    kept = keyed.keep_days(appended(t), "FiledAt", fil.as_date(FILINGS_AS_OF), 500)
    return kept.select(F.col("ord").alias("FilingId"), "CIK", "IsNew")


@query("rows_added", "v_filings", sql=APPEND_SQL + "SELECT count(*) AS RowsAdded FROM added")
def rows_added(t: Tables) -> DataFrame:
    return appended(t).where("IsNew").agg(F.count("*").alias("RowsAdded"))
