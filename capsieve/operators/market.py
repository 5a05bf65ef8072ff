"""Prices and quotes: trading-volume averages, latest prices, spreads, market-data merge."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from capsieve.functions.text import cik, resolve_column, ticker
from capsieve.operators.keyed import last_per_key, top_rows
from capsieve.rules import RULES, Rules


def latest_with_adv(prices: DataFrame, ties: Sequence[Column] = (), rows: int = 20,
                    undated: str = "drop") -> DataFrame:
    """Latest bar per ticker with the mean volume of its last ``rows`` bars.

    The mean is null until all of these bars exist and have a volume. Only the
    last ``rows`` bars of a ticker are shuffled, so a ticker that owns a large
    share of the table costs no more than any other. ``undated='win'`` treats
    bars without a date as the newest.
    """
    if undated == "drop":
        prices = prices.where(F.col("Date").isNotNull())
    tail = top_rows(prices, ["Ticker"], [F.desc_nulls_first("Date"), *ties], rows, rank="__rank")
    newest = F.col("__rank") == 1
    return tail.groupBy("Ticker").agg(
        F.max(F.when(newest, F.col("Date"))).alias("PriceDate"),
        F.max(F.when(newest, F.col("Close"))).alias("Close"),
        F.when(F.count("Volume") == rows, F.avg("Volume")).alias("ADV20"),
    )


def adv_gate(latest: DataFrame, rules: Rules = RULES) -> DataFrame:
    """Tickers whose latest average volume reaches the minimum; a missing mean counts as 0."""
    if rules.adv_min <= 0:
        return latest
    return latest.where(F.coalesce(F.col("ADV20"), F.lit(0.0)) >= rules.adv_min)


def spread_metrics(quotes: DataFrame) -> DataFrame:
    """Add Spread, MidPrice and SpreadPct (null unless the middle price is positive)."""
    spread, mid = F.col("AskPrice") - F.col("BidPrice"), (F.col("AskPrice") + F.col("BidPrice")) / 2.0
    pct = F.when(mid > 0, spread / F.when(mid > 0, mid) * 100.0)
    finite = pct.isNotNull() & ~F.isnan(pct) & (F.abs(pct) != F.lit(float("inf")))
    return quotes.withColumns({"Spread": spread, "MidPrice": mid, "SpreadPct": F.when(finite, pct)})


def with_quotes(profiles: DataFrame, quotes: DataFrame, ordinal: str) -> DataFrame:
    """Profiles with the last quote of their ticker and its spread."""
    last = spread_metrics(last_per_key(quotes, ["Ticker"], ordinal)).drop(ordinal)
    return profiles.join(last, "Ticker", "left")


def market_table(df: DataFrame, *keep: str) -> DataFrame:
    """Ticker, CIK, Price, MarketCap, ADV20 from any table naming them in a known way, with the ``keep`` columns."""
    def pick(*names: str) -> Column:
        found = resolve_column(df.columns, names)
        return F.col(f"`{found}`") if found else F.lit(None)

    return df.select(
        ticker(pick("Ticker").cast("string")).alias("Ticker"),
        cik(pick("CIK")).alias("CIK"),
        pick("Price", "Close", "Last", "LastPrice").cast("double").alias("Price"),
        pick("MarketCap", "Market_Cap", "MarketCapitalization").cast("double").alias("MarketCap"),
        pick("ADV20", "AverageVolume20", "AverageVolume20Day").cast("double").alias("ADV20"),
        *keep,
    )


def merge_market(df: DataFrame, market: DataFrame, ordinal: str) -> DataFrame:
    """Fill null Price, MarketCap and ADV20 by ticker, then by CIK (last market row per key)."""
    columns = ["Price", "MarketCap", "ADV20"]
    out = df.withColumns({c: F.col(c) if c in df.columns else F.lit(None).cast("double") for c in columns})
    out = out.withColumns({"__ticker": ticker("Ticker"), "__cik": cik("CIK")})
    for source, key in (("Ticker", "__ticker"), ("CIK", "__cik")):
        last = last_per_key(market.where(F.col(source) != ""), [source], ordinal)
        last = last.select(F.col(source).alias(key), *[F.col(c).alias(f"__{c}") for c in columns])
        out = out.join(last, key, "left")
        out = out.withColumns({c: F.coalesce(F.col(c), F.col(f"__{c}")) for c in columns})
        out = out.drop(*[f"__{c}" for c in columns])
    return out.drop("__ticker", "__cik")
