"""Row-level universe gates. All are plain predicates: one scan, no shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from capsieve import rules as R
from capsieve.functions.text import any_of, blank_to_null, contains_any, exchange, strip, upper_key
from capsieve.rules import RULES, Rules, SpreadTier


def passes(cond: Column) -> Column:
    """Null-safe predicate: unknown counts as false."""
    return F.coalesce(cond, F.lit(False))


def is_excluded_instrument(company: str, ticker: str, rules: Rules = RULES) -> Column:
    """Funds, units, warrants and the like, by substring or whole word of name and ticker."""
    text = strip(F.upper(F.concat_ws(" ", F.coalesce(F.col(company), F.lit("")), F.coalesce(F.col(ticker), F.lit("")))))
    words = F.lit(False)
    if rules.drop_words:
        words = text.rlike(r"\b(?:" + "|".join(rules.drop_words) + r")\b")
    return contains_any(text, rules.drop_substrings) | words


def on_allowed_exchange(column: str, rules: Rules = RULES) -> Column:
    """Listed on an allowed exchange and not on an over-the-counter venue."""
    otc = upper_key(column).rlike(r"\b(?:" + "|".join(R.OTC_VENUES) + r")\b")
    allowed = {R.EXCHANGE_ALIASES.get(x.upper(), x.upper()) for x in rules.exchanges}
    return ~otc & exchange(column).isin(*sorted(allowed))


def price_and_cap_in_range(rules: Rules = RULES, price: str = "Price", cap: str = "MarketCap") -> Column:
    """Known values must be in range; unknown ones pass here."""
    bad = passes(F.col(price) < rules.min_price)
    bad = bad | passes(F.col(cap) < rules.cap_min) | passes(F.col(cap) > rules.cap_max)
    return ~bad


def complete_rows(df: DataFrame) -> DataFrame:
    """Blank text becomes null, then every row with a null is dropped."""
    texts = {f.name: blank_to_null(strip(f"`{f.name}`")) for f in df.schema.fields
             if isinstance(f.dataType, T.StringType)}
    return df.withColumns(texts).dropna("any")


def has_usable_quote(bid: str = "BidPrice", ask: str = "AskPrice") -> Column:
    """Both sides present, positive and not locked or crossed."""
    return passes((F.col(bid) > 0) & (F.col(ask) > 0) & (F.col(ask) > F.col(bid)))


def in_tier(mid: Column, tier: SpreadTier) -> Column:
    low = F.lit(True) if tier.min_price is None else mid >= tier.min_price
    high = F.lit(True) if tier.max_price is None else mid < tier.max_price
    return low & high


def within_spread_cap(rules: Rules = RULES, mid: str = "MidPrice", pct: str = "SpreadPct") -> Column:
    """Spread below the cap of the price tier; prices outside all tiers pass.

    The tiers are configuration, so the range join folds into one predicate.
    """
    too_wide = any_of(
        in_tier(F.col(mid), t) & F.coalesce(F.col(pct) >= t.max_spread_pct, F.lit(True)) for t in rules.spread_tiers
    )
    return ~passes(too_wide)


def universe_gate(profiles: DataFrame, rules: Rules = RULES) -> DataFrame:
    """Instrument, exchange, price and size gates over company profiles."""
    return profiles.where(
        ~is_excluded_instrument("Company", "Ticker", rules)
        & on_allowed_exchange("Exchange", rules) & price_and_cap_in_range(rules)
    )


def quote_gate(profiles_with_quotes: DataFrame, rules: Rules = RULES) -> DataFrame:
    return profiles_with_quotes.where(has_usable_quote() & within_spread_cap(rules))


def shortlist_gate(hydrated: DataFrame, rules: Rules = RULES) -> DataFrame:
    """Price, size, volume and a catalyst of an enabled kind."""
    def present(c: str) -> Column:
        return passes(F.col(c).isNotNull() & (F.col(c) != ""))

    catalyst = F.lit(False)
    if rules.use_filings_catalyst:
        catalyst = catalyst | present("LatestForm")
    if rules.use_fda_catalyst:
        catalyst = catalyst | present("FDA_EventType")
    return hydrated.where(
        (F.col("Close") >= rules.min_price) & F.col("MarketCap").between(rules.cap_min, rules.cap_max)
        & (F.col("ADV20") >= rules.adv_min) & catalyst
    )


def watchlist_market_gate(price: str = "Price", cap: str = "MarketCap", adv: str = "ADV20",
                          rules: Rules = RULES) -> Column:
    """Stricter gate of the watchlist: unknown values fail, the size bound is exclusive."""
    return passes((F.col(price) >= rules.min_price) & (F.col(cap) < rules.cap_max) & (F.col(adv) >= rules.adv_min))
