"""Screening rules: thresholds, form lists, lexicons.

The constants below are FIXED VALUES: results only match the published
screening rules when they are kept exactly as they are. Everything that a user
may tune is a field of :class:`Rules`.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# --------------------------------------------------------------------------
# universe
# --------------------------------------------------------------------------
DROP_SUBSTRINGS = ("ETF", "ETN", "ADR", "FUND", "TRUST", "PREF", ".U", "-U", ".WS", "-WS", ".W", "-W")
DROP_WORDS = (
    "UNIT", "UNITS", "WARRANT", "WARRANTS", "WTS", "WRT", "RTS", "RIGHT", "RIGHTS",
    "SPAC", "SPACS", "ACQ", "STAPLED",
)
EXCHANGE_ALIASES = {
    "NASDAQ": "NASDAQ", "NASDAQGS": "NASDAQ", "NASDAQGM": "NASDAQ", "NASDAQCM": "NASDAQ",
    "NYSE": "NYSE", "NYSE AMERICAN": "NYSEAM", "AMEX": "NYSEAM",
}
OTC_VENUES = ("OTC", "OTCQX", "OTCQB", "PINK", "GREY")
US_COUNTRIES = ("US", "USA", "UNITED STATES", "UNITED STATES OF AMERICA")

# --------------------------------------------------------------------------
# forms
# --------------------------------------------------------------------------
FORM_WHITELIST = (
    "8-K", "8-K/A", "10-Q", "10-Q/A", "10-QT", "10-QT/A", "10-K", "10-K/A", "10-KT", "10-KT/A",
    "20-F", "20-F/A", "40-F", "40-F/A", "6-K", "S-3", "S-3/A", "S-8", "S-8/A", "S-4",
    "424B1", "424B2", "424B3", "424B4", "424B5", "424B7", "424B8", "8-A12B", "DEF 14A",
    "13D", "13D/A", "13G", "13G/A", "13F-HR",
)
FORM_GROUPS = {
    "Financials_Quarterly": (("10-Q", "10-Q/A", "10-QT", "10-QT/A", "6-K"), 180),
    "Financials_Annual": (
        ("10-K", "10-K/A", "10-KT", "10-KT/A", "20-F", "20-F/A", "40-F", "40-F/A"), 400),
    "Catalyst": (("8-K", "8-K/A"), 180),
    "Dilution_Overhang": (
        ("S-3", "S-3/A", "424B1", "424B2", "424B3", "424B4", "424B5", "424B7", "424B8",
         "S-8", "S-8/A", "S-4", "8-K"), 400),
    "Governance": (("10-K", "10-K/A", "DEF 14A"), 400),
    "Ownership": (("13D", "13D/A", "13G", "13G/A", "13F-HR"), 365),
}
DEFAULT_LOOKBACK = 60
CORE_FORMS = ("10-Q", "10-K")                 # either one is enough
FOREIGN_ANNUAL_FORMS = ("20-F", "40-F")       # needs an interim form as well
FOREIGN_INTERIM_FORMS = ("6-K",)
RUNWAY_FORMS = ("10-Q", "10-K", "20-F", "6-K", "40-F")
FORM_FAMILY_MONTHS = {"10-Q": 3, "10-K": 12, "20-F": 12, "40-F": 12, "6-K": 3}
FORM_FAMILY = {
    "10-Q": "US_Quarterly", "10-K": "US_Annual", "20-F": "Foreign_Annual",
    "40-F": "Foreign_Annual", "6-K": "SixK",
}

# Form names inside free text. The first match wins.
FORM_IN_TEXT = (
    r"(?i)(10[-\s_/x]?QT?|10[-\s_/x]?KT?|20[-\s_/x]?F|40[-\s_/x]?F|6[-\s_/x]?K|8[-\s_/x]?K"
    r"|S[-\s_/x]?3|S[-\s_/x]?4|S[-\s_/x]?8|8[-\s_/x]?A12B|424B[1-8]|DEF\s*14A|13D|13G|13F[-\s_/x]?HR)"
)
FORM_TEXT_NAMES = {
    "10Q": "10-Q", "10K": "10-K", "20F": "20-F", "40F": "40-F", "6K": "6-K", "8K": "8-K",
    "S3": "S-3", "S4": "S-4", "S8": "S-8", "8A12B": "8-A12B", "DEF14A": "DEF 14A",
    "13D": "13D", "13G": "13G", "13FHR": "13F-HR",
}
# Form prefix -> label of the progress counters, in matching order.
PROGRESS_FORMS = (
    ("10-QT", "10-Q"), ("10-Q", "10-Q"), ("10-KT", "10-K"), ("10-K", "10-K"), ("20-F", "20-F"),
    ("40-F", "40-F"), ("6-K", "6-K"), ("S-3", "S-3"), ("S-8", "S-8"), ("424B", "424B"),
    ("DEF14A", "DEF 14A"), ("DEFM14", "DEF 14A"), ("DEFC14", "DEF 14A"), ("DEFA14A", "DEF 14A"),
    ("DEF 14", "DEF 14A"), ("3", "FORM 3"), ("4", "FORM 4"), ("5", "FORM 5"),
)
PROGRESS_PLACEHOLDERS = ("S-3", "S-8", "424B", "DEF 14A", "FORM 3", "FORM 4", "FORM 5")

# --------------------------------------------------------------------------
# Event lexicons
# --------------------------------------------------------------------------
EVENT_LEXICON = (
    ("ATM", ("at-the-market", "atm", "equity line", "registered direct", "convertible", "warrant", "offering")),
    ("FDA", ("fda", "clearance", "approval", "510(k)", "pdufa", "de novo")),
    ("GuidanceUp", ("guidance", "raise guidance", "increase guidance", "upward guidance")),
    ("ContractAward", ("contract", "award", "purchase order", "task order", "funded")),
    ("ListingChange", ("uplist", "upli", "listing", "nyse", "nasdaq", "spin-off", "spinoff")),
)
EVENT_ITEMS = (("2.02", "Earnings"), ("5.02", "ManagementChange"))
DILUTION_TAGS = (
    ("registered direct", "registered_direct"), ("securities purchase agreement", "spa"),
    ("purchase agreement", "purchase_agreement"), ("underwriting agreement", "underwriting_agreement"),
    ("subscription agreement", "subscription_agreement"), ("at-the-market", "atm"),
    ("equity line", "equity_line"), ("convertible", "convertible"), ("warrant", "warrant"),
    ("offering", "offering"),
)
DILUTION_ITEMS = ("1.01", "1.02", "3.02")
CATALYST_ITEMS = ("1.01", "1.02", "2.02", "5.02", "7.01", "8.01", "8.02", "8.03")
TIER1_TRIGGERS = (
    ("FDA", r"(510\(k\)|de ?novo|pdufa|approval|cleared|clearance|crl|complete response letter"
            r"|adcom vote|ind (accepted|cleared))"),
    ("GuidanceUp", r"(raises|increases|hikes)\s+guidance|guidance.*(raised|increased)"),
    ("FundedAward", r"(award|contract).*(obligated|obligation).*\$[0-9]"),
    ("OverhangRemoval", r"(terminate(d|s)?|withdraw(n|s)?)\s.*(atm|shelf|sales agreement|equity distribution)"),
)
CATALYST_ITEM_LABELS = (
    ("1.01", "Material Agreement"), ("2.02", "Earnings Results"), ("3.02", "Unregistered Sales"),
    ("7.01", "Reg FD"), ("8.01", "Other Events"),
)
CATALYST_KEYWORD_LABELS = (
    ("guidance", "Guidance"), ("contract|award|partnership", "Commercial Update"),
    ("regulatory|approval|clearance|adcom|pdufa", "Regulatory"),
    ("bankruptcy|restructuring", "Restructuring"), ("buyback", "Buyback"),
    ("uplist|downlist", "Listing Change"),
)

# --------------------------------------------------------------------------
# Dilution, governance, ownership evidence
# --------------------------------------------------------------------------
WEEKLY_DILUTION_FORMS = ("S-3", "S-8", "424B", "424B1", "424B2", "424B3", "424B4", "424B5", "424B7", "424B8")
RESEARCH_DILUTION_FORMS = (
    "S-3", "S-3ASR", "S-8", "424B", "424B1", "424B2", "424B3", "424B4", "424B5", "424B7", "424B8",
)
RESEARCH_DILUTION_WORDS = ("offering", "atm", "at-the-market", "sale of common stock", "equity line")
CATEGORY_DILUTION = ("S-1", "S-3", "S-4", "S-8", "424B")
CATEGORY_CATALYST = ("8-K", "6-K", "10-Q", "10-K", "S-4", "S-3", "S-1")
CATEGORY_GOVERNANCE = ("DEF 14", "8-A12")
CATEGORY_INSIDER = ("13D", "13G", "13F")
NEGATIVE_DILUTION_TERMS = ("high risk", "toxic", "at-the-market")
MANAGER_FORMS = ("13F", "13F-HR", "SC 13D", "SC 13G")
WATCH_DILUTION_FORMS = ("S-1", "S-3", "F-1", "F-3", "424B", "S-8")
WATCH_OFFERING_FORMS = ("S-1", "S-3", "F-1", "F-3", "424B")
WATCH_DILUTION_WORDS = (
    "equity distribution agreement", "atm", "at-the-market", "sales agreement", "registered direct",
    "underwritten", "follow-on", "prospectus supplement", "rule 415", "shelf", "pipe",
    "subscription agreement", "convertible note", "convertible debenture", "convertible", "warrant",
    "pre-funded",
)
FORM_URL_PATTERNS = (
    ("10q", r"/[^/]*10-?q"), ("10k", r"/[^/]*10-?k"), ("8k", r"/[^/]*8-?k"), ("6k", r"/[^/]*6-?k"),
    ("20f", r"/[^/]*20-?f"), ("40f", r"/[^/]*40-?f"), ("def14a", r"/[^/]*def14a"),
    ("424b", r"/[^/]*424b"), ("s1", r"/[^/]*s-?1"), ("s3", r"/[^/]*s-?3"), ("f1", r"/[^/]*f-?1"),
    ("f3", r"/[^/]*f-?3"), ("8a12b", r"/[^/]*8a12b"),
)
GOVERNANCE_FORMS = ("DEF 14A", "10-K", "20-F", "40-F")
INSIDER_LINK = r"(?i)(form[345]|xslf345)"
OWNERSHIP_LINK = r"(?i)(13f|sc13d|sc13g)"
CATALYST_GUARDED_FORMS = ("s3", "424b5", "424b3")
IMAGE_SUFFIXES = (".jpg", ".jpeg", ".png", ".gif", ".bmp", ".webp", ".tif", ".tiff", ".svg")

# --------------------------------------------------------------------------
# Cash-runway extraction
# --------------------------------------------------------------------------
BALANCE_HEADERS = ("CONSOLIDATED BALANCE SHEETS", "CONDENSED CONSOLIDATED BALANCE SHEETS", "BALANCE SHEETS")
CASHFLOW_HEADERS = (
    "CONSOLIDATED STATEMENTS OF CASH FLOWS", "CONSOLIDATED STATEMENT OF CASH FLOWS",
    "CONDENSED CONSOLIDATED STATEMENTS OF CASH FLOWS", "CONDENSED CONSOLIDATED STATEMENT OF CASH FLOWS",
    "STATEMENTS OF CASH FLOWS", "STATEMENT OF CASH FLOWS",
    "INTERIM CONDENSED CONSOLIDATED STATEMENTS OF CASH FLOWS",
    "INTERIM CONDENSED CONSOLIDATED STATEMENT OF CASH FLOWS",
)
CASHFLOW_HEADER_PATTERN = r"CONSOLIDATED\s*(?:CONDENSED\s*)?(?:INTERIM\s*)?STATEMENTS?\s*OF\s*CASH\s*FLOWS"
CASH_CAPTIONS_BALANCE = (
    "Cash and cash equivalents", "Cash and cash equivalents, current", "Cash",
    "Cash, cash equivalents and restricted cash",
    "Cash and cash equivalents including restricted cash", "Cash and restricted cash",
)
CASH_CAPTIONS_FLOW = (
    "Cash and cash equivalents, end of period", "Cash and cash equivalents at end of period",
    "Cash, cash equivalents and restricted cash, end of period",
    "Cash and cash equivalents, including restricted cash, end of period",
    "Cash, end of period", "Cash - End of period", "Cash – End of period", "Cash end of period",
    "Cash at end of period", "Cash at period end", "Cash, end of year", "Cash end of year",
    "Cash, end of the year", "End of period", "Cash and cash equivalents and restricted cash",
    "Cash and restricted cash, end of period", "Cash and restricted cash at end of period",
    "Cash and cash equivalents and restricted cash, end of period",
    "Cash from continuing operations, end of the period",
    "Cash from continuing operations, end of period",
)
OCF_CAPTIONS_BURN = (
    "Net cash used in operating activities - continuing operations",
    "Net cash used in operating activities — continuing operations",
    "Net cash used in operating activities from continuing operations",
    "Net cash used for operating activities - continuing operations",
    "Net cash (used in) operating activities - continuing operations",
    "Net cash (used in) operating activities — continuing operations",
    "Net cash used in operating activities, continuing operations",
    "Net cash (used in) operating activities, continuing operations",
    "Net cash used for operating activities, continuing operations",
    "Net cash used in operating activities",
    "Net cash used for operating activities",
    "Net cash (used in) operating activities",
    "Net cash flows used in operating activities",
    "Net cash used for operating activities — continuing operations",
    "Net cash flows (used in) operating activities",
    "Net cash used in operations",
    "Cash used in operations",
    "Cash used in operating activities",
    "Cash flows used in operating activities",
    "Cash flows (used in) operating activities",
    "Cash flows provided by (used in) operating activities",
    "Net cash outflow from operating activities",
    "Net cash (outflow) from operating activities",
    "Net cash used by operating activities",
)
OCF_CAPTIONS_PROVIDED = (
    "Net cash provided by operating activities - continuing operations",
    "Net cash provided by operating activities — continuing operations",
    "Net cash provided by operating activities from continuing operations",
    "Net cash provided by (used in) operating activities - continuing operations",
    "Net cash provided by (used in) operating activities — continuing operations",
    "Net cash from operating activities - continuing operations",
    "Net cash from operating activities — continuing operations",
    "Net cash provided by operating activities, continuing operations",
    "Net cash provided by (used in) operating activities, continuing operations",
    "Net cash flows from operating activities, continuing operations",
    "Net cash from operating activities, continuing operations",
    "Net cash provided by operating activities",
    "Net cash provided by (used in) operating activities",
    "Net cash flows from operating activities",
    "Net cash from operating activities",
    "Net cash provided from operating activities — continuing operations",
    "Net cash flows from operating activities — continuing operations",
    "Net cash provided from operating activities",
    "Net cash flow from operating activities",
    "Net cash generated from operating activities",
    "Net cash generated by operating activities",
    "Net cash flows generated by operating activities",
    "Net cash flows generated from operating activities",
    "Cash generated from operations",
    "Cash generated by operations",
    "Net cash inflow from operating activities",
    "Cash flows provided by operating activities",
    "Cash flows provided by (used in) operating activities",
    "Cash flows from operating activities",
)
STATEMENT_CASH_LABELS = (
    "Cash and cash equivalents", "Cash and cash equivalents, at end of period",
    "Cash and cash equivalents at carrying value",
)
CURRENCY_MARKERS = (
    "US$", "U.S.$", "C$", "CA$", "CAD", "USD", "EUR", "GBP", "AUD", "JPY", "RMB", "CHF", "HK$",
    "SGD", "NZD", "€", "£", "¥",
)
SCALE_PHRASE = r"(?i)\([^)]*?\bin\s+(thousand|thousands|million|millions)\b[^)]*\)"
PERIOD_PHRASES = (
    (12, r"(?i)twelve\s+months\s+ended"), (12, r"(?i)twelve\s+month\s+period"), (12, r"(?i)year\s+ended"),
    (9, r"(?i)nine\s+months\s+ended"), (6, r"(?i)six\s+months\s+ended"), (3, r"(?i)three\s+months\s+ended"),
)
PERIOD_COLUMN_PATTERNS = (
    (3, r"(?i)(THREE|3)\s+MONTH"), (6, r"(?i)(SIX|6)\s+MONTH"), (9, r"(?i)(NINE|9)\s+MONTH"),
    (12, r"(?i)(TWELVE|12)\s+MONTH|FISCAL YEAR|YEAR"),
)
FISCAL_PERIOD_MONTHS = {
    "Q1": 3, "Q2": 6, "Q3": 9, "Q4": 12, "FY": 12, "HY": 6, "H1": 6, "H2": 6, "YTD": 12,
}
CASH_CONCEPTS = (
    "CashAndCashEquivalentsAtCarryingValue", "CashAndCashEquivalents",
    "CashAndCashEquivalentsAndShortTermInvestments",
    "CashAndCashEquivalentsIncludingRestrictedCashCurrent",
    "CashAndCashEquivalentsAndOtherShortTermInvestments",
)
OCF_CONCEPTS = (
    "NetCashProvidedByUsedInOperatingActivities",
    "NetCashProvidedByUsedInOperatingActivitiesContinuingOperations",
    "NetCashProvidedByUsedInOperatingActivitiesExcludingDiscontinuedOperations",
    "NetCashProvidedByUsedInOperatingActivitiesConverted",
    "NetCashFlowsFromUsedInOperatingActivities", "NetCashFlowsFromOperatingActivities",
    "NetCashFlowsFromOperations",
)
PREFERRED_UNITS = ("USD", "USD ", "USD millions", "USDm", "USD $", "USD $ millions")
EXHIBIT_TOKENS = ("ex-99", "ex99", "exhibit 99", "ex_99")
EXHIBIT_FINANCIAL_WORDS = (
    "financial statements", "financial report", "audited financial", "condensed consolidated",
    "interim financial report", "interim consolidated",
)
EXHIBIT_NAME_HINT = r"(?i)\bex(?:hibit)?[-_. ]?99[-_. ]?[1235][a-z]?(\.\d+)?\b"
# --------------------------------------------------------------------------
# End of fixed values
# --------------------------------------------------------------------------


@dataclass(frozen=True)
class SpreadTier:
    min_price: float | None
    max_price: float | None
    max_spread_pct: float


@dataclass(frozen=True)
class Rules:
    """Everything tunable, with the published defaults."""

    min_price: float = 1.0
    cap_min: float = 25_000_000.0
    cap_max: float = 350_000_000.0
    adv_min: float = 40_000.0
    adv_rows: int = 20
    price_keep_days: int = 60
    spread_tiers: tuple[SpreadTier, ...] = (
        SpreadTier(1.0, 2.0, 5.0), SpreadTier(2.0, 5.0, 3.0), SpreadTier(5.0, None, 2.0))
    exchanges: tuple[str, ...] = ("NYSE", "NASDAQ", "AMEX")
    drop_substrings: tuple[str, ...] = DROP_SUBSTRINGS
    drop_words: tuple[str, ...] = DROP_WORDS
    whitelist: tuple[str, ...] = FORM_WHITELIST
    form_groups: dict[str, tuple[tuple[str, ...], int]] = field(default_factory=lambda: dict(FORM_GROUPS))
    use_filings_catalyst: bool = True
    use_fda_catalyst: bool = False
    shortlist_size: int = 40
    runway_stale_days: int = 465

    def form_lookbacks(self) -> dict[str, int]:
        """Longest lookback per form over all groups."""
        longest: dict[str, int] = {}
        for forms, days in self.form_groups.values():
            for name in forms:
                key = name.strip().upper()
                if key:
                    longest[key] = max(days, longest.get(key, days))
        return longest

    def max_lookback(self) -> int:
        return max(self.form_lookbacks().values(), default=DEFAULT_LOOKBACK)

    def form_group_table(self, spark: SparkSession) -> DataFrame:
        """The form groups as a table ``(group, forms, lookback_days)``."""
        rows = [(name, list(forms), days) for name, (forms, days) in self.form_groups.items()]
        return spark.createDataFrame(rows, "`group` string, forms array<string>, lookback_days int")


def lookback_per_form(groups: DataFrame) -> DataFrame:
    """``(Form, LookbackDays)``: the longest lookback of any group naming the form."""
    return (
        groups.select(F.explode("forms").alias("Form"), "lookback_days")
        .select(F.upper(F.trim("Form")).alias("Form"), "lookback_days")
        .where(F.col("Form") != "")
        .groupBy("Form")
        .agg(F.max("lookback_days").alias("LookbackDays"))
    )


RULES = Rules()
