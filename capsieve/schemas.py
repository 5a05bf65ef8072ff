"""Fixed schemas of the stage tables. Keys and identifiers are always text."""

from __future__ import annotations

from pyspark.sql import types as T



TABLES: dict[str, str] = {
    "01_profiles": (
        "Ticker string, CIK string, Company string, Exchange string, Country string, Currency string, Sector string,"
        " Industry string, MarketCap double, Price double, UpdatedAt timestamp, BidPrice double, AskPrice double,"
        " BidSize double, AskSize double, AfterHoursVolume double, QuoteTimestamp timestamp, Spread double, SpreadPct double"),
    "02_filings": (
        "CIK string, Ticker string, Company string, Form string, FiledAt date, Age int, URL string, RunwayQuarters double,"
        " HasRunway boolean, RunwaySourceURL string, `Desc` string, ord bigint"),
    "03_prices": "Date date, Ticker string, Open double, High double, Low double, Close double, Volume double",
    "04_fda": (
        "EventID string, ApplicantName string, EventType string, DecisionDate date, Product string, URL string, CIK string,"
        " Ticker string, ord bigint"),
    "05_hydrated_candidates": (
        "Ticker string, EvidencePart bigint, Company string, Sector string, CIK string, MarketCap double, PriceDate date,"
        " Close double, ADV20 double, LatestForm string, FiledAt date, FilingURL string, FilingsSummary string,"
        " FilingURLsAll string, FDA_EventType string, FDA_Date date, FDA_URL string, FDA_Summary string, FDA_URLsAll string"),
    "runlog": "ts timestamp, module string, rows bigint, ms bigint, note string",
    "errorlog": "ts timestamp, module string, message string",
}
TABLES["01_universe_gated"] = TABLES["01_profiles"]


# The columns of the published watchlist report, in its order.
WATCHLIST_COLUMNS = (
    "Ticker", "Company", "Sector", "CIK", "Price", "MarketCap", "ADV20", "LatestForm", "LatestFiledAt",
    "LatestFiledAgeDays", "CatalystType", "Catalyst", "CatalystStatus", "CatalystPrimaryForm", "CatalystPrimaryDate",
    "CatalystPrimaryDaysAgo", "CatalystPrimaryURL", "RunwayQuartersRaw", "RunwayQuarters", "RunwayCashRaw",
    "RunwayCash", "RunwayQuarterlyBurnRaw", "RunwayQuarterlyBurn", "RunwayEstimate", "RunwayNotes", "RunwayDays",
    "RunwayBucket", "RunwaySourceForm", "RunwaySourceDate", "RunwaySourceDaysAgo", "RunwaySourceURL", "RunwayStatus",
    "DilutionFlag", "Dilution", "DilutionStatus", "DilutionFormsHit", "DilutionKeywordsHit", "DilutionPrimaryForm",
    "DilutionPrimaryDate", "DilutionPrimaryDaysAgo", "DilutionPrimaryURL", "DilutionEvidenceAll", "Governance",
    "GovernanceStatus", "GovernancePrimaryForm", "GovernancePrimaryDate", "GovernancePrimaryDaysAgo",
    "GovernancePrimaryURL", "GovernanceEvidenceAll", "GovernanceNotes", "HasGoingConcern", "HasMaterialWeakness",
    "Auditor", "Insider", "InsiderStatus", "InsiderForms345Links", "InsiderBuyCount", "HasInsiderCluster",
    "Ownership", "OwnershipStatus", "OwnershipLinks", "Materiality", "SubscoresEvidenced", "SubscoresEvidencedCount",
    "Status", "ChecklistPassed", "ChecklistCatalyst", "ChecklistDilution", "ChecklistRunway", "ChecklistGovernance",
    "ChecklistInsider", "ChecklistOwnership", "RiskFlag", "Tier1Type", "Tier1Trigger",
)
# End of the fixed values.


def schema(name: str) -> T.StructType:
    return T.StructType.fromDDL(TABLES[name])
