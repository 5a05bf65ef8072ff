import datetime as dt

import pytest
from conftest import one
from pyspark.sql import functions as F

from capsieve.operators import evidence as ev
from capsieve.operators import events as evt
from capsieve.operators import filings as fil
from capsieve.operators import keyed, market, scoring, watchlist
from capsieve.sources import payloads

SNIPPETS = {
    "atm_801": ("Item 8.01 Other Events. The Company entered into an at-the-market equity distribution agreement.", "ATM", "Tier-1", True, True),
    "guidance_202": ("Item 2.02 Results. The Company raises guidance for fiscal year 2025.", "GuidanceUp", "Tier-1", False, True),
    "contract_101": ("Item 1.01 Entry. An obligated base value under the task order.", "ContractAward", "Tier-1", True, True),
    "items_302_901": ("Item 3.02 Unregistered Sales Item 9.01 Financial Statements", "Financing", "Tier-1", True, True),
    "item_502": ("Item 5.02 Departure of Directors", "ManagementChange", "Tier-2", False, True),
    "plain_801": ("Item 8.01 Other Events\nThe Company reports a material event under Item 8.01.", "OtherEvent", "Tier-2", False, True),
    "reg_fd_701": ("Item 7.01 Regulation FD Disclosure. Reg FD only update.", "OtherEvent", "Tier-2", False, True),
}


def test_eight_k_snippets(spark):
    rows = [(k, "1", "AAA", "8-K", dt.date(2025, 1, 1), f"https://x/{k}", v[0]) for k, v in SNIPPETS.items()]
    df = spark.createDataFrame(rows, "AccessionNo string, CIK string, Ticker string, Form string, FiledAt date, URL string, Text string")
    got = {r["AccessionNo"]: r for r in evt.build_events(evt.parse_8k(df)).collect()}
    for name, (_, kind, tier, dilution, catalyst) in SNIPPETS.items():
        r = got[name]
        assert (r["EventType"], r["EventTier"], r["IsDilution"], r["IsCatalyst"]) == (kind, tier, dilution, catalyst), name


def test_word_match_option(spark):
    df = spark.createDataFrame([("medical treatment",)], "t string")
    items = F.array().cast("array<string>")
    assert one(df.select(evt.classify("t", items)["type"].alias("x")))["x"] == "ATM"
    assert one(df.select(evt.classify("t", items, match="word")["type"].alias("x")))["x"] == "OtherEvent"


def test_append_twice_adds_nothing(spark):
    old = spark.createDataFrame([("1", "a"), (None, "b")], "CIK string, URL string")
    new = spark.createDataFrame([("1", "a", 1), (None, "b", 2), ("2", "c", 3), ("2", "c", 4)], "CIK string, URL string, n int")
    once = keyed.append_new(old, new, ["CIK", "URL"])
    assert once.count() == 4  # repeated keys inside a delivery stay
    assert keyed.append_new(once, new, ["CIK", "URL"]).count() == 4
    assert keyed.append_new(old, new, ["CIK", "URL"], dedupe=True).count() == 3


def test_text_parts_are_whole_and_bounded(spark):
    """A hot key with one huge undated day is cut into parts that join to the full text."""
    rows = [("hot", None, i, f"u{i}") for i in range(500)] + [("hot", dt.date(2024, 1, 1 + i % 9), 500 + i, f"d{i}") for i in range(120)]
    rows += [("cold", dt.date(2024, 1, 1), 1, "x"), ("cold", dt.date(2024, 2, 1), 2, "y")]
    df = spark.createDataFrame(rows, "k string, day date, o bigint, t string")
    parts = keyed.text_parts(df, ["k"], "o", "t", "cell", "day", lines_per_part=40).collect()
    cold = [r["cell"] for r in parts if r["k"] == "cold"]
    assert cold == ["y\nx"]
    hot = [r["cell"] for r in sorted((r for r in parts if r["k"] == "hot"), key=lambda r: r["EvidencePart"])]
    lines = "\n".join(hot).split("\n")
    expected = sorted((r for r in rows if r[0] == "hot"), key=lambda r: (-(r[1].toordinal()) if r[1] else 0, r[2]))
    assert lines == [r[3] for r in expected]
    assert len(hot) > 10 and max(len(c.split("\n")) for c in hot) <= 120


def test_parts_of_written_lines_equal_the_others(spark):
    """Long keys that are found by buckets first are cut as before, and lines are dealt by the key that the cells are used by."""
    rows = [("hot", f"c{i % 2}", None if i % 3 else dt.date(2024, 1, 1 + i % 9), i, f"t{i}") for i in range(400)]
    rows += [(f"k{i}", "c0", dt.date(2024, 1, 1), i, f"s{i}") for i in range(300)] + [("edge", "c1", None, i, f"e{i}") for i in range(41)]
    df = spark.createDataFrame(rows, "k string, c string, day date, o bigint, t string")
    found = []
    for dealt in (None, ["k"]):
        parts = keyed.text_parts(df, ["k", "c"], "o", "t", "cell", "day", lines_per_part=40, dealt=dealt)
        found.append(sorted(tuple(r) for r in parts.select("k", "c", "EvidencePart", "cell").collect()))
    assert found[0] == found[1] and len(found[0]) > 310
    crowded = keyed._crowded(df, ["k", "c"], 40, buckets=7)
    assert crowded.where("k IN ('hot', 'edge')").count() == 441
    assert keyed._crowded(df, ["k", "c"], 40).where("k IN ('hot', 'edge')").count() == 441


def test_adv_needs_twenty_bars_with_volume(spark):
    rows = [("A", dt.date(2024, 1, 1) + dt.timedelta(i), float(i), 10.0) for i in range(25)]
    rows += [("B", dt.date(2024, 1, 1) + dt.timedelta(i), 1.0, None if i == 20 else 5.0) for i in range(25)]
    rows += [("C", dt.date(2024, 1, 1), 1.0, 5.0), ("A", None, 99.0, 1.0)]
    df = spark.createDataFrame(rows, "Ticker string, Date date, Close double, Volume double")
    got = {r["Ticker"]: (r["Close"], r["ADV20"]) for r in market.latest_with_adv(df).collect()}
    assert got == {"A": (24.0, 10.0), "B": (1.0, None), "C": (1.0, None)}
    undated = {r["Ticker"]: r["Close"] for r in market.latest_with_adv(df, undated="win").collect()}
    assert undated["A"] == 99.0


def test_top_rows_limits_groups_before_the_shuffle(spark):
    plan = keyed.top_rows(spark.range(100).withColumn("k", F.col("id") % 3), ["k"], [F.desc("id")], 3)._jdf.queryExecution().executedPlan().toString()
    shuffle = plan.index("Exchange hashpartitioning")
    assert "WindowGroupLimit" in plan[shuffle:], "no map-side group limit below the shuffle"


def test_lookback(spark):
    df = spark.createDataFrame([("10-Q", dt.date(2024, 1, 21)), ("8-K", dt.date(2022, 12, 1)), ("8-K/A", dt.date(2023, 6, 1)), ("ZZ", dt.date(2024, 1, 1))],
                               "Form string, FiledAt date")
    assert [r["Form"] for r in fil.whitelisted(df, "2024-01-31").collect()] == ["10-Q"]
    assert {r["Form"] for r in fil.purge(df.unionByName(df.limit(1).withColumn("FiledAt", F.lit(None).cast("date"))), "2024-01-31").collect()} == {"10-Q", "ZZ"}


def test_company_list(spark):
    doc = '{"0":{"ticker":"abc","cik_str":123,"title":"Alpha"},"1":{"ticker":"x.U","cik_str":5,"title":"Unit Co"},"2":{"ticker":"w","cik_str":6,"title":"Warrant Holdings"}}'
    got = payloads.company_list(spark.createDataFrame([(doc,)], "payload string")).collect()
    assert [tuple(r) for r in got] == [("ABC", "0000000123", "Alpha")]


@pytest.mark.parametrize("count, catalyst, mandatory, mat, conv", [
    (3, "Tier-1", False, "FAIL", "Low"), (4, "Tier-1", True, "PASS", "High"), (4, "Tier-2", True, "PASS", "Medium"), (3, "Tier-1", True, "FAIL", "Low")])
def test_materiality(spark, count, catalyst, mandatory, mat, conv):
    df = spark.createDataFrame([(count, catalyst, mandatory)], "n int, c string, m boolean")
    df = df.withColumn("mat", scoring.materiality(F.col("n"), F.col("c"), F.col("m")))
    r = one(df.withColumn("conv", scoring.conviction(F.col("n"), F.col("c"), F.col("mat"))))
    assert r["mat"].startswith(mat) and r["conv"] == conv


def shortlist_frame(spark):
    return spark.createDataFrame(
        [("ABC", "Abc Bio", "0000000001", "Healthcare", "Biotechnology", 3.5, 5e7, 8e4), ("XYZ", "Xyz", "0000000002", "Tech", "Software", 4.0, 6e7, 9e4)],
        "Ticker string, Company string, CIK string, Sector string, Industry string, Price double, MarketCap double, ADV20 double")


def test_research_to_validation(spark):
    url = "file:///tmp/runway.html"
    filings = spark.createDataFrame(
        [("ABC", "0000000001", "10-Q", dt.date(2024, 5, 1), url, None, 1), ("ABC", "0000000001", "S-3", dt.date(2024, 4, 1), "https://www.sec.gov/s3", None, 2),
         ("ABC", "0000000001", "4", dt.date(2024, 4, 1), "https://www.sec.gov/f4", None, 3), ("XYZ", "0000000002", "8-K", dt.date(2024, 5, 1), "https://www.sec.gov/8k", None, 4)],
        "Ticker string, CIK string, Form string, FiledAt date, URL string, RunwayQuarters double, ord bigint")
    events = spark.createDataFrame(
        [("ABC", "0000000001", "2024-06-02", "ContractAward", "Tier-1", "https://www.sec.gov/e1", 1), ("XYZ", "0000000002", "2024-06-01", "OtherEvent", "Tier-2", "https://www.sec.gov/e2", 2)],
        "Ticker string, CIK string, event_date string, event_type string, event_tier string, primary_source_url string, ord bigint")
    texts = spark.createDataFrame([(url, "Cash and cash equivalents: $12,000,000 operating activities: $(3,000,000)")], "URL string, Text string")
    out = scoring.deep_research(shortlist_frame(spark), filings, events, "2024-06-30", documents=texts)
    rows = {r["Ticker"]: r.asDict() for r in out.collect()}
    assert rows["ABC"]["RunwayQuarters"] == 4.0 and rows["ABC"]["Runway (qtrs)"] == "4.0" and rows["ABC"]["DilutionScore"] == "High"
    assert rows["ABC"]["CatalystScore"] == "Tier-1" and rows["ABC"]["SubscoresEvidencedCount"] == 5 and rows["ABC"]["InsiderScore"] == "Strong"
    assert rows["ABC"]["Biotech Peer Read-Through (Y/N + link)"] == "Y:Peer: stub"
    checked = scoring.validate(out)
    assert [r["Ticker"] for r in scoring.validated_selections(checked).collect()] == ["ABC"]
    excluded = scoring.exclusions(checked).collect()
    assert [r["Ticker"] for r in excluded] == ["XYZ"] and excluded[0]["Reason"].startswith("Mandatory subscore missing: Runway")


def test_peers(spark):
    filings = spark.createDataFrame([], "Ticker string, CIK string, Form string, FiledAt date, URL string, RunwayQuarters double, ord bigint")
    events = spark.createDataFrame([], "Ticker string, CIK string, event_date string, event_type string, event_tier string, primary_source_url string, ord bigint")
    peers = spark.createDataFrame([("Biotechnology", "ABC", "Tier-1"), ("Biotechnology", "PEER", "Tier-1")], "Industry string, Ticker string, Tier string")
    out = scoring.deep_research(shortlist_frame(spark), filings, events, "2024-06-30", peers=peers)
    fields = {r["Ticker"]: r["Biotech Peer Read-Through (Y/N + link)"] for r in out.collect()}
    assert fields == {"ABC": "Y:Peer: PEER", "XYZ": "N"}


def test_shortlist_picks_newest_tier1(spark):
    universe = spark.createDataFrame([("AAA", "A", "1", "NASDAQ", 5e7, 8e4, 3.5), ("BBB", "B", "2", "NYSE", None, None, None)],
                                     "Ticker string, Company string, CIK string, Exchange string, MarketCap double, ADV20 double, Close double")
    events = spark.createDataFrame(
        [("AAA", "2024-06-02", "ContractAward", "Tier-1", "u1", 1), ("AAA", "2024-05-01", "Other", "Tier-2", "u2", 2), ("BBB", "2024-06-01", "Other", "Tier-2", "u3", 3)],
        "Ticker string, event_date string, event_type string, event_tier string, primary_source_url string, ord bigint")
    rows = {r["Ticker"]: r for r in scoring.candidate_shortlist(universe, events).collect()}
    assert (rows["AAA"]["EventDate"], rows["AAA"]["EventTier"], rows["AAA"]["NotesStatus"]) == ("2024-06-02", "Tier-1", "Pass")
    assert rows["BBB"]["NotesStatus"] == "TBD — exclude"


def test_evidence_entry_tie_keeps_the_earlier_one(spark):
    cell = "2024-01-01 | 8-K | https://a\n2024-01-01 | 10-K | https://b; 2023-01-01 | S-3 | https://c note"
    df = spark.createDataFrame([(cell,)], "c string").withColumn("e", ev.entries("c"))
    assert one(df.select(ev.primary_entry(F.col("e"))["form"].alias("f")))["f"] == "8-K"
    assert one(df.select(ev.format_entries(F.col("e")).alias("f")))["f"].endswith("2023-01-01 S-3 https://c note")


def test_offering_only_catalyst_leaves_nothing(spark):
    row = spark.createDataFrame(
        [("ABC", "1", "Abc", "Tech", 5.0, 1e8, 1e5, "8", "1000", "125", "interim", "10-Q", "2024-05-01", "https://www.sec.gov/Archives/edgar/data/1/x/10q.htm",
          "2024-05-01 S-3 https://www.sec.gov/Archives/edgar/data/1/x/s3.htm", "2024-05-01 S-3 https://www.sec.gov/Archives/edgar/data/1/x/s3.htm", "2024-05-01 10-K https://www.sec.gov/Archives/edgar/data/1/x/10k.htm")],
        "Ticker string, CIK string, Company string, Sector string, Price double, MarketCap double, ADV20 double, RunwayQuartersRaw string, RunwayCash string,"
        " RunwayQuarterlyBurn string, RunwayEstimate string, RunwaySourceForm string, RunwaySourceDate string, RunwaySourceURL string, Catalyst string, Dilution string, Governance string")
    market_rows = spark.createDataFrame([], "Ticker string, CIK string, Price double, MarketCap double, ADV20 double, ord bigint")
    events = spark.createDataFrame(
        [], "FilingURL string, CIK string, Ticker string, FilingDate string, IsCatalyst boolean, IsDilution boolean, CatalystType string, Tier1Type string,"
        " Tier1Trigger string, DilutionTags string, ord bigint")
    checked = watchlist.check_research(row, market_rows, events, "2024-06-01")
    assert one(checked.select("DropReason"))["DropReason"] == "Catalyst evidence missing"
    assert watchlist.watchlist(checked).count() == 0
