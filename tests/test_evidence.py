"""Companies with more evidence than a printed cell holds: one verdict, all lines."""

import datetime as dt

from pyspark.sql import functions as F

from capsieve.operators import filings as fil
from capsieve.operators import keyed, lines, scoring, watchlist
from capsieve.plans.standins import Tables

FOLDER = "/root/testdata/sf0.001"
LINE = "CIK string, Cell string, Day date, Seq bigint, Text string, Form string"


def core(spark, *tickers):
    rows = [(t, f"{t} Inc", "Health", f"c{t}", "10-Q", "2031-01-01", "https://primary", None, None, None) for t in tickers]
    return spark.createDataFrame(rows, "Ticker string, Company string, Sector string, CIK string, LatestForm string, FiledAt string, FilingURL string,"
                                       " FDA_EventType string, FDA_Date string, FDA_URL string")


def test_one_verdict_for_many_lines(spark):
    """30,000 lines of which one in the last part tells of dilution."""
    n = 30_000
    rows = spark.range(n).select(
        F.lit("cBIG").alias("CIK"), F.date_sub(F.lit("2031-01-01").cast("date"), (F.col("id") % 997).cast("int")).alias("Day"), F.col("id").alias("Seq"),
        F.when(F.col("id") == 996, "S-3").otherwise("10-Q").alias("Form"), F.concat(F.lit("https://l/"), "id").alias("URL"))
    evidence = fil.evidence_lines(rows, F.concat_ws(" | ", F.col("Day").cast("string"), "Form", "URL"), "Day", "URL", "Seq", *fil.FILING_CELLS)
    small = spark.createDataFrame([("cOne", "FilingsSummary", dt.date(2031, 1, 1), 1, "2031-01-01 | 10-K | https://x", "")], LINE)
    evidence = evidence.unionByName(small).withColumn("place", lines.place_of("Day", "Seq"))
    got = scoring.bundle(core(spark, "BIG", "One", "Bare"), evidence).collect()
    big = sorted((r for r in got if r["Ticker"] == "BIG"), key=lambda r: r["EvidencePart"])
    assert len(big) > 1 and {(r["HasDilutionFlag"], r["DilutionForms"]) for r in big} == {("TRUE", "S-3")}
    assert [r["DilutionLinks"] for r in big if r["DilutionLinks"]] == ["https://l/996"]
    links = "; ".join(r["CatalystEvidencePrimaryLinks"] for r in big if r["CatalystEvidencePrimaryLinks"]).split("; ")
    order = sorted(range(n), key=lambda i: (i % 997, i))
    assert links == ["https://primary", *(f"https://l/{i}" for i in order)]
    assert {r["Ticker"]: (r["HasDilutionFlag"], r["EvidencePart"]) for r in got if r["Ticker"] != "BIG"} == {"One": ("FALSE", 0), "Bare": ("FALSE", 0)}


def test_bundle_of_wanted_cells_only(spark):
    """Links left at all their places, in any number of parts, give the cells that distinct lines give."""
    t = Tables(spark, FOLDER)
    again = t.filings().unionByName(t.filings().withColumn("FiledAt", F.date_sub("FiledAt", 400)).withColumn("ord", F.col("ord") + 1_000_000))
    few, found = ("CatalystEvidencePrimaryLinks", "DilutionLinks"), []
    for every, cells in ((False, scoring.BUNDLE_CELLS), (True, few)):
        evidence = fil.company_evidence(again, t.fda(), every_link=every).withColumn("place", lines.place_of("Day", "Seq"))
        parts = t.profiles().withColumns({c: F.lit(None).cast("string") for c in ("LatestForm", "FiledAt", "FDA_EventType", "FDA_Date", "FDA_URL")})
        got = scoring.bundle(parts.withColumn("FilingURL", F.lit("https://primary")), evidence, lines_per_part=3, cells=cells)
        assert [c for c in scoring.BUNDLE_CELLS if c in got.columns] == list(cells)
        order = {c: {} for c in few}
        for r in sorted(got.collect(), key=lambda r: r["EvidencePart"]):
            for c in few:
                order[c].setdefault(r["Ticker"], []).extend(r[c].split("; ") if r[c] else [])
        found.append((order, {(r["Ticker"], r["HasDilutionFlag"], r["DilutionForms"], r["DilutionNotes"]) for r in got.collect()}))
    assert found[0] == found[1] and max(len(v) for v in found[0][0][few[0]].values()) > 6


def test_bundle_of_stored_cells(spark):
    """Printed rows, cut into parts or not, give the same verdicts and the same links."""
    t = Tables(spark, FOLDER)
    prices = spark.createDataFrame([], "Ticker string, PriceDate date, Close double, ADV20 double")
    found = []
    for size in (None, 3):
        hydrated = fil.hydrate(t.profiles(), prices, t.filings(), None, lines_per_part=size)
        parts = scoring.research_bundle(hydrated)
        found.append({r["Ticker"]: (r["HasDilutionFlag"], r["DilutionForms"], r["DilutionLinks"], r["CatalystEvidencePrimaryLinks"]) for r in parts.collect()})
    assert found[0] == found[1] and any(v[0] == "TRUE" for v in found[0].values())


def research_row(ticker, dilution, governance, catalyst):
    return dict(
        Ticker=ticker, CIK="1", Company=f"{ticker} Inc", Sector="Health", Price=5.0, MarketCap=5e7, ADV20=9e4, RunwayQuartersRaw="4", RunwayCash="1000",
        RunwayQuarterlyBurn="250", RunwayEstimate="interim", RunwaySourceForm="10-Q", RunwaySourceDate="2031-01-01", RunwayNotes="note",
        RunwaySourceURL="https://www.sec.gov/Archives/edgar/data/1/x/10q.htm", InsiderStatus="Pass", OwnershipStatus="Pass", Insider="", Status="Active",
        SubscoresEvidenced="Catalyst", Catalyst="; ".join(catalyst), Dilution="; ".join(dilution), Governance="; ".join(governance),
        FilingsSummary="\n".join([*dilution, *governance]))


def archive(form, i, name, note=""):
    return f"2030-{1 + i % 12:02d}-{1 + i % 28:02d} {form} https://www.sec.gov/Archives/edgar/data/1/{i}/{name} {note}".strip()


def cut(rows, cells, n):
    """Rows with their cells dealt over parts of n lines."""
    for row in rows:
        pieces = {c: [x for x in row[c].replace("\n", ";").split(";") if x.strip()] for c in cells}
        for part in range(max(1, max(-(-len(p) // n) for p in pieces.values()))):
            yield row | {c: "; ".join(p[part * n:(part + 1) * n]) for c, p in pieces.items()} | {"EvidencePart": part}


def test_parts_do_not_change_the_watchlist(spark):
    dilution = [archive("S-8", i, "s8.htm") for i in range(9)] + [archive("8-K", 50, "d8k.htm", "warrant"), archive("S-3", 3, "s3.htm"), archive("S-8", 2, "s8.htm")]
    governance = [archive("DEF 14A", i, "def14a.htm") for i in range(7)] + [archive("10-K", 40, "form10k.htm", "going concern")]
    catalyst = [archive("10-Q", i, "form10q.htm") for i in range(8)] + [archive("8-K", 90, "d8k.htm", "fda clearance")]
    rows = [research_row("AAA", dilution, governance, catalyst), research_row("BBB", dilution[:5], governance[:2], catalyst[:3]),
            research_row("CCC", dilution[-1:], [], catalyst[-1:]), research_row("DDD", [*dilution, "toxic note"], governance, catalyst)]
    cells = ("Catalyst", "Dilution", "Governance", "FilingsSummary")
    market = spark.createDataFrame([], "Ticker string, CIK string, Price double, MarketCap double, ADV20 double, ord bigint")
    event = dict(Ticker="", CIK="", FilingDate="2030-02-02", FilingURL="https://www.sec.gov/Archives/edgar/data/1/90/d8k.htm", CatalystType="Tier-1", Tier1Type="FDA",
                 Tier1Trigger="x", IsCatalyst=True, IsDilution=False, DilutionTags="", ord=1)
    events = spark.createDataFrame([event])
    found = []
    for table in ([r | {"EvidencePart": 0} for r in rows], list(cut(rows, cells, 4))):
        checked = watchlist.check_research(spark.createDataFrame(table), market, events, "2031-01-31")
        found.append([r.asDict() for r in checked.orderBy("Ticker", "EvidencePart").collect()])
    whole, parts = ({t: [r for r in rs if r["Ticker"] == t] for t in "AAA BBB CCC DDD".split()} for rs in found)
    lists = ("DilutionEvidenceAll", "GovernanceEvidenceAll", "EvidencePart", "RunwayNotes")
    for t, (one,) in whole.items():
        for row in parts[t]:
            assert {k: v for k, v in row.items() if k not in lists} == {k: v for k, v in one.items() if k not in lists}, t
        for name in lists[:2]:
            assert "; ".join(r[name] for r in parts[t] if r[name]) == one[name]
    assert len(parts["AAA"]) > 1 and whole["AAA"][0]["DropReason"] != whole["DDD"][0]["DropReason"] == "Negative dilution terms"
    assert whole["AAA"][0]["HasGoingConcern"] and whole["AAA"][0]["DilutionStatus"] == "Pass (Offering)"
    counts = {r["DropReason"]: r["Rows"] for r in watchlist.drop_counts(checked).collect()}
    assert sum(counts.values()) == sum(r[0]["DropReason"] != "" for r in whole.values())


def test_reports_count_candidates(spark):
    """Dilution evidence that stands in the second part only counts; every part has the same verdict."""
    base = {"Ticker": "A", "Company": "A", "CIK": "1", "RunwayQuarters": 4.0, "RunwayEvidencePrimary": "https://r", "DilutionScore": "High", "CatalystScore": "Tier-1",
            "CatalystEvidencePrimary": "https://c", "SubscoresEvidencedCount": 5, "Materiality": "PASS", "BiotechPeerRead": "N", "Evidence (Primary links)": "https://p;https://q"}
    rows = [base | {"EvidencePart": 0, "DilutionEvidencePrimary": ""}, base | {"EvidencePart": 1, "DilutionEvidencePrimary": "https://d", "Evidence (Primary links)": "https://z"}]
    rows += [r | {"Ticker": "B", "CIK": "2", "SubscoresEvidencedCount": 1} for r in rows]
    checked = scoring.validate(spark.createDataFrame(rows))
    good = scoring.validated_selections(checked).collect()
    assert {(r["Ticker"], r["EvidencePart"], r["PrimarySource"]) for r in good} == {("A", 0, "https://p"), ("A", 1, "https://p")}
    assert [(r["Ticker"], r["Reason"]) for r in scoring.exclusions(checked).collect()] == [("B", "Subscores <4/5")]
    assert scoring.runway_coverage(checked).collect()[0].asDict() == {"Total": 2, "WithQuarters": 2, "Missing": 0, "EvidenceOnly": 0}


def test_cells_of_several_tables(spark):
    rows = spark.createDataFrame([("A", 1), ("B", 2)], "Ticker string, n int")
    a = spark.createDataFrame([("A", 0, "x"), ("A", 1, "y")], "Ticker string, EvidencePart bigint, one string")
    b = spark.createDataFrame([("A", 0, "u"), ("A", 2, "v")], "Ticker string, EvidencePart bigint, two string")
    got = sorted(tuple(r) for r in keyed.with_all_parts(rows, "Ticker", (a, ["one"]), (b, ["two"])).select("Ticker", "EvidencePart", "one", "two").collect())
    assert got == [("A", 0, "x", "u"), ("A", 1, "y", None), ("A", 2, None, "v"), ("B", 0, None, None)]
