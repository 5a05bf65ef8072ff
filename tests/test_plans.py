"""Costly steps stand once in a plan, and tables used several times are read where they were written."""

import datetime as dt

from pyspark.sql import functions as F

from capsieve.catalog import research
from capsieve.catalog import runway as runway_catalog
from capsieve.functions import dates, urls
from capsieve.operators import events as evt
from capsieve.operators import runway as rw
from capsieve.operators import runway_rules as rr
from capsieve.operators import scoring
from capsieve.operators import scoring
from capsieve.plans.standins import Tables

FOLDER = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().analyzed().toString()


def test_events_are_parsed_once_for_four_look_ups(spark):
    text = plan(research.watch_rows(Tables(spark, FOLDER)))
    assert evt.ITEM not in text


def test_events_of_links_that_no_row_names_meet_none(spark):
    fields = "CIK string, Ticker string, FilingURL string, FilingDate string, ord long"
    events = spark.createDataFrame([
        (None, "A", "https://x.example/edgar/data/1/aa/1.htm", "2024-01-01", 1), (None, "A", "https://x.example/edgar/data/1/aa/2.htm", "2024-02-01", 2),
        (None, "Z", "https://x.example/edgar/data/1/bb/3.htm", "2024-03-01", 3)], fields)
    rows = spark.createDataFrame([(1, "", "A", "https://x.example/edgar/data/1/aa/1.htm"), (2, "", "A", "https://other.example"), (3, "", "Q", "https://x.example/edgar/data/9/BB/9.htm"),
                                  (4, "", "Q", None)], "id long, CIK string, Ticker string, u string")
    out = evt.match_events(rows, events, "id", evt.candidate_links("u"), "ord")
    assert {r.id: r.event and r.event.FilingURL[-5:] for r in out.collect()} == {1: "1.htm", 2: "2.htm", 3: "3.htm", 4: None}


def test_lines_of_a_bundle_are_printed_from_one_table(spark):
    text = plan(research.research_bundle(Tables(spark, FOLDER)))
    # the union of links that is printed is made before: cells come from a written table
    assert "Union" not in text


def test_a_bundle_writes_and_shuffles_only_what_is_printed(spark, monkeypatch):
    written, store = {}, scoring.stored_once

    def spy(df, name):
        written[name] = store(df, name)
        return written[name]

    monkeypatch.setattr(scoring, "stored_once", spy)
    out = research.research_bundle(Tables(spark, FOLDER))
    assert "bundle-lines" not in written
    assert {r.Cell for r in written["bundle-printed"].select("Cell").distinct().collect()} == {"CatalystEvidencePrimaryLinks", "DilutionLinks"}
    # prices, filings and clearances are ranked once, for both uses of the core rows
    assert "bundle-core" in written and "Window" not in out._jdf.queryExecution().optimizedPlan().toString().replace("LogicalWindow", "Window").split("bundle")[0]
    # lines pass one shuffle, by company and part, on their way to the cells
    text = out._jdf.queryExecution().executedPlan().toString()
    assert text.count("REPARTITION_BY_COL") == 1 and text.count("ObjectHashAggregate") <= 4


def test_a_bundle_writes_and_shuffles_only_what_is_printed(spark, monkeypatch):
    written, store = {}, scoring.stored_once

    def spy(df, name):
        written[name] = store(df, name)
        return written[name]

    monkeypatch.setattr(scoring, "stored_once", spy)
    out = research.research_bundle(Tables(spark, FOLDER))
    assert set(written) == {"bundle-core", "bundle-hits", "bundle-printed"}
    assert {r.Cell for r in written["bundle-printed"].select("Cell").distinct().collect()} == {"CatalystEvidencePrimaryLinks", "DilutionLinks"}
    # prices, filings and clearances are ranked once, for both uses of the core rows; lines pass one shuffle on their way to the cells
    text = out._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" not in text and text.count("Exchange hashpartitioning") == 5 and text.count("REPARTITION_BY_COL") == 1


def test_unprinted_fields_of_a_verdict_are_not_joined(spark):
    files = runway_catalog.extracted(Tables(spark, FOLDER), False)
    stored = [f for f in files.inputFiles() if "runway-rows" in f]
    verdict = spark.read.parquet(*stored).schema["__v"].dataType
    assert "source_tags" not in verdict.names and {"cash", "status", "complete"} <= set(verdict.names)


def test_link_checks_and_verdicts_of_the_runway_choice_are_computed_once(spark, monkeypatch):
    written, store = {}, rw.stored_once

    def spy(df, name):
        written[name] = df._jdf.queryExecution().optimizedPlan().toString()
        return store(df, name)

    monkeypatch.setattr(rw, "stored_once", spy)
    runway_catalog.extracted(Tables(spark, FOLDER), False)
    assert written["runway-rows"].count("UrlCodec.decode") == 1
    assert written["runway-rows"].count("-800.0") == 1
    # notes are chosen once, not for each of the counts over them
    assert "runway-notes" in written


def test_only_companies_with_a_key_and_named_links_have_a_runway(spark):
    day = dt.date(2024, 1, 2)
    files = spark.createDataFrame([
        ("1", "10-Q", day, "https://www.sec.gov/x/10q.htm", 1), ("n/a", "10-Q", day, "https://www.sec.gov/y/10q.htm", 2),
        (None, "10-K", day, "https://www.sec.gov/z/10k.htm", 3), ("CIK 2", "10-K/A", day, "https://other.example/z", 4), ("3", "6-K", day, " ", 5)],
        "CIK string, Form string, FiledAt date, URL string, ord long")
    verdict = rr.finalize(F.lit(800.0), F.lit(-400.0), F.lit(3), F.lit("10-Q"))
    results = files.select("URL", F.when(F.col("URL") != " ", verdict).alias("result"))
    companies = spark.createDataFrame([("A", "1"), ("B", "2"), ("C", "3"), ("D", "")], "Ticker string, CIK string")
    out = {r.Ticker: (r.RunwayStatus, r.RunwayQuarters) for r in rw.extract_runway(companies, files, results, "2024-01-31").collect()}
    assert out == {"A": ("OK", "2.00"), "B": ("Form/URL mismatch", ""), "C": ("Fetch error", ""), "D": ("No eligible filing", "")}



def test_links_and_dates_name_each_pattern_once(spark):
    rows = spark.createDataFrame([("https://www.sec.gov/ix?doc=/Archives/edgar/data/1/000000000000000002/a.htm",), (None,), ("x",)], "u string")
    out = rows.select(urls.sec_url("u").alias("s"), urls.viewer_document("u").alias("v"), urls.filing_ids("u").alias("i"), dates.parse_date("u").alias("d"))
    assert plan(rows.select(urls.sec_url("u"))).count("(?:^|&)doc=") <= 2
    assert plan(rows.select(urls.filing_ids("u"))).count(urls._DATA_PATH) <= 4  # a lambda prints its body twice
    first, none, bare = out.collect()
    assert first.s == "https://www.sec.gov/Archives/edgar/data/1/000000000000000002/a.htm" == first.v
    assert (first.i.cik, first.i.accession) == ("0000000001", "0000000000-00-000002") and first.d is None
    assert (none.s, none.v, none.i.accession) == ("", "", "") and (bare.s, bare.v) == ("x", "x")


def test_dates_of_all_shapes(spark):
    given = ["2024-01-02", "2024-01-02T03:04:05Z", "3/4/2024", "03.04.2024", "2024/5/6", "7 Aug 2024", "x2024-01-02", "", None, "2024-13-40"]
    rows = spark.createDataFrame([(i, g) for i, g in enumerate(given)], "i int, t string").orderBy("i")
    assert [str(r.d) for r in rows.select(F.col("i"), dates.parse_date("t").alias("d")).collect()] == [
        "2024-01-02", "2024-01-02", "2024-04-03", "2024-04-03", "2024-05-06", "2024-08-07", "None", "None", "None", "None"]


def test_exhibits_are_dealt_to_all_tasks_and_index_pages_read_once(spark):
    text = runway_catalog.exhibit_follow(Tables(spark, FOLDER))._jdf.queryExecution().optimizedPlan().toString()
    assert "Press release" not in text  # rows of index pages come from a written table
    candidates = spark.createDataFrame([("u", "a", "EX-99.1", "a.htm", 90, 1), ("u", "b", "EX-99.2", "b.htm", 50, 2), ("v", "a", "EX-99.1", "a.htm", 90, 1)],
                                       "url string, exhibit_url string, doc_type string, filename string, score int, seq int")
    page = ("<p>CONSOLIDATED BALANCE SHEETS</p><table><tr><td>Cash and cash equivalents</td><td>$ {0}</td></tr></table><h2>Consolidated Statements of Cash Flows</h2>"
            "<p>Three months ended</p><table><tr><td>Net cash used in operating activities</td><td>({0})</td></tr></table>")
    pages = spark.createDataFrame([("a", "<p>none</p>"), ("b", page.format("5,000")), ("b", page.format("5,000")), ("c", page.format("7,000")), (None, "x"), ("a", None)],
                                  "exhibit_url string, html string").coalesce(1)
    best = rw.follow_exhibits(candidates, pages, "url", F.lit("6-K"))
    assert "REPARTITION_BY_NUM" in best._jdf.queryExecution().executedPlan().toString()
    assert [(r.url, r.exhibit_url, r.cash, r.ocf, r.months) for r in best.collect()] == [("u", "b", 5000.0, -5000.0, 3)]
