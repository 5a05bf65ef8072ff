import datetime as dt
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from capsieve.catalog import stores
from capsieve.operators import keyed
from capsieve.plans import flows
from capsieve.plans.standins import Tables
from capsieve.rules import Rules
from capsieve.session import work_dir
from capsieve.sources import accumulated, tables
from capsieve.streaming import call_rate, ingest, progress

LOG = "ts timestamp, message string, ord bigint"


def log(spark, *messages):
    base = dt.datetime(2024, 1, 1)
    return spark.createDataFrame([(base + dt.timedelta(minutes=50 * i), m, i) for i, m in enumerate(messages)], LOG)


def counts(df):
    return {r["form"]: (r["parsed"], r["valid"], r["missing"], r["note"]) for r in df.collect()}


MESSAGES = (
    "parse_q10 [INFO] QZT fetching 6-K filed 2031-05-15T00:00:00 url https://filings.example/one.htm",
    "parse_q10 [INFO] compute_runway: QZT cash=1 ocf=1 months=12 scale=1 est=interim form=6-K date=2031-05-15",
    "parse_q10 [WARN] QZT runway status Missing OCF (from exhibit)",
    "parse_q10 [INFO] compute_runway: QZT cash=1 ocf=1 months=12 scale=1 est=interim form=6-K date=2031-08-20",
    "parse_q10 [OK] QZT runway status OK (from exhibit)",
    "parse_q10 [OK] QZT runway status OK (from exhibit)",
    "INFO | dr_forms [INFO] LMN fetching 424B5 filed 2031-02-11 url https://filings.example/two.htm",
    "dr_forms [OK] LMN 424B5 form status OK dilution evidence captured",
    "dr_forms [INFO] LMN fetching DEFA14A filed 2031-02-12 url https://filings.example/three.htm",
    "dr_forms [OK] LMN DEFA14A form status OK governance evidence captured",
    "dr_forms [INFO] LMN fetching 4 filed 2031-02-13",
    "dr_forms [WARN] LMN 4 incomplete: missing filing URL",
    "dr_forms [WARN] LMN 4 incomplete: missing filing URL",
    "parse_q10 [INFO] compute_runway: BARE cash=0 ocf=0 months=6 scale=1 est=interim date=2031-01-02",
)


def test_progress_counts(spark):
    got = counts(progress.progress(log(spark, *MESSAGES)))
    assert got["6-K"] == (2, 1, 1, "") and got["424B"] == (1, 1, 0, "") and got["DEF 14A"] == (1, 1, 0, "")
    assert got["FORM 4"] == (1, 0, 1, "") and got["Unspecified"] == (1, 0, 0, "Missing form detail") and got["S-3"] == (0, 0, 0, "NI")


def test_progress_restart_and_eight_k(spark):
    got = counts(progress.progress(log(
        spark, *MESSAGES, "parse_q10: start", "parse_q10 [INFO] A fetching 10-QT/A filed 2024-01-01", "parse_q10 [OK] A runway 3.50 qtrs",
        "eight_k: start", "eight_k: (1.0%) processed 5/9", "eight_k: parsed 3", "eight_k: failed 1")))
    assert got["10-Q"] == (1, 1, 0, "") and "6-K" not in got and got["8-K Events"] == (5, 3, 1, "")


def test_progress_stream_equals_batch(spark):
    folder = tempfile.mkdtemp(prefix="spark-")
    # the last lines: a compute of one filing, then the outcome of another of the same form
    rows = log(spark, *MESSAGES, "parse_q10 [INFO] compute_runway: ONE cash=1 ocf=1 months=12 scale=1 est=interim form=20-F date=2025-07-31",
               "parse_q10 [INFO] TWO fetching 20-F filed 2025-07-31", "parse_q10 [OK] TWO runway status OK")
    for i in range(2):  # two files, so two micro-batches
        rows.where(F.col("ord").between(9 * i, 9 * i + 8)).coalesce(1).write.mode("append").parquet(f"{folder}/in")
    stream = spark.readStream.schema(LOG).option("maxFilesPerTrigger", 1).option("latestFirst", "false").parquet(f"{folder}/in")
    query = progress.progress_changes(stream).writeStream.format("memory").queryName("progress_out").outputMode("append").option(
        "checkpointLocation", f"{folder}/cp").start()
    query.processAllAvailable()
    query.stop()
    got = {r["form"]: (r["parsed"], r["valid"], r["missing"]) for r in progress.stream_totals(spark.table("progress_out")).collect()}
    batch = {f: c[:3] for f, c in counts(progress.progress(rows)).items() if any(c[:3])}
    assert got == batch and got["20-F"] == (1, 1, 0)


def test_tickers_return_after_months(spark):
    """Lines of one ticker far apart, in many micro-batches: forms, keys and counted outcomes are remembered."""
    folder, base = tempfile.mkdtemp(prefix="spark-"), dt.datetime(2024, 1, 1)
    messages = ["parse_q10 [INFO] AA fetching 10-Q filed 2024-01-01", "parse_q10 [OK] AA runway status OK", "parse_q10 [OK] AA runway status OK",
                "parse_q10 [WARN] AA runway status Missing OCF", "parse_q10 [INFO] AA fetching 10-K filed 2024-02-01", "parse_q10 [OK] AA runway status OK",
                "dr_forms [WARN] BB 4 incomplete: missing filing URL", "dr_forms [WARN] BB 4 incomplete: missing filing URL",
                "parse_q10 [INFO] compute_runway: AA cash=1 ocf=1 months=12 scale=1 est=interim form=20-F date=2024-03-01", "parse_q10 [OK] AA runway status OK",
                "parse_q10 [INFO] AA fetching 10-Q filed 2024-01-01", "parse_q10 [OK] AA runway status OK"]
    rows = spark.createDataFrame([(base + dt.timedelta(days=40 * i), m, i) for i, m in enumerate(messages)], LOG)
    for i in range(0, len(messages), 2):
        rows.where(F.col("ord").between(i, i + 1)).coalesce(1).write.mode("append").parquet(f"{folder}/in")
    stream = spark.readStream.schema(LOG).option("maxFilesPerTrigger", 1).parquet(f"{folder}/in")
    query = progress.progress_changes(stream).writeStream.format("memory").queryName("returning_out").outputMode("append").option(
        "checkpointLocation", f"{folder}/cp").start()
    query.processAllAvailable()
    query.stop()
    got = {r["form"]: (r["parsed"], r["valid"], r["missing"]) for r in progress.stream_totals(spark.table("returning_out")).collect()}
    batch = {f: c[:3] for f, c in counts(progress.progress(rows)).items() if any(c[:3])}
    assert got == batch and got["10-Q"] == (1, 1, 0) and got["FORM 4"] == (1, 0, 1)


def test_call_rate_matches_brute_force(spark):
    base = dt.datetime(2024, 1, 1)
    rows = [("h" if i % 3 else "g", base + dt.timedelta(seconds=(i * 37) % 400)) for i in range(200)]
    got = {(r["host"], r["ts"]): r["calls"] for r in call_rate.trailing_calls(spark.createDataFrame(rows, "host string, ts timestamp"), bin_seconds=70).collect()}
    for host, ts in rows:
        assert got[(host, ts)] == sum(1 for h, t in rows if h == host and ts - dt.timedelta(seconds=60) <= t <= ts)


def test_sliding_calls_stream(spark):
    folder = tempfile.mkdtemp(prefix="spark-")
    base = dt.datetime(2024, 1, 1)
    rows = [("h", base + dt.timedelta(seconds=s)) for s in (0, 10, 59, 70, 600)]
    spark.createDataFrame(rows, "host string, ts timestamp").coalesce(1).write.parquet(f"{folder}/in")
    stream = spark.readStream.schema("host string, ts timestamp").parquet(f"{folder}/in")
    query = call_rate.sliding_calls(stream, slide_seconds=30).writeStream.format("memory").queryName("calls_out").outputMode("append").option(
        "checkpointLocation", f"{folder}/cp").start()
    query.processAllAvailable()
    query.stop()
    got = {r["start"]: r["calls"] for r in spark.table("calls_out").collect()}
    assert got[base] == 3 and got[base + dt.timedelta(seconds=30)] == 2


FILING = "CIK string, Ticker string, Company string, Form string, FiledAt date, URL string, ord bigint"


def filing(i, form="10-Q", ticker="AAA", day=dt.date(2024, 1, 10)):
    return ("0000000001", ticker, "", form, day, f"https://www.sec.gov/Archives/edgar/data/1/{i}/doc.htm", i)


def test_ingest_is_idempotent_and_gated(spark):
    folder = tempfile.mkdtemp(prefix="spark-")
    first = [filing(1), filing(2, "8-K"), filing(3, day=dt.date(2020, 1, 1))]
    second = [filing(2, "8-K"), filing(4, "S-3"), ("0000000002", "", "", "8-K", dt.date(2024, 1, 9), "https://u/5", 5)]
    for i, rows in enumerate((first, second)):
        spark.createDataFrame(rows, FILING).coalesce(1).write.mode("append").parquet(f"{folder}/in")
        stream = spark.readStream.schema(FILING).parquet(f"{folder}/in")
        ingest.ingest(stream, f"{folder}/store", f"{folder}/cp", "2024-01-31").awaitTermination()
    assert sorted(r["ord"] for r in spark.read.parquet(f"{folder}/store").collect()) == [1, 2, 4, 5]
    ingest.store_batch(spark.createDataFrame(second, FILING), 1, f"{folder}/store", Rules(), "2024-01-31")  # a replay
    assert spark.read.parquet(f"{folder}/store").count() == 4
    profiles = spark.createDataFrame([("AAA", "0000000001", "Alpha", "US", 1), ("BBB", "0000000002", "Beta", "US", 2)],
                                     "Ticker string, CIK string, Company string, Country string, ord bigint")
    rows = ingest.current_filings(spark, f"{folder}/store", profiles, "2024-01-31").collect()
    assert sorted(r["ord"] for r in rows) == [1, 2, 4] and {r["Company"] for r in rows} == {"Alpha"} and {r["Age"] for r in rows} == {21}
    ingest.compact(spark, f"{folder}/store", "2024-08-31")
    assert sorted(r["ord"] for r in spark.read.parquet(f"{folder}/store").collect()) == [2, 4, 5]


def flow_inputs(spark):
    profiles = spark.createDataFrame(
        [("AAA", "0000000001", "Alpha", "NASDAQ", "US", "USD", "Health", "Software", 5e7, 3.5), ("BBB", "0000000002", "Beta Trust", "NYSE", "US", "USD", "x", "y", 5e7, 3.0),
         ("CCC", "0000000003", "Gamma", "NYSE", "US", "USD", "x", "y", 6e7, 2.5)],
        "Ticker string, CIK string, Company string, Exchange string, Country string, Currency string, Sector string, Industry string, MarketCap double, Price double")
    profiles = profiles.withColumn("UpdatedAt", F.lit("2024-06-30").cast("timestamp"))
    quotes = spark.createDataFrame([("AAA", 3.49, 3.51, 1), ("CCC", 2.49, 2.51, 2)], "Ticker string, BidPrice double, AskPrice double, ord bigint")
    base = "https://www.sec.gov/Archives/edgar/data/1/"
    rows = [("0000000001", "AAA", "", "10-Q", dt.date(2024, 5, 1), base + "a/form10-q.htm", 1), ("0000000001", "AAA", "", "S-3", dt.date(2024, 4, 1), base + "b/s3.htm", 2),
            ("0000000001", "", "", "8-K", dt.date(2024, 6, 1), base + "c/d8k.htm", 3), ("0000000001", "AAA", "", "DEF 14A", dt.date(2024, 3, 1), base + "d/def14a.htm", 4),
            ("0000000003", "CCC", "", "8-K", dt.date(2024, 6, 1), "https://www.sec.gov/Archives/edgar/data/3/e/d8k.htm", 5)]
    texts = spark.createDataFrame([(base + "a/form10-q.htm", "Cash and cash equivalents: $12,000,000 operating activities: $(3,000,000)"),
                                   (base + "c/d8k.htm", "Item 1.01 Entry. The contract award under a purchase agreement.")], "URL string, Text string")
    prices = [(dt.date(2024, 6, 1) + dt.timedelta(i), "AAA", 3.0, 3.6, 2.9, 3.5, 90000.0) for i in range(25)]
    return {"profiles": profiles, "quotes": quotes, "filings": spark.createDataFrame(rows, FILING), "texts": texts,
            "prices": spark.createDataFrame(prices, "Date date, Ticker string, Open double, High double, Low double, Close double, Volume double")}


def test_weekly_daily_and_legacy(spark):
    run = flows.Run(spark, tempfile.mkdtemp(prefix="spark-"), "2024-06-30")
    inputs = flow_inputs(spark)
    funnel = {r["Stage"]: r["Rows"] for r in flows.weekly(run, inputs).collect()}
    assert funnel == {"universe": 1, "filings": 4, "events": 1, "shortlist": 1, "deep_research": 1, "validated": 1, "tbd": 0}
    report = run.read("40_validated_selections").collect()[0]
    assert (report["Ticker"], report["Runway (qtrs)"], report["ConvictionScore"]) == ("AAA", "4.0", "High")
    again = {r["Stage"]: r["Rows"] for r in flows.weekly(run, {}, start_stage="hydrate").collect()}
    assert again == funnel
    assert {r["Stage"]: r["Rows"] for r in flows.daily(run, inputs["prices"]).collect()}["shortlist"] == 1
    from capsieve.operators.runway_rules import finalize
    results = run.read("02_filings").where("Form = '10-Q'").select(
        "URL", finalize(F.lit(1.2e7), F.lit(-3e6), F.lit(3), F.col("Form")).alias("result"))
    dropped = {r["DropReason"]: r["Rows"] for r in flows.legacy(run, results).collect()}
    assert dropped == {}
    row = run.read("11_validated_watchlist").collect()[0]
    assert (row["CatalystType"], row["RunwayQuarters"], row["DilutionStatus"], row["ChecklistRunway"]) == ("Tier-1", 4.0, "Pass (Offering)", "Pass")
    # without verdicts the landed documents decide
    page = "<h2>Statements of Cash Flows</h2><p>Three months ended</p><table><tr><td>Net cash used in operating activities</td><td>(2,000)</td></tr>" \
           "<tr><td>Cash and cash equivalents, end of period</td><td>9,000</td></tr></table>"
    run.write(run.read("02_filings").where("Form = '10-Q'").select("URL", F.lit(page).alias("html")), "02_documents")
    assert flows.legacy(run).count() == 0 and run.read("11_validated_watchlist").collect()[0]["RunwayQuarters"] == 4.5
    with pytest.raises(ValueError):
        flows.weekly(run, {}, start_stage="nothing")


def test_deliveries_accumulate(spark):
    """Two weekly runs with disjoint filings keep both; the second reads runway texts of its own filings only."""
    run, inputs = flows.Run(spark, tempfile.mkdtemp(prefix="spark-"), "2024-06-30"), flow_inputs(spark)
    run.write(inputs["profiles"], "01_profiles")
    early, late = inputs["filings"].where("FiledAt < '2024-05-01'"), inputs["filings"].where("FiledAt >= '2024-05-01'")
    flows.filings_stage(run, early, inputs["texts"])
    assert run.read("02_filings").count() == 0  # no core form yet, so nothing is covered
    flows.filings_stage(run, late, inputs["texts"])
    flows.filings_stage(run, late, inputs["texts"].limit(0))
    rows = {r["ord"]: r for r in run.read("02_filings").collect()}
    assert sorted(rows) == [1, 2, 3, 4] and rows[1]["RunwayQuarters"] == 4.0 and rows[2]["RunwayQuarters"] is None
    assert spark.read.parquet(f"{run.folder}/{flows.FILINGS_STORE}").count() == 5
    log = [(r["module"], r["rows"]) for r in run.read("runlog").orderBy("ts").collect() if r["module"] == "filings"]
    assert log == [("filings", 2), ("filings", 3), ("filings", 0)]
    assert accumulated.drop_months(spark, run.folder, flows.FILINGS_STORE, dt.date(2024, 5, 15)) == ["2024-03", "2024-04"]
    assert spark.read.parquet(f"{run.folder}/{flows.FILINGS_STORE}").count() == 3


def test_appends_read_touched_months(spark):
    folder = tempfile.mkdtemp(prefix="spark-")
    columns = flows.schema("02_filings")
    for month in (1, 2, 3):
        rows = spark.createDataFrame([filing(10 * month + i, day=dt.date(2024, month, 5)) for i in range(3)], FILING)
        assert accumulated.accumulate(rows, folder, "t", flows.FILING_KEYS, "FiledAt", columns) == 3
    again = spark.createDataFrame([filing(10, day=dt.date(2024, 1, 5)), filing(99, day=dt.date(2024, 1, 9)), filing(98, day=None)], FILING)
    stored = accumulated.read_store(spark, folder, "t", columns)
    fresh = accumulated.unseen(again, stored, flows.FILING_KEYS, "FiledAt")
    plan = fresh._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [Month" in plan and "2024-01,undated" in plan.replace(" ", "")
    assert accumulated.accumulate(again, folder, "t", flows.FILING_KEYS, "FiledAt", columns) == 2
    assert accumulated.accumulate(again.limit(0), folder, "t", flows.FILING_KEYS, "FiledAt", columns) == 0
    with pytest.raises(ValueError):
        accumulated.unseen(again, stored, ("CIK", "URL"), "FiledAt")


def test_errors_are_logged(spark):
    run = flows.Run(spark, tempfile.mkdtemp(prefix="spark-"), "2024-06-30")
    with pytest.raises(tables.MissingTable):
        run.logged("step", lambda: run.read("nothing").count())
    assert run.read("errorlog").collect()[0]["module"] == "step"


def test_swap_keeps_the_old_table(spark):
    folder = tempfile.mkdtemp(prefix="spark-")
    tables.write_table(spark.range(3), folder, "t")
    with pytest.raises(RuntimeError):
        tables.swap(spark, f"{folder}/missing", f"{folder}/t")
    assert spark.read.parquet(f"{folder}/t").count() == 3
    tables.write_table(spark.range(5), folder, "t__next")
    tables.swap(spark, f"{folder}/t__next", f"{folder}/t")
    assert spark.read.parquet(f"{folder}/t").count() == 5 and not tables.table_exists(spark, folder, "t__last")


def test_tables(spark):
    folder = tempfile.mkdtemp(prefix="spark-")
    with pytest.raises(tables.MissingTable):
        tables.read_table(spark, folder, "01_profiles")
    empty = spark.createDataFrame([], "Ticker string")
    tables.write_table(empty, folder, "01_profiles", flows.schema("01_profiles"))
    stored = tables.read_table(spark, folder, "01_profiles", ["CIK", "SpreadPct"])
    assert stored.count() == 0
    with pytest.raises(tables.MissingTable):
        tables.read_table(spark, folder, "01_profiles", ["Nope"])
    tables.log_step(spark, folder, "filings", 3, 12, "ok", dt.datetime(2024, 1, 1))
    tables.log_step(spark, folder, "events", 4, 12, "ok", dt.datetime(2024, 1, 2))
    assert spark.read.parquet(f"{folder}/runlog").count() == 2
    tables.write_csv(spark.createDataFrame([("a", ["x", "y"])], "Ticker string, Links array<string>"), f"{folder}/csv")
    csv = tables.read_csv_table(spark, f"{folder}/csv", flows.schema("03_prices"))
    assert csv.collect()[0]["Ticker"] == "a" and csv.columns[0] == "Date"
    assert tables.newest(spark, folder, "01_profiles", "absent").count() == 0


def test_work_dir_is_stable(spark):
    folder = work_dir(spark)
    assert folder and work_dir(spark) == folder


def test_text_files(spark):
    folder = tempfile.mkdtemp(prefix="spark-")
    with open(os.path.join(folder, "a.htm"), "wb") as handle:
        handle.write(b"Cash \xff and more")
    row = tables.read_text_files(spark, folder).collect()[0]
    assert row["URL"].endswith("a.htm") and row["URL"].startswith("file:///") and row["Text"] == "Cash  and more"


def test_files_of_their_own_are_written_and_listed_by_tasks(spark):
    """More texts than a folder holds, nulls and line ends; no path goes through the driver."""
    folder = tempfile.mkdtemp(prefix="spark-")
    rows = spark.range(0, 5000, 1, 2).select(F.concat(F.col("id").cast("string"), F.lit(".txt")).alias("name"),
                                             F.when(F.col("id") % 7 != 0, F.concat(F.lit("Käse\r\n "), "id")).alias("text"))
    files = tables.write_text_files(rows, folder)
    found = tables.read_listed_files(files)
    number = F.regexp_extract("URL", "/([0-9]+)[.]txt$", 1).cast("long")
    wrong = found.where(~F.col("Text").eqNullSafe(F.concat(F.when(number % 7 != 0, F.concat(F.lit("Käse\r\n "), number)).otherwise(""), F.lit("\n"))))
    assert found.count() == found.select("URL").distinct().count() == 5000 and wrong.count() == 0
    assert found.where("URL NOT LIKE 'file:///%' AND URL NOT LIKE '/%'").count() == 0
    assert "BinaryFile" not in found._jdf.queryExecution().toString() and files.columns == ["URL"]


def test_pages_as_files_go_through_no_listing(spark):
    plan = stores.text_files(Tables(spark, "/root/testdata/sf0.001"))._jdf.queryExecution().toString()
    assert "text-files" in plan and "binaryFile" not in plan


def test_numbers_of_a_whole_table_without_one_task(spark):
    rows = spark.range(0, 20_000, 1, 3).select((F.col("id") * 7919 % 20_000).alias("k"), (F.col("id") % 3).alias("t"))
    out = keyed.numbered(rows, ["t", "k"])
    wanted = {(r.t, r.k): i + 1 for i, r in enumerate(sorted(rows.collect(), key=lambda r: (r.t, r.k)))}
    assert {(r.t, r.k): r.n for r in out.collect()} == wanted and {r.total for r in out.select("total").distinct().collect()} == {20_000}
    assert out.select(F.spark_partition_id().alias("p")).distinct().count() > 1
    assert keyed.numbered(rows.limit(0), ["t", "k"]).count() == 0


def test_calls_cost_the_same_in_a_dense_window(spark):
    """Calls a microsecond apart, at bin ends and repeated: a running sum, no window that is added up for every call."""
    second = 1_000_000
    times = [0, 0, 1, 59 * second, 60 * second, 60 * second + 1, 90 * second - 1, 90 * second, 150 * second, 150 * second + 1, 400 * second, -30 * second]
    rows = spark.createDataFrame([("h", t) for t in times] + [("other", 5)], "host string, us long").select("host", F.timestamp_micros("us").alias("ts"))
    for bins in (60, 90, 600):
        out = call_rate.trailing_calls(rows, bin_seconds=bins)
        got = {r.us: r.calls for r in out.where("host = 'h'").select(F.unix_micros("ts").alias("us"), "calls").collect()}
        assert got == {t: sum(t - 60 * second <= u <= t for u in times) for t in times}
    assert "RangeFrame, -" not in out._jdf.queryExecution().analyzed().toString()
