"""Queries: accumulating tables, micro-batches, run log, promotion, resumed flows, CSV and text files.

Each writes tables of the sample data to a fresh folder of the shared work folder and returns what is read back.
"""

from __future__ import annotations

import time
import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from capsieve.catalog.base import query
from capsieve.catalog.universe import LOOKBACK_SQL
from capsieve.functions.urls import form_from_url
from capsieve.operators import evidence as ev
from capsieve.operators import runway as rw
from capsieve.operators import statements
from capsieve.operators.keyed import numbered
from capsieve.plans import flows
from capsieve.plans.standins import FILINGS_AS_OF, Tables
from capsieve.rules import INSIDER_LINK, OWNERSHIP_LINK
from capsieve.schemas import schema
from capsieve.session import work_dir
from capsieve.sources import accumulated, tables
from capsieve.streaming import ingest, progress


def new_folder(t: Tables) -> str:
    return f"{work_dir(t.spark)}/store-{uuid.uuid4().hex}"


# ---------------------------------------------------------------- accumulating tables

def delivered(t: Tables) -> tuple[str, list[int]]:
    """Three deliveries of filings with overlaps, the last one a repetition; the folder, and the rows that each added."""
    folder, filings = new_folder(t), t.filings()
    added = [accumulated.accumulate(filings.where(part), folder, "filings", flows.FILING_KEYS, "FiledAt", schema("02_filings"))
             for part in ("ord % 3 <> 0", "ord % 3 <> 1", "ord % 3 <> 1")]
    return folder, added


@query("accumulated_filings", "v_filings", sql="""
SELECT ord AS FilingId, coalesce(strftime(filed_at, '%Y-%m'), 'undated') AS Month, cik AS CIK, form AS Form, url AS URL FROM v_filings
""")
def accumulated_filings(t: Tables) -> DataFrame:
    folder, _ = delivered(t)
    stored = accumulated.read_store(t.spark, folder, "filings", schema("02_filings"))
    return stored.select(F.col("ord").alias("FilingId"), accumulated.MONTH, "CIK", "Form", "URL")


@query("run_log", "v_filings", "v_profiles", sql="""
SELECT 'filings' AS Module, 1 AS Step, (SELECT count(*) FROM v_filings WHERE ord % 3 <> 0) AS Rows, 'append+purge' AS Note
UNION ALL SELECT 'filings', 2, (SELECT count(*) FROM v_filings WHERE ord % 3 = 0), 'append+purge' UNION ALL SELECT 'filings', 3, 0, 'append+purge'
UNION ALL SELECT 'profiles', 4, (SELECT count(*) FROM v_profiles), 'OK' UNION ALL SELECT 'profiles_again', 5, 0, 'OK'
""")
def run_log(t: Tables) -> DataFrame:
    """Lines of the run log, each with the rows that were counted while they were written."""
    run = flows.Run(t.spark, new_folder(t), FILINGS_AS_OF)
    filings, profiles = t.filings(), t.profiles().select("Ticker", "CIK")
    for part in ("ord % 3 <> 0", "ord % 3 <> 1", "ord % 3 <> 1"):
        run.logged("filings", lambda part=part: accumulated.accumulate(
            filings.where(part), run.folder, "filings", flows.FILING_KEYS, "FiledAt", schema("02_filings")), "append+purge")
    for name in ("profiles", "profiles_again"):
        run.logged(name, lambda: tables.append_table(t.spark, profiles, run.folder, "profiles", ("Ticker",), run.as_of))
    lines = run.read("runlog").orderBy("ts").select("module", "rows", "note", "ts")
    at = F.transform(F.array_sort(F.collect_list(F.struct("ts", "module", "rows", "note"))), lambda x, i: F.struct(x["module"].alias("Module"), (i + 1).alias("Step"), x["rows"].alias("Rows"), x["note"].alias("Note")))
    return lines.agg(at.alias("lines")).select(F.inline("lines"))  # five lines


@query("stream_ingest", "v_filings", sql=LOOKBACK_SQL + f"""
SELECT ord AS FilingId, cik AS CIK, form AS Form, coalesce(strftime(filed_at, '%Y-%m'), 'undated') AS Month FROM k
WHERE rn = 1 AND (filed_at IS NULL OR filed_at >= DATE '{FILINGS_AS_OF}' - coalesce(d, 400))
""")
def stream_ingest(t: Tables) -> DataFrame:
    """Two files as two micro-batches, the second with rows of the first again, appended inside retention."""
    folder, filings = new_folder(t), t.filings()
    for part in ("ord % 3 <> 0", "ord % 3 <> 1"):
        filings.where(part).coalesce(1).write.mode("append").parquet(f"{folder}/in")
        time.sleep(0.01)
    stream = t.spark.readStream.schema(filings.schema).option("maxFilesPerTrigger", 1).parquet(f"{folder}/in")
    ingest.ingest(stream, f"{folder}/store", f"{folder}/offsets", FILINGS_AS_OF, log_folder=folder).awaitTermination()
    return t.spark.read.parquet(f"{folder}/store").select(F.col("ord").alias("FilingId"), "CIK", "Form", F.col("Month").cast("string"))


# ---------------------------------------------------------------- promotion and resumed flows

@query("newest_table", "v_profiles", sql="""
SELECT 'canonical' AS Picked, ticker AS Ticker FROM v_profiles WHERE ord % 2 = 0
UNION ALL SELECT 'older', ticker FROM v_profiles WHERE ord % 2 = 1 UNION ALL SELECT 'first', ticker FROM v_profiles WHERE ord % 2 = 1
""")
def newest_table(t: Tables) -> DataFrame:
    """Of two tables the one written last; and the first that exists."""
    run, rows = flows.Run(t.spark, new_folder(t), FILINGS_AS_OF), t.profiles().select("Ticker", "ord")

    def put(name: str, part: str) -> None:
        time.sleep(0.02)
        tables.write_table(rows.where(part), run.folder, name)

    def picked(label: str, df: DataFrame) -> DataFrame:
        return df.select(F.lit(label).alias("Picked"), "Ticker")

    put("a_older", "ord % 2 = 1")
    put("a", "ord % 2 = 0")
    put("b", "ord % 2 = 0")
    put("b_older", "ord % 2 = 1")
    return picked("canonical", tables.newest(t.spark, run.folder, "a", "a_older")).unionByName(
        picked("older", tables.newest(t.spark, run.folder, "b", "b_older"))).unionByName(
        picked("first", tables.first_existing(t.spark, run.folder, ("absent", "a_older", "a"))))


@query("resumed_validation", "v_profiles", sql="""
WITH r AS (SELECT *, ord % 3 = 0 AS bad FROM v_profiles)
SELECT 'deep_research' AS Stage, count(*) AS Rows FROM r UNION ALL SELECT 'validated', count(*) FROM r WHERE NOT bad UNION ALL SELECT 'tbd', count(*) FROM r WHERE bad
UNION ALL SELECT 'universe', count(*) FROM r UNION ALL SELECT 'shortlist', count(*) FROM r UNION ALL SELECT 'filings', 0 UNION ALL SELECT 'events', 0
""")
def resumed_validation(t: Tables) -> DataFrame:
    """A flow that starts at its last stage, on stored tables of the earlier ones."""
    run, rows = flows.Run(t.spark, new_folder(t), FILINGS_AS_OF), t.profiles()
    run.write(rows, "01_universe_gated")
    run.write(rows.select("Ticker", "Company", "CIK"), "20_candidate_shortlist")
    shown = {"RunwayQuarters": F.lit(4.0), "RunwayEvidencePrimary": F.lit("https://r"), "DilutionScore": F.when(F.col("ord") % 3 == 0, "TBD").otherwise("High"),
             "DilutionEvidencePrimary": F.lit("https://d"), "CatalystScore": F.lit("Tier-1"), "CatalystEvidencePrimary": F.lit("https://c"),
             "SubscoresEvidencedCount": F.lit(5), "Materiality": F.lit("PASS"), "BiotechPeerRead": F.lit("N"), "EvidencePart": F.lit(0).cast("bigint")}
    run.write(rows.select("Ticker", "CIK", "ord").withColumns(shown).drop("ord"), "30_deep_research")
    return flows.weekly(run, {}, start_stage="validated")


# ---------------------------------------------------------------- files

@query("csv_tables", "v_profiles", sql="""
SELECT ticker AS Ticker, cik AS CIK, company AS Company, sector AS Sector, country AS Country, exchange AS Exchange, market_cap AS MarketCap, price AS Price FROM v_profiles
""")
def csv_tables(t: Tables) -> DataFrame:
    """Profiles written as CSV and read with the schema of their table."""
    path = f"{new_folder(t)}/profiles.csv"
    tables.write_csv(t.profiles(), path)
    return tables.read_csv_table(t.spark, path, schema("01_profiles")).select(
        "Ticker", "CIK", "Company", "Sector", "Country", "Exchange", "MarketCap", "Price")


@query("text_files", sql="""
SELECT page_id AS PageId, CAST(length(coalesce(html, '')) + 1 AS INTEGER) AS Chars, md5(coalesce(html, '') || chr(10)) AS Digest FROM pages
""")
def text_files(t: Tables) -> DataFrame:
    """Every page as a file of its own, read back as filing text (a line end is added by the writer)."""
    pages = t.base("pages").select(F.concat(F.lit("page_id="), "page_id", F.lit(".txt")).alias("name"), F.col("html").alias("text"))
    files = tables.read_listed_files(tables.write_text_files(pages, f"{new_folder(t)}/pages"))
    return files.select(F.regexp_extract("URL", "page_id=([0-9]+)[.]txt$", 1).cast("bigint").alias("PageId"), F.length("Text").alias("Chars"),
                        F.md5(F.col("Text").cast("binary")).alias("Digest"))


# ---------------------------------------------------------------- small rules without a table of their own

@query("eight_k_progress", sql="""
WITH e AS (SELECT *, row_number() OVER (ORDER BY ts, event_id) AS n, count(*) OVER () AS total FROM events),
c AS (SELECT max(n) FILTER (event_type NOT IN ('view', 'error')) AS p, max(n) FILTER (event_type = 'view') AS v, max(n) FILTER (event_type = 'error') AS f FROM e)
SELECT '8-K Events' AS Form, greatest(p, v + f) AS Parsed, v AS Valid, f AS Missing FROM c
""")
def eight_k_progress(t: Tables) -> DataFrame:
    """Latest counters of the 8-K lines of a log, one line per event."""
    events = numbered(t.base("events").select("ts", "event_id", "event_type"), ["ts", "event_id"])
    lines = t.sql("""SELECT ts, event_id AS ord, CASE event_type WHEN 'view' THEN concat('eight_k: parsed ', n) WHEN 'error' THEN concat('eight_k: failed ', n)
      ELSE concat('eight_k: (1.0%) processed ', n, '/', total) END AS message FROM numbered_events""", numbered_events=events)
    return progress.progress(lines).where("form = '8-K Events'").select(
        F.col("form").alias("Form"), F.col("parsed").alias("Parsed"), F.col("valid").alias("Valid"), F.col("missing").alias("Missing"))


@query("evidence_links", "v_filings", sql="""
SELECT ord AS FilingId, CASE WHEN form = '4' THEN url || '/xslF345X03/form4.xml' ELSE '' END AS InsiderLinks, CASE WHEN form = 'SC 13G' THEN url || '/sc13g.htm' ELSE '' END AS OwnershipLinks FROM v_filings
""")
def evidence_links(t: Tables) -> DataFrame:
    """Links of a cell that are insider forms, and those that are ownership forms."""
    tail = F.when(F.col("Form") == "4", "/xslF345X03/form4.xml").when(F.col("Form") == "SC 13G", "/sc13g.htm").otherwise("/other.htm")
    link = F.concat("URL", tail)
    cell = F.concat(F.lit("2001-01-01 "), F.col("Form"), F.lit(" "), link, F.lit("\nagain "), link, F.lit("\nhttps://example.org/plain"))
    return t.filings().select(F.col("ord").alias("FilingId"), F.array_join(ev.links_like(cell, INSIDER_LINK), "; ").alias("InsiderLinks"),
                              F.array_join(ev.links_like(cell, OWNERSHIP_LINK), "; ").alias("OwnershipLinks"))


@query("restricted_cash", sql="""
SELECT s_suppkey AS SupplierId, CASE WHEN s_suppkey % 3 = 0 THEN CAST(s_suppkey + 10 AS DOUBLE) WHEN s_suppkey % 3 = 1 THEN CAST(s_suppkey + 20 AS DOUBLE) END AS Cash,
  CAST(-s_suppkey - 5 AS DOUBLE) AS OCF FROM supplier
""")
def restricted_cash(t: Tables) -> DataFrame:
    """A cash label without a number lends its name to the restricted-cash row after it; alone such a row is no cash."""
    k, lit = F.col("s_suppkey"), F.lit

    def row(label: str, value: Column | str) -> Column:
        return F.concat(lit(f"<tr><td>{label}</td><td>"), lit(value) if isinstance(value, str) else value.cast("string"), lit("</td></tr>"))

    both = F.concat(row("Cash and cash equivalents", ""), row("Cash and restricted cash", k + 10))
    rows = F.when(k % 3 == 0, both).when(k % 3 == 1, row("Cash at end of period", k + 20)).otherwise(row("Restricted deposits", k + 30))
    html = F.concat(lit("<p>STATEMENTS OF CASH FLOWS</p><table><tr><td></td><td>2024</td></tr>"), row("Net cash used in operating activities", F.concat(lit("("), k + 5, lit(")"))), rows, lit("</table>"))
    parsed = statements.parse_statements(t.base("supplier").select("s_suppkey", html.alias("html")))
    return parsed.select(F.col("s_suppkey").alias("SupplierId"), F.col("statement.cash").alias("Cash"), F.col("statement.ocf").alias("OCF"))


@query("form_inference", "v_filings", sql="""
SELECT ord AS FilingId, CASE ord % 4 WHEN 0 THEN '20-F' WHEN 1 THEN '10-Q' WHEN 2 THEN '6-K' END AS Form, CASE ord % 4 WHEN 1 THEN '10-Q' END AS FromLink FROM v_filings
""")
def form_inference(t: Tables) -> DataFrame:
    """A hint before the link, the link before the text."""
    turn = F.col("ord") % 4
    link = F.concat(F.lit("https://www.sec.gov/Archives/edgar/data/1/"), F.when(turn == 1, "a-10q.htm").otherwise("a.htm"))
    text = F.when(turn == 2, "<p>Report on <b>Form 6-K</b> for May</p>").when(turn == 1, "<p>Form 40-F</p>").otherwise("<p>nothing</p>")
    return t.filings().select(F.col("ord").alias("FilingId"), rw.form_of(link, text, F.when(turn == 0, "FORM 20-F")).alias("Form"), form_from_url(link).alias("FromLink"))
