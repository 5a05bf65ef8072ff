import pytest
from conftest import one
from pyspark.sql import functions as F

from capsieve.catalog import runway as runway_catalog
from capsieve.operators import resolution as rs
from capsieve.operators import runway as rw
from capsieve.operators import runway_rules as rr
from capsieve.operators import statements
from capsieve.plans.standins import Tables


def verdict(spark, cash, ocf, months, form="10-Q", quarterly=None):
    df = spark.createDataFrame([(cash, ocf, months, quarterly)], "c double, o double, m int, q double")
    return one(df.select(rr.finalize(F.col("c"), F.col("o"), F.col("m"), F.lit(form), F.col("q")).alias("r")))["r"]


@pytest.mark.parametrize("value, months, expected, tag", [(-900000.0, 9, -300000.0, "9m/3"), (-1200000.0, 12, -300000.0, "annual/4"), (5.0, 7, 5.0, None)])
def test_quarterly(spark, value, months, expected, tag):
    df = spark.createDataFrame([(value, months)], "v double, m int")
    row = one(df.select(rr.quarterly(F.col("v"), F.col("m")).alias("q"), rr.quarterly_tag(F.col("v"), F.col("m")).alias("t")))
    assert row == {"q": expected, "t": tag}


def test_final_statuses(spark):
    r = verdict(spark, 1e6, None, 6)
    assert (r["status"], r["quarterly_burn"], r["runway_quarters"], r["complete"]) == ("Missing OCF", None, None, False)
    r = verdict(spark, None, -300000.0, 3)
    assert (r["status"], r["runway_quarters"]) == ("Missing cash", None)
    r = verdict(spark, 2e6, 1e5, 3)
    assert (r["status"], r["quarterly_burn"], r["runway_quarters"], r["complete"]) == ("OCF positive (self-funding)", 0.0, None, True)
    r = verdict(spark, 3e5, -150000.0, 3)
    assert (r["status"], r["quarterly_burn"], r["runway_quarters"], r["runway_months_display"], r["complete"]) == ("OK", 150000.0, 2.0, 6.0, True)


# fixed values: figures of four known filings and what follows from them
@pytest.mark.parametrize("cash, ocf, months, tag, burn, quarters", [
    (658136, -3160656, 6, "6m/2", 1580328, 0.42), (6145000, -8619000, 6, "6m/2", 4309500, 1.43),
    (6521000, -16239000, 9, "9m/3", 5413000, 1.20), (17829149, -9390622, 12, "annual/4", 2347655.5, 7.59)])
def test_known_filings(spark, cash, ocf, months, tag, burn, quarters):
    df = spark.createDataFrame([(float(cash), float(ocf), months)], "c double, o double, m int")
    q = rr.quarterly(F.col("o"), F.col("m"))
    r = one(df.select(rr.finalize(F.col("c"), F.col("o"), F.col("m"), F.lit("6-K"), q, rr.quarterly_tag(F.col("o"), F.col("m"))).alias("r")))["r"]
    assert (r["assumption"], r["quarterly_burn"], r["runway_quarters"]) == (tag, burn, quarters)


def test_text_rule(spark):
    texts = ["<p>Cash and cash equivalents: $12,000,000</p><p>Net cash used in operating activities: $(3,000,000)</p>",
             "cash and cash equivalents $10,000 ... operating activities $(2,000)", "nothing"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").orderBy("i")
    assert [r[0] for r in df.select(rr.text_runway("t")).collect()] == [4.0, 5.0, None]


def page(cash, flow, heading="Statements of Cash Flows", period="Six months ended", unit=""):
    """A made-up statement; a missing value leaves its row out."""
    rows = [("Net cash used in operating activities", flow), ("Cash and cash equivalents, end of period", cash)]
    body = "".join(f"<tr><td>{label}</td><td>{value}</td></tr>" for label, value in rows if value)
    return f"<h2>{heading}</h2>\n{unit}<p>{period}</p><table><tr><th></th><th>2031</th></tr>{body}</table>"


BASE = "https://www.sec.gov/Archives/edgar/data/77/000000007731000042"
CONTENTS = (f'<table><tr><td>Letter to holders</td><td>EX-99.3</td><td><a href="{BASE}/letter.htm">letter</a></td></tr>'
            f'<tr><td>Financial statements of the group</td><td>EX-99.7</td><td><a href="group_fs.htm">group_fs.htm</a></td></tr></table>')


def test_exhibit_is_followed(spark):
    url = f"{BASE}/annual.htm"
    index = rw.exhibit_index(spark.createDataFrame([(url, CONTENTS)], "url string, html string"), "url", "html")
    candidates = rw.exhibit_candidates(index, "url", F.lit("20-F"))
    exhibits = spark.createDataFrame([
        (f"{BASE}/group_fs.htm", page("1,000", "(400)", period="Year ended June 30, 2031")), (f"{BASE}/letter.htm", "<p>Dear holders</p>"),
        ("https://elsewhere.example/other.htm", page("9", "(9)"))], "exhibit_url string, html string")
    best = rw.exhibit_verdict(rw.follow_exhibits(candidates, exhibits, "url", F.lit("20-F")), F.lit("20-F"))
    r = one(best.select("exhibit_url", "months", "result"))
    assert r["exhibit_url"] == f"{BASE}/group_fs.htm" and r["months"] == 12 and r["result"]["runway_quarters"] == 10.0 and r["result"]["complete"]


FACTS = ("CIK string, Taxonomy string, Concept string, Unit string, Val double, Accn string, Start date, End date, Fy int, Fp string, Form string, ord bigint")


def fact(cik, concept, value, n=1, fp="Q1"):
    names = {"cash": "CashAndCashEquivalents", "flow": "NetCashProvidedByUsedInOperatingActivities"}
    return (cik, "us-gaap", names[concept], "USD", value, None, None, None, 2031, fp, "10-Q", n)


def link(cik, n, name="doc.htm"):
    return f"https://www.sec.gov/Archives/edgar/data/{cik}/{n:018d}/{name}"


def test_sources_in_turn(spark):
    """Facts before the document, the document before exhibits; a missing value of one is filled by the next."""
    forms = ["10-Q", "10-Q", "20-F", "20-F", "6-K", "6-K", "10-K", "", "8-K", "10-Q"]
    urls = [link(i, i) for i in range(10)]
    urls[7] = link(7, 7, "x-10q.htm")
    filings = spark.createDataFrame([*zip(urls, forms), (urls[0], "10-Q"), (None, "10-Q"), ("", "10-K")], "URL string, Form string")
    documents = spark.createDataFrame([
        (urls[0], page("5", "(5)")), (urls[1], page("300", None)), (urls[2], page("80", None)), (urls[3], "<p>nothing</p>"), (urls[4], "<p>news</p>"),
        (urls[5], "<p>news</p>"), (urls[7], page("900", "(600)", unit="<p>(in thousands)</p>\n")), (urls[8], page("1", "(1)")), (urls[9], None)],
        "URL string, html string")
    contents = spark.createDataFrame([(urls[i], CONTENTS.replace(BASE, f"https://www.sec.gov/Archives/edgar/data/{i}")) for i in (0, 2, 3, 4)], "URL string, html string")
    exhibits = spark.createDataFrame([(link(i, i, "group_fs.htm"), page("60", "(12)")) for i in (0, 2, 3, 4)], "exhibit_url string, html string")
    facts = spark.createDataFrame([fact("0000000000", "cash", 700.0), fact("0000000000", "flow", -70.0, 2), fact("0000000001", "flow", -50.0, 3)], FACTS)
    got = {r["URL"]: r for r in rs.runway_results(filings, rs.Sources(facts, documents, contents, exhibits)).collect()}
    assert set(got) == {u for u, f in zip(urls, forms) if f != "8-K"}
    seen = {i: (got[u]["Source"], got[u]["Form"], got[u]["result"] and (got[u]["result"]["status"], got[u]["result"]["cash_raw"], got[u]["result"]["ocf_quarterly_raw"]))
            for i, u in enumerate(urls) if u in got}
    assert seen == {
        0: ("facts", "10-Q", ("OK", 700.0, -70.0)), 1: ("document", "10-Q", ("OK", 300.0, -50.0)),
        2: ("exhibit", "20-F", ("OK (from exhibit EX-99.7)", 80.0, -6.0)), 3: ("exhibit", "20-F", ("OK (from exhibit EX-99.7)", 60.0, -6.0)),
        4: ("exhibit", "6-K", ("OK (from exhibit EX-99.7)", 60.0, -6.0)), 5: ("document", "6-K", ("6-K missing OCF (exhibits tried)", None, None)),
        6: ("", "10-K", None), 7: ("document", "10-Q", ("OK", 900_000.0, -300_000.0)), 9: ("document", "10-Q", ("Missing OCF", None, None))}


def test_no_sources(spark):
    filings = spark.createDataFrame([(link(1, 1), "10-Q")], "URL string, Form string")
    assert one(rs.runway_results(filings, rs.Sources()))["result"] is None
    assert rs.runway_results(filings.limit(0), rs.Sources()).count() == 0


def test_decided_companies_read_no_more(spark):
    """Company 1 is decided by its newest filing, 2 by an older one, 3 by none; one company has most of the filings."""
    rows = [("0000000001", "10-Q", f"2031-01-{20 - i:02d}", link(1, i, "10-q.htm"), i) for i in range(12)]
    rows += [("0000000002", "10-Q", f"2031-01-{20 - i:02d}", link(2, i, "10-q.htm"), i) for i in range(8)]
    rows += [("0000000003", "10-K", "2031-01-01", link(3, 0, "10-k.htm"), 0), ("0000000003", "10-K", None, link(3, 1, "10-k.htm"), 1)]
    filings = spark.createDataFrame(rows, "CIK string, Form string, FiledAt string, URL string, ord bigint").withColumn("FiledAt", F.col("FiledAt").cast("date"))
    pages = [(r[3], page("100", "(20)" if (r[0], r[4]) in {("0000000001", 0), ("0000000001", 5), ("0000000002", 6)} else None)) for r in rows]
    sources = rs.Sources(documents=spark.createDataFrame(pages, "URL string, html string"))
    few, every = rs.first_results(filings, sources), rs.runway_results(filings, sources)
    tried = {r["URL"] for r in few.collect()}
    assert {u for u in tried if "/data/1/" in u} == {link(1, 0, "10-q.htm")} and len([u for u in tried if "/data/2/" in u]) == 8
    companies = spark.createDataFrame([("A", "1"), ("B", "2"), ("C", "3"), ("D", "4")], "Ticker string, CIK string")
    verdicts = [sorted(map(str, rw.extract_runway(companies, filings, r, "2031-02-01").collect())) for r in (few, every)]
    assert verdicts[0] == verdicts[1] and len(verdicts[0]) == 4


def test_statement_details(spark):
    restricted = """<p>CONSOLIDATED STATEMENTS OF CASH FLOWS</p>\n<p>(in millions)</p><table>
<tr><td></td><td>2023</td><td>2024</td></tr><tr><td>Cash flows from operating activities</td><td>(</td><td>5</td><td>)</td></tr>
<tr><td>Cash and cash equivalents</td></tr><tr><td>Cash and restricted cash</td><td>7</td><td>9</td></tr></table>"""
    other = "<p>no heading</p><table><tr><td>Net cash used in operations</td><td>(1,500)</td></tr><tr><td>Cash at end of period</td><td>4,000</td></tr></table>"
    docs = spark.createDataFrame([(1, restricted), (2, other), (3, None)], "id int, html string")
    rows = {r["id"]: r["statement"] for r in statements.parse_statements(docs).collect()}
    assert rows[1]["ocf"] == -5e6 and rows[1]["cash"] == 9e6 and rows[1]["units"] == 1_000_000
    assert rows[2]["ocf"] == -1500.0 and rows[2]["cash"] == 4000.0 and not rows[2]["header"]
    assert rows[3]["cash"] is None and rows[3]["ocf"] is None


def test_tables_with_equal_beginnings(spark):
    """Two tables that agree in far more than their first words, each with its own scale before it."""
    filler = "".join(f"<tr><td>Item {i}</td><td>{i}</td></tr>" for i in range(60))

    def table(cash, flow):
        return (f"<table><tr><td></td><td>2031</td></tr>{filler}<tr><td>Net cash used in operating activities</td><td>({flow})</td></tr>"
                f"<tr><td>Cash and cash equivalents, end of period</td><td>{cash}</td></tr></table>")

    gap = "\n" + "<p>text</p>\n" * 600
    one = f"<p>Selected data</p>\n<p>(in millions)</p>{table(1, 2)}{gap}<h2>Statements of Cash Flows</h2>\n<p>(in thousands)</p>{table(900, 300)}"
    two = f"<h2>Statements of Cash Flows</h2>\n<p>(in thousands)</p>{table(900, 300)}{gap}<p>Other data</p>\n<p>(in millions)</p>{table(1, 2)}"
    docs = spark.createDataFrame([(1, one), (2, two)], "id int, html string")
    rows = {r["id"]: r["statement"] for r in statements.parse_statements(docs).collect()}
    assert {i: (s["cash"], s["ocf"]) for i, s in rows.items()} == {1: (900_000.0, -300_000.0), 2: (900_000.0, -2e6)}
    placed = docs.select("id", statements.placed_tables(F.col("html"), F.lit(1)).alias("t")).collect()
    texts = {1: one, 2: two}
    assert all(texts[r["id"]][x["at"] - 1:].startswith(x["t"]) for r in placed for x in r["t"]) and [len(r["t"]) for r in placed] == [2, 2]


def test_sign_option(spark):
    html = "<p>STATEMENTS OF CASH FLOWS</p><table><tr><td>Net cash provided by operating activities</td><td>5,000</td></tr></table>"
    docs = spark.createDataFrame([(html,)], "html string")
    assert one(statements.parse_statements(docs))["statement"]["ocf"] == 5000.0
    assert one(statements.parse_statements(docs, sign="flip_provided"))["statement"]["ocf"] == -5000.0


def test_statement_lookup_uses_first_matching_row(spark):
    rows = [("f", "10-Q", "cashflow", 0, "Net cash used in operating activities", 0, "Three Months Ended", "-1200"),
            ("f", "10-Q", "balance", 0, "Cash and cash equivalents", 0, "", "5000")]
    cells = spark.createDataFrame(rows, "filing_id string, form string, stmt string, row_idx int, label string, col_idx int, period_label string, value string")
    r = one(rw.statements_runway(cells))["result"]
    assert (r["cash_raw"], r["ocf_raw"], r["period_months"], r["complete"]) == (5000.0, -1200.0, 3, True)


def test_facts_never_pair_filings_with_facts(spark):
    facts = spark.createDataFrame(
        [("1", "us-gaap", "CashAndCashEquivalents", "USD", 10.0, "a1", None, "2024-03-31", 2024, "Q1", "10-Q", 1),
         ("1", "us-gaap", "CashAndCashEquivalents", "USD", 20.0, "a2", None, "2024-06-30", 2024, "Q2", "10-Q", 2),
         ("1", "us-gaap", "CashAndCashEquivalents", "shares", 99.0, "a2", None, "2025-06-30", 2025, "Q2", "10-Q", 3)],
        "CIK string, Taxonomy string, Concept string, Unit string, Val double, Accn string, Start date, End string, Fy int, Fp string, Form string, ord bigint",
    ).withColumn("End", F.col("End").cast("date"))
    filings = spark.createDataFrame([("u1", "10-Q", "1", "a1"), ("u3", "10-Q", "1", "zz")], "URL string, Form string, CIK string, Accn string")
    got = {r["URL"]: r["result"]["cash_raw"] for r in rw.facts_runway(filings, facts, "ord", parse_url=False).collect()}
    assert got == {"u1": 10.0, "u3": 20.0}


def task_count(df):
    return df.select(F.spark_partition_id().alias("p")).distinct().count()


def test_statements_of_a_small_file_are_parsed_by_many_tasks(spark):
    companies = runway_catalog.companies(Tables(spark, "/root/testdata/sf0.01"))
    parsed = statements.parse_statements(companies.withColumn("html", runway_catalog.statement_html()))
    assert task_count(parsed) >= 8 and parsed.count() == spark.read.parquet("/root/testdata/sf0.01/supplier.parquet").count()
