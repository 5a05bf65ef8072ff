"""Queries: numbers, statements, tagged facts, exhibits, runway choice."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from capsieve import rules as R
from capsieve.catalog.base import query
from capsieve.functions import numbers
from capsieve.functions.text import starts_any, upper_key
from capsieve.operators import runway as rw
from capsieve.operators import runway_rules as rr
from capsieve.operators import keyed, resolution, scoring, statements
from capsieve.plans.standins import FILINGS_AS_OF, Tables
from capsieve.session import stored_once

# cash, operating cash flow, months and print scale of a made-up company per supplier
COMPANY = """
SELECT s_suppkey AS k, s_name AS name, (s_suppkey + 1) * 1000 AS cash, (s_suppkey % 7 + 1) * 400 AS burn,
  CASE s_suppkey % 4 WHEN 0 THEN 3 WHEN 1 THEN 6 WHEN 2 THEN 9 ELSE 12 END AS months,
  CASE WHEN s_suppkey % 5 = 0 THEN 1 ELSE 1000 END AS scale, s_suppkey % 3 = 0 AS no_balance FROM supplier
"""


def companies(t: Tables) -> DataFrame:
    """Rows of a few numbers that become whole documents, so they are dealt to all tasks first."""
    return keyed.spread(t.sql(COMPANY), "k")


def _n(c: str) -> Column:
    return F.format_number(c, 0)


def statement_html() -> Column:
    """Balance sheet and cash-flow statement of a :data:`COMPANY` row as filing HTML."""
    lit = F.lit
    note = F.when(F.col("scale") == 1000, "\n<p>(in thousands)</p>").otherwise("\n<p>&nbsp;</p>")
    balance = F.when(F.col("no_balance"), "").otherwise(F.concat(
        lit("<p>CONSOLIDATED BALANCE SHEETS</p>"), note,
        lit("<table><tr><td></td><td>2024</td><td>2023</td></tr><tr><td>Cash and cash equivalents</td><td>$ "), _n("cash"),
        lit("</td><td>999</td></tr></table>\n")))
    words = F.when(F.col("months") == 3, "Three months ended").when(F.col("months") == 6, "Six months ended")
    words = words.when(F.col("months") == 9, "Nine months ended").otherwise("Year ended")
    return F.concat(
        lit("<html><body>\n\n\n\n\n\n"), balance, lit("<h2>Consolidated Statements of Cash Flows</h2>"), note, lit("<p>"), words,
        lit("</p>\n<table><tr><th></th><th>2023</th><th>2024</th></tr>"
            "<tr><td>Net cash used in operating activities</td><td>(1)</td><td>("), _n("burn"),
        lit(")</td></tr><tr><td>Net increase in cash</td><td>5</td><td>6</td></tr>"
            "<tr><td>Cash and cash equivalents, beginning of period</td><td>1</td><td>2</td></tr>"
            "<tr><td>Cash and cash equivalents, end of period</td><td>77</td><td>"), _n("cash"),
        lit("</td></tr></table></body></html>"))


@query("runway_regex", sql=f"""
WITH c AS ({COMPANY}) SELECT k AS SupplierId, CASE WHEN k % 11 = 3 THEN NULL ELSE (cash * 1.0) / (burn * 2.5) END AS Quarters FROM c
""".replace("(cash * 1.0) / (burn * 2.5)", "round_even(cash / CAST(burn AS DOUBLE), 2)"))
def runway_regex(t: Tables) -> DataFrame:
    text = F.concat(F.lit("Cash and cash equivalents: $"), _n("cash"), F.lit(". <b>Net cash used in OPERATING ACTIVITIES: $("), _n("burn"),
                    F.lit(")</b>"))
    text = F.when(F.col("k") % 11 == 3, "no statement here").otherwise(text)
    return companies(t).select(F.col("k").alias("SupplierId"), rr.text_runway(text).alias("Quarters"))


PRINTED = """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(l_shipdate AS DATE) AS d, CAST(round(l_extendedprice * 100) AS BIGINT) AS cents,
  l_linenumber % 7 AS style FROM lineitem
"""


@query("number_parser", sql=f"""
WITH p AS ({PRINTED}), v AS (SELECT *, cents // 100 AS w, lpad(CAST(cents % 100 AS VARCHAR), 2, '0') AS f FROM p)
SELECT l_orderkey AS OrderKey, l_partkey AS PartKey, l_suppkey AS SuppKey, CAST(d AS VARCHAR) AS Day, style AS Style,
  CASE style WHEN 0 THEN CAST(w || '.' || f AS DOUBLE) WHEN 1 THEN -CAST(w || '.' || f AS DOUBLE) WHEN 2 THEN CAST(w || '.' || f AS DOUBLE)
    WHEN 3 THEN -CAST(w AS DOUBLE) WHEN 4 THEN CAST(w AS DOUBLE) WHEN 5 THEN -CAST(w || '.' || f AS DOUBLE) ELSE NULL END AS Value FROM v
""")
def number_parser(t: Tables) -> DataFrame:
    whole, frac = F.expr("cents div 100"), F.lpad((F.col("cents") % 100).cast("string"), 2, "0")
    us, dot = F.format_number(whole, 0), F.translate(F.format_number(whole, 0), ",", ".")
    lit, style = F.lit, F.col("style")
    text = (
        F.when(style == 0, F.concat(lit("US$ "), us, lit("."), frac)).when(style == 1, F.concat(lit("("), us, lit("."), frac, lit(")")))
        .when(style == 2, F.concat(dot, lit(","), frac, lit(" EUR"))).when(style == 3, F.concat(lit("−"), us))
        .when(style == 4, F.translate(us, ",", "'")).when(style == 5, F.concat(lit("$("), us, lit("."), frac, lit(") [1]")))
        .otherwise("n/a —"))
    return t.sql(PRINTED).select(
        F.col("l_orderkey").alias("OrderKey"), F.col("l_partkey").alias("PartKey"), F.col("l_suppkey").alias("SuppKey"),
        F.col("d").cast("string").alias("Day"), F.col("style").alias("Style"), numbers.parse_number(text).alias("Value"))


@query("number_display", sql="""
SELECT s_suppkey AS SupplierId, format('{:.2f}', s_acctbal) AS Display, format('{:.6f}', s_acctbal) AS Raw, s_acctbal AS Rounded,
  CASE WHEN s_suppkey % 2 = 0 THEN -s_acctbal ELSE s_acctbal END AS Cell FROM supplier
""")
def number_display(t: Tables) -> DataFrame:
    c = F.col("s_acctbal")
    # all balances are printed the same way; negative ones in parentheses
    money = F.format_number(F.abs(c), 2)
    printed = F.when(F.col("s_suppkey") % 2 == 0, F.concat(F.lit("("), money, F.lit(")"))).otherwise(money)
    printed = F.when(c < 0, F.when(F.col("s_suppkey") % 2 == 0, money).otherwise(F.concat(F.lit("("), money, F.lit(")")))).otherwise(printed)
    return t.base("supplier").select(
        F.col("s_suppkey").alias("SupplierId"), numbers.display_number(c).alias("Display"), numbers.raw_number(c).alias("Raw"),
        numbers.half_up(c).alias("Rounded"), numbers.statement_number(printed).alias("Cell"))


FINAL = """
SELECT s_suppkey AS k, CASE WHEN s_suppkey % 6 = 1 THEN NULL ELSE s_acctbal + 2000 END AS cash,
  CASE WHEN s_suppkey % 8 = 2 THEN NULL WHEN s_suppkey % 8 = 5 THEN 1000.0 ELSE -(s_suppkey % 9 + 1) * 300.0 END AS ocf,
  CASE s_suppkey % 5 WHEN 0 THEN 3 WHEN 1 THEN 6 WHEN 2 THEN 9 WHEN 3 THEN 12 ELSE 7 END AS months,
  CASE s_suppkey % 3 WHEN 0 THEN '10-K' WHEN 1 THEN '6-K' ELSE '' END AS form FROM supplier
"""
VERDICT = """
v AS (SELECT *, CASE WHEN months IN (3, 6, 9, 12) THEN ocf / (months / 3.0) ELSE ocf END AS q FROM f),
w AS (SELECT *, CASE WHEN q >= 0 THEN 0.0 WHEN q < 0 THEN abs(q) END AS b, CASE WHEN q < 0 THEN cash / abs(q) END AS r,
  cash IS NOT NULL AND q IS NOT NULL AND months IN (3, 6, 9, 12) AS done FROM v)
"""


@query("ocf_normalize_finalize", sql=f"""
WITH f AS ({FINAL}), {VERDICT}
SELECT k AS SupplierId, q AS Quarterly, CASE WHEN ocf IS NULL THEN NULL WHEN months = 3 THEN '' WHEN months = 6 THEN '6m/2' WHEN months = 9 THEN '9m/3'
    WHEN months = 12 THEN 'annual/4' END AS Tag, b AS Burn, r AS QuartersRaw,
  CASE WHEN q IS NULL THEN 'Missing OCF' WHEN q >= 0 THEN 'OCF positive (self-funding)' WHEN cash IS NULL THEN 'Missing cash' WHEN done THEN 'OK' ELSE 'Incomplete' END AS Status,
  done AS Complete, CASE form WHEN '' THEN '' WHEN '10-K' THEN 'annual_div4' ELSE 'interim' END AS Estimate,
  CASE WHEN r IS NULL THEN '' WHEN r < 1 THEN '<1q' WHEN r < 3 THEN '1-3q' WHEN r < 6 THEN '3-6q' WHEN r < 12 THEN '6-12q' ELSE '>12q' END AS Bucket,
  CAST(round_even(r * 90, 0) AS INTEGER) AS Days FROM w
""")
def ocf_normalize_finalize(t: Tables) -> DataFrame:
    o, m = F.col("ocf"), F.col("months")
    rows = t.sql(FINAL.replace("1000.0", "1000.0D").replace("300.0", "300.0D")).withColumns(
        {"q": rr.quarterly(o, m), "r": rr.finalize(F.col("cash"), o, m, F.col("form"), rr.quarterly(o, m))})
    raw = F.col("r.runway_quarters_raw")
    return rows.select(
        F.col("k").alias("SupplierId"), F.col("q").alias("Quarterly"), rr.quarterly_tag(o, m).alias("Tag"),
        F.col("r.quarterly_burn_raw").alias("Burn"), raw.alias("QuartersRaw"), F.col("r.status").alias("Status"),
        F.col("r.complete").alias("Complete"), F.col("r.estimate").alias("Estimate"), rr.bucket(raw).alias("Bucket"),
        rr.runway_days(raw).alias("Days"))


@query("review_filter", sql=f"""
WITH f AS ({FINAL}), {VERDICT} SELECT k AS SupplierId FROM w WHERE NOT done
""")
def review_filter(t: Tables) -> DataFrame:
    """Rows for the review log: incomplete or unsuccessful verdicts."""
    o, m = F.col("ocf"), F.col("months")
    rows = t.sql(FINAL.replace("1000.0", "1000.0D").replace("300.0", "300.0D")).withColumn(
        "r", rr.finalize(F.col("cash"), o, m, F.col("form"), rr.quarterly(o, m)))
    return rows.where(rr.needs_review(F.col("r"))).select(F.col("k").alias("SupplierId"))


# ---------------------------------------------------------------- HTML

@query("html_cells", sql=f"""
WITH c AS ({COMPANY}), n AS (SELECT *, CASE WHEN no_balance THEN 0 ELSE 1 END AS ft, format('{{:,}}', cash) AS ct, format('{{:,}}', burn) AS bt FROM c),
r AS (SELECT k, ft AS t, i, [['', '2023', '2024'], ['Net cash used in operating activities', '(1)', '(' || bt || ')'], ['Net increase in cash', '5', '6'],
    ['Cash and cash equivalents, beginning of period', '1', '2'], ['Cash and cash equivalents, end of period', '77', ct]][i + 1] AS cells FROM n, range(5) x(i)
  UNION ALL SELECT k, 0, i, [['', '2024', '2023'], ['Cash and cash equivalents', '$ ' || ct, '999']][i + 1] FROM n, range(2) x(i) WHERE NOT no_balance)
SELECT k AS SupplierId, CAST(t AS INTEGER) AS TableIdx, CAST(i AS INTEGER) AS RowIdx, CAST(j AS INTEGER) AS ColIdx, cells[j + 1] AS Text FROM r, range(3) y(j)
""")
def html_cells(t: Tables) -> DataFrame:
    """Every cell of every table of the statements."""
    docs = companies(t).withColumn("html", statement_html())
    return statements.html_cells(docs, "k").select(
        F.col("k").alias("SupplierId"), F.col("table_idx").alias("TableIdx"), F.col("row_idx").alias("RowIdx"),
        F.col("col_idx").alias("ColIdx"), F.col("text").alias("Text"))


@query("page_list_items", sql=r"""
WITH l AS (SELECT page_id, unnest(regexp_extract_all(html, '(?is)<li(?:\s[^>]*)?>.*?</li>')) AS li FROM pages)
SELECT page_id AS PageId, count(*) AS Items, sum(length(trim(regexp_replace(regexp_replace(li, '<[^>]+>', ' ', 'g'), '\s+', ' ', 'g')))) AS Chars
FROM l GROUP BY page_id
""")
def page_list_items(t: Tables) -> DataFrame:
    return statements.html_elements(t.base("pages"), "page_id", "li").groupBy(F.col("page_id").alias("PageId")).agg(
        F.count("*").alias("Items"), F.sum(F.length("text")).alias("Chars"))


STATEMENT_SQL = f"""
WITH c AS ({COMPANY}), f AS (SELECT k, CAST(cash * scale AS DOUBLE) AS cash, CAST(-burn * scale AS DOUBLE) AS ocf, months, scale, '10-Q' AS form FROM c)
"""


@query("html_statement_runway", sql=STATEMENT_SQL + f""", {VERDICT}
SELECT k AS SupplierId, cash AS Cash, ocf AS OCF, months AS Months, CAST(scale AS BIGINT) AS Units, TRUE AS HasHeader, r AS QuartersRaw, 'OK' AS Status FROM w
""")
def html_statement_runway(t: Tables) -> DataFrame:
    docs = companies(t).withColumn("html", statement_html())
    parsed = statements.parse_statements(docs)
    s = F.col("statement")
    final = rr.finalize(s["cash"], s["ocf"], s["months"], F.lit("10-Q"), rr.quarterly(s["ocf"], s["months"]))
    return parsed.withColumn("r", final).select(
        F.col("k").alias("SupplierId"), s["cash"].alias("Cash"), s["ocf"].alias("OCF"), s["months"].alias("Months"),
        s["units"].alias("Units"), s["header"].alias("HasHeader"), F.col("r.runway_quarters_raw").alias("QuartersRaw"),
        F.col("r.status").alias("Status"))


@query("page_statements", sql=r"""
SELECT page_id AS PageId, FALSE AS HasHeader, CAST(1 AS BIGINT) AS Units FROM pages
""")
def page_statements(t: Tables) -> DataFrame:
    """The statement parser over every web page: none of them holds a statement."""
    parsed = statements.parse_statements(t.base("pages").select("page_id", "html"))
    return parsed.select(F.col("page_id").alias("PageId"), F.col("statement.header").alias("HasHeader"), F.col("statement.units").alias("Units"))


@query("caption_number", sql="""
SELECT p_partkey AS PartKey, CASE p_partkey % 4 WHEN 0 THEN CAST(p_size * 1000 + 234 AS DOUBLE) WHEN 1 THEN CAST(-(p_size * 1000 + 234) AS DOUBLE)
  WHEN 2 THEN CAST(p_size * 1000 + 7 AS DOUBLE) ELSE NULL END AS Value FROM part
""")
def caption_number(t: Tables) -> DataFrame:
    k, lit = F.col("p_partkey") % 4, F.lit
    n = F.format_number(F.col("p_size") * 1000 + 234, 0)
    text = (
        F.when(k == 0, F.concat(F.col("p_name"), lit(" Net cash used in operating activities (3) $ "), n, lit(" and others")))
        .when(k == 1, F.concat(lit("NET CASH USED IN OPERATING ACTIVITIES 12 ("), n, lit(") (5,000)")))
        .when(k == 2, F.concat(lit("Net  cash provided by operating activities 4 "), F.format_number(F.col("p_size") * 1000 + 7, 0), lit(" 2023")))
        .otherwise(F.concat(lit("no caption here but "), n)))
    return t.base("part").select(
        F.col("p_partkey").alias("PartKey"),
        statements.caption_number(text, [*R.OCF_CAPTIONS_BURN, *R.OCF_CAPTIONS_PROVIDED]).alias("Value"))


@query("period_vote", sql="""
SELECT s_suppkey AS SupplierId, CASE s_suppkey % 4 WHEN 0 THEN 9 WHEN 1 THEN 12 WHEN 2 THEN 3 ELSE NULL END AS Months,
  CASE s_suppkey % 4 WHEN 0 THEN 1000 WHEN 1 THEN 1000000 END AS Scale,
  CASE s_suppkey % 4 WHEN 0 THEN 6 WHEN 1 THEN 12 WHEN 2 THEN 3 ELSE NULL END AS ColumnMonths FROM supplier
""")
def period_vote(t: Tables) -> DataFrame:
    k = F.col("s_suppkey") % 4
    text = (F.when(k == 0, "three months ended, nine months ended (dollars in thousands)").when(k == 1, "Twelve  months ended; year ended; six months ended (US$ in millions, except)")
            .when(k == 2, "three months ended and three months ended, year ended").otherwise("as of June 30"))
    label = F.when(k == 0, "6 Months Ended").when(k == 1, "Fiscal Year 2024").when(k == 2, "THREE MONTHS").otherwise("June 30")
    return t.base("supplier").select(F.col("s_suppkey").alias("SupplierId"), rr.months_in_text(text).alias("Months"),
                                     rr.scale_in(text).alias("Scale"), rr.months_in_column(label).alias("ColumnMonths"))


# ---------------------------------------------------------------- tagged facts and rendered statements

FACT_SQL = """
WITH a AS (SELECT cik, concept, accn, val, end_dt, row_number() OVER (PARTITION BY cik, concept, accn ORDER BY end_dt DESC, ord) AS rn FROM v_facts),
b AS (SELECT cik, concept, val, end_dt, row_number() OVER (PARTITION BY cik, concept ORDER BY end_dt DESC, ord) AS rn FROM v_facts),
q AS (SELECT DISTINCT cik, concat('A', CAST(ord % 4 AS VARCHAR)) AS accn FROM v_facts),
g AS (SELECT q.cik, q.accn, coalesce(c1.val, c2.val) AS cash, coalesce(o1.val, o2.val) AS ocf FROM q
  LEFT JOIN a c1 ON c1.cik = q.cik AND c1.accn = q.accn AND c1.concept = 'Cash' AND c1.rn = 1
  LEFT JOIN b c2 ON c2.cik = q.cik AND c2.concept = 'Cash' AND c2.rn = 1
  LEFT JOIN a o1 ON o1.cik = q.cik AND o1.accn = q.accn AND o1.concept = 'OCF' AND o1.rn = 1
  LEFT JOIN b o2 ON o2.cik = q.cik AND o2.concept = 'OCF' AND o2.rn = 1)
"""


@query("xbrl_best_fact", "v_facts", sql=FACT_SQL + """
SELECT cik || '/' || accn AS Filing, cash AS Cash, ocf AS OCF, CASE WHEN ocf IS NULL THEN NULL ELSE ocf / 2.0 END AS Quarterly,
  CASE WHEN ocf IS NULL THEN 'Missing OCF' WHEN cash IS NULL AND ocf IS NOT NULL THEN 'Incomplete' ELSE 'OK' END AS Status FROM g
""")
def xbrl_best_fact(t: Tables) -> DataFrame:
    v = t.view("v_facts")
    cash = F.when(F.col("concept") == "Cash", "CashAndCashEquivalents").otherwise("NetCashProvidedByUsedInOperatingActivities")
    facts = v.select(
        F.col("cik").alias("CIK"), F.lit("us-gaap").alias("Taxonomy"), cash.alias("Concept"), F.lit("USD").alias("Unit"),
        F.col("val").alias("Val"), F.col("accn").alias("Accn"), F.lit(None).cast("date").alias("Start"), F.col("end_dt").alias("End"),
        F.lit(2000).alias("Fy"), F.lit("H1").alias("Fp"), F.lit("6-K").alias("Form"), "ord")
    ids = v.select(F.col("cik").alias("CIK"), F.concat(F.lit("A"), F.col("ord") % 4).alias("Accn")).distinct()
    ids = ids.withColumns({"URL": F.concat("CIK", F.lit("/"), "Accn"), "Form": F.lit("6-K")})
    out = rw.facts_runway(ids, facts, "ord", parse_url=False)
    r = F.col("result")
    return out.select(F.col("URL").alias("Filing"), r["cash_raw"].alias("Cash"), r["ocf_raw"].alias("OCF"),
                      r["ocf_quarterly_raw"].alias("Quarterly"), r["status"].alias("Status"))


@query("months_from_dates", "v_facts", sql="""
WITH d AS (SELECT ord, CAST(end_dt AS DATE) AS e, CAST(10 + (ord % 14) * 30 AS INTEGER) AS n, ord % 3 = 0 AS coded FROM v_facts),
m AS (SELECT *, CAST(round_even(n / 30.4375, 0) AS INTEGER) AS r FROM d)
SELECT ord AS FactId, CASE WHEN coded THEN 9 WHEN r BETWEEN 2 AND 4 THEN 3 WHEN r BETWEEN 5 AND 7 THEN 6 WHEN r BETWEEN 8 AND 10 THEN 9
  WHEN r BETWEEN 11 AND 13 THEN 12 ELSE r END AS Months FROM m
""")
def months_from_dates(t: Tables) -> DataFrame:
    days = (F.lit(10) + (F.col("ord") % 14) * 30).cast("int")
    rows = t.view("v_facts").withColumn("start", F.date_sub("end_dt", days))
    fp = F.when(F.col("ord") % 3 == 0, "q3")
    return rows.select(F.col("ord").alias("FactId"), rr.months_of_fact(fp, F.col("start"), F.col("end_dt"), F.lit(12)).alias("Months"))


@query("statement_lookup", sql=f"""
WITH c AS ({COMPANY}), f AS (SELECT k, CAST(cash AS DOUBLE) AS cash, CAST(-burn AS DOUBLE) AS ocf, CASE WHEN k % 2 = 0 THEN 6 ELSE 3 END AS months, '10-Q' AS form FROM c), {VERDICT}
SELECT k AS SupplierId, cash AS Cash, ocf AS OCF, months AS Months, r AS QuartersRaw, 'OK' AS Status FROM w
""")
def statement_lookup(t: Tables) -> DataFrame:
    period = F.when(F.col("k") % 2 == 0, "Six Months Ended").otherwise("Three Months Ended")

    def row(stmt: str, i: int, label: str, first: Column, second: Column) -> Column:
        return F.array(*[F.struct(F.lit(stmt).alias("stmt"), F.lit(i).alias("row_idx"), F.lit(label).alias("label"),
                                  F.lit(j).alias("col_idx"), v.cast("string").alias("value")) for j, v in enumerate((first, second))])

    none, other = F.lit(None), F.lit("999")
    minus = F.concat(F.lit("("), _n("burn"), F.lit(")"))
    cells = companies(t).withColumn("period_label", period).select("k", "period_label", F.inline(F.concat(
        row("balance", 0, "Total assets", other, other), row("balance", 1, "Cash and Cash Equivalents, Current", none, _n("cash")),
        row("balance", 2, "Cash and cash equivalents, restricted", other, other),
        row("cashflow", 0, "Depreciation", other, other),
        row("cashflow", 3, "NET CASH USED IN OPERATING ACTIVITIES", minus, other))))
    cells = cells.withColumnRenamed("k", "filing_id").withColumn("form", F.lit("10-Q"))
    r = F.col("result")
    return rw.statements_runway(cells).select(
        F.col("filing_id").alias("SupplierId"), r["cash_raw"].alias("Cash"), r["ocf_raw"].alias("OCF"), r["period_months"].alias("Months"),
        r["runway_quarters_raw"].alias("QuartersRaw"), r["status"].alias("Status"))


# ---------------------------------------------------------------- exhibits

def filing_pages(t: Tables) -> DataFrame:
    """Index page of a filing per supplier with three exhibit rows, one of them an image."""
    k, lit = F.col("k").cast("string"), F.lit

    def row(description: Column, name: str, kind: str) -> Column:
        return F.concat(lit("<tr><td>"), description, lit(f'</td><td>{kind}</td><td><a href="{name}">{name}</a></td></tr>\n'))

    first = F.when(F.col("k") % 3 == 1, "Interim condensed consolidated financial statements").otherwise("Press release")
    html = F.concat(
        lit("<table>"), row(lit("Annual report"), "main.htm", "20-F"), row(first, "ex99-1.htm", "EX-99.1"),
        F.replace(row(lit("Audited Financial Statements"), "/files/@/x_ex99-2.htm", "EX-99.2"), lit("@"), k), row(lit("Logo"), "ex99-3.jpg", "EX-99.3"), lit("</table>"))
    form = F.when(F.col("k") % 3 == 0, "40-F").when(F.col("k") % 3 == 1, "6-K").otherwise("20-F")
    return companies(t).withColumns({
        "url": F.concat(lit("https://www.sec.gov/Archives/edgar/data/"), k, lit("/acc"), k, lit("/main.htm")), "index_html": html, "form": form})


EXHIBIT_SQL = """
e AS (SELECT k, 1 AS seq, 'EX-99.1' AS doc_type, 'https://www.sec.gov/Archives/edgar/data/' || k || '/acc' || k || '/ex99-1.htm' AS link,
    CASE k % 3 WHEN 1 THEN 50 + 8 + 40 + 10 + 900 ELSE 58 END AS score FROM c
  UNION ALL SELECT k, 2, 'EX-99.2', 'https://www.sec.gov/files/' || k || '/x_ex99-2.htm', CASE k % 3 WHEN 0 THEN 1090 WHEN 1 THEN 90 ELSE 890 END FROM c)
"""


def ranked_exhibits(t: Tables) -> DataFrame:
    pages = filing_pages(t)
    index = rw.exhibit_index(pages.select("url", "index_html"), "url", "index_html")
    index = index.join(pages.select("url", "k", "form"), "url")
    return rw.exhibit_candidates(index, "url", F.col("form"))


@query("exhibit_rank", sql=f"""
WITH c AS ({COMPANY}), {EXHIBIT_SQL}
SELECT k AS SupplierId, doc_type AS DocType, link AS Link, CAST(score AS INTEGER) AS Score, row_number() OVER (PARTITION BY k ORDER BY score DESC, doc_type DESC) AS Place FROM e
""".replace("AS Place", "AS BigPlace").replace("row_number() OVER", "CAST(row_number() OVER").replace("doc_type DESC) AS BigPlace", "doc_type DESC) AS INTEGER) AS Place"))
def exhibit_rank(t: Tables) -> DataFrame:
    ranked = ranked_exhibits(t).withColumn("Place", F.row_number().over(Window.partitionBy("url").orderBy(*rw.exhibit_rank_order())))
    return ranked.select(F.col("k").alias("SupplierId"), F.col("doc_type").alias("DocType"), F.col("exhibit_url").alias("Link"),
                         F.col("score").alias("Score"), "Place")


@query("exhibit_follow", sql=f"""
WITH c AS ({COMPANY})
SELECT k AS SupplierId, 'https://www.sec.gov/Archives/edgar/data/' || k || '/acc' || k || '/ex99-1.htm' AS Link, CAST(cash * scale AS DOUBLE) AS Cash,
  CAST(-burn * scale AS DOUBLE) AS OCF, months AS Months, 'OK (from exhibit EX-99.1)' AS Status FROM c
""")
def exhibit_follow(t: Tables) -> DataFrame:
    """The best-ranked exhibit is often empty here, so the next one that has a statement is taken."""
    candidates = stored_once(ranked_exhibits(t), "exhibit-links")
    pages = filing_pages(t).withColumn("html", statement_html())
    good = pages.select(F.regexp_replace("url", "main", "ex99-1").alias("exhibit_url"), "html")
    bad = pages.select(F.concat(F.lit("https://www.sec.gov/files/"), "k", F.lit("/x_ex99-2.htm")).alias("exhibit_url"), F.lit("<p>nothing</p>").alias("html"))
    best = rw.follow_exhibits(candidates, good.unionByName(bad), "url", F.col("form"))
    best = rw.exhibit_verdict(best.join(candidates.select("url", "k", "form").distinct(), "url"), F.col("form"))
    return best.select(F.col("k").alias("SupplierId"), F.col("exhibit_url").alias("Link"), F.col("cash").alias("Cash"), F.col("ocf").alias("OCF"),
                       F.col("months").alias("Months"), F.col("result.status").alias("Status"))


@query("exhibit_needed", sql=f"""
WITH f AS ({FINAL}) SELECT k AS SupplierId, CASE WHEN k % 3 = 0 THEN cash IS NULL OR ocf IS NULL OR months = 7 OR k % 2 = 1 ELSE cash IS NULL AND ocf IS NULL AND k % 2 = 1 END AS Needed FROM f
""")
def exhibit_needed(t: Tables) -> DataFrame:
    form = F.when(F.col("k") % 3 == 0, "20-F").otherwise("10-Q")
    rows = t.sql(FINAL.replace("1000.0", "1000.0D").replace("300.0", "300.0D"))
    return rows.select(F.col("k").alias("SupplierId"), rr.needs_exhibit(
        form, F.col("cash"), F.col("ocf"), F.col("months"), F.col("k") % 2 == 0).alias("Needed"))


MERGE = """
SELECT s_suppkey AS k, CASE WHEN s_suppkey % 2 = 0 THEN 5000.0 END AS h_cash, CASE WHEN s_suppkey % 3 = 0 THEN -900.0 END AS h_ocf,
  CASE WHEN s_suppkey % 5 = 0 THEN 9 END AS h_months, CASE WHEN s_suppkey % 7 <= 2 THEN 7000.0 END AS x_cash,
  CASE WHEN s_suppkey % 11 <= 4 THEN -1200.0 END AS x_ocf, CASE WHEN s_suppkey % 13 <= 6 THEN 6 END AS x_months FROM supplier
"""


@query("html_xbrl_merge", sql=f"""
WITH m AS ({MERGE}), a AS (SELECT *, x_cash IS NOT NULL AND x_ocf IS NOT NULL AND x_months IS NOT NULL AS full_x,
    CASE WHEN x_months = 6 THEN x_ocf / 2.0 ELSE x_ocf END AS xq, CASE WHEN h_months = 9 THEN h_ocf / 3.0 ELSE h_ocf END AS hq FROM m),
b AS (SELECT *, CASE WHEN full_x THEN x_cash ELSE coalesce(h_cash, x_cash) END AS cash, coalesce(xq, hq) AS q,
    CASE WHEN full_x THEN x_months WHEN x_ocf IS NULL AND h_ocf IS NOT NULL AND h_months IS NOT NULL THEN h_months ELSE coalesce(x_months, h_months, 3) END AS months FROM a)
SELECT k AS SupplierId, cash AS Cash, q AS Quarterly, months AS Months,
  CASE WHEN q IS NULL THEN 'Missing OCF' WHEN cash IS NULL THEN 'Missing cash' ELSE 'OK' END AS Status,
  CASE WHEN full_x THEN 'XBRL' ELSE concat_ws(',', CASE WHEN (h_cash IS NULL AND x_cash IS NOT NULL) OR x_ocf IS NOT NULL OR (x_months IS NOT NULL AND months = x_months) THEN 'XBRL' END,
    CASE WHEN h_cash IS NOT NULL OR (x_ocf IS NULL AND h_ocf IS NOT NULL) OR (h_months IS NOT NULL AND months = h_months) THEN 'HTML' END) END AS Tags FROM b
""")
def html_xbrl_merge(t: Tables) -> DataFrame:
    rows = t.sql(MERGE.replace("00.0", "00.0D"))
    html = F.struct(F.col("h_cash").alias("cash"), F.col("h_ocf").alias("ocf"), F.col("h_months").alias("months"),
                    F.lit(1).alias("units"), F.lit("").alias("evidence"))
    o, m = F.col("x_ocf"), F.col("x_months")
    status = F.when(o.isNull(), "Missing OCF").when(m.isNull(), "Missing OCF period").otherwise("OK")
    xbrl = rr.finalize(F.col("x_cash"), o, m, F.lit("10-Q"), rr.quarterly(o, m), rr.quarterly_tag(o, m), F.lit("values parsed from XBRL: u"),
                       F.lit(1), status, F.array(F.lit("XBRL")))
    rows = rows.withColumns({"h": html, "x": xbrl})
    merged = rr.merge_sources(F.col("h"), F.col("x"), F.lit("10-Q"), F.lit(3), F.lit("u"))
    rows = rows.withColumn("r", merged)
    return rows.select(F.col("k").alias("SupplierId"), F.col("r.cash_raw").alias("Cash"), F.col("r.ocf_quarterly_raw").alias("Quarterly"),
                       F.col("r.period_months").alias("Months"), F.col("r.status").alias("Status"),
                       F.array_join("r.source_tags", ",").alias("Tags"))


# ---------------------------------------------------------------- filings <- runway

RUN_VIEW = """
rf AS (SELECT *, CASE WHEN form IN ('10-Q', '10-K', '20-F', '6-K', '40-F') THEN form END AS fam,
  CASE form WHEN '10-Q' THEN 0 WHEN '10-K' THEN 1 WHEN '20-F' THEN 2 WHEN '40-F' THEN 2 ELSE 3 END AS pr FROM v_filings)
"""


@query("attach_runway", "v_filings", sql=f"""
WITH {RUN_VIEW}, q AS (SELECT *, CASE WHEN fam IS NOT NULL AND ord % 5 <> 0 THEN (ord % 40 + 1) * 2.5 END AS quarters FROM rf)
SELECT ord AS FilingId, quarters AS RunwayQuarters, quarters IS NOT NULL AS HasRunway, CASE WHEN quarters IS NOT NULL THEN url END AS RunwaySourceURL FROM q
""")
def attach_runway(t: Tables) -> DataFrame:
    f = t.filings()
    cash = F.format_number((F.col("ord") % 40 + 1) * 1000, 0)
    text = F.concat(F.lit("Cash and cash equivalents "), cash, F.lit("; used in operating activities (400)"))
    pages = f.select("URL", F.when(F.col("ord") % 5 == 0, "no numbers").otherwise(text).alias("Text"))
    return rw.attach_runway(f, rw.runway_by_url(f, pages)).select(
        F.col("ord").alias("FilingId"), "RunwayQuarters", "HasRunway", "RunwaySourceURL")


@query("runway_filing_pick", "v_filings", sql=f"""
WITH {RUN_VIEW}, q AS (SELECT *, CASE WHEN ord % 3 = 0 THEN NULL ELSE (ord % 40) / 4.0 END AS quarters,
  coalesce(date_diff('day', filed_at, DATE '{FILINGS_AS_OF}'), 1000000) AS age FROM rf WHERE fam IS NOT NULL),
r AS (SELECT *, row_number() OVER (PARTITION BY cik ORDER BY quarters IS NULL, age, ord) AS rn FROM q)
SELECT cik AS CIK, ord AS FilingId, CAST(quarters AS DOUBLE) AS Quarters FROM r WHERE rn = 1
""")
def runway_filing_pick(t: Tables) -> DataFrame:
    f = t.filings().withColumn("RunwayQuarters", F.when(F.col("ord") % 3 != 0, (F.col("ord") % 40) / F.lit(4.0)))
    return scoring.runway_filing(f, ["CIK"], "Form", "FiledAt", FILINGS_AS_OF, "ord").select(
        "CIK", F.col("ord").alias("FilingId"), F.col("RunwayQuarters").alias("Quarters"))


RESULT_SQL = f"""
WITH {RUN_VIEW}, u AS (SELECT *, url || '?form=' || fam AS link, CASE WHEN ord % 3 = 0 THEN NULL ELSE (ord % 50 + 1) * 1000.0 END AS cash,
    CASE WHEN ord % 5 = 0 THEN NULL ELSE -800.0 END AS ocf, ord % 7 <> 0 AS parsed FROM rf WHERE fam IS NOT NULL AND filed_at IS NOT NULL),
s AS (SELECT *, parsed AND cash IS NOT NULL AND ocf IS NOT NULL AS done,
    CASE WHEN NOT parsed THEN 'Fetch error' WHEN ocf IS NULL THEN 'Missing OCF' WHEN cash IS NULL THEN 'Missing cash' ELSE 'OK' END AS status,
    CASE WHEN NOT parsed THEN fam || ' parser returned no data' WHEN ocf IS NULL THEN 'Missing OCF' WHEN cash IS NULL THEN 'Missing cash' ELSE 'OK' END AS note,
    row_number() OVER (PARTITION BY cik ORDER BY filed_at DESC, pr, ord) AS place FROM u),
fin AS (SELECT *, row_number() OVER (PARTITION BY cik ORDER BY place) AS rn FROM s WHERE done),
par AS (SELECT *, row_number() OVER (PARTITION BY cik ORDER BY pr, filed_at DESC, ord) AS rn FROM s WHERE parsed AND NOT done),
fir AS (SELECT * FROM s WHERE place = 1),
lst AS (SELECT cik, arg_max(status, place) AS status FROM s GROUP BY cik),
tried AS (SELECT s.cik, s.note, min(s.place) AS p FROM s LEFT JOIN (SELECT * FROM fin WHERE rn = 1) f ON f.cik = s.cik
          WHERE f.place IS NULL OR s.place <= f.place GROUP BY s.cik, s.note),
notes AS (SELECT cik, string_agg(note, ' | ' ORDER BY p) AS notes FROM tried GROUP BY cik)
"""


@query("runway_first_complete", "v_filings", "v_profiles", sql=RESULT_SQL + f"""
SELECT p.cik AS CIK, coalesce(format('{{:.2f}}', CASE WHEN f.cik IS NOT NULL THEN f.cash ELSE r.cash END), '') AS RunwayCash,
  CASE WHEN f.cik IS NOT NULL THEN format('{{:.6f}}', f.cash / 800.0) ELSE '' END AS RunwayQuartersRaw,
  CASE WHEN f.cik IS NOT NULL THEN 'OK' WHEN r.cik IS NOT NULL THEN r.status ELSE coalesce(l.status, 'No eligible filing') END AS RunwayStatus,
  coalesce(f.fam, r.fam, i.fam, '') AS RunwaySourceForm, coalesce(strftime(coalesce(f.filed_at, r.filed_at, i.filed_at), '%Y-%m-%d'), '') AS RunwaySourceDate,
  coalesce(f.link, r.link, i.link, '') AS RunwaySourceURL,
  CASE WHEN i.cik IS NULL THEN 'No eligible filing' ELSE concat(strftime(coalesce(f.filed_at, r.filed_at, i.filed_at), '%Y-%m-%d'), ' ', coalesce(f.fam, r.fam, i.fam), ' ',
    coalesce(f.link, r.link, i.link), ' | ', n.notes) END AS RunwayNotes,
  coalesce(CAST(date_diff('day', coalesce(f.filed_at, r.filed_at, i.filed_at), DATE '{FILINGS_AS_OF}') AS VARCHAR), '') AS RunwaySourceDaysAgo
FROM v_profiles p LEFT JOIN fin f ON f.cik = p.cik AND f.rn = 1 LEFT JOIN par r ON r.cik = p.cik AND r.rn = 1 AND f.cik IS NULL
  LEFT JOIN fir i ON i.cik = p.cik LEFT JOIN lst l ON l.cik = p.cik LEFT JOIN notes n ON n.cik = p.cik
""")
def runway_first_complete(t: Tables) -> DataFrame:
    return extracted(t, False).select(
        "CIK", "RunwayCash", "RunwayQuartersRaw", "RunwayStatus", "RunwaySourceForm", "RunwaySourceDate", "RunwaySourceURL", "RunwayNotes",
        "RunwaySourceDaysAgo")


@query("runway_drop_incomplete", "v_filings", "v_profiles", sql=RESULT_SQL + """
SELECT p.ticker AS Ticker, f.link AS RunwaySourceURL FROM v_profiles p JOIN fin f ON f.cik = p.cik AND f.rn = 1
""")
def runway_drop_incomplete(t: Tables) -> DataFrame:
    return extracted(t, True).select("Ticker", "RunwaySourceURL")


def extracted(t: Tables, drop: bool) -> DataFrame:
    f = t.filings()
    f = f.withColumn("URL", F.concat("URL", F.lit("?form="), "Form"))
    # as of resolution.runway_results: links that can carry a runway have a verdict, other forms have none
    carry = f.where(starts_any(upper_key("Form"), R.RUNWAY_FORMS)).withColumns({
        "cash": F.when(F.col("ord") % 3 != 0, (F.col("ord") % 50 + 1) * F.lit(1000.0)), "ocf": F.when(F.col("ord") % 5 != 0, F.lit(-800.0))})
    verdict = rr.finalize(F.col("cash"), F.col("ocf"), F.lit(3), F.col("Form"), F.col("ocf"))
    # inside a condition Spark computes a part of the verdict wherever it is named, so the condition is put on the finished one
    judged = keyed.evaluate_once(carry.select("URL", "ord", verdict.alias("result")), "result")
    results = judged.select("URL", F.when(F.col("ord") % 7 != 0, F.col("result")).alias("result"))
    return rw.extract_runway(t.profiles().select("Ticker", "CIK"), f, results, FILINGS_AS_OF, "ord", drop)


@query("source_defaults", "v_filings", sql="""
SELECT ord AS FilingId, CASE WHEN ord % 2 = 0 AND form <> '' THEN form ELSE CASE WHEN ord % 3 = 0 THEN '10-Q' ELSE '8-K' END END AS Form,
  CASE WHEN ord % 2 = 0 AND filed_at IS NOT NULL THEN CAST(filed_at AS VARCHAR) ELSE '2001-01-01' END AS Date, CASE WHEN ord % 2 = 0 THEN url ELSE 'first' END AS Url FROM v_filings
""")
def source_defaults(t: Tables) -> DataFrame:
    used = F.struct(F.col("Form").alias("form"), "FiledAt", "URL")
    used = F.when(F.col("ord") % 2 == 0, used)
    first = F.struct(F.lit("8-K").alias("form"), F.lit("2001-01-01").cast("date").alias("FiledAt"), F.lit("first").alias("URL"))
    given = F.when(F.col("ord") % 3 == 0, "10-Q").otherwise("")
    rows = t.filings().withColumn("s", rw.source_defaults(given, F.lit(""), F.lit(""), used, first))
    return rows.select(F.col("ord").alias("FilingId"), F.col("s.form").alias("Form"), F.col("s.date").alias("Date"), F.col("s.url").alias("Url"))


# ---------------------------------------------------------------- filings to verdicts as one job

def landed_sources(t: Tables) -> tuple[DataFrame, resolution.Sources]:
    """A filing per supplier and what has landed of it: by turns a document, complete facts beside a document that must not
    count, a document and a fact, an index page with an exhibit, nothing, and a 6-K without a statement."""
    rows = companies(t).withColumns({
        "turn": F.col("k") % 6, "html": statement_html(),
        "URL": F.concat(F.lit("https://www.sec.gov/Archives/edgar/data/"), "k", F.lit("/"), F.lpad(F.col("k").cast("string"), 18, "0"), F.lit("/main.htm"))})
    turn, lit = F.col("turn"), F.lit
    form = F.when(turn == 3, "20-F").when(turn == 4, "10-K").when(turn == 5, "6-K").otherwise("10-Q")
    filings = rows.select("URL", form.alias("Form"))
    documents = rows.where(turn != 4).select("URL", F.when(turn.isin(3, 5), "<p>press release</p>").otherwise(F.col("html")).alias("html"))
    index = rows.where(turn == 3).select("URL", lit(
        '<table><tr><td>Audited financial statements</td><td>EX-99.1</td><td><a href="statements.htm">statements.htm</a></td></tr>'
        '<tr><td>Chart</td><td>EX-99.2</td><td><a href="chart.jpg">chart.jpg</a></td></tr></table>').alias("html"))
    exhibits = rows.select(F.replace("URL", lit("main.htm"), lit("statements.htm")).alias("exhibit_url"), "html")
    period = F.when(F.col("months") == 3, "Q1").when(F.col("months") == 6, "Q2").when(F.col("months") == 9, "Q3").otherwise("FY")

    def fact(concept: str, value: Column, known: Column) -> Column:
        return F.struct(lit(concept).alias("Concept"), F.when(known, value.cast("double")).alias("Val"))

    both = F.array(fact("CashAndCashEquivalents", F.col("cash") * 7, turn == 1), fact("NetCashProvidedByUsedInOperatingActivities", F.col("burn") * -7, turn.isin(1, 2)))
    facts = rows.where(turn.isin(1, 2)).select("k", period.alias("Fp"), F.inline(both)).select(
        F.lpad(F.col("k").cast("string"), 10, "0").alias("CIK"), lit("us-gaap").alias("Taxonomy"), "Concept", lit("USD").alias("Unit"), "Val",
        lit(None).cast("string").alias("Accn"), lit(None).cast("date").alias("Start"), lit(None).cast("date").alias("End"), lit(2024).alias("Fy"), "Fp",
        lit("10-Q").alias("Form"), F.col("k").alias("ord"))
    return filings, resolution.Sources(facts, documents, index, exhibits)


@query("filing_runway", sql=f"""
WITH c AS ({COMPANY}), t AS (SELECT *, k % 6 AS turn FROM c),
f AS (SELECT k, turn, CASE WHEN turn = 1 THEN CAST(cash * 7 AS DOUBLE) WHEN turn IN (0, 2, 3) THEN CAST(cash * scale AS DOUBLE) END AS cash,
  CASE WHEN turn IN (1, 2) THEN CAST(burn * -7 AS DOUBLE) WHEN turn IN (0, 3) THEN CAST(-burn * scale AS DOUBLE) END AS ocf,
  CASE WHEN turn = 5 THEN 3 WHEN turn <> 4 THEN months END AS months, '' AS form FROM t), {VERDICT}
SELECT k AS SupplierId, CASE turn WHEN 3 THEN '20-F' WHEN 4 THEN '10-K' WHEN 5 THEN '6-K' ELSE '10-Q' END AS Form,
  CASE turn WHEN 1 THEN 'facts' WHEN 3 THEN 'exhibit' WHEN 4 THEN '' ELSE 'document' END AS Source,
  CASE turn WHEN 3 THEN 'OK (from exhibit EX-99.1)' WHEN 4 THEN NULL WHEN 5 THEN '6-K missing OCF (exhibits tried)' ELSE 'OK' END AS Status,
  cash AS Cash, q AS Quarterly, months AS Months, r AS QuartersRaw, CASE WHEN turn <> 4 THEN done END AS Complete,
  CASE turn WHEN 1 THEN 'XBRL' WHEN 2 THEN 'XBRL,HTML' WHEN 4 THEN NULL WHEN 5 THEN '' ELSE 'HTML' END AS Tags FROM w
""")
def filing_runway(t: Tables) -> DataFrame:
    filings, sources = landed_sources(t)
    r = F.col("result")
    return resolution.runway_results(filings, sources).select(
        F.regexp_extract("URL", r"data/(\d+)/", 1).cast("bigint").alias("SupplierId"), "Form", "Source", r["status"].alias("Status"), r["cash_raw"].alias("Cash"),
        r["ocf_quarterly_raw"].alias("Quarterly"), r["period_months"].alias("Months"), r["runway_quarters_raw"].alias("QuartersRaw"),
        r["complete"].alias("Complete"), F.array_join(r["source_tags"], ",").alias("Tags"))


@query("company_runway", "v_filings", "v_profiles", sql=RESULT_SQL + """
SELECT p.cik AS CIK, coalesce(format('{:.2f}', CASE WHEN f.cik IS NOT NULL THEN f.cash ELSE r.cash END), '') AS RunwayCash,
  CASE WHEN f.cik IS NOT NULL THEN format('{:.6f}', f.cash / 800.0) ELSE '' END AS RunwayQuartersRaw,
  CASE WHEN f.cik IS NOT NULL THEN 'OK' WHEN r.cik IS NOT NULL THEN r.status ELSE coalesce(l.status, 'No eligible filing') END AS RunwayStatus,
  coalesce(f.link, r.link, i.link, '') AS RunwaySourceURL
FROM v_profiles p LEFT JOIN fin f ON f.cik = p.cik AND f.rn = 1 LEFT JOIN par r ON r.cik = p.cik AND r.rn = 1 AND f.cik IS NULL
  LEFT JOIN fir i ON i.cik = p.cik LEFT JOIN lst l ON l.cik = p.cik
""")
def company_runway(t: Tables) -> DataFrame:
    """Filings and their landed documents to one verdict per company; documents of decided companies stay unread."""
    f = t.filings().withColumn("URL", F.concat("URL", F.lit("?form="), "Form"))
    lit = F.lit
    cash = F.when(F.col("ord") % 3 == 0, "").otherwise(F.concat(
        lit("<tr><td>Cash and cash equivalents, end of period</td><td>"), _n((F.col("ord") % 50 + 1) * 1000), lit("</td></tr>")))
    flow = F.when(F.col("ord") % 5 == 0, "").otherwise("<tr><td>Net cash used in operating activities</td><td>(800)</td></tr>")
    html = F.concat(lit("<h2>Statements of Cash Flows</h2><p>Three months ended</p><table><tr><th></th><th>2024</th></tr>"), flow, cash, lit("</table>"))
    documents = f.where(F.col("ord") % 7 != 0).select("URL", html.alias("html"))
    results = resolution.first_results(f, resolution.Sources(documents=documents))
    return rw.extract_runway(t.profiles().select("Ticker", "CIK"), f, results, FILINGS_AS_OF, "ord").select(
        "CIK", "RunwayCash", "RunwayQuartersRaw", "RunwayStatus", "RunwaySourceURL")
