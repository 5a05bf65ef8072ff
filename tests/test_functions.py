from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from capsieve.functions import dates, forms, numbers, text, urls
from capsieve.operators import statements

QUICK = settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


def values(spark, inputs, expr):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(inputs)], "i int, v string")
    return [r[0] for r in df.orderBy("i").select(expr(F.col("v"))).collect()]


def test_numbers(spark):
    cases = {
        "(9,390,622)": -9390622.0, "US$ 5,000": 5000.0, "$(3,000,000)": -3000000.0, "1.234,56": 1234.56, "1,234.56": 1234.56,
        "1,5": 1.5, "1'234'567": 1234567.0, "(US$ 12.5)": -12.5, "−45": -45.0, "-7": -7.0, "abc": None, "12,3456": 123456.0,
        "1 234 567": 1234567.0, "5,": 5.0, "[7]": 7.0, "1.234": 1234.0, "1,234,567.8": 1234567.8, "12.5": 12.5, "EUR 1.234.567": 1234567.0,
    }
    assert values(spark, list(cases), numbers.parse_number) == list(cases.values())


@QUICK
@given(st.lists(st.integers(-10**12, 10**12), min_size=1, max_size=30))
def test_numbers_round_trip(spark, ns):
    printed = [f"({abs(n):,})" if n < 0 else f"{n:,}" for n in ns]
    assert values(spark, printed, numbers.parse_number) == [float(n) for n in ns]


def test_cik_variants(spark):
    assert values(spark, ["CIK 12", "", None, "12345678901"], text.cik) == ["0000000012", "", "", "12345678901"]
    assert values(spark, ["12.0", " ", None], text.cik_keep_missing) == ["0000000012", None, None]
    assert values(spark, ["7", ""], text.cik_raw) == ["0000000007", ""]


@QUICK
@given(st.lists(st.text(alphabet="ab ;\n", max_size=12), min_size=1, max_size=20))
def test_evidence_split(spark, cells):
    def plain(cell):
        parts = [p.strip() for p in cell.replace("\n", ";").split(";")]
        return list(dict.fromkeys(p for p in parts if p))

    got = values(spark, cells, lambda c: F.array_distinct(text.split_evidence(c)))
    assert got == [plain(c) for c in cells]


def test_forms(spark):
    assert values(spark, ["https://x/form6xk09x11x2025.htm", "FORM 10-Q", "10-KT/A", "DEF 14A", "none"], forms.form_in_text) == [
        "6-K", "10-Q", "10-K", "DEF 14A", None]
    assert values(spark, ["10-QT/A", "20-F/A", "S-3"], forms.canonical_form) == ["10-Q", "20-F", "S-3"]
    assert values(spark, ["424B5", "DEFA14A", "DEFM14", "FORM4", "4", "", "weird"], forms.progress_form) == [
        "424B", "DEF 14A", "DEF 14A", "FORM 4", "FORM 4", "Unknown", "WEIRD"]
    assert values(spark, ["FORM 10-K / A", "nan", "SC 13G"], forms.form_key) == ["10k", "", "sc13g"]


def test_links(spark):
    ids = values(spark, ["https://www.sec.gov/ix?doc=/Archives/edgar/data/1234567/0001234567-23-000999.htm"], urls.filing_ids)[0]
    assert (ids["cik"], ids["accession"]) == ("0001234567", "0001234567-23-000999")
    links = ["http://sec.gov/Archives/edgar/data/1/2/d.htm", "https://www.sec.gov/ix?doc=/Archives/edgar/data/1/2/d.htm",
             "Archives/edgar/data/1/2/d.htm", "https://www.sec.gov/Archives/edgar/data/1/2/x-index.htm", "https://x.org/a"]
    wrapped = "https://www.sec.gov/ix?doc=/Archives/edgar/data/1/2/d.htm"
    assert values(spark, links, urls.sec_url) == [
        wrapped, "https://www.sec.gov/Archives/edgar/data/1/2/d.htm", wrapped, links[3], links[4]]
    fits = values(spark, ["https://www.sec.gov/Archives/edgar/data/1/a/form10-q.htm", "https://www.sec.gov/Archives/edgar/data/1/a/doc.htm",
                          "https://www.sec.gov/Archives/edgar/data/1/a/d10k.htm", "https://example.com/x.htm"],
                  lambda c: urls.url_matches_form(F.lit("10-Q"), c))
    assert fits == [True, True, False, False]


def test_dates(spark):
    got = values(spark, ["2024-01-02", "2024-01-02 03:04:05", "3/4/2024", "x", None, "2024-13-40"], lambda c: dates.parse_date(c).cast("string"))
    assert got == ["2024-01-02", "2024-01-02", "2024-04-03", None, None, None]


def test_column_resolver():
    assert text.resolve_column(["cik", "Market_Cap"], ["MarketCap"]) == "Market_Cap"
    assert text.resolve_column(["cik"], ["Price"]) is None


def test_empty_lists_match_nothing(spark):
    from capsieve.functions import text
    row = spark.range(1).select(text.contains_any(F.lit("x"), ()).alias("a"), text.starts_any(F.lit("x"), ()).alias("b")).first()
    assert (row.a, row.b) == (False, False)


def test_number_patterns_run_once(spark):
    """Inside lambdas every mention of an expression is computed, so each pattern may be named a single time."""
    rows = spark.createDataFrame([("(1,234.5)",), ("no digit",), (None,), ("−7",), ("1.234,5 EUR",)], "t string")
    found = rows.select(numbers.parse_number("t").alias("v"))
    plan = found._jdf.queryExecution().analyzed().toString()
    assert plan.count(numbers._NUMBER) == 1 and plan.count(numbers._MINUS) == 1
    assert [r.v for r in found.collect()] == [-1234.5, None, None, -7.0, 1234.5]


def test_captions_after_the_first_number_are_not_read(spark):
    text = F.concat(F.lit("Net cash used in operating activities 5,000 net cash provided by operating activities "), F.col("id").cast("string"), F.lit(",000"))
    out = spark.range(2).select(statements.caption_number(text, ["net cash provided by operating activities", "net cash used in operating activities"]).alias("v"),
                                statements.caption_number(F.lit("cash held: none. total cash 1,200"), ["cash held", "total cash"]).alias("w"))
    assert [r.v for r in out.collect()] == [0.0, 1000.0] and out.collect()[0].w == 1200.0
    assert out._jdf.queryExecution().analyzed().toString().count(numbers._NUMBER) == 2
