"""Text normalisation as Column expressions."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from capsieve import rules as R

def empty() -> Column:
    return F.lit("")


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def once(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed a single time, however often it is used.

    Inside lambdas nothing is shared between the places that name an expression; a lambda variable is.
    """
    return F.element_at(F.transform(F.array(value), use), 1)


def any_of(conditions: Iterable[Column]) -> Column:
    """OR of the conditions; false when there are none."""
    return reduce(lambda a, b: a | b, conditions, F.lit(False))


def quote(word: str) -> str:
    """Literal text inside a regular expression."""
    return "".join(ch if ch.isalnum() or ch in " _" or not ch.isascii() else "\\" + ch for ch in word)


def contains_any(text: Column, words: Sequence[str]) -> Column:
    """Does the text contain one of the words? One pattern, however many words there are."""
    return text.rlike("|".join(quote(w) for w in words)) if words else F.lit(False)


def starts_any(text: Column, prefixes: Sequence[str]) -> Column:
    return text.rlike("^(?:" + "|".join(quote(p) for p in prefixes) + ")") if prefixes else F.lit(False)


def string_array(values: Sequence[str]) -> Column:
    """Constant array of texts (folded to a literal by the optimizer)."""
    return F.split(F.lit("\x01".join(values)), "\x01")


WHITE = " \t\n\r\f\x0b\u00a0"


def strip(c: Column | str) -> Column:
    """Trim all white space (not only blanks) on both sides."""
    return F.btrim(col(c), F.lit(WHITE))


def squeeze(c: Column | str) -> Column:
    return F.trim(F.regexp_replace(col(c), r"[\s\u00A0]+", " "))


def blank_to_null(c: Column | str) -> Column:
    """Blank text becomes null; other text is returned as it is."""
    c = col(c)
    return F.when(strip(c) != "", c)


def first_nonblank(*cols: Column | str) -> Column:
    """First column whose text is neither null nor blank, else ''."""
    return F.coalesce(*[blank_to_null(c) for c in cols], empty())


def upper_key(c: Column | str) -> Column:
    """Trimmed upper-case text, '' for null."""
    return F.upper(strip(F.coalesce(col(c), empty())))


def ticker(c: Column | str, drop_us_suffix: bool = False) -> Column:
    text = upper_key(c)
    return F.regexp_replace(text, r"\.US$", "") if drop_us_suffix else text


def zero_fill(c: Column, width: int) -> Column:
    """Left-fill with zeros without ever shortening the value."""
    return F.when(F.length(c) < width, F.lpad(c, width, "0")).otherwise(c)


def cik(c: Column | str) -> Column:
    """Ten-digit key from the digits of the value; '' when it has none."""
    digits = F.regexp_replace(F.coalesce(col(c).cast("string"), empty()), "[^0-9]", "")
    return F.when(digits == "", empty()).otherwise(zero_fill(digits, 10))


def cik_keep_missing(c: Column | str) -> Column:
    """Drop a trailing '.0' and zero-fill; blank stays null."""
    text = F.regexp_replace(strip(col(c).cast("string")), r"\.0+$", "")
    return F.when(text != "", zero_fill(text, 10))


def cik_raw(c: Column | str) -> Column:
    """Zero-fill the trimmed text as it is; '' for null or blank."""
    text = strip(F.coalesce(col(c).cast("string"), empty()))
    return F.when(text == "", empty()).otherwise(zero_fill(text, 10))


def lookup(c: Column, mapping: dict[str, object], default: Column | None = None) -> Column:
    """Literal map lookup that stays inside one expression."""
    pairs = [F.lit(x) for item in mapping.items() for x in item]
    found = F.try_element_at(F.create_map(*pairs), c)
    return found if default is None else F.coalesce(found, default)


def exchange(c: Column | str) -> Column:
    name = upper_key(c)
    return lookup(name, R.EXCHANGE_ALIASES, name)


def country(c: Column | str) -> Column:
    return upper_key(c)


def is_us(c: Column | str) -> Column:
    name = country(c)
    return (name == "") | name.isin(*R.US_COUNTRIES)


def description(*fields: Column) -> Column:
    """First non-blank field with white space squeezed; a 120-character summary column."""
    texts = [F.when(squeeze(f) != "", squeeze(f)) for f in fields]
    return F.substring(F.coalesce(*texts, empty()), 1, 120)


def clean_text(c: Column | str, null_words: Sequence[str] = ("nan", "none", "null")) -> Column:
    """Unix line ends, trimmed; null and null-like words become ''."""
    text = strip(F.regexp_replace(F.coalesce(col(c).cast("string"), empty()), "\r\n?", "\n"))
    return F.when(F.lower(text).isin(*null_words), empty()).otherwise(text)


def detail_text(c: Column | str, width: int = 160) -> Column:
    """Squeezed detail note, shortened with an ellipsis; null when blank or 'nan'."""
    text = squeeze(col(c).cast("string"))
    short = F.when(F.length(text) > width, F.concat(F.substring(text, 1, width - 3), F.lit("...")))
    return F.when((text != "") & (F.lower(text) != "nan"), F.coalesce(short, text))


def to_bool(c: Column | str) -> Column:
    return F.coalesce(F.lower(strip(col(c).cast("string"))).isin("1", "true", "yes", "y", "t"), F.lit(False))


def to_number(c: Column | str) -> Column:
    """Plain number with optional thousands commas, else null."""
    return F.expr("double(null)") if c is None else (
        F.regexp_replace(strip(col(c).cast("string")), ",", "").try_cast("double"))


def split_evidence(c: Column | str, null_word: bool = True) -> Column:
    """Evidence cell -> trimmed entries in order (separators ';' and line ends)."""
    parts = F.transform(F.split(clean_text(c), r"[;\r\n]+"), strip)
    if null_word:
        return F.filter(parts, lambda x: (x != "") & (F.lower(x) != "nan"))
    return F.filter(parts, lambda x: x != "")


def join_distinct(entries: Column, separator: str = ";") -> Column:
    """First-seen distinct entries joined into a cell."""
    return F.array_join(F.array_distinct(F.filter(entries, lambda x: x.isNotNull() & (x != ""))), separator)


def urls_in(c: Column | str) -> Column:
    """All distinct links of a text in order of appearance."""
    return F.array_distinct(F.regexp_extract_all(F.coalesce(col(c), empty()), F.lit(r"(https?://\S+)"), F.lit(1)))


def first_url(c: Column | str) -> Column:
    return F.regexp_extract(F.coalesce(col(c), empty()), r"(https?://\S+)", 1)


def url_key(c: Column | str) -> Column:
    """Link without trailing punctuation, as used for matching."""
    return F.regexp_replace(strip(F.coalesce(col(c), empty())), r"[;.,]+$", "")


def strip_tags(c: Column | str) -> Column:
    return squeeze(F.regexp_replace(F.coalesce(col(c), empty()), r"<[^>]+>", " "))


# The HTML entities that occur in filings.
_ENTITIES = (
    ("&nbsp;", " "), ("&#160;", " "), ("&#xa0;", " "), ("&lt;", "<"), ("&gt;", ">"),
    ("&quot;", '"'), ("&#34;", '"'), ("&apos;", "'"), ("&#39;", "'"), ("&rsquo;", "’"),
    ("&#8217;", "’"), ("&lsquo;", "‘"), ("&#8216;", "‘"), ("&ldquo;", "“"),
    ("&#8220;", "“"), ("&rdquo;", "”"), ("&#8221;", "”"), ("&ndash;", "–"),
    ("&#8211;", "–"), ("&mdash;", "—"), ("&#8212;", "—"), ("&minus;", "−"),
    ("&#8722;", "−"), ("&euro;", "€"), ("&pound;", "£"), ("&yen;", "¥"),
    ("&#36;", "$"), ("&#38;", "&"), ("&amp;", "&"),
)


def unescape_entities(c: Column | str) -> Column:
    """Decode the entities above; '&amp;' last so nothing is decoded twice."""
    text = col(c)
    return F.when(F.contains(text, F.lit("&")), reduce(lambda acc, e: F.replace(acc, F.lit(e[0]), F.lit(e[1])), _ENTITIES, text)).otherwise(text)


def match_form(c: Column | str) -> Column:
    """Fold dashes and white space so captions compare equal."""
    text = F.translate(col(c), "\u00a0", " ")
    text = F.regexp_replace(text, r"[\u2010-\u2015]", "-")
    return F.regexp_replace(F.regexp_replace(text, r"-\s*/\s*-", "-"), r"\s+", " ")


def match_form_literal(text: str) -> str:
    """Driver-side twin of :func:`match_form` for the caption constants."""
    for dash in "\u2010\u2011\u2012\u2013\u2014\u2015":
        text = text.replace(dash, "-")
    return " ".join(text.replace("\u00a0", " ").split())


def resolve_column(columns: Sequence[str], candidates: Sequence[str]) -> str | None:
    """Pick a column by name, ignoring case and punctuation (driver side, schema only)."""
    def squash(name: str) -> str:
        return "".join(ch for ch in name.lower() if ch.isascii() and ch.isalnum())

    by_key = {squash(name): name for name in columns}
    return next((by_key[squash(c)] for c in candidates if squash(c) in by_key), None)
