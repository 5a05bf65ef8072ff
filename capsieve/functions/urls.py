"""Filing links: canonical forms, accession numbers, form/link consistency."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from capsieve import rules as R
from capsieve.functions.forms import form_in_text, form_key
from capsieve.functions.text import empty, any_of, col, once, strip, zero_fill

SEC = "https://www.sec.gov"
ARCHIVE = "/archives/edgar/data/"


def host(url: Column) -> Column:
    return F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1))


def path(url: Column) -> Column:
    """Path of an absolute link, or of the text itself when it has no scheme."""
    return F.regexp_extract(url, r"^(?:[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)?([^?#]*)", 1)


def query(url: Column) -> Column:
    return F.regexp_extract(url, r"^[^?#]*\?([^#]*)", 1)


def query_value(url: Column, key: str) -> Column:
    """Decoded first value of a query parameter, '' when absent."""
    raw = F.regexp_extract(query(url), f"(?:^|&){key}=([^&]*)", 1)
    return F.coalesce(F.try_url_decode(raw), empty())


def query_values(url: Column) -> Column:
    """All decoded query values joined by blanks."""
    raw = F.regexp_extract_all(query(url), F.lit("=([^&]+)"), F.lit(1))
    return F.array_join(F.transform(raw, lambda v: F.coalesce(F.try_url_decode(v), empty())), " ")


def is_sec(url: Column) -> Column:
    return host(url).endswith("sec.gov")


def sec_url(c: Column | str) -> Column:
    """Canonical filing link: https + www, viewer links unwrapped, archive pages wrapped."""
    url = strip(F.coalesce(col(c), empty()))
    url = F.regexp_replace(url, "^http://", "https://")
    url = F.regexp_replace(url, "(?i)^https://sec\\.gov", SEC)
    return once(url, lambda u: once(F.lower(u), lambda low: _canonical(u, low)))


def _canonical(url: Column, low: Column) -> Column:
    viewer = is_sec(url) & F.lower(path(url)).isin("/ix", "/ixviewer", "/cgi-bin/viewer", "/viewer")
    docs = [query_value(url, k) for k in ("doc", "filename", "file", "source", "href")]
    doc = F.coalesce(*[once(d, lambda v: F.when(F.lower(v).contains(ARCHIVE), path(v))) for d in docs])
    relative = F.regexp_replace(url, "^/+", "")
    page = (
        low.startswith("https://www.sec.gov/archives/") & low.rlike(r"\.(htm|html|xhtml)$")
        & ~low.rlike(r"-index\.(htm|html|xhtml)$")
    )
    return (
        F.when(viewer, once(doc, lambda d: F.when(d.startswith("/"), F.concat(F.lit(SEC), d)).otherwise(
            F.coalesce(F.concat(F.lit(SEC + "/"), d), url))))
        .when(low.rlike("^/?archives/"), F.concat(F.lit(SEC + "/ix?doc=/"), relative))
        .when(page, F.concat(F.lit(SEC + "/ix?doc="), F.substring(url, len(SEC) + 1, 1 << 30)))
        .otherwise(url)
    )


def viewer_document(c: Column | str) -> Column:
    """Link of the document shown by a viewer link; other links unchanged."""
    def shown(url: Column) -> Column:
        site = F.regexp_extract(url, r"^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)", 1)
        doc = once(F.regexp_replace(strip(query_value(url, "doc")), "#.*$", ""), lambda d: F.when(d == "", url).when(d.contains("://"), d).otherwise(
            F.concat(site, F.lit("/"), F.regexp_replace(d, "^/+", ""))))
        return F.when(is_sec(url) & F.lower(path(url)).rlike("^(/ix|/cgi-bin/viewer)"), doc).otherwise(url)

    return once(F.coalesce(col(c), empty()), shown)


def with_scheme(c: Column | str) -> Column:
    """Give scheme-less filing links an explicit one."""
    url = strip(F.coalesce(col(c), empty()))
    return (
        F.when((url == "") | url.contains("://"), url)
        .when(url.startswith("//"), F.concat(F.lit("https:"), url))
        .when(url.startswith("/"), F.concat(F.lit(SEC), url))
        .otherwise(F.concat(F.lit("https://"), url))
    )


def accession_text(digits: Column) -> Column:
    """18 digits as 10-2-6 with dashes; '' for no digits."""
    def dashed(full: Column) -> Column:
        return F.concat_ws("-", F.substring(full, 1, 10), F.substring(full, 11, 2), F.substring(full, 13, 1 << 20))

    return once(F.regexp_replace(digits, "[^0-9]", ""), lambda bare: F.when(bare == "", empty()).otherwise(once(zero_fill(bare, 18), dashed)))


_DATA_PATH = r"(?i)/data/(\d{1,10})/([\w-]+)/"
_BARE = r"(\d{10})[-_]?(\d{2})[-_]?(\d{6})"


def filing_ids(c: Column | str) -> Column:
    """``struct(cik, accession)`` named by a filing link; '' where not found."""
    def ids(url: Column) -> Column:
        bare = [F.regexp_extract(url, _BARE, i) for i in (1, 2, 3)]
        return once(F.regexp_extract(url, _DATA_PATH, 1), lambda cik_path: F.struct(
            F.when(cik_path != "", zero_fill(cik_path, 10)).otherwise(bare[0]).alias("cik"),
            accession_text(F.when(cik_path != "", F.regexp_extract(url, _DATA_PATH, 2)).otherwise(F.concat(*bare))).alias("accession")))

    return once(F.coalesce(col(c), empty()), ids)


def accession_token(c: Column | str) -> Column:
    """Folder of an archive link in lower case; '' when the link is not one."""
    return F.lower(F.regexp_extract(F.coalesce(col(c), empty()), r"(?i)/edgar/data/\d+/([^/?#]+)/", 1))


_DOC_VALUES = r"(?:^|&)(?:doc|filename|file|document)=([^&]+)"
_KNOWN_KEY = "^(?:" + "|".join(prefix for prefix, _ in R.FORM_URL_PATTERNS) + ")"
_OWN_LINK = "^(?:" + "|".join(f"{prefix}[a-z0-9]* .*{pattern}" for prefix, pattern in R.FORM_URL_PATTERNS) + ")"
_ANY_LINK = "|".join(pattern for _, pattern in R.FORM_URL_PATTERNS)


def url_matches_form(form: Column | str, url: Column | str) -> Column:
    """Does the link fit the form? Unknown forms and blanks count as fitting.

    A link that names its form fits, one that names another form does not, and
    any other link fits when it is an archive or viewer link.
    """
    def known(key: Column, link: Column) -> Column:
        docs = F.transform(F.regexp_extract_all(query(link), F.lit(_DOC_VALUES), F.lit(1)), lambda v: F.coalesce(F.try_url_decode(v), empty()))
        whole = F.lower(F.when(link.contains("?"), F.concat_ws(" ", link, F.array_join(docs, " "))).otherwise(link))
        return F.when((link == "") | ~key.rlike(_KNOWN_KEY), True).otherwise(once(whole, lambda text: fits(key, link, text)))

    def fits(key: Column, link: Column, text: Column) -> Column:
        archive = is_sec(link) & (text.contains(ARCHIVE) | F.lower(path(link)).rlike("^(/ix|/cgi-bin/ix|/cgi-bin/viewer)"))
        return F.when(F.concat_ws(" ", key, text).rlike(_OWN_LINK), True).when(text.rlike(_ANY_LINK), False).otherwise(archive)

    return once(form_key(form), lambda key: once(F.coalesce(col(url), empty()), lambda link: known(key, link)))


def url_names_form(form: Column | str, url: Column | str) -> Column:
    """Stricter check of the runway step: the link names the form or is a viewer link."""
    link = F.coalesce(col(url), empty())
    text = F.replace(F.upper(F.concat_ws(" ", path(link), query_values(link))), F.lit("-"), F.lit(""))
    viewer = is_sec(link) & F.lower(path(link)).rlike("^(/ix|/cgi-bin/viewer)")
    return once(form_in_text(form), lambda name: F.when(name.isNull(), False).otherwise(
        F.contains(text, F.replace(name, F.lit("-"), F.lit(""))) | viewer))


def form_from_url(c: Column | str) -> Column:
    """Form named by a link: the ``form`` parameter first, then path and other parameters."""
    url = F.coalesce(col(c), empty())
    hint = form_in_text(F.regexp_extract(query(url), "(?i)(?:^|&)form=([^&]*)", 1))
    return F.coalesce(hint, form_in_text(F.concat_ws(" ", path(url), query_values(url))))


def is_image(c: Column | str) -> Column:
    return any_of(F.lower(path(F.coalesce(col(c), empty()))).endswith(s) for s in R.IMAGE_SUFFIXES)


def is_primary_source(url: Column) -> Column:
    """Regulator or local-file link, as opposed to a secondary source."""
    low = F.lower(url)
    return low.startswith("file://") | low.contains("sec.gov") | low.contains("edgar")
