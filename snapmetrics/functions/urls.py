"""URL column functions (STR-7..14, STR-30, STR-32, FLT-2)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from snapmetrics.functions.common import as_col, nonempty


def host(c) -> Column:
    """STR-8 ``url_extract_host``; null on a malformed URL (``parse_url`` would raise)."""
    return F.try_parse_url(as_col(c), F.lit("HOST"))


def host_like(c, suffix: str) -> Column:
    """FLT-2: host ends with ``suffix``."""
    return host(c).endswith(suffix)


def domain(c) -> Column:
    """STR-9: registrable domain ``([\\w]+.bg)$`` of the host (the dot is unescaped, as in the reference)."""
    return nonempty(F.regexp_extract(host(c), r"([\w]+.bg)$", 1))


def site_of(c) -> Column:
    """STR-7: text between ``://`` and the next ``/``; null when absent."""
    return nonempty(F.regexp_extract(as_col(c), r".*://([^/]*)", 1))


def category(c) -> Column:
    """STR-10: first path segment after the host; null when absent."""
    return nonempty(F.regexp_extract(as_col(c), r"^[a-zA-Z][a-zA-Z0-9+.-]*://[^/]+/([^/?#]+)/", 1))


def link_id(c, pattern: str = r"([0-9]+)/?(?:[?#].*)?$") -> Column:
    """STR-11: trailing id of a link by rule; null when absent."""
    return nonempty(F.regexp_extract(as_col(c), pattern, 1))


def clean_url(c, twice: bool = False) -> Column:
    """STR-12: percent-decode (``+`` shielded from form decoding) and drop the query string."""
    s = F.replace(as_col(c), F.lit("+"), F.lit("%2B"))
    s = F.try_url_decode(s)
    if twice:
        s = F.try_url_decode(F.replace(s, F.lit("+"), F.lit("%2B")))
    return F.regexp_replace(s, r"\?.*", "")


def query_value(c, key: str) -> Column:
    """STR-13: value of a query parameter with ``+`` read as a space."""
    return F.replace(F.try_parse_url(as_col(c), F.lit("QUERY"), F.lit(key)), F.lit("+"), F.lit(" "))


def absolute_url(base: str | Column, href) -> Column:
    """STR-32: base (a text or a column, without its last slash) + path for site-relative links; absolute links pass."""
    h = as_col(href)
    root = base if isinstance(base, Column) else F.lit(base.rstrip("/"))
    return F.when(h.startswith("/"), F.concat(root, h)).otherwise(h)


def basename(c) -> Column:
    """STR-30: last path segment of a link."""
    return F.substring_index(as_col(c), "/", -1)


def embedded_url_pattern(prefix: str, end: str = '",') -> str:
    return "(\\Q" + prefix + "\\E.*?)\\Q" + end + "\\E"


def embedded_urls(c, prefix: str, end: str = '",') -> Column:
    """STR-14: every URL starting with ``prefix`` up to the ``end`` marker inside a text blob."""
    return F.regexp_extract_all(as_col(c), F.lit(embedded_url_pattern(prefix, end)), 1)
