"""Stored raw pages and documents (PIPE-27..31): extraction jobs over a table of pages, one pass per page.

All rules are native regex / array expressions in one projection over the scan — a narrow stage that scales with
the number of pages; only the distinct-link step shuffles.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snapmetrics.functions.text import attribute_value, class_text, clean_text, paragraphs, strip_noise, tag_text
from snapmetrics.functions.urls import absolute_url, category, embedded_urls, host, query_value
from snapmetrics.sources.io import ARTICLE_COLUMNS, conform
from snapmetrics.sources.tables import table

# A link is the href of an anchor, in any position and either quote.
HREF = r"""<a\s(?:[^>]*?\s)?href\s*=\s*["']([^"'>]*)["']"""
# Keyword list for document search (FLT-14).
KEYWORDS = ["the", "que", "und", "ion", "Eauouon."]
VISIT_STAMP = "2024-01-01 10:00:00"


@dataclass(frozen=True)
class LinkRules:
    """FLT-17: which hrefs of a page are followed. Every rule is off by default."""

    prefix: str | None = None
    suffix: str | None = None
    pattern: str | None = None
    without: tuple[str, ...] = ()

    def keep(self, href: Column) -> Column:
        """An empty href is no link."""
        cond = F.length(href) > 0
        if self.prefix is not None:
            cond = cond & href.startswith(self.prefix)
        if self.suffix is not None:
            cond = cond & href.endswith(self.suffix)
        if self.pattern is not None:
            cond = cond & href.rlike(self.pattern)
        for s in self.without:
            cond = cond & ~href.contains(s)
        return cond


def site_root(url) -> F.Column:
    return F.concat(F.try_parse_url(url, F.lit("PROTOCOL")), F.lit("://"), host(url))


def _links(pages: DataFrame, rules: LinkRules, *more: Column) -> DataFrame:
    """One row per followed href: site, resolved link and the ``more`` columns."""
    links = pages.select(
        host("url").alias("site"), site_root(F.col("url")).alias("root"), *more,
        F.explode(F.regexp_extract_all(strip_noise("html"), F.lit(HREF), 1)).alias("href"),
    )
    return links.filter(rules.keep(F.col("href"))).withColumn("link", absolute_url(F.col("root"), "href")).drop("root", "href")


def page_outlinks(pages: DataFrame, rules: LinkRules = LinkRules()) -> DataFrame:  # noqa: B008
    """PIPE-27 (HTM-2, FLT-17, STR-32, AG-11): distinct resolved outgoing links per site."""
    return _links(pages, rules).distinct()


def page_articles(pages: DataFrame, without: list[str] | None = None) -> DataFrame:
    """PIPE-28 (HTM-1, STR-1, STR-10, AG-13, FLT-15): title, headline, lead, text and paragraph count per page; paragraphs
    that hold one of the phrases ``without`` are left out (FLT-16)."""
    p = pages.select("page_id", "url", strip_noise("html").alias("h"))
    p = p.withColumn("pars", paragraphs(F.col("h"), without))
    out = p.select(
        "page_id",
        "url",
        host("url").alias("site"),
        category("url").alias("category"),
        tag_text("h", "title").alias("title"),
        tag_text("h", "h1").alias("headline"),
        F.try_element_at("pars", F.lit(1)).alias("lead"),
        F.size("pars").alias("n_paragraphs"),
        F.array_join("pars", "\n").alias("article_text"),
    )
    return out.filter(F.col("headline").isNotNull())


def unified_articles(pages: DataFrame, stamp: str = VISIT_STAMP) -> DataFrame:
    """PIPE-29 (PRJ-1,2,5, SET-2): two per-source layouts (``.com`` sites put headline/lead/category into
    title/subtitle/section; the others title/category) renamed, conformed to the 16 snapshot columns and stamped
    with the site and the visit time. One pass: the layout is chosen per row, not by filtering and unioning."""
    a = page_articles(pages)
    com = F.col("site").endswith(".com")
    layout = a.select(
        F.when(com, F.col("headline")).otherwise(F.col("title")).alias("title"),
        F.when(com, F.col("lead")).alias("subtitle"),
        "article_text",
        F.when(com, F.col("category")).alias("section"),
        F.when(~com, F.col("category")).alias("category"),
        F.col("url").alias("link"),
        "site",
    )
    return conform(layout, ARTICLE_COLUMNS + ["site"]).withColumn("visited_timestamp", F.lit(stamp))


def poi_extract(pages: DataFrame, key: str = "ref") -> DataFrame:
    """PIPE-31 (STR-13, STR-14, HTM-1): POI name, the page's link, the value it carries under ``key`` and the URLs embedded
    in the page."""
    urls = embedded_urls("html", 'href="/', '"')
    return pages.select(
        "page_id", tag_text(strip_noise("html"), "title").alias("name"), F.col("url").alias("link"),
        query_value("url", key).alias("address_from_link"), F.array_join(urls, " ").alias("embedded"), F.size(urls).alias("n_links"),
    )


#: Rules of ``page_fields``: column -> (kind, what it looks for).
FIELD_RULES = {
    "lang": ("attribute", ("html", "lang")), "charset": ("attribute", ("meta", "charset")), "first_href": ("attribute", ("a", "href")),
    "first_item": ("tag", "li"), "notice": ("class", "ad"), "footer": ("tag", "footer"),
}


def page_fields(pages: DataFrame, rules: dict | None = None) -> DataFrame:
    """HTM-1: fields by rule - text of a tag, text of the first element of a class, value of a tag's attribute."""
    p = pages.select("page_id", strip_noise("html").alias("h"))
    read = {"tag": lambda x: tag_text("h", x), "class": lambda x: class_text("h", x), "attribute": lambda x: attribute_value("h", *x)}
    return p.select("page_id", *[read[kind](what).alias(name) for name, (kind, what) in (rules or FIELD_RULES).items()])


def document_keyword_hits(docs: DataFrame, terms: list[str] = KEYWORDS) -> DataFrame:
    """PIPE-30 (STR-1, FLT-14): per document and term, paragraphs containing the term and paragraphs equal to it
    (the reference's list-membership quirk); whole texts, every paragraph."""
    d = docs.select("doc_id", F.transform(F.split("text", "\n"), lambda p: clean_text(p)).alias("pars"))
    # One struct per term computed over the paragraph array in place; only the small structs are exploded, so a
    # long text is never copied once per term.
    hits = F.transform(
        F.array(*[F.lit(t) for t in terms]),
        lambda t: F.struct(
            t.alias("term"),
            F.size(F.filter("pars", lambda p: F.instr(p, t) > 0)).alias("hits_contains"),
            F.size(F.filter("pars", lambda p: p == t)).alias("hits_equal"),
        ),
    )
    out = d.select("doc_id", F.explode(hits).alias("h")).select("doc_id", "h.*")
    return out.filter(F.col("hits_contains") > 0)


QUERIES = {
    "page_outlinks": lambda spark, d: page_outlinks(table(spark, d, "pages")),
    "page_articles": lambda spark, d: page_articles(table(spark, d, "pages")),
    "unified_articles": lambda spark, d: unified_articles(table(spark, d, "pages")),
    "poi_extract": lambda spark, d: poi_extract(table(spark, d, "pages")),
    "page_fields": lambda spark, d: page_fields(table(spark, d, "pages")),
    "document_keyword_hits": lambda spark, d: document_keyword_hits(table(spark, d, "documents")),
}

_NOISE = r"regexp_replace(html, '(?s)<script.*?</script>|<style.*?</style>|<!--.*?-->', '', 'g')"
_HOST = r"regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/:?#]+)', 1)"


def _clean_sql(x: str) -> str:
    s = x
    for a in ["\n", "\r", "\t", " "]:
        s = f"replace({s}, chr({ord(a)}), ' ')"
    s = f"replace(replace(replace({s}, '\"', ''''), '„', ''''), '“', '''')"
    s = f"replace(replace({s}, '\\xa0', ' '), '&nbsp;', ' ')"
    return f"regexp_replace({s}, '^[\\s ]+|[\\s ]+$', '', 'g')"


def _tag_sql(h: str, tag: str) -> str:
    inner = f"regexp_replace(regexp_extract({h}, '(?s)<{tag}(?:\\s[^>]*)?>(.*?)</{tag}>', 1), '<[^>]*>', '', 'g')"
    return f"nullif({_clean_sql(inner)}, '')"


_PARS = (
    "list_filter(list_transform(regexp_split_to_array(h, '<p(?:\\s[^>]*)?>')[2:], lambda p: "
    + _clean_sql("regexp_replace(split_part(split_part(p, '</p>', 1), '</article>', 1), '<[^>]*>', '', 'g')")
    + "), lambda t: length(t) > 0)"
)

_ARTICLES = f"""
art AS (
  SELECT page_id, url, {_HOST} AS site,
    nullif(regexp_extract(url, '^[a-zA-Z][a-zA-Z0-9+.-]*://[^/]+/([^/?#]+)/', 1), '') AS category,
    {_tag_sql('h', 'title')} AS title, {_tag_sql('h', 'h1')} AS headline, pars
  FROM (SELECT page_id, url, h, {_PARS} AS pars FROM (SELECT page_id, url, {_NOISE} AS h FROM pages) a) b
)"""

ORACLE = {
    "page_outlinks": f"""
SELECT DISTINCT site, CASE WHEN href[1] = '/' THEN root || href ELSE href END AS link FROM (
  SELECT {_HOST} AS site, regexp_extract(url, '^([A-Za-z][A-Za-z0-9+.-]*)://', 1) || '://' || {_HOST} AS root,
    unnest(list_transform(string_split({_NOISE}, '<a href="')[2:], lambda x: split_part(x, '"', 1))) AS href
  FROM pages
) l WHERE href <> ''""",
    "page_articles": f"""
WITH {_ARTICLES}
SELECT page_id, url, site, category, title, headline, pars[1] AS lead, CAST(len(pars) AS INTEGER) AS n_paragraphs,
  array_to_string(pars, chr(10)) AS article_text
FROM art WHERE headline IS NOT NULL""",
    "unified_articles": f"""
WITH {_ARTICLES}
SELECT CAST(NULL AS VARCHAR) AS comments, CAST(NULL AS VARCHAR) AS views, CAST(NULL AS VARCHAR) AS shares, CAST(NULL AS VARCHAR) AS created_timestamp,
  '{VISIT_STAMP}' AS visited_timestamp, CAST(NULL AS VARCHAR) AS tags, category AS section, headline AS title, pars[1] AS subtitle,
  CAST(NULL AS VARCHAR) AS category, url AS link, array_to_string(pars, chr(10)) AS article_text, CAST(NULL AS VARCHAR) AS author,
  CAST(NULL AS VARCHAR) AS thumbs_down, CAST(NULL AS VARCHAR) AS thumbs_up, CAST(NULL AS VARCHAR) AS location, site
FROM art WHERE headline IS NOT NULL AND site LIKE '%.com'
UNION ALL
SELECT CAST(NULL AS VARCHAR), CAST(NULL AS VARCHAR), CAST(NULL AS VARCHAR), CAST(NULL AS VARCHAR), '{VISIT_STAMP}', NULL, NULL, title, NULL, category, url,
  array_to_string(pars, chr(10)), NULL, NULL, NULL, NULL, site
FROM art WHERE headline IS NOT NULL AND NOT site LIKE '%.com'""",
    "poi_extract": f"""
SELECT page_id, {_tag_sql(_NOISE, 'title')} AS name, url AS link,
  array_to_string(regexp_extract_all(html, '(href="/.*?)"', 1), ' ') AS embedded,
  CAST(len(regexp_extract_all(html, '(href="/.*?)"', 1)) AS INTEGER) AS n_links,
  replace(nullif(regexp_extract(url, '[?&]ref=([^&#]*)', 1), ''), '+', ' ') AS address_from_link
FROM pages""",
    "page_fields": f"""
SELECT page_id, nullif(regexp_extract(h, '<html lang="([^"]*)"', 1), '') AS lang, nullif(regexp_extract(h, '<meta charset="([^"]*)"', 1), '') AS charset,
  nullif(regexp_extract(h, '<a href="([^"]*)"', 1), '') AS first_href, {_tag_sql('h', 'li')} AS first_item,
  nullif({_clean_sql("regexp_replace(regexp_extract(h, '(?s)<div class=" + chr(34) + "ad" + chr(34) + ">(.*?)</div>', 1), '<[^>]*>', '', 'g')")}, '') AS notice,
  {_tag_sql('h', 'footer')} AS footer
FROM (SELECT page_id, {_NOISE} AS h FROM pages) p""",
    "document_keyword_hits": f"""
WITH pars AS (
  SELECT doc_id, {_clean_sql('p')} AS p FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS p FROM documents) s
), terms AS (SELECT unnest([{', '.join(repr(t) for t in KEYWORDS)}]) AS term)
SELECT doc_id, term, CAST(count(*) FILTER (WHERE instr(p, term) > 0) AS INTEGER) AS hits_contains,
  CAST(count(*) FILTER (WHERE p = term) AS INTEGER) AS hits_equal
FROM pars, terms GROUP BY doc_id, term HAVING count(*) FILTER (WHERE instr(p, term) > 0) > 0""",
}


def labelled_outlinks(pages: DataFrame, label: str = "most_read", rules: LinkRules = LinkRules()) -> DataFrame:  # noqa: B008
    """SET-4: links of a section (here: of every fourth page) carry its label, every other link is kept once without one.
    One extraction: a link is of the section if any of its occurrences is."""
    links = _links(pages, rules, (F.col("page_id") % 4 == 0).alias("inside"))
    inside = links.groupBy("site", "link").agg(F.max("inside").alias("inside"))
    return inside.select("site", "link", F.when(F.col("inside"), F.lit(label)).alias("section"))


QUERIES["labelled_outlinks"] = lambda spark, d: labelled_outlinks(table(spark, d, "pages"))

_LINKS = f"""(
  SELECT DISTINCT site, CASE WHEN href[1] = '/' THEN root || href ELSE href END AS link FROM (
    SELECT page_id, {_HOST} AS site, regexp_extract(url, '^([A-Za-z][A-Za-z0-9+.-]*)://', 1) || '://' || {_HOST} AS root,
      unnest(list_transform(string_split({_NOISE}, '<a href="')[2:], lambda x: split_part(x, '"', 1))) AS href
    FROM pages WHERE {{cond}}
  ) l WHERE href <> ''
)"""

ORACLE["labelled_outlinks"] = f"""
WITH a AS {_LINKS.format(cond='true')}, s AS {_LINKS.format(cond='page_id % 4 = 0')}
SELECT site, link, 'most_read' AS section FROM s
UNION ALL
SELECT site, link, NULL AS section FROM a WHERE (site, link) NOT IN (SELECT (site, link) FROM s)"""


def page_link_parts(pages: DataFrame) -> DataFrame:
    """STR-11, STR-12, STR-30, STR-10: decoded link without query string, its last segment, trailing id, category."""
    from snapmetrics.functions.urls import basename, clean_url, link_id

    c = clean_url(F.col("url"))
    return pages.select(
        "page_id", c.alias("clean_link"), basename(c).alias("basename"), link_id("url").alias("link_id"),
        category("url").alias("category"),
    )


QUERIES["page_link_parts"] = lambda spark, d: page_link_parts(table(spark, d, "pages"))

ORACLE["page_link_parts"] = r"""
SELECT page_id, regexp_replace(url_decode(url), '\?.*', '') AS clean_link,
  regexp_extract(regexp_replace(url_decode(url), '\?.*', ''), '([^/]*)$', 1) AS basename,
  nullif(regexp_extract(url, '([0-9]+)/?(?:[?#].*)?$', 1), '') AS link_id,
  nullif(regexp_extract(url, '^[a-zA-Z][a-zA-Z0-9+.-]*://[^/]+/([^/?#]+)/', 1), '') AS category
FROM pages"""
