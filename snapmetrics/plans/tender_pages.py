"""Tender fields of the two page sources (PIPE-22): labelled spans of the tax office, labelled boxes of the court portal."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapmetrics.functions.common import bound, nonempty
from snapmetrics.functions.numbers import no_spaces
from snapmetrics.functions.text import class_text, parse_bg_datetime, term_range, text_after
from snapmetrics.functions.urls import basename
from snapmetrics.sources.tables import spread, table

BASE_URL = "https://sales.example.bg"
PLACEHOLDER = "/assets/images/photo-placeholder.png"
# Labels of the tax office's pages and the part of the value that is read.
TAX_LABELS = {
    "published": ("Дата на съобщение:", r"^\s?([\d.]+)"),
    "period_start": ("Начална дата за подаване на предложения:", r"^\s?([\d.]+)"),
    "period_end": ("Краен срок за внасяне на депозит:", r"^\s?([\d.]+)"),
    "announcement": ("Дата  и час на провеждане на търга:", r"^\s?([\d.\s:]+)"),
    "responsible_person": ("Водещ продажбата:", None),
    "department": ("ТД на НАП:", None),
    "deposit": ("Депозит:", r"^([\d.\s]+)"),
    "price": ("Първоначална цена:", r"^([\d.\s]+)"),
    "already_held": ("Брой провеждания:", r"^\s?([\d]+)"),
}
# Labels of the court portal's boxes.
COURT_LABELS = {"city": "НАСЕЛЕНО МЯСТО", "address": "Адрес", "organizer": "ЧАСТЕН СЪДЕБЕН ИЗПЪЛНИТЕЛ", "term": "СРОК", "announcement": "ОБЯВЯВАНЕ НА"}


def tax_tender_fields(pages: DataFrame) -> DataFrame:
    """One row per page: label -> following text, cut to the value; null when a label is absent."""
    def read(label: str, pattern: str | None):
        text = text_after("html", label)
        return text if pattern is None else nonempty(F.trim(F.regexp_extract(text, pattern, 1)))

    return pages.select("page_id", *[read(*rule).alias(name) for name, rule in TAX_LABELS.items()])


def court_tender_fields(pages: DataFrame) -> DataFrame:
    """Offer id and link, publication time, title, area, price, labelled boxes, term, and the attachments as (name, link)
    pairs without the placeholder image."""
    href = nonempty(F.regexp_extract("html", r"""<a\s(?:[^>]*?\s)?href=["'](/properties/\d+)["']""", 1))
    stamp = class_text("html", "date")
    for drop, put in (("Публикувано на ", ""), (" г. в ", " "), (" часа", "")):
        stamp = F.replace(stamp, F.lit(drop), F.lit(put))
    term = text_after("html", COURT_LABELS["term"])
    files = F.regexp_extract_all("html", F.lit(r"""<a\s(?:[^>]*?\s)?href=["'](/(?:assets|files)/[^"']*)["']"""), 1)
    pairs = F.transform(F.filter(files, lambda f: f != PLACEHOLDER), lambda f: F.struct(basename(f).alias("name"), F.concat(F.lit(BASE_URL), f).alias("link")))
    return pages.select(
        "page_id", F.regexp_extract(href, r"(\d+)$", 1).try_cast("bigint").alias("offer_id"), F.concat(F.lit(BASE_URL), href).alias("link"),
        bound(stamp, parse_bg_datetime).alias("published"), class_text("html", "title").alias("title"),
        no_spaces(F.replace(class_text("html", "category"), F.lit(" кв.м"), F.lit(""))).try_cast("double").alias("area"),
        no_spaces(F.replace(class_text("html", "price"), F.lit("лв."), F.lit(""))).try_cast("double").alias("price"),
        *[text_after("html", COURT_LABELS[c]).alias(c) for c in ("city", "address", "organizer", "announcement")],
        bound(term, lambda t: term_range(t, "start")).alias("term_start"), bound(term, lambda t: term_range(t, "end")).alias("term_end"),
        pairs.alias("attachments"),
    )


# ---------------------------------------------------------------- input pages, the same text in both engines
_N = "CAST(s_suppkey AS STRING)"
_DAY = "CAST(10 + s_suppkey % 18 AS STRING)"
TAX_PAGE = (
    "'<div class=\"tender-item\" id=\"item' || " + _N + " || '\"><span>Дата на съобщение:</span> ' || " + _DAY + " || '.05.2021 г.<br>"
    "<span>Начална дата за подаване на предложения:</span> ' || " + _DAY + " || '.06.2021<br><span>Водещ продажбата:</span> ' || s_name || '<br>' || "
    "CASE WHEN s_suppkey % 5 = 0 THEN '' ELSE '<span>Краен срок за внасяне на депозит:</span> ' || " + _DAY + " || '.07.2021 до 17:00<br>' END || "
    "'<span>Дата  и час на провеждане на търга:</span> ' || " + _DAY + " || '.08.2021 10:30 ч.<br><span>ТД на НАП:</span> ' || 'ТД ' || CAST(s_nationkey AS STRING) || "
    "'<br><span>Депозит:</span> ' || " + _N + " || ' 500.00 лв.<br><span>Първоначална цена:</span> ' || " + _N + " || '000.50 лв.<br><span>Брой провеждания:</span> ' || "
    "CAST(s_suppkey % 4 AS STRING) || ' пъти</div>'"
)
_C = "CAST(c_custkey AS STRING)"
_CDAY = "CAST(1 + c_custkey % 28 AS STRING)"
COURT_PAGE = (
    "'<a class=\"x\" href=\"/properties/' || " + _C + " || '\">виж</a><div class=\"date\">Публикувано на ' || " + _CDAY + " || ' декември 2020 г. в 16:31 часа</div>"
    "<div class=\"title\">' || c_name || '</div><div class=\"category\">' || CAST(20 + c_custkey % 300 AS STRING) || ' кв.м</div>"
    "<div class=\"price\">' || CAST(1 + c_custkey % 90 AS STRING) || '\u00a0000.00 лв.</div><div><div class=\"label\">НАСЕЛЕНО МЯСТО</div></div><div class=\"info\">гр. ' || c_mktsegment || '</div>' || "
    "CASE WHEN c_custkey % 3 = 0 THEN '' ELSE '<div><div class=\"label\">Адрес</div></div><div class=\"info\">' || 'ул. ' || c_name || '</div>' END || "
    "'<div><div class=\"label\">ЧАСТЕН СЪДЕБЕН ИЗПЪЛНИТЕЛ</div></div><div class=\"info\">ЧСИ ' || CAST(c_nationkey AS STRING) || '</div><div><div class=\"label\">СРОК</div></div><div class=\"info\">от ' || "
    + _CDAY + " || '.01.2021 до ' || " + _CDAY + " || '.02.2021</div><div><div class=\"label\">ОБЯВЯВАНЕ НА</div></div><div class=\"info\">' || " + _CDAY + " || '.02.2021 09:00</div>"
    "<ul><li><a href=\"/files/doc' || " + _C + " || '.pdf\">d</a></li></ul><a class=\"item-image\" href=\"' || CASE WHEN c_custkey % 2 = 0 THEN '/assets/images/photo-placeholder.png' ELSE '/assets/images/' || " + _C + " || '.jpg' END || '\"></a>'"
)


def _pages(spark, d, name: str, key: str, page: str) -> DataFrame:
    """A page a row, its rows spread first: reading pages out costs a thousand times what scanning their rows does."""
    rows = table(spark, d, name)
    return spread(rows.select(*[c for c in rows.columns if c in page])).selectExpr(f"{key} AS page_id", f"{page} AS html")


def _court(spark, d) -> DataFrame:
    found = court_tender_fields(_pages(spark, d, "customer", "c_custkey", COURT_PAGE))
    said = F.array_join(F.transform("attachments", lambda a: F.concat_ws("=", a["name"], a["link"])), ",")
    return found.withColumn("attachments", said)


# A box whose text is spread over elements of its own kind, 0 to 4 deep, before a sibling of that kind and an unclosed one.
NESTED_PAGE = (
    "'<div id=top><div class=\"row first\">x</div><section class=\"item box\">' || repeat('<section><b>', c_custkey % 5) || c_name || repeat('</b></section> ', c_custkey % 5) || "
    "'<section class=\"note\">' || CAST(c_nationkey AS STRING) || '</section>end</section><section>after</section></div><section class=\"open\">' || c_name"
)


def nested_page_fields(pages: DataFrame) -> DataFrame:
    """HTM-1 on elements that hold others of their kind: the whole box, an inner one, and one that is not closed."""
    return pages.select("page_id", *[class_text("html", c).alias(c) for c in ("box", "note", "open", "first")])


QUERIES = {
    "nested_page_fields": lambda spark, d: nested_page_fields(_pages(spark, d, "customer", "c_custkey", NESTED_PAGE)),
    "tax_tender_fields": lambda spark, d: tax_tender_fields(_pages(spark, d, "supplier", "s_suppkey", TAX_PAGE)),
    "court_tender_fields": _court,
}

ORACLE = {
    "nested_page_fields": """
SELECT c_custkey AS page_id, c_name || repeat(' ', c_custkey % 5) || c_nationkey || 'end' AS box, CAST(c_nationkey AS VARCHAR) AS note, CAST(NULL AS VARCHAR) AS open,
  'x' AS first FROM customer""",
    "tax_tender_fields": """
SELECT s_suppkey AS page_id, (10 + s_suppkey % 18) || '.05.2021' AS published, (10 + s_suppkey % 18) || '.06.2021' AS period_start,
  CASE WHEN s_suppkey % 5 <> 0 THEN (10 + s_suppkey % 18) || '.07.2021' END AS period_end, (10 + s_suppkey % 18) || '.08.2021 10:30' AS announcement,
  s_name AS responsible_person, 'ТД ' || s_nationkey AS department, s_suppkey || ' 500.00' AS deposit, s_suppkey || '000.50' AS price, CAST(s_suppkey % 4 AS VARCHAR) AS already_held
FROM supplier""",
    "court_tender_fields": """
SELECT c_custkey AS page_id, c_custkey AS offer_id, 'https://sales.example.bg/properties/' || c_custkey AS link,
  make_timestamp(2020, 12, 1 + c_custkey % 28, 16, 31, 0) AS published, c_name AS title, CAST(20 + c_custkey % 300 AS DOUBLE) AS area,
  1000.0 * CAST(1 + c_custkey % 90 AS DOUBLE) AS price, 'гр. ' || c_mktsegment AS city, CASE WHEN c_custkey % 3 <> 0 THEN 'ул. ' || c_name END AS address,
  'ЧСИ ' || c_nationkey AS organizer, (1 + c_custkey % 28) || '.02.2021 09:00' AS announcement, (1 + c_custkey % 28) || '.01.2021' AS term_start,
  (1 + c_custkey % 28) || '.02.2021' AS term_end, 'doc' || c_custkey || '.pdf=https://sales.example.bg/files/doc' || c_custkey || '.pdf'
    || CASE WHEN c_custkey % 2 = 1 THEN ',' || c_custkey || '.jpg=https://sales.example.bg/assets/images/' || c_custkey || '.jpg' ELSE '' END AS attachments
FROM customer""",
}
