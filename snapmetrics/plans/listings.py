"""Listing cleaning and typing (PIPE-8, 9, 12, 34): scraped text -> typed columns, all with native expressions.

Each plan is a single projection over one scan (narrow, no shuffle): it scales with the number of executors.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snapmetrics.functions import numbers as _num
from snapmetrics.functions import text as _txt
from snapmetrics.functions.common import as_col, nonempty
from snapmetrics.functions.jsonx import lookup, repair_json, zip_to_map
from snapmetrics.functions.numbers import (
    decimal_comma,
    digit_run,
    eu_number,
    first_number,
    first_year,
    round_half_up,
    strip_units,
)
from snapmetrics.functions.text import (
    GROUND_FLOORS,
    ON_REQUEST,
    after_place,
    country,
    is_apartment,
    listing_place,
    listing_type,
    parse_bg_datetime,
    short_title,
)
from snapmetrics.functions.urls import site_of
from snapmetrics.sources import fixtures
from snapmetrics.sources.fixture_exprs import LISTING_EXTRAS
from snapmetrics.sources.fixtures_sql import F3_LISTINGS, with_ctes

# The two BGN/EUR rates (staged cast vs scrape time), VAT factor and area units.
STAGING_RATE = 1.9588  # BGN per EUR in the staged-price cast
SCRAPE_RATE = 1.9558  # BGN per EUR at scrape time
VAT = 1.2
AREA_UNITS = ["кв.м", "m²", "M2"]


def to_double(c, strict: bool = False) -> Column:
    """PRJ-8: text -> DOUBLE; what is no number becomes null, or fails the load if ``strict``."""
    return as_col(c).cast("double") if strict else as_col(c).try_cast("double")


def to_bigint(c) -> Column:
    return F.trim(as_col(c)).try_cast("bigint")


def listings_clean(raw: DataFrame, keep_country: str | None = "bg", strict: bool = False) -> DataFrame:
    """PIPE-8: canonical type, apartment flag, country, site, place, price, area, year, lon/lat, labels, availability; typed
    (``strict``: coordinates that are no numbers fail the load).

    FLT-9 keeps one country (the reference loads only ``bg``). Nulls stay null (the reference's ``map(str)``
    turns them into ``nan``/``None`` text; we do not).
    """
    typ = listing_type("type")
    df = raw.select(
        "link", "id", "city", "measurement_day",
        typ.alias("type"),
        is_apartment(typ).alias("is_apartment"),
        country("link").alias("country"),
        site_of("link").alias("site"),
        listing_place("place").alias("place"),
        F.lower(F.trim("is_for_sale")).try_cast("boolean").alias("is_for_sale"),
        to_double(first_number("price", 3)).alias("price"),
        to_double(first_number("area", 2)).alias("area"),
        to_double(first_year("year")).alias("year"),
        "labels", "available_from",
        to_double(decimal_comma("lon"), strict).alias("lon"),
        to_double(decimal_comma("lat"), strict).alias("lat"),
        to_double(F.replace(F.col("views"), F.lit("пъти"), F.lit(""))).alias("views"),
        F.col("details"),
    )
    if keep_country:
        df = df.filter(F.col("country") == keep_country)
    return df


def price_eur(price, rate: float = STAGING_RATE) -> Column:
    """NUM-2: ``лв`` (any case) -> digits / rate rounded to 2; ``при запитване`` -> 0; else the digits."""
    p = as_col(price)
    amount = to_double(digit_run(p))
    return (
        F.when(F.lower(p).contains("лв"), round_half_up(amount / F.lit(rate), 2).cast("double"))
        .when(F.trim(p) == ON_REQUEST, F.lit(0.0))
        .otherwise(amount)
    )


def price_sqm_eur(sqm, price, rate: float = STAGING_RATE) -> Column:
    """NUM-3: as NUM-2 for the per-m² text; the on-request branch tests the *price* and ``лв`` is case-sensitive."""
    s = as_col(sqm)
    num = F.regexp_substr(_num.no_spaces(s), F.lit(r"[0-9.]+"))
    return (
        F.when(s.contains("лв"), round_half_up(to_double(num) / F.lit(rate), 2).cast("double"))
        .when(F.trim(as_col(price)) == ON_REQUEST, F.lit(0.0))
        .otherwise(to_double(num))
    )


def floor_no(c) -> Column:
    """NUM-10: ground/basement words -> 1, else the first digits."""
    f = as_col(c)
    return F.when(F.lower(F.trim(f)).isin(*GROUND_FLOORS), F.lit(1).cast("bigint")).otherwise(
        F.regexp_substr(f, F.lit("[0-9]+")).try_cast("bigint")
    )


def listings_staged_cast(raw: DataFrame) -> DataFrame:
    """PIPE-9: the staging -> typed cast (short title, address remainder, repaired details JSON, EUR prices)."""
    return raw.select(
        "link",
        short_title("title").alias("title"),
        after_place("address", "place").alias("address"),
        repair_json("details").alias("details"),
        F.trim("place").alias("place"),
        to_double("lon").alias("lon"),
        to_double("lat").alias("lat"),
        "id",
        price_eur("price").alias("price"),
        price_sqm_eur("price_sqm", "price").alias("price_sqm"),
        F.regexp_substr("area", F.lit("[0-9]+")).try_cast("bigint").alias("area"),
        floor_no("floor").alias("floor"),
        "description",
        to_bigint(F.replace(F.col("views"), F.lit("пъти"), F.lit(""))).alias("views"),
        "date",
        "measurement_day",
    )


def scrape_price_eur(text, area=None, rate: float = SCRAPE_RATE) -> Column:
    """NUM-4/NUM-5: digits of the price text; on request -> 0; ``лв`` -> /rate rounded half-even to an integer;
    a per-m² price (``на кв.м``) times the area."""
    t = as_col(text)
    digits = F.coalesce(digit_run(t), F.when(~t.rlike(r"\s"), F.lit("0")))  # words without a number: no price
    dnum = digits.try_cast("decimal(38,6)")
    p = (
        F.when(t.contains("Цена при запитване"), F.lit(0).cast("decimal(38,6)"))
        .when(F.lower(t).contains("eur"), dnum)
        .when(F.lower(t).contains("лв"), F.bround(dnum / F.lit(rate).cast("decimal(10,4)"), 0))
        .otherwise(dnum)
    )
    if area is not None:
        p = F.when(t.contains("на кв.м"), F.bround(p * as_col(area).try_cast("decimal(38,6)"), 0)).otherwise(p)
    return p.cast("double")


def price_with_vat(text) -> Column:
    """NUM-6 (sale): digits; ``без ДДС`` -> ×1.2; on request -> null; ranges (``–``) are not numbers -> null."""
    t = as_col(text)
    d = digit_run(t).try_cast("decimal(38,2)")
    return (
        F.when(t.contains("–") | t.contains("Цена по запитване") | t.contains(ON_REQUEST), F.lit(None))
        .when(t.contains("без ДДС"), d * F.lit(VAT).cast("decimal(3,1)"))
        .otherwise(d)
        .cast("double")
    )


def site_price(text, rent: bool = False) -> tuple[Column, Column]:
    """NUM-6: (number, text): the first number of a sale, or the rent a month, with VAT where the price lacks it; a range and
    a text without a number stay text."""
    t = as_col(text)
    found = _num.no_spaces(F.regexp_extract(_num.plain_spaces(t), r"Наем €\s*(\d[\d\s]*)/месец", 1)) if rent else digit_run(t)
    d = F.when(~t.contains("–"), nonempty(found).try_cast("decimal(38,2)"))
    d = F.when(t.contains("без ДДС"), d * F.lit(VAT).cast("decimal(3,1)")).otherwise(d).cast("double")
    return d, F.when(d.isNull(), t)


def currency_price_eur(text, rate: float = SCRAPE_RATE) -> Column:
    """NUM-4 (``Цена:`` layout): ``EUR`` -> digits; ``BGN`` -> digits / rate rounded half-even; else null."""
    t = F.replace(as_col(text), F.lit("Цена: "), F.lit(""))
    digits = _num.no_spaces(F.replace(F.replace(t, F.lit("EUR"), F.lit("")), F.lit("BGN"), F.lit("")))
    d = digits.try_cast("decimal(38,6)")
    return (
        F.when(t.contains("EUR"), d)
        .when(t.contains("BGN"), F.bround(d / F.lit(rate).cast("decimal(10,4)"), 0))
        .cast("double")
    )


def monthly_fees(c) -> dict[str, Column]:
    """NUM-8: leading total, ``Hoitovastike n`` and ``Rahoitusvastike n`` as numbers (European format)."""
    s = as_col(c)

    def grab(pattern):
        return to_double(eu_number(nonempty(F.regexp_extract(s, pattern, 1))))

    return {
        "monthly_fee": grab(r"^([\d\s,]+)"),
        "maintenance_fee": grab(r"Hoitovastike ([\d,\s]+)"),
        "financial_fee": grab(r"Rahoitusvastike ([\d,\s]+)"),
    }


def listing_price_variants(raw: DataFrame) -> DataFrame:
    """PIPE-12: the per-source price rules side by side."""
    fees, total = monthly_fees("fees"), monthly_fees("fees_total")
    sale, text = site_price("price_site")
    area = F.regexp_substr("area", F.lit("[0-9]+"))
    return raw.select(
        "id",
        scrape_price_eur("price_site", area).alias("site_price_eur"), sale.alias("site_price"), text.alias("site_price_text"),
        site_price("price_site", rent=True)[0].alias("site_rent"), _num.bgn_to_eur(digit_run("price_site")).alias("site_as_bgn"),
        total["monthly_fee"].alias("total_fee"), total["maintenance_fee"].alias("total_maintenance"),
        scrape_price_eur("price", F.regexp_substr("area", F.lit("[0-9]+"))).alias("scrape_price_eur"),
        price_with_vat("price").alias("price_with_vat"),
        currency_price_eur("price_alt").alias("alt_price_eur"),
        to_double(eu_number("price_eu")).alias("eu_price"),
        strip_units("area", AREA_UNITS, "0").alias("area_number"),
        *[v.alias(k) for k, v in fees.items()],
    )


def parse_localized_dates(raw: DataFrame) -> DataFrame:
    """PIPE-34: month-name and numeric date texts -> timestamp."""
    return raw.select("id", "date_text", parse_bg_datetime("date_text").alias("published_at"))


# ---------------------------------------------------------------- registry

QUERIES = {
    "listings_clean": lambda spark, d: listings_clean(fixtures.raw_listings(spark, d)),
    "listings_staged_cast": lambda spark, d: listings_staged_cast(fixtures.raw_listings(spark, d)),
    "listing_price_variants": lambda spark, d: listing_price_variants(fixtures.raw_listings(spark, d)),
    "parse_localized_dates": lambda spark, d: parse_localized_dates(fixtures.raw_listings(spark, d)),
}

# Oracle pieces (DuckDB): regexp_extract gives '' on no match, hence nullif.
_CLEAN_SQL = r"""
cleaned AS (
  SELECT link, id, city, measurement_day,
    labels, available_from,
    replace(replace(replace(replace(replace(trim(lower(type)), '1-', 'едно'), '2-', 'дву'), '3-', 'три'), '4-', 'четири'),
      ' апартамент', '') AS type,
    CASE WHEN link LIKE '%etuovi.com%' OR link LIKE '%www.vuokraovi.com%' THEN 'fi' ELSE 'bg' END AS country,
    nullif(regexp_extract(link, '.*://([^/]*)', 1), '') AS site,
    replace(replace(replace(replace(replace(replace(trim(lower(place)), 'гр. софия', ''), 'софийска област', ''),
      'българия', ''), '/', ''), ',', ''), 'близо до', '') AS place,
    TRY_CAST(lower(trim(is_for_sale)) AS BOOLEAN) AS is_for_sale,
    TRY_CAST(nullif(regexp_extract(replace(price, ' ', ''), '([0-9.]{3,})', 1), '') AS DOUBLE) AS price,
    TRY_CAST(nullif(regexp_extract(replace(area, ' ', ''), '([0-9.]{2,})', 1), '') AS DOUBLE) AS area,
    TRY_CAST(nullif(regexp_extract(replace(year, ' ', ''), '([0-9]{4})', 1), '') AS DOUBLE) AS year,
    TRY_CAST(replace(lon, ',', '.') AS DOUBLE) AS lon,
    TRY_CAST(replace(lat, ',', '.') AS DOUBLE) AS lat,
    TRY_CAST(replace(views, 'пъти', '') AS DOUBLE) AS views,
    details
  FROM listings
)"""

_CLEAN_COLS = (
    "link, id, city, measurement_day, type, "
    "coalesce(regexp_matches(type, '(?:стаен|мезонет|ателие)'), false) AS is_apartment, country, site, place, "
    "is_for_sale, price, area, year, labels, available_from, lon, lat, views, details"
)

ORACLE = {
    "listings_clean": with_ctes(F3_LISTINGS, _CLEAN_SQL) + f"SELECT {_CLEAN_COLS} FROM cleaned WHERE country = 'bg'",
    "listings_staged_cast": with_ctes(F3_LISTINGS) + r"""
SELECT link,
  lower(split_part(title, '   ', 1)) AS title,
  CASE WHEN instr(address, trim(place)) > 0
       THEN nullif(substr(address, instr(address, trim(place)) + length(trim(place))), '') END AS address,
  replace(substr(details, 2, length(details) - 2), '""', '"') AS details,
  trim(place) AS place,
  TRY_CAST(lon AS DOUBLE) AS lon, TRY_CAST(lat AS DOUBLE) AS lat, id,
  CASE WHEN lower(price) LIKE '%лв%' THEN CAST(round(CAST(TRY_CAST(replace(nullif(regexp_extract(price, '([0-9\s]+)', 1), ''), ' ', '') AS DOUBLE) / 1.9588 AS DECIMAL(38,10)), 2) AS DOUBLE)
       WHEN trim(price) = 'при запитване' THEN 0.0
       ELSE TRY_CAST(replace(nullif(regexp_extract(trim(price), '([0-9\s]+)', 1), ''), ' ', '') AS DOUBLE) END AS price,
  CASE WHEN price_sqm LIKE '%лв%' THEN CAST(round(CAST(TRY_CAST(nullif(regexp_extract(price_sqm, '([0-9.]+)', 1), '') AS DOUBLE) / 1.9588 AS DECIMAL(38,10)), 2) AS DOUBLE)
       WHEN trim(price) = 'при запитване' THEN 0.0
       ELSE TRY_CAST(nullif(regexp_extract(price_sqm, '([0-9.]+)', 1), '') AS DOUBLE) END AS price_sqm,
  TRY_CAST(nullif(regexp_extract(area, '([0-9]+)', 1), '') AS BIGINT) AS area,
  CASE WHEN lower(trim(floor)) IN ('партер', 'сутерен') THEN CAST(1 AS BIGINT)
       ELSE TRY_CAST(nullif(regexp_extract(floor, '([0-9]+)', 1), '') AS BIGINT) END AS floor,
  description, TRY_CAST(trim(replace(views, 'пъти', '')) AS BIGINT) AS views, date,
  measurement_day
FROM listings""",
    "listing_price_variants": with_ctes(F3_LISTINGS) + r"""
, v AS (
  SELECT id, price, price_alt, price_eu, fees, area, pk, price_site, CAST(100 + pk % 900 AS DOUBLE) AS n3, CAST(sz AS DOUBLE) AS sz, CAST(replace(n_sp, ' ', '') AS DOUBLE) AS n6,
    TRY_CAST(coalesce(replace(nullif(regexp_extract(price, '([0-9\s]+)', 1), ''), ' ', ''), '0') AS DECIMAL(38,6)) AS dnum,
    TRY_CAST(nullif(regexp_extract(area, '([0-9]+)', 1), '') AS DECIMAL(38,6)) AS area_n
  FROM listings
)
SELECT id,
  CAST(CASE WHEN price LIKE '%Цена при запитване%' THEN 0
       WHEN lower(price) LIKE '%eur%' THEN dnum
       WHEN lower(price) LIKE '%лв%' THEN round_even(dnum / 1.9558, 0)
       ELSE dnum END AS DOUBLE) AS scrape_price_eur,
  CAST(CASE WHEN price LIKE '%–%' OR price LIKE '%Цена по запитване%' OR price LIKE '%при запитване%' THEN NULL
       WHEN price LIKE '%без ДДС%' THEN TRY_CAST(nullif(trim(replace(regexp_extract(price, '([0-9\s]+)', 1), ' ', '')), '') AS DECIMAL(38,2)) * 1.2
       ELSE TRY_CAST(nullif(trim(replace(regexp_extract(price, '([0-9\s]+)', 1), ' ', '')), '') AS DECIMAL(38,2)) END AS DOUBLE)
    AS price_with_vat,
  CAST(CASE WHEN replace(price_alt, 'Цена: ', '') LIKE '%EUR%'
         THEN TRY_CAST(replace(replace(replace(replace(price_alt, 'Цена: ', ''), 'EUR', ''), 'BGN', ''), ' ', '') AS DECIMAL(38,6))
       WHEN replace(price_alt, 'Цена: ', '') LIKE '%BGN%'
         THEN round_even(TRY_CAST(replace(replace(replace(replace(price_alt, 'Цена: ', ''), 'EUR', ''), 'BGN', ''), ' ', '') AS DECIMAL(38,6)) / 1.9558, 0)
       END AS DOUBLE) AS alt_price_eur,
  TRY_CAST(replace(replace(replace(price_eu, ' €', ''), ' ', ''), ',', '.') AS DOUBLE) AS eu_price,
  CASE WHEN replace(replace(replace(replace(area, 'кв.м', ''), 'm²', ''), 'M2', ''), ' ', '') = '' THEN '0'
       ELSE replace(replace(replace(replace(area, 'кв.м', ''), 'm²', ''), 'M2', ''), ' ', '') END AS area_number,
  TRY_CAST(replace(replace(replace(nullif(regexp_extract(fees, '^([0-9\s,]+)', 1), ''), ' €', ''), ' ', ''), ',', '.') AS DOUBLE) AS monthly_fee,
  TRY_CAST(replace(replace(replace(nullif(regexp_extract(fees, 'Hoitovastike ([0-9,\s]+)', 1), ''), ' €', ''), ' ', ''), ',', '.') AS DOUBLE) AS maintenance_fee,
  TRY_CAST(replace(replace(replace(nullif(regexp_extract(fees, 'Rahoitusvastike ([0-9,\s]+)', 1), ''), ' €', ''), ' ', ''), ',', '.') AS DOUBLE) AS financial_fee
,
  CASE pk % 8 WHEN 0 THEN round_even(n6 / 1.9558, 0) WHEN 1 THEN 0.0 WHEN 2 THEN n3 * sz WHEN 4 THEN round_even(n3 / 1.9558, 0) * sz
    WHEN 5 THEN n3 WHEN 6 THEN NULL ELSE n6 END AS site_price_eur,
  CASE pk % 8 WHEN 0 THEN n6 WHEN 2 THEN n3 WHEN 4 THEN n3 WHEN 5 THEN n3 WHEN 7 THEN CAST(CAST(n6 AS DECIMAL(18,2)) * 1.2 AS DOUBLE) END AS site_price,
  CASE WHEN pk % 8 IN (1, 3, 6) THEN price_site END AS site_price_text,
  CASE WHEN pk % 8 = 5 THEN n3 END AS site_rent,
  CAST(round_even(CASE WHEN pk % 8 IN (0, 3, 7) THEN n6 WHEN pk % 8 IN (2, 4, 5) THEN n3 END / 1.9558, 0) AS BIGINT) AS site_as_bgn,
  CAST((pk % 400) || '.20' AS DOUBLE) AS total_fee, CAST((pk % 300) || '.15' AS DOUBLE) AS total_maintenance
FROM v""",
    "parse_localized_dates": with_ctes(F3_LISTINGS) + """
SELECT id, date_text, make_timestamp(y, m, d, CAST(hh AS BIGINT), CAST(mi AS BIGINT), 0.0) AS published_at
FROM listings""",
}


# ---------------------------------------------------------------- per-source text rules (F3 extras)

# Tooltip labels that are not listing labels.
NON_LABELS = ["Преглеждания на сайта", "Спрямо всички оферти в района", "Добави в любими"]


def listing_text_rules(df: DataFrame) -> DataFrame:
    """STR-23..27, STR-31, STR-33, NUM-11, NUM-16..18, ARR-3, ARR-4 side by side over scraped snippets."""
    place, recent = _txt.place_and_label("title_text")
    typ, labels = _txt.extend_labels("type_text", "label_text")
    lon_t, lat_t = _num.lon_lat_pair("mapn")
    lon5, lat5 = _num.coords_from_dict("coord_dict")
    return df.select(
        "id",
        place.alias("place"), recent.alias("recent_label"),
        typ.alias("type_clean"), labels.alias("labels"),
        _num.counter("meta_line", "first").alias("comments_n"),
        _num.counter("meta_line", "last").alias("views_n"),
        _num.counter("views_text", "times").alias("views_times"),
        _txt.author_after_colon("author_meta").alias("author_meta"),
        _txt.author_after_semicolon("info").alias("author_info"),
        lon_t.alias("lon_text"), lat_t.alias("lat_text"),
        lon5.alias("lon5"), lat5.alias("lat5"),
        _num.suffixed_price("rent_price").alias("rent_eur"),
        _txt.leading_token("deposit_text").alias("deposit"),
        _txt.join_except("label_list", NON_LABELS).alias("labels_kept"),
        _txt.all_words("tag_blob").alias("tags"),
        F.replace(_txt.drop_control_chars("noisy"), F.lit("\\"), F.lit("/")).alias("noisy_clean"),
        _txt.cut_before("cut_text", "Tweet").alias("cut"), _txt.cut_after("cut_text", "Tweet").alias("cut_rest"),
        _txt.place_from_title("city_title").alias("city_place"), _txt.strip_literals("city_title", ["Продава ", "гр. "]).alias("city_bare"),
        _num.counter("meta_line", 5).alias("fifth_word"),
        lookup(zip_to_map(F.array(F.lit("kind"), F.lit("number")), "pair_values"), "number").alias("zipped"),
    )


QUERIES["listing_text_rules"] = lambda spark, d: listing_text_rules(fixtures.listing_extras(spark, d))

_EXTRAS = "x AS (SELECT " + ", ".join(LISTING_EXTRAS).replace("ARR(", "list_value(") + " FROM part)"

ORACLE["listing_text_rules"] = f"WITH {_EXTRAS}" + r"""
SELECT id,
  CASE WHEN strpos(title_text, '(публикувана') > 0 THEN substr(title_text, 1, strpos(title_text, '(публикувана') - 1)
       ELSE title_text END AS place,
  CASE WHEN strpos(title_text, '(публикувана') > 0 THEN 'published recently' ELSE '' END AS recent_label,
  CASE WHEN type_text LIKE '%В процес на строителство%'
         THEN trim(replace(replace(replace(type_text, 'В процес на строителство', ''), '(', ''), ')', ''))
       WHEN type_text LIKE '%Предварителни продажби%'
         THEN trim(replace(replace(replace(type_text, 'Предварителни продажби', ''), '(', ''), ')', ''))
       ELSE type_text END AS type_clean,
  concat_ws(', ', nullif(label_text, ''),
    CASE WHEN type_text LIKE '%В процес на строителство%' THEN 'В процес на строителство' END,
    CASE WHEN lower(type_text) LIKE '%апартаменти%' THEN 'Множество апартаменти' END,
    CASE WHEN type_text LIKE '%Предварителни продажби%' THEN 'Предварителни продажби' END) AS labels,
  TRY_CAST(regexp_extract(meta_line, '^(\d+)', 1) AS BIGINT) AS comments_n,
  TRY_CAST(regexp_extract(meta_line, '(\d+)$', 1) AS BIGINT) AS views_n,
  TRY_CAST(trim(replace(views_text, 'пъти', '')) AS BIGINT) AS views_times,
  trim(nullif(regexp_extract(author_meta, ':([А-Яа-я\s]+$)', 1), '')) AS author_meta,
  CASE WHEN info LIKE '%;%' THEN split_part(info, ';', 2) END AS author_info,
  CASE WHEN mapn LIKE '%,%' THEN split_part(mapn, ',', 1) ELSE '' END AS lon_text,
  CASE WHEN mapn LIKE '%,%' THEN split_part(mapn, ',', 2) ELSE '' END AS lat_text,
  CAST(round(CAST(CAST(regexp_extract(coord_dict, '''lng'': ([0-9.]+)', 1) AS DOUBLE) AS DECIMAL(38,10)), 5) AS DOUBLE) AS lon5,
  CAST(round(CAST(CAST(regexp_extract(coord_dict, '''lat'': ([0-9.]+)', 1) AS DOUBLE) AS DECIMAL(38,10)), 5) AS DOUBLE) AS lat5,
  CASE WHEN regexp_extract(rent_price, '([\d ]+)(?:[\d,]+)? €\/kk$', 1) = '' THEN '0'
       ELSE replace(regexp_extract(rent_price, '([\d ]+)(?:[\d,]+)? €\/kk$', 1), ' ', '') END AS rent_eur,
  trim(nullif(regexp_extract(deposit_text, '^(?:\s)?([\d\.\s]+).*', 1), '')) AS deposit,
  array_to_string(list_filter(label_list, lambda l: trim(l) NOT IN ('Преглеждания на сайта', 'Спрямо всички оферти в района', 'Добави в любими')), ', ') AS labels_kept,
  CASE WHEN len(regexp_extract_all(tag_blob, '([А-Яа-я]+)', 1)) > 0
       THEN array_to_string(regexp_extract_all(tag_blob, '([А-Яа-я]+)', 1), ' - ') END AS tags,
  replace(replace(noisy, chr(7), ''), chr(92), '/') AS noisy_clean,
  split_part(cut_text, 'Tweet', 1) AS cut, split_part(cut_text, 'Tweet', 2) AS cut_rest,
  CASE id % 3 WHEN 0 THEN 'Лозенец' WHEN 1 THEN ', Център' ELSE '' END AS city_place,
  replace(replace(city_title, 'Продава ', ''), 'гр. ', '') AS city_bare, CAST(id * 3 AS BIGINT) AS fifth_word, CAST(id AS VARCHAR) AS zipped
FROM x"""
