"""Attribute bags and embedded page JSON (PIPE-13, PIPE-35)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapmetrics.functions.common import first_present
from snapmetrics.functions.jsonx import lookup, pairs_to_map, repr_to_map
from snapmetrics.functions.text import between
from snapmetrics.operators.joins import keep_first
from snapmetrics.plans.listings import listings_clean
from snapmetrics.sources import fixtures
from snapmetrics.sources.fixture_exprs import ATTRIBUTES

AREA_KEY = "Квадратура"
FLOOR_KEY = "Етаж"
EMBED_START = "var aditional = '"
EMBED_END = "]'"
EMBED_SCHEMA = "array<struct<id:bigint, lang:string, lat:double, lon:double, area:int>>"


def attributes_map(df: DataFrame) -> DataFrame:
    """PIPE-13 (AG-14, JS-4, JS-5, PRJ-7): key/value list -> map (odd length -> null) and repr text -> map;
    typed lookups with the reference's '' default, and the first present of the two sources."""
    m = pairs_to_map("items")
    r = repr_to_map("details_repr")
    return df.select(
        "id",
        lookup(m, AREA_KEY).alias("area_pairs"),
        lookup(m, FLOOR_KEY).alias("floor_pairs"),
        lookup(r, AREA_KEY).alias("area_repr"),
        lookup(r, FLOOR_KEY).alias("floor_repr"),
        first_present(lookup(m, AREA_KEY), lookup(r, AREA_KEY)).try_cast("int").alias("area"),
        F.size(F.map_keys(r)).alias("n_keys"),
    )


def embedded_listing_locations(pages: DataFrame, listings: DataFrame) -> DataFrame:
    """PIPE-35 (HTM-3, WN-9, JN-4): JSON array in a page script -> one row per id (first page wins), joined to
    the listings by id."""
    items = pages.select(
        "page_id", F.explode(F.from_json(F.concat(between("html", EMBED_START, EMBED_END), F.lit("]")), EMBED_SCHEMA)).alias("it")
    ).select("page_id", F.col("it.id").alias("id"), F.col("it.lat").alias("lat"), F.col("it.lon").alias("lon"))
    first = keep_first(items, ["id"], ["page_id"])
    l_ = listings.select(F.col("id").try_cast("bigint").alias("id"), "link")
    return l_.join(first.drop("page_id"), "id", "left")


QUERIES = {
    "attributes_map": lambda spark, d: attributes_map(fixtures.attribute_lists(spark, d)),
    "embedded_listing_locations": lambda spark, d: embedded_listing_locations(
        fixtures.listing_pages(spark, d), listings_clean(fixtures.raw_listings(spark, d), keep_country=None)
    ),
}

ORACLE = {
    "attributes_map": "WITH a AS (SELECT " + ", ".join(ATTRIBUTES).replace("ARR(", "list_value(") + " FROM part)" + """
SELECT id,
  CASE WHEN len(items) % 2 = 0 THEN items[2] ELSE '' END AS area_pairs,
  CASE WHEN len(items) % 2 = 0 THEN items[4] ELSE '' END AS floor_pairs,
  regexp_extract(details_repr, 'Квадратура'': ''([^'']*)''', 1) AS area_repr,
  regexp_extract(details_repr, 'Етаж'': ''([^'']*)''', 1) AS floor_repr,
  TRY_CAST(coalesce(CASE WHEN len(items) % 2 = 0 THEN nullif(items[2], '') END,
                    nullif(regexp_extract(details_repr, 'Квадратура'': ''([^'']*)''', 1), '')) AS INTEGER) AS area,
  2 AS n_keys
FROM a""",
    "embedded_listing_locations": """
SELECT p_partkey AS id, 'https://' || CASE p_partkey % 4 WHEN 0 THEN 'www.listings-a.bg' WHEN 1 THEN 'www.etuovi.com'
    WHEN 2 THEN 'www.vuokraovi.com' ELSE 'www.listings-b.bg' END || '/offer/' || CAST(p_partkey % 500 AS VARCHAR) AS link,
  42.0 + CAST(CASE WHEN p_partkey % 20 < 2 AND p_partkey >= 20 THEN p_partkey // 20 - 1 ELSE p_partkey // 20 END AS DOUBLE) / 1000.0 AS lat,
  23.0 + CAST(p_partkey AS DOUBLE) / 10000.0 AS lon
FROM part""",
}
