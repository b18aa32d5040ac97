"""Typed schemas of the tables the reference reads and writes (SNK-10), and a drop-and-create helper.

Landing data is all text (the reference unifies everything as strings before casting); the typed tables below are
what the cast/load steps produce.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import (
    ArrayType,
    BooleanType,
    DateType,
    DecimalType,
    DoubleType,
    LongType,
    StringType,
    StructField,
    StructType,
)

from snapmetrics.sources.io import ARTICLE_COLUMNS, LISTING_COLUMNS, string_schema


def _s(*fields: tuple[str, object]) -> StructType:
    return StructType([StructField(n, t, True) for n, t in fields])


STR, DBL, LONG, BOOL = StringType(), DoubleType(), LongType(), BooleanType()

ARTICLE_SNAPSHOT = string_schema(ARTICLE_COLUMNS)
LISTING_RAW = string_schema(LISTING_COLUMNS)
STAGED_WEEKLY_LISTING = string_schema(
    ["link", "title", "address", "details", "place", "lon", "lat", "id", "price", "price_sqm", "area", "floor",
     "description", "views", "date", "measurement_day"]
)
LISTING_DIMENSION = _s(
    ("link", STR), ("site", STR), ("country", STR), ("id", STR), ("type", STR), ("is_apartment", BOOL),
    ("city", STR), ("place", STR), ("area", DBL), ("details", STR), ("year", DBL), ("available_from", STR),
    ("lon", DBL), ("lat", DBL),
)
MEASUREMENT_FACT = _s(
    ("site", STR), ("id", STR), ("is_for_sale", BOOL), ("price", DBL), ("labels", STR), ("views", DBL),
    ("measurement_day", STR),
)
COMPANY = _s(("symbol", STR), ("name", STR), ("weight", DBL), ("details", STR))
PRICE_BAR = _s(
    ("symbol", STR), ("at_date", DateType()), ("volume", DecimalType(38, 0)), ("at_open", DBL), ("at_close", DBL),
    ("at_close_adj", DBL), ("high", DBL), ("low", DBL),
)
COURT_TENDER = string_schema(
    ["page_id", "area", "place", "price", "type", "court_full", "court_short", "link", "published", "period_end",
     "period_start", "announcement", "notarius", "description", "additional_desc", "ideal_parts", "city_clean",
     "mun_clean"]
)
TAX_TENDER = _s(
    ("page_id", STR), ("link", STR), ("related_page_ids", ArrayType(STR)), ("period_start", STR), ("period_end", STR),
    ("announcement", STR), ("published", STR), ("category", STR), ("ideal_part", STR), ("desc", STR),
    ("quantity", STR), ("already_held", STR), ("deposit", STR), ("price", STR), ("responsible_person", STR),
    ("department", STR), ("region", STR), ("municipality", STR), ("place", STR), ("address", STR), ("type", STR),
    ("area", STR), ("photo_links", ArrayType(STR)), ("lat", STR), ("lon", STR),
)
GAZETTEER = _s(
    ("link", STR), ("place_name", STR), ("mun", STR), ("region", STR), ("lon", STR), ("lat", STR), ("ekatte", STR)
)
SERVICE = ArrayType(_s(("groupName", STR), ("displayName", STR)))
STORE = _s(
    ("store_name", STR), ("store_id", LONG), ("store_type", STR), ("is_open_24h", BOOL), ("lon", DBL), ("lat", DBL),
    ("opening_date", STR), ("postal_code", STR), ("street_address", STR), ("city", STR), ("state", STR),
    ("country", STR), ("can_order_custom_cakes_online", BOOL), ("primary_services", SERVICE),
    ("secondary_services", SERVICE),
)
POINT_OF_INTEREST = string_schema(
    ["center_id", "address_from_link", "address_from_div", "name", "reviews", "rating", "link", "lon", "lat"]
)


def ensure_table(spark: SparkSession, name: str, schema: StructType, path: str, replace: bool = True) -> DataFrame:
    """SNK-10: ``DROP TABLE IF EXISTS`` + create an empty parquet table with the given schema at ``path``."""
    if replace:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
    if not spark.catalog.tableExists(name):
        # overwrite: a dropped external table leaves its files at the location
        spark.createDataFrame([], schema).write.mode("overwrite").format("parquet").option("path", path).saveAsTable(
            name
        )
    return spark.table(name)
