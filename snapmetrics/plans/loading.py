"""Incremental loading (PIPE-10, 11, 33): first-seen dimension upsert, append of unseen days, file-name partitions.

The "already loaded" sets are DataFrames joined with ``left_anti`` — never collected into an ``IN (...)`` list.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from snapmetrics.operators.joins import insert_if_absent, only_new
from snapmetrics.plans.listings import listings_clean
from snapmetrics.schemas import LISTING_DIMENSION, MEASUREMENT_FACT
from snapmetrics.sources import fixtures
from snapmetrics.sources.fixtures_sql import F3_LISTINGS, with_ctes
from snapmetrics.sources.io import drop_partitions, partition_from_filename

DIMENSION_COLUMNS = LISTING_DIMENSION.fieldNames()
FACT_COLUMNS = MEASUREMENT_FACT.fieldNames()
LOADED_DAYS = ["2020-07-10", "2020-07-11"]  # fixture: days already in the fact table
PURGE_SOURCES = ["www.listings-a.bg"]
PURGE_DAYS = ["2020-07-12", "2020-07-13"]


def listings_upsert(clean: DataFrame, existing_dim: DataFrame) -> DataFrame:
    """PIPE-10: rows to insert into the link-keyed dimension (first version wins, existing links untouched)."""
    new = clean.select(*DIMENSION_COLUMNS, "measurement_day")
    rows = insert_if_absent(new, existing_dim.select("link"), ["link"], ["measurement_day", "id"])
    return rows.select(*DIMENSION_COLUMNS)


def measurements_incremental(clean: DataFrame, loaded_facts: DataFrame) -> DataFrame:
    """PIPE-11: fact rows of the days not loaded yet (anti join on the loaded days)."""
    days = loaded_facts.select("measurement_day").distinct()
    return only_new(clean, days, ["measurement_day"]).select(*FACT_COLUMNS)


def partition_maintenance(spark: SparkSession, raw: DataFrame) -> DataFrame:
    """PIPE-33: day partition from the file name (``MMDD`` + fixed year), then purge listed source × day cells."""
    df = partition_from_filename(raw, "file_name", r"^(\d{2})(\d{2})", year=2020, out="file_day")
    df = df.withColumn("site", F.regexp_extract("link", r".*://([^/]*)", 1))
    # a VALUES relation has a known size, so the grid is broadcast and the facts stay where they are
    cells = ", ".join(f"('{s}', '{d}')" for s in PURGE_SOURCES for d in PURGE_DAYS)
    grid = spark.sql(f"SELECT * FROM VALUES {cells} AS grid(site, file_day)")
    return drop_partitions(df, grid, ["site", "file_day"]).select("id", "site", "file_day", "measurement_day")


def _clean(spark, d):
    return listings_clean(fixtures.raw_listings(spark, d))


def _existing_dim(spark, d):
    return _clean(spark, d).filter(F.col("measurement_day") == "2020-07-10")


def _loaded_facts(spark, d):
    return _clean(spark, d).filter(F.col("measurement_day").isin(*LOADED_DAYS))


QUERIES = {
    "listings_upsert": lambda spark, d: listings_upsert(
        _clean(spark, d).filter(F.col("measurement_day") != "2020-07-10"), _existing_dim(spark, d)
    ),
    "measurements_incremental": lambda spark, d: measurements_incremental(_clean(spark, d), _loaded_facts(spark, d)),
    "partition_maintenance": lambda spark, d: partition_maintenance(spark, fixtures.raw_listings(spark, d)),
}

_CLEAN_VIEW = """
clean AS (
  SELECT link,
    nullif(regexp_extract(link, '.*://([^/]*)', 1), '') AS site,
    CASE WHEN link LIKE '%etuovi.com%' OR link LIKE '%www.vuokraovi.com%' THEN 'fi' ELSE 'bg' END AS country,
    id,
    replace(replace(replace(replace(replace(trim(lower(type)), '1-', 'едно'), '2-', 'дву'), '3-', 'три'), '4-', 'четири'),
      ' апартамент', '') AS type,
    city, labels, available_from,
    replace(replace(replace(replace(replace(replace(trim(lower(place)), 'гр. софия', ''), 'софийска област', ''),
      'българия', ''), '/', ''), ',', ''), 'близо до', '') AS place,
    TRY_CAST(nullif(regexp_extract(replace(area, ' ', ''), '([0-9.]{2,})', 1), '') AS DOUBLE) AS area,
    details,
    TRY_CAST(nullif(regexp_extract(replace(year, ' ', ''), '([0-9]{4})', 1), '') AS DOUBLE) AS year,
    TRY_CAST(replace(lon, ',', '.') AS DOUBLE) AS lon,
    TRY_CAST(replace(lat, ',', '.') AS DOUBLE) AS lat,
    TRY_CAST(lower(trim(is_for_sale)) AS BOOLEAN) AS is_for_sale,
    TRY_CAST(nullif(regexp_extract(replace(price, ' ', ''), '([0-9.]{3,})', 1), '') AS DOUBLE) AS price,
    TRY_CAST(replace(views, 'пъти', '') AS DOUBLE) AS views,
    measurement_day
  FROM listings
  WHERE NOT (link LIKE '%etuovi.com%' OR link LIKE '%www.vuokraovi.com%')
),
clean2 AS (
  SELECT *, coalesce(regexp_matches(type, '(?:стаен|мезонет|ателие)'), false) AS is_apartment FROM clean
)"""

_DIM = ", ".join(DIMENSION_COLUMNS)
_LOADED = ", ".join(f"'{d}'" for d in LOADED_DAYS)

ORACLE = {
    "listings_upsert": with_ctes(F3_LISTINGS, _CLEAN_VIEW) + f"""
SELECT {_DIM} FROM (
  SELECT *, row_number() OVER (PARTITION BY link ORDER BY measurement_day, id) AS rn
  FROM (SELECT DISTINCT {_DIM}, measurement_day FROM clean2 WHERE measurement_day <> '2020-07-10') s
) r
WHERE rn = 1 AND link NOT IN (SELECT link FROM clean2 WHERE measurement_day = '2020-07-10')""",
    "measurements_incremental": with_ctes(F3_LISTINGS, _CLEAN_VIEW) + f"""
SELECT site, id, is_for_sale, price, labels, views, measurement_day FROM clean2
WHERE measurement_day NOT IN ({_LOADED})""",
    "partition_maintenance": with_ctes(F3_LISTINGS) + """
SELECT id, site, file_day, measurement_day FROM (
  SELECT id, regexp_extract(link, '.*://([^/]*)', 1) AS site,
    '2020-' || regexp_extract(file_name, '^([0-9]{2})([0-9]{2})', 1) || '-' ||
      regexp_extract(file_name, '^([0-9]{2})([0-9]{2})', 2) AS file_day,
    measurement_day
  FROM listings
) t
WHERE NOT (site = 'www.listings-a.bg' AND file_day IN ('2020-07-12', '2020-07-13'))""",
}
