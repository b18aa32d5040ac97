"""Stored tables end to end: documents a file, keyed updates, purged cells, the catalog with typed DDL and SQL functions.

Every query writes what it derives from the given tables into a fresh folder of the shared location and reads it back.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from snapmetrics import sql
from snapmetrics.plans.listings import ORACLE as LISTING_ORACLE
from snapmetrics.plans.listings import listings_staged_cast
from snapmetrics.schemas import PRICE_BAR, ensure_table
from snapmetrics.session import scratch_path
from snapmetrics.sources import fixtures
from snapmetrics.sources.fixtures_sql import F3_LISTINGS, F5_PRICES, with_ctes
from snapmetrics.sources.io import partition_from_filename, purge_cells, read_json_docs
from snapmetrics.sources.tables import register_views, table
from snapmetrics.sources.versioned import read_table, replace_table, update_table


def _run(spark: SparkSession, name: str) -> str:
    return scratch_path(spark, f"tables/{name}-{uuid.uuid4().hex[:12]}")


# ---------------------------------------------------------------- SRC-6

REGION_DOC = "id bigint, name string, customers array<struct<key:bigint,name:string>>"


def json_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC-6: one JSON document a file (a nation with all its customers), every seventh cut off, every eleventh empty; read with
    a schema, broken files beside the documents with their reason."""
    path = f"{_run(spark, 'json')}/docs"
    own = F.struct(F.col("c_custkey").alias("key"), F.col("c_name").alias("name"))
    nations = table(spark, sf_dir, "nation").join(table(spark, sf_dir, "customer"), F.col("c_nationkey") == F.col("n_nationkey"), "left")
    held = F.sort_array(F.collect_list(F.when(F.col("c_custkey").isNotNull(), own)))
    docs = nations.groupBy("n_nationkey", "n_name").agg(held.alias("customers"))
    doc = F.to_json(F.struct(F.col("n_nationkey").alias("id"), F.col("n_name").alias("name"), "customers"))
    doc = F.regexp_replace(doc, ",", ",\n ")  # a document spans lines
    n = F.col("n_nationkey")
    broken = F.when(n % 11 == 5, F.lit("")).when(n % 7 == 3, F.substring(doc, F.lit(1), F.length(doc) - 5)).otherwise(doc)
    docs.select(broken.alias("value"), n.alias("n")).repartition("n").write.option("maxRecordsPerFile", 1).partitionBy("n").text(path)
    good, bad = read_json_docs(spark, path, spark.createDataFrame([], REGION_DOC).schema)
    number = F.regexp_extract("path", r"/n=(\d+)/", 1).cast("bigint")
    rows = good.select(number.alias("file"), "id", "name", F.size("customers").alias("n_customers"), F.lit(True).alias("whole"), F.lit(None).cast("string").alias("reason"))
    none = [F.lit(None).cast(t).alias(c) for c, t in (("id", "bigint"), ("name", "string"), ("n_customers", "int"))]
    return rows.unionByName(bad.select(number.alias("file"), *none, F.lit(False).alias("whole"), "reason"))


# ---------------------------------------------------------------- SNK-4, SNK-7


def keyed_updates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SNK-7: customer details, updated by key twice: every seventh customer, then one customer; each update rewrites its keys'
    buckets and switches the table in one step."""
    path = f"{_run(spark, 'updates')}/customers"
    c = table(spark, sf_dir, "customer")
    details = F.to_json(F.struct(F.col("c_name").alias("shortName"), F.col("c_nationkey").alias("nation")))
    replace_table(c.select(F.col("c_custkey").alias("key"), details.alias("details"), F.lit(0).alias("revision")), path, ["key"], 16)
    first = c.filter("c_custkey % 7 = 0").select(F.col("c_custkey").alias("key"), F.concat(F.lit("first "), "c_name").alias("details"), F.lit(1).alias("revision"))
    second = c.filter("c_custkey IN (14, 15) OR c_custkey < 0").select(F.col("c_custkey").alias("key"), F.lit("second").alias("details"), F.lit(2).alias("revision"))
    second = second.unionByName(spark.sql("SELECT -5L AS key, 'nobody' AS details, 2 AS revision"))
    for updates in (first, second):
        update_table(spark, path, updates, ["details", "revision"])
    return read_table(spark, path)


def replaced_listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SNK-4: the typed listings table made again from its staging rows, over a first version from some of them."""
    path = f"{_run(spark, 'replaced')}/listings"
    staged = listings_staged_cast(fixtures.raw_listings(spark, sf_dir))
    replace_table(staged.filter(F.col("id") % 2 == 0), path, ["id"], 8)
    replace_table(staged, path, ["id"], 8)
    return read_table(spark, path)


# ---------------------------------------------------------------- SNK-9

PURGED_WHOLE, PURGED_PART, PURGED_SITE = "2020-07-12", "2020-07-13", "www.listings-a.bg"


def purged_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SNK-9: listings stored by day; of one day all sites' cells are purged, of another one site's; what storage then holds."""
    run = _run(spark, "purge")
    raw = fixtures.raw_listings(spark, sf_dir).select("id", "link", "file_name")
    rows = partition_from_filename(raw, "file_name", r"^(\d{2})(\d{2})", year=2020, out="file_day")
    rows = rows.withColumn("site", F.regexp_extract("link", r".*://([^/]*)", 1))
    rows.select("id", "site", "file_day").write.partitionBy("file_day").parquet(f"{run}/listings")
    cells = rows.select("site").distinct().withColumn("file_day", F.lit(PURGED_WHOLE))
    cells = cells.unionByName(spark.sql(f"SELECT '{PURGED_SITE}' AS site, '{PURGED_PART}' AS file_day"))
    purge_cells(spark, f"{run}/listings", "file_day", cells, ["site", "file_day"], f"{run}/left")
    return spark.read.parquet(f"{run}/listings").select("id", "site", F.col("file_day").cast("string").alias("file_day"))


# ---------------------------------------------------------------- SRC-7, SNK-10, UDF-1


def catalog_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SNK-10, SRC-7, UDF-1: price bars written by SQL from views of the given tables into a table of the typed DDL (made anew),
    then read by SQL with the rounding function."""
    register_views(spark, sf_dir)
    sql.register_functions(spark)
    name = f"price_bars_{uuid.uuid4().hex[:8]}"
    ensure_table(spark, name, PRICE_BAR, f"{_run(spark, 'catalog')}/{name}")
    spark.sql(f"""
INSERT INTO {name}
SELECT n_name, CAST(trunc(o_orderdate, 'month') AS DATE), CAST(sum(floor(o_totalprice)) AS DECIMAL(38, 0)),
  CAST(min_by(o_totalprice, struct(o_orderdate, o_orderkey)) AS DOUBLE), CAST(max_by(o_totalprice, struct(o_orderdate, o_orderkey)) AS DOUBLE),
  CAST(max_by(o_totalprice, struct(o_orderdate, o_orderkey)) AS DOUBLE), CAST(max(o_totalprice) AS DOUBLE), CAST(min(o_totalprice) AS DOUBLE)
FROM orders JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey GROUP BY 1, 2""")
    return spark.sql(f"""
SELECT symbol, count(*) AS n_bars, CAST(sum(volume) AS BIGINT) AS volume, round_numeric(max(high), 1) AS high, round_numeric(min(low), -2) AS low
FROM {name} GROUP BY symbol""")


QUERIES = {
    "json_documents": json_documents,
    "keyed_updates": keyed_updates,
    "replaced_listings": replaced_listings,
    "purged_cells": purged_cells,
    "catalog_sql": catalog_sql,
}

ORACLE = {
    "json_documents": """
SELECT n_nationkey AS file, CASE WHEN reason IS NULL THEN n_nationkey END AS id, CASE WHEN reason IS NULL THEN n_name END AS name,
  CASE WHEN reason IS NULL THEN CAST(n AS INTEGER) END AS n_customers, reason IS NULL AS whole, reason
FROM (
  SELECT CAST(n_nationkey AS BIGINT) AS n_nationkey, n_name, count(c_custkey) AS n, CASE WHEN n_nationkey % 11 = 5 THEN 'empty'
    WHEN n_nationkey % 7 = 3 THEN 'not a JSON document of the schema' END AS reason
  FROM nation LEFT JOIN customer ON c_nationkey = n_nationkey GROUP BY 1, 2, 4) d""",
    "keyed_updates": """
SELECT c_custkey AS key, CASE WHEN c_custkey IN (14, 15) THEN 'second' WHEN c_custkey % 7 = 0 THEN 'first ' || c_name
    ELSE '{"shortName":"' || c_name || '","nation":' || c_nationkey || '}' END AS details,
  CASE WHEN c_custkey IN (14, 15) THEN 2 WHEN c_custkey % 7 = 0 THEN 1 ELSE 0 END AS revision
FROM customer""",
    "replaced_listings": LISTING_ORACLE["listings_staged_cast"],
    "purged_cells": with_ctes(F3_LISTINGS) + f"""
SELECT id, site, file_day FROM (
  SELECT id, regexp_extract(link, '.*://([^/]*)', 1) AS site, '2020-' || file_name[1:2] || '-' || file_name[3:4] AS file_day FROM listings) f
WHERE file_day <> '{PURGED_WHOLE}' AND NOT (file_day = '{PURGED_PART}' AND site = '{PURGED_SITE}')""",
    "catalog_sql": with_ctes(F5_PRICES) + """
SELECT symbol, count(*) AS n_bars, CAST(sum(volume) AS BIGINT) AS volume, round(CAST(max(high) AS DECIMAL(38, 10)), 1) AS high,
  round(CAST(min(low) AS DECIMAL(38, 10)), -2) AS low
FROM prices GROUP BY symbol""",
}
