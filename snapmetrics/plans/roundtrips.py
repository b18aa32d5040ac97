"""Sources and sinks exercised by write-then-read round trips (SRC-1..6, SRC-8, SNK-1..3, SNK-10..12).

Each query writes a fixture into a fresh folder under the shared checkpoint location, reads it back with the
library's reader, and returns what was read; the oracle is the fixture itself.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from snapmetrics.plans.snapshots import ORACLE as SNAP_ORACLE
from snapmetrics.plans.snapshots import article_popularity
from snapmetrics.plans.stores import ORACLE as STORE_ORACLE
from snapmetrics.plans.listings import ORACLE as LISTING_ORACLE
from snapmetrics.plans.listings import listings_staged_cast
from snapmetrics.plans.stores import STORE_SCHEMA, flat_from_parsed, store_buffers, store_services_exploded, stores_flat
from snapmetrics.schemas import STAGED_WEEKLY_LISTING
from snapmetrics.session import scratch_path
from snapmetrics.sources import fixtures
from snapmetrics.operators.joins import only_known
from snapmetrics.sources.fixtures_sql import F1_SNAPSHOTS, F3_LISTINGS, with_ctes
from snapmetrics.sources.io import (
    NULL_TEXT,
    append_fact,
    conform_to_table,
    drop_partitions,
    load_staging,
    partition_from_filename,
    read_snapshots,
    read_strings,
    read_typed,
    read_whole_text,
    save_ctas,
    write_partitioned,
    write_tsv,
)
from snapmetrics.sources.tables import table

SNAPSHOT_TEXT_COLUMNS = [
    "snapshot_id", "link", "title", "tags", "category", "views", "comments", "created_timestamp", "visited_timestamp",
]
ENCODINGS = ["UTF-8", "UTF-16"]
PAGES_PER_FILE = 1_000
REWRITTEN_DAY, PURGED_DAY = "2020-07-14", "2020-07-16"


def _run(spark: SparkSession, name: str) -> str:
    return scratch_path(spark, f"roundtrip/{name}-{uuid.uuid4().hex[:12]}")


def source_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SNK-2 -> SRC-1/2/3: snapshots written as a headered TSV lake (one folder per site and visit day), in UTF-8
    and UTF-16, read back as all-string columns with site and day from the folder names."""
    run = _run(spark, "tsv")
    snaps = fixtures.snapshots(spark, sf_dir).withColumn("visit_day", F.substring("visited_timestamp", 1, 10))
    out = None
    for enc in ENCODINGS:
        root = f"{run}/{enc}"
        write_tsv(snaps, root, partition_by=["site", "visit_day"], encoding=enc, null_value=NULL_TEXT)
        df = read_snapshots(spark, root, SNAPSHOT_TEXT_COLUMNS, encoding=enc, pattern="*/*/*.csv",
                            null_value=NULL_TEXT).withColumn("encoding", F.lit(enc))
        out = df if out is None else out.unionByName(df)
    return out


def json_docs_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SNK-11 -> SRC-6: store documents, one JSON document a line and many a file, read with a fixed schema, then flattened
    like ``stores_flat`` (``read_json_docs`` reads a folder of one-document files)."""
    path = f"{_run(spark, 'json')}/docs"
    fixtures.store_documents(spark, sf_dir).select(F.col("doc").alias("value")).write.text(path)
    return flat_from_parsed(spark.read.schema(STORE_SCHEMA).json(path))


def wholetext_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC-5: pages stored as JSON lines, at most ``PAGES_PER_FILE`` a file, scanned as whole texts and taken apart."""
    path = f"{_run(spark, 'text')}/pages"
    table(spark, sf_dir, "pages").select("page_id", "html").write.option("maxRecordsPerFile", PAGES_PER_FILE).json(path)
    lines = read_whole_text(spark, path).select(F.explode(F.split("value", "\n")).alias("line")).filter("line <> ''")
    page = lines.select(F.from_json("line", "page_id bigint, html string").alias("p")).select("p.*")
    return page.select("page_id", F.length("html").alias("n_chars"), F.md5("html").alias("digest"))


def csv_readers_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SNK-2 -> SRC-3, SRC-4, SRC-8: customers as headered CSV, read as texts and with inferred types; the typed rows conform
    to the table they came from (a column it lacks is dropped, one it has more is null)."""
    path = f"{_run(spark, 'csv')}/customer"
    c = table(spark, sf_dir, "customer")
    c.select("c_custkey", "c_name", "c_nationkey", F.lit("x").alias("extra")).write.option("header", "true").csv(path)
    text = read_strings(spark, path).select("c_custkey", "c_name", F.lit("text").alias("read_as"), F.lit(None).cast("string").alias("c_mktsegment"))
    typed = conform_to_table(read_typed(spark, path), c)
    typed = typed.select(F.col("c_custkey").cast("string"), "c_name", F.concat(F.lit("typed "), F.typeof("c_custkey")).alias("read_as"), "c_mktsegment")
    return text.unionByName(typed)


def writers_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SNK-3, SNK-5, SNK-8, SNK-9, JN-6: staging cleared and refilled, facts appended in two loads, one day rewritten, one
    source purged, and only facts of known listings kept."""
    run = _run(spark, "writers")
    raw = fixtures.raw_listings(spark, sf_dir).select("id", "link", "views", "measurement_day", "file_name")
    load_staging(raw.limit(5), f"{run}/staging")
    load_staging(raw, f"{run}/staging")
    staged = partition_from_filename(spark.read.parquet(f"{run}/staging"), "file_name", r"^(\d{2})(\d{2})", year=2020, out="file_day")
    late = F.col("file_day") >= REWRITTEN_DAY
    append_fact(staged.filter(~late), f"{run}/facts", ["file_day"])
    append_fact(staged.filter(late), f"{run}/facts", ["file_day"])
    facts = spark.read.parquet(f"{run}/facts").withColumn("file_day", F.col("file_day").cast("string"))
    again = facts.filter(F.col("file_day") == REWRITTEN_DAY).withColumn("views", F.lit("0"))
    write_partitioned(again.select(*staged.columns), f"{run}/rewritten", "file_day")
    write_partitioned(spark.read.parquet(f"{run}/rewritten").select(*staged.columns), f"{run}/facts", "file_day")
    facts = spark.read.parquet(f"{run}/facts").withColumn("file_day", F.col("file_day").cast("string"))
    grid = spark.sql(f"SELECT * FROM VALUES ('{PURGED_DAY}') AS grid(file_day)")
    known = staged.filter(F.col("id").cast("long") % 2 == 0).select("id")
    return only_known(drop_partitions(facts, grid, ["file_day"]), known, ["id"]).select("id", "views", "file_day")


def store_tables_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SNK-11, SNK-12: the flat stores, their services and their buffers written as three tables; read back, per store:
    city, named services and buffers."""
    run, docs = _run(spark, "stores"), fixtures.store_documents(spark, sf_dir)
    for name, df in (("stores", stores_flat(docs)), ("services", store_services_exploded(docs)), ("buffers", store_buffers(docs))):
        load_staging(df, f"{run}/{name}")
    read = lambda name: spark.read.parquet(f"{run}/{name}")
    services = read("services").groupBy("store_id").agg(F.count("display_name").alias("n_services"))
    buffers = read("buffers").groupBy("store_id").agg(F.count("wkt").alias("n_buffers"))
    return read("stores").select("store_id", "city").join(services, "store_id").join(buffers, "store_id")


def staged_listings_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SNK-4, SNK-10: the typed listings written to a table of their staged columns and read back."""
    path = f"{_run(spark, 'staged')}/listings"
    staged = listings_staged_cast(fixtures.raw_listings(spark, sf_dir))
    assert sorted(staged.columns) == sorted(STAGED_WEEKLY_LISTING.fieldNames())
    append_fact(staged, path)
    return spark.read.parquet(path)


def ctas_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SNK-1: ``CREATE TABLE IF NOT EXISTS … AS`` to an external parquet location; a second call is a no-op."""
    run = _run(spark, "ctas")
    name = f"popular_articles_{uuid.uuid4().hex[:8]}"
    df = article_popularity(fixtures.snapshots(spark, sf_dir))
    save_ctas(spark, df, name, f"{run}/popular_articles")
    return save_ctas(spark, df, name, f"{run}/popular_articles")


QUERIES = {
    "source_roundtrip": source_roundtrip,
    "json_docs_roundtrip": json_docs_roundtrip,
    "wholetext_roundtrip": wholetext_roundtrip,
    "csv_readers_roundtrip": csv_readers_roundtrip,
    "writers_roundtrip": writers_roundtrip,
    "store_tables_roundtrip": store_tables_roundtrip,
    "staged_listings_roundtrip": staged_listings_roundtrip,
    "ctas_roundtrip": ctas_roundtrip,
}

_TEXT = ", ".join(
    f"CAST({c} AS VARCHAR) AS {c}" for c in SNAPSHOT_TEXT_COLUMNS
)

ORACLE = {
    "source_roundtrip": with_ctes(F1_SNAPSHOTS) + " UNION ALL ".join(
        f"SELECT {_TEXT}, site, substr(visited_timestamp, 1, 10) AS visit_day, '{enc}' AS encoding FROM snapshots"
        for enc in ENCODINGS
    ),
    "json_docs_roundtrip": STORE_ORACLE["stores_flat"],
    "wholetext_roundtrip": "SELECT page_id, CAST(length(html) AS INTEGER) AS n_chars, md5(html) AS digest FROM pages",
    "ctas_roundtrip": SNAP_ORACLE["article_popularity"],
    "staged_listings_roundtrip": LISTING_ORACLE["listings_staged_cast"],
    "store_tables_roundtrip": f"""
SELECT f.store_id, f.city, CAST(count(e.display_name) AS BIGINT) AS n_services, CAST(2 AS BIGINT) AS n_buffers
FROM ({STORE_ORACLE['stores_flat']}) f JOIN ({STORE_ORACLE['store_services_exploded']}) e ON e.store_id = f.store_id GROUP BY ALL""",
    "csv_readers_roundtrip": """
SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name, r AS read_as, CAST(NULL AS VARCHAR) AS c_mktsegment
FROM customer, (VALUES ('text'), ('typed bigint')) v(r)""",
    "writers_roundtrip": with_ctes(F3_LISTINGS) + f"""
SELECT id, CASE WHEN day = '{REWRITTEN_DAY}' THEN '0' ELSE views END AS views, day AS file_day
FROM (SELECT id, views, '2020-' || file_name[1:2] || '-' || file_name[3:4] AS day FROM listings) f
WHERE day <> '{PURGED_DAY}' AND CAST(id AS BIGINT) % 2 = 0""",
}
