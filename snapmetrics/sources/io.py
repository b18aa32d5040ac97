"""Sources and sinks (SRC-*, SNK-*): readers and writers of the landing formats, written as plain Spark I/O.

Paths are whatever the cluster uses (object store or shared file system); nothing here uses a machine-local folder.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

# The 16 snapshot columns in landing order.
ARTICLE_COLUMNS = [
    "comments", "views", "shares", "created_timestamp", "visited_timestamp", "tags", "section", "title",
    "subtitle", "category", "link", "article_text", "author", "thumbs_down", "thumbs_up", "location",
]
# The 16 listing columns in landing order.
LISTING_COLUMNS = [
    "link", "id", "type", "city", "place", "is_for_sale", "price", "area", "details", "labels", "year",
    "available_from", "views", "lon", "lat", "measurement_day",
]


def string_schema(columns: Sequence[str]) -> StructType:
    return StructType([StructField(c, StringType(), True) for c in columns])


NULL_TEXT = "\\N"  # null marker in written TSV, so empty strings survive a round trip


def read_snapshots(spark: SparkSession, root: str, columns: Sequence[str] = ARTICLE_COLUMNS,
                   encoding: str = "UTF-8", pattern: str = "*/*/*.tsv", null_value: str = "") -> DataFrame:
    """SRC-1/SRC-2: headered TSV lake ``<root>/<site>/<date>/<site>_<date>_<h>h.tsv``; ``site`` and ``visit_day``
    from the two directory levels. UTF-16 files need ``multiLine`` (Spark's line reader is byte-oriented)."""
    reader = (
        spark.read.option("sep", "\t").option("header", "true").option("encoding", encoding)
        .option("nullValue", null_value).option("basePath", root)
    )
    if encoding.upper().startswith("UTF-16"):
        reader = reader.option("multiLine", "true")
    df = reader.schema(string_schema(columns)).csv(f"{root.rstrip('/')}/{pattern}")
    return with_path_partitions(df, ["site", "visit_day"]).select(*columns, "site", "visit_day")


def with_path_partitions(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """SRC-2: name the unnamed directory levels above each file (``partition_0`` … in the reference)."""
    path = F.col("_metadata.file_path")
    out = df
    n = len(names)
    pattern = "/" + "/".join(["([^/]+)"] * n) + "/[^/]+$"
    for i, name in enumerate(names):
        # directory i of the last n directories before the file name; a ``key=`` prefix (Hive layout) is dropped
        part = F.regexp_extract(path, pattern, i + 1)
        out = out.withColumn(name, F.regexp_replace(part, "^[^=/]*=", ""))
    return out


def read_strings(spark: SparkSession, path: str, sep: str = ",", columns: Sequence[str] | None = None) -> DataFrame:
    """SRC-3: headered CSV as all-string columns (no inference)."""
    r = spark.read.option("sep", sep).option("header", "true")
    if columns:
        r = r.schema(string_schema(columns))
    else:
        r = r.option("inferSchema", "false")
    return r.csv(path)


def read_typed(spark: SparkSession, path: str, sep: str = ",") -> DataFrame:
    """SRC-4: headered CSV/TSV with inferred types."""
    return spark.read.option("sep", sep).option("header", "true").option("inferSchema", "true").csv(path)


def read_whole_text(spark: SparkSession, path: str) -> DataFrame:
    """SRC-5: one row per file (``value``) with its path, for scanning embedded content."""
    return spark.read.text(path, wholetext=True).withColumn("path", F.col("_metadata.file_path"))


def read_json_docs(spark: SparkSession, path: str, schema: StructType) -> tuple[DataFrame, DataFrame]:
    """SRC-6: a folder of one-JSON-document-per-file -> (documents with their ``path``, broken files).

    Files are read whole; Spark packs small ones together into a task (``spark.sql.files.maxPartitionBytes``), so a million
    files are not a million tasks. A file that does not parse is no document: it stands in the second result with its
    path, its text and the reason. (Spark reads no row from a file of zero bytes: it is in neither result.)"""
    files = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("text"))
    parsing = StructType([*schema.fields, StructField("_broken", StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_broken"}
    read = files.withColumn("doc", F.from_json("text", parsing, options))
    blank = F.col("text").rlike(r"^\s*$")
    reason = F.when(blank, "empty").when(F.col("doc._broken").isNotNull() | F.col("doc").isNull(), "not a JSON document of the schema")
    read = read.withColumn("reason", reason)
    good = read.filter("reason IS NULL").select("path", *[F.col("doc")[f.name].alias(f.name) for f in schema.fields])
    return good, read.filter("reason IS NOT NULL").select("path", "text", "reason")


def conform(df: DataFrame, columns: Sequence[str], types: dict[str, str] | None = None) -> DataFrame:
    """PRJ-1 / SRC-8: project to a fixed ordered column list; absent columns become typed nulls."""
    types = types or {}
    have = set(df.columns)
    return df.select(
        *[
            (F.col(c) if c in have else F.lit(None)).cast(types.get(c, "string")).alias(c)
            if (c not in have or c in types) else F.col(c)
            for c in columns
        ]
    )


def conform_to_table(df: DataFrame, target: DataFrame) -> DataFrame:
    """SRC-8: project ``df`` to the target table's columns and types."""
    return conform(df, target.columns, {f.name: f.dataType.simpleString() for f in target.schema.fields})


def write_tsv(df: DataFrame, path: str, mode: str = "overwrite", partition_by: Sequence[str] = (),
              encoding: str = "UTF-8", null_value: str = "") -> None:
    """SNK-2: headered TSV (optionally one folder level per partition column; rows are dealt by it first, large values over
    several tasks, so a task writes a few files instead of one in every folder)."""
    if partition_by:
        df = df.hint("rebalance", *partition_by)
    w = df.write.mode(mode).option("sep", "\t").option("header", "true").option("encoding", encoding)
    w = w.option("nullValue", null_value)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.csv(path)


def save_ctas(spark: SparkSession, df: DataFrame, name: str, path: str) -> DataFrame:
    """SNK-1: ``CREATE TABLE IF NOT EXISTS … USING parquet LOCATION … AS`` — an existing table is left as is."""
    if not spark.catalog.tableExists(name):
        df.write.mode("errorifexists").format("parquet").option("path", path).saveAsTable(name)
    return spark.table(name)


def load_staging(df: DataFrame, path: str) -> None:
    """SNK-3: clear and refill a staging table (partitioned writes replace the 100,000-row slices)."""
    df.write.mode("overwrite").parquet(path)


def append_fact(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """SNK-5: append rows to a fact table."""
    w = df.write.mode("append")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def partition_from_filename(df: DataFrame, file_col: str, regex: str, year: int, out: str = "measurement_day") -> DataFrame:
    """SNK-8: ``MMDD`` from the file name + a fixed year -> ``yyyy-MM-dd`` partition value."""
    f = F.col(file_col)
    return df.withColumn(
        out,
        F.concat(F.lit(f"{year}-"), F.regexp_extract(f, regex, 1), F.lit("-"), F.regexp_extract(f, regex, 2)),
    )


def write_partitioned(df: DataFrame, path: str, partition_col: str) -> None:
    """SNK-8/SNK-9 write: dynamic partition overwrite replaces only the partitions present in ``df``."""
    (
        df.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(partition_col)
        .parquet(path)
    )


def drop_partitions(df: DataFrame, grid: DataFrame, keys: Sequence[str]) -> DataFrame:
    """SNK-9: rows outside the listed (source, day) cells (anti join against the grid)."""
    return df.join(grid.select(*keys), list(keys), "left_anti")


def purge_cells(spark: SparkSession, path: str, partition_col: str, grid: DataFrame, keys: Sequence[str], scratch: str) -> None:
    """SNK-9 on storage: delete the rows of the listed cells (``keys``, the partition column among them) from a table laid out
    by ``partition_col``. Only partitions that a cell names are read; what is left of them is written to ``scratch`` first and
    put in their place, and a partition of which nothing is left loses its folder. Partitions without a listed cell
    are not touched. The names of touched partitions come to the driver."""
    def folders(df: DataFrame) -> dict[str, str]:
        at = df.select(F.col(partition_col).cast("string").alias("p"), F.regexp_replace("_metadata.file_path", "/[^/]*$", "").alias("f"))
        return {r["p"]: r["f"] for r in at.distinct().collect()}

    days = [r[0] for r in grid.select(F.col(partition_col).cast("string")).distinct().collect()]
    touched = spark.read.option("recursiveFileLookup", "false").parquet(path).filter(F.col(partition_col).cast("string").isin(days))
    there = folders(touched)
    same = [F.col(f"r.{k}").cast("string") == F.col(f"g.{k}").cast("string") for k in keys]
    on = same[0]
    for s in same[1:]:
        on = on & s
    left = touched.alias("r").join(grid.alias("g"), on, "left_anti")
    left.write.mode("overwrite").parquet(scratch)
    left = spark.read.schema(touched.schema).parquet(scratch)
    write_partitioned(left.select(*touched.columns), path, partition_col)
    for day in set(there) - {r[0] for r in left.select(F.col(partition_col).cast("string")).distinct().collect()}:
        jpath = spark._jvm.org.apache.hadoop.fs.Path(there[day])
        jpath.getFileSystem(spark._jsc.hadoopConfiguration()).delete(jpath, True)
