"""Keyed tables that are updated in place of their buckets: copy-on-write files and one pointer.

``data/version=V/bucket=B/`` holds a bucket's rows as of version V. ``current/V`` is the list of (bucket, version) that make up
the table as of V; the highest V is the table. A writer writes new files beside the old ones, then the list below a
temporary name, and renames it: readers see the old table or the new one, and a writer that fails leaves the old one.
One writer at a time. Lists have one row a bucket.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from snapmetrics.operators.joins import update_by_key

BUCKETS = 64


def _bucket(keys: Sequence[str], buckets: int):
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def _fs(spark: SparkSession, path: str):
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark._jsc.hadoopConfiguration()), jpath


def versions(spark: SparkSession, path: str) -> list[int]:
    """Versions of the table, oldest first."""
    fs, jpath = _fs(spark, f"{path}/current")
    if not fs.exists(jpath):
        return []
    return sorted(int(s.getPath().getName()) for s in fs.listStatus(jpath) if s.getPath().getName().isdigit())


def _list(spark: SparkSession, path: str, version: int) -> dict:
    return json.loads(spark.read.text(f"{path}/current/{version}", wholetext=True).first()[0])


def _switch(spark: SparkSession, path: str, version: int, listed: dict) -> None:
    new = f"{path}/current/_{uuid.uuid4().hex}"
    spark.createDataFrame([(json.dumps(listed),)], "value string").coalesce(1).write.text(new)
    fs, source = _fs(spark, new)
    if not fs.rename(source, _fs(spark, f"{path}/current/{version}")[1]):
        raise RuntimeError(f"version {version} of {path} was written by another job")


def _put(df: DataFrame, path: str, version: int, keys: Sequence[str], buckets: int) -> list[int]:
    """Write a version's buckets; their numbers."""
    folder = f"{path}/data/version={version}"
    laid = df.withColumn("bucket", _bucket(keys, buckets))
    laid.repartition(buckets, "bucket").write.mode("overwrite").partitionBy("bucket").parquet(folder)
    fs, jpath = _fs(df.sparkSession, folder)
    return sorted(int(s.getPath().getName().split("=")[1]) for s in fs.listStatus(jpath) if s.getPath().getName().startswith("bucket="))


def replace_table(df: DataFrame, path: str, keys: Sequence[str], buckets: int = BUCKETS) -> None:
    """SNK-4: the whole table anew, switched in one step (also its first version)."""
    spark = df.sparkSession
    version = max(versions(spark, path), default=-1) + 1
    written = _put(df, path, version, keys, buckets)
    _switch(spark, path, version, {"keys": list(keys), "buckets": buckets, "schema": df.schema.jsonValue(), "at": {str(b): version for b in written}})


def _read(spark: SparkSession, path: str, listed: dict, only: Sequence[int] | None = None) -> DataFrame:
    from pyspark.sql.types import StructType

    schema = StructType.fromJson(listed["schema"])
    paths = [f"{path}/data/version={v}/bucket={b}" for b, v in listed["at"].items() if only is None or int(b) in only]
    if not paths:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*paths)


def read_table(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """The newest version of the table, or a given one."""
    return _read(spark, path, _list(spark, path, versions(spark, path)[-1] if version is None else version))


def update_table(spark: SparkSession, path: str, updates: DataFrame, cols: Sequence[str]) -> list[int]:
    """SNK-7: set ``cols`` of the rows whose key ``updates`` holds. Reads and rewrites the buckets of these keys only, then
    switches; returns the buckets. Keys that the table lacks change nothing."""
    at = versions(spark, path)[-1]
    listed = _list(spark, path, at)
    keys, buckets = listed["keys"], listed["buckets"]
    found = [r[0] for r in updates.select(_bucket(keys, buckets).alias("b")).distinct().collect()]  # at most ``buckets``
    touched = [b for b in found if str(b) in listed["at"]]
    base = _read(spark, path, listed, touched)
    written = _put(update_by_key(base, updates, keys, cols).select(*base.columns), path, at + 1, keys, buckets) if touched else []
    _switch(spark, path, at + 1, {**listed, "at": {**listed["at"], **{str(b): at + 1 for b in written}}})
    return sorted(touched)
