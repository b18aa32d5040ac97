"""Access to the driver's parquet tables.

Every query reads whole tables through ``table(spark, sf_dir, name)``; column pruning and filter pushdown reach
the parquet scan because the plans only ``select``/``filter`` on top of it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


_RESOLVED: dict[tuple[str, str], DataFrame] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The driver table as a DataFrame; the resolved relation (file listing, footer schema) is kept per
    application, as the tables are read-only."""
    if name not in TABLES:
        raise ValueError(f"unknown table {name!r}")
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    key = (spark.sparkContext.applicationId, path)
    df = _RESOLVED.get(key)
    if df is None:
        df = spark.read.parquet(path)
        _RESOLVED[key] = df
    return df


def spread(df: DataFrame) -> DataFrame:
    """The rows dealt in turn over tasks, for work that costs far more than reading its bytes: a scan is cut by bytes, so a
    small file is one task however many cores there are. Dealt by no key, so no group of copies weighs."""
    spark = df.sparkSession
    return df.repartition(max(int(spark.conf.get("spark.sql.shuffle.partitions")), 3 * spark.sparkContext.defaultParallelism))


def register_views(spark: SparkSession, sf_dir: str) -> None:
    """Expose every driver table as a temp view of the same name (SRC-7)."""
    for name in TABLES:
        table(spark, sf_dir, name).createOrReplaceTempView(name)
