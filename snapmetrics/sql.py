"""SQL surface: the analyst queries as Spark SQL over temp views.

``register_views`` exposes the snapshot and price tables plus the balanced per-snapshot ``deltas`` view with all columns of a snapshot (the
chunked operator — plain ``lag() over (partition by link)`` in SQL would give a hot link to one task), so the
reference's analyst SQL runs on Spark with only the window part replaced by the view. ``register_functions`` adds
the rounding rule of its ``ROUND(float, int)`` function as a SQL function.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from snapmetrics.plans.prices import with_sector
from snapmetrics.plans.snapshots import DEFAULT_YEAR, source, with_deltas
from snapmetrics.session import configure
from snapmetrics.sources import fixtures


#: DECIMAL(38, 10) holds ten fraction digits; from there on nothing is left to round.
DIGITS = 10


def register_functions(spark: SparkSession) -> None:
    """UDF-1: SQL function ``round_numeric(x, n)`` = ``ROUND(x::numeric, n)`` — the double goes through DECIMAL first (a SQL
    function, inlined by the analyzer: no Python). More than ``DIGITS`` digits leave x as it is."""
    cases = " ".join(f"WHEN {n} THEN CAST(round(CAST(x AS DECIMAL(38, {DIGITS})), {n}) AS DOUBLE)" for n in range(-DIGITS, DIGITS + 1))
    spark.sql(
        "CREATE OR REPLACE TEMPORARY FUNCTION round_numeric(x DOUBLE, n INT) RETURNS DOUBLE "
        f"RETURN CASE n {cases} ELSE CASE WHEN n > {DIGITS} THEN x WHEN n IS NOT NULL AND x IS NOT NULL THEN 0D END END"
    )


def register_views(spark: SparkSession, sf_dir: str, year: int | None = DEFAULT_YEAR) -> None:
    """Temp views ``raw`` (snapshots), ``deltas`` (per-snapshot deltas), ``sp500_companies`` (with ``sector``) and
    ``price_actions``."""
    configure(spark)
    snaps = fixtures.snapshots(spark, sf_dir)
    snaps.createOrReplaceTempView("raw")
    deltas = with_deltas(source(snaps, year)).drop("visited_timestamp").withColumnRenamed("visited_ts", "visited_timestamp")
    deltas.createOrReplaceTempView("deltas")
    with_sector(fixtures.companies(spark, sf_dir)).createOrReplaceTempView("sp500_companies")
    fixtures.prices(spark, sf_dir).createOrReplaceTempView("price_actions")


# The batch queries of the same names as Spark SQL over the views: grouping sets of the same sums, no join back to ``raw``.
DAILY_VIEWS_PER_SITE = """
SELECT site, CAST(visited_timestamp AS DATE) AS date, sum(comments_generated) AS sum_comments, sum(views_generated) AS sum_views
FROM deltas GROUP BY ALL
"""

ARTICLE_POPULARITY = """
WITH per_link AS (
  SELECT site, CAST(visited_timestamp AS DATE) AS date, link, title, trim(tags) AS tags,
    sum(comments_generated) AS sum_comments, sum(views_generated) AS sum_views
  FROM deltas GROUP BY ALL
), per_site AS (
  SELECT site AS at, date AS day, sum(sum_comments) AS site_sum_comments, sum(sum_views) AS site_sum_views FROM per_link GROUP BY ALL
)
SELECT site, date, link, title, tags,
  sum_comments, site_sum_comments, round_numeric(try_divide(100.0 * sum_comments, site_sum_comments), 1) AS share_comments,
  sum_views, site_sum_views, round_numeric(try_divide(100.0 * sum_views, site_sum_views), 1) AS share_views
FROM per_link LEFT JOIN per_site ON at <=> site AND day <=> date
"""

SECTOR_SUMMARY = """
SELECT sector, sum(cap) AS sum_market_cap_mln, count(*) AS companies_count, avg(cap) AS avg_market_cap_mln,
  sum(weight) AS sum_weight, avg(weight) AS avg_weight
FROM (
  SELECT sector, weight, CAST(round(CAST(details.marketCap AS DECIMAL(38, 0)) / 1000000) AS BIGINT) AS cap
  FROM (SELECT sector, weight, from_json(details, 'marketCap string') AS details FROM sp500_companies)
  WHERE details.marketCap IS NOT NULL
) GROUP BY sector
"""


def run(spark: SparkSession, sf_dir: str, sql: str) -> DataFrame:
    register_functions(spark)
    register_views(spark, sf_dir)
    return spark.sql(sql)
