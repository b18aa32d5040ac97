"""Free-text place -> gazetteer matching (PIPE-18) and gazetteer building from crawled pages (PIPE-32)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapmetrics.functions.text import strip
from snapmetrics.operators.joins import only_new
from snapmetrics.sources import fixtures
from snapmetrics.sources.fixture_exprs import GAZETTEER, PLACE_RECORDS

GRAM = 3  # characters of a name that index it


def match_places(records: DataFrame, gazetteer: DataFrame, place: str = "place", region: str = "region",
                 max_position: int | None = None) -> DataFrame:
    """JN-7: attach the gazetteer row whose name occurs earliest in the record's place, within its region.

    Ties: village before town, then gazetteer order (``gorder``). Plain substring match, no word boundary;
    ``max_position``, if given, is the last start (from 0, exclusive) that counts.

    A name can only occur where its first characters do: names are keyed by region and their first ``GRAM``
    characters (fewer for shorter names), the distinct (region, place) texts by the characters they hold, and the two meet
    in an equi-join. The first match is a ``min`` per text, joined back to the records, so repeated records stay.
    """
    rank = F.when(F.trim("settlement_type") == "с", F.lit(0)).when(F.trim("settlement_type") == "гр", F.lit(1))
    g_region = F.when(F.trim("mun") == "София-град", F.lit("София-град")).otherwise(F.col("region"))
    name = F.lower(strip("name"))
    g = gazetteer.select(
        F.lower(strip(g_region)).alias("_region"), F.substring(name, 1, GRAM).alias("_gram"), name.alias("_name"),
        rank.alias("_rank"), F.col("gorder").alias("_order"),
        F.struct(F.col("name").alias("city_clean"), F.col("mun").alias("mun_clean"), "lon", "lat").alias("_g"),
    ).filter(F.col("_rank").isNotNull() & (F.length("_name") > 0))
    keyed = records.withColumns({"_place": F.lower(strip(place)), "_region": F.lower(strip(region))})
    texts = keyed.select("_region", "_place").distinct()
    size = F.length("_place")
    grams = F.array_distinct(F.flatten(F.transform(
        F.sequence(F.lit(1), F.lit(GRAM)),
        lambda n: F.when(size >= n, F.transform(F.sequence(F.lit(1), size - n + 1), lambda i: F.substring(F.col("_place"), i, n))).otherwise(F.array().cast("array<string>")),
    )))
    at = F.call_function("instr", F.col("_place"), F.col("_name")) - 1
    hits = texts.select("_region", "_place", F.explode(grams).alias("_gram")).join(g, ["_region", "_gram"]).withColumn("_at", at)
    hits = hits.filter(F.col("_at") >= 0 if max_position is None else (F.col("_at") >= 0) & (F.col("_at") < max_position))
    first = hits.groupBy("_region", "_place").agg(F.min_by("_g", F.struct("_at", "_rank", "_order")).alias("_best"))
    best = keyed.join(first, ["_region", "_place"], "left")
    return best.select(*records.columns, *[F.col("_best")[c].alias(c) for c in ("city_clean", "mun_clean", "lon", "lat")])


def normalise_region(c) -> F.Column:
    """STR-19 (region): drop ``област ``; the capital's names -> ``София-област``."""
    s = F.replace(c, F.lit("област "), F.lit(""))
    return F.when(s.isin("София (столица)", "София"), F.lit("София-област")).otherwise(s)


def normalise_mun(c) -> F.Column:
    """STR-19 (municipality): drop ``община ``; ``Столична`` -> ``София-град``."""
    s = F.replace(c, F.lit("община "), F.lit(""))
    return F.when(s == "Столична", F.lit("София-град")).otherwise(s)


def gazetteer_build(pages: DataFrame, done: DataFrame) -> DataFrame:
    """PIPE-32: gazetteer rows from crawled settlement pages whose link is not done yet."""
    todo = only_new(pages, done, ["link"])
    rest = F.split_part("title", F.lit(" - "), F.lit(2))
    return todo.select(
        "link",
        F.split_part("title", F.lit(" - "), F.lit(1)).alias("place_name"),
        normalise_mun(F.split_part(rest, F.lit(", "), F.lit(2))).alias("mun"),
        normalise_region(F.split_part(rest, F.lit(", "), F.lit(1))).alias("region"),
        F.regexp_extract("page_text", r'"longitude":[^0-9.]*([0-9.]+)', 1).alias("lon"),
        F.regexp_extract("page_text", r'"latitude":[^0-9.]*([0-9.]+)', 1).alias("lat"),
        F.split_part(rest, F.lit(", ЕКАТТЕ "), F.lit(2)).alias("ekatte"),
    )


QUERIES = {
    "match_places": lambda spark, d: match_places(fixtures.place_records(spark, d), fixtures.gazetteer(spark, d)),
    "gazetteer_build": lambda spark, d: gazetteer_build(
        fixtures.gazetteer(spark, d), fixtures.gazetteer(spark, d).filter(F.col("gorder") % 4 == 0).select("link")
    ),
}

_GAZ = "gaz AS (SELECT " + ", ".join(GAZETTEER) + " FROM nation JOIN region ON n_regionkey = r_regionkey)"
_REC = (
    "rec AS (SELECT " + ", ".join(PLACE_RECORDS)
    + " FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)"
)

ORACLE = {
    "match_places": f"""
WITH {_GAZ}, {_REC},
cand AS (
  SELECT rec.rid, gaz.name, gaz.mun, gaz.lon, gaz.lat,
    instr(lower(trim(rec.place)), lower(trim(gaz.name))) - 1 AS pos,
    CASE WHEN trim(gaz.settlement_type) = 'с' THEN 0 ELSE 1 END AS trank, gaz.gorder
  FROM rec JOIN gaz
    ON lower(trim(CASE WHEN trim(gaz.mun) = 'София-град' THEN 'София-град' ELSE gaz.region END)) = lower(trim(rec.region))
   AND trim(gaz.settlement_type) IN ('с', 'гр')
   AND instr(lower(trim(rec.place)), lower(trim(gaz.name))) >= 1
),
best AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY rid ORDER BY pos, trank, gorder) AS rn FROM cand
  ) WHERE rn = 1
)
SELECT rec.rid, rec.region, rec.place, best.name AS city_clean, best.mun AS mun_clean, best.lon, best.lat
FROM rec LEFT JOIN best ON rec.rid = best.rid""",
    "gazetteer_build": f"""
WITH {_GAZ}
SELECT link,
  split_part(title, ' - ', 1) AS place_name,
  CASE WHEN replace(split_part(split_part(title, ' - ', 2), ', ', 2), 'община ', '') = 'Столична' THEN 'София-град'
       ELSE replace(split_part(split_part(title, ' - ', 2), ', ', 2), 'община ', '') END AS mun,
  CASE WHEN replace(split_part(split_part(title, ' - ', 2), ', ', 1), 'област ', '') IN ('София (столица)', 'София')
       THEN 'София-област' ELSE replace(split_part(split_part(title, ' - ', 2), ', ', 1), 'област ', '') END AS region,
  regexp_extract(page_text, '"longitude":[^0-9.]*([0-9.]+)', 1) AS lon,
  regexp_extract(page_text, '"latitude":[^0-9.]*([0-9.]+)', 1) AS lat,
  split_part(split_part(title, ' - ', 2), ', ЕКАТТЕ ', 2) AS ekatte
FROM gaz WHERE gorder % 4 <> 0""",
}
