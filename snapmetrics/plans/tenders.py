"""Auction tenders (PIPE-19..22): coordinate-cluster dispersal, export, incremental merge, free-text fields."""

from __future__ import annotations

from os.path import commonprefix

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from snapmetrics.functions.common import as_col, nonempty
from snapmetrics.functions.geo import GOLDEN_ANGLE, golden_offset, slugify_bg
from snapmetrics.functions.dates import parse_dmy
from snapmetrics.functions.text import tidy_place
from snapmetrics.operators.joins import only_new
from snapmetrics.sources import fixtures
from snapmetrics.sources.fixture_exprs import COURT_TENDERS, TAX_TENDERS

CLUSTER_MIN = 10  # clusters are coordinates shared by more than this many rows
CLUSTER_RADIUS = 0.01
RUN_DATE = "2021-06-01"  # export run date (the reference uses today's date)
ID_CHUNK = 1 << 16  # numeric ids per numbering chunk inside one coordinate cluster
TEXT_CHUNK = 3  # characters of text ids, after their common ones, that make a chunk
EXPORT_COLUMNS = [
    "area", "address", "region", "price", "type", "lon", "lat", "is_appr_coor", "period_start", "period_end",
    "link", "ideal_parts", "source",
]


def id_chunk(df: DataFrame, key: str) -> Column:
    """Chunk of an id that follows the order of ids: ranges of numbers, the characters of texts after what the smallest and
    the largest id (two values to the driver) have in common."""
    if isinstance(df.schema[key].dataType, T.StringType):
        ends = df.agg(F.min(key), F.max(key)).first()
        return F.substring(key, 1, len(commonprefix([e or "" for e in ends])) + TEXT_CHUNK)
    return F.floor(F.col(key) / F.lit(ID_CHUNK))


def disperse_clusters(df: DataFrame, key: str = "page_id", lon: str = "lon", lat: str = "lat",
                      threshold: int = CLUSTER_MIN, radius: float = CLUSTER_RADIUS, phase: float = 0.0) -> DataFrame:
    """PIPE-19 (AG-12, WN-8, NUM-13): spread rows that share a coordinate (> ``threshold`` rows) on a golden-angle
    spiral of ``radius`` degrees; k-th member in ``key`` order (ids are numbers or texts).

    One crowded coordinate is numbered by many tasks: rows are counted by (coordinate, id chunk), the counts before a
    chunk and of the whole cluster come from one window over this small table, and the place inside the chunk is added.
    """
    at = Window.partitionBy(lon, lat)
    inside = Window.partitionBy(lon, lat, "_chunk").orderBy(key)
    d = df.withColumn("_chunk", id_chunk(df, key))
    counts = d.filter(F.col(lon).isNotNull() & F.col(lat).isNotNull()).groupBy(lon, lat, "_chunk").agg(F.count("*").alias("_n"))
    earlier = at.orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    whole = at.orderBy("_chunk").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    counts = counts.select(
        F.col(lon).alias("_lon"), F.col(lat).alias("_lat"), F.col("_chunk").alias("_of"),
        F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"), F.sum("_n").over(whole).alias("cluster_size"),
    )
    d = d.withColumn("_place", F.row_number().over(inside))
    same = (F.col(lon) == F.col("_lon")) & (F.col(lat) == F.col("_lat")) & F.col("_chunk").eqNullSafe(F.col("_of"))
    d = d.join(counts, same, "left").drop("_lon", "_lat", "_of")
    clustered = F.coalesce(F.col("cluster_size") > threshold, F.lit(False))
    x, y = golden_offset(lon, lat, F.col("_before") + F.col("_place") - 1, "cluster_size", radius, phase)
    return d.withColumns(
        {
            "display_lon": F.when(clustered, x).otherwise(F.col(lon)),
            "display_lat": F.when(clustered, y).otherwise(F.col(lat)),
            "is_appr_coor": clustered,
        }
    ).drop("_chunk", "_place", "_before")


def rounded(df: DataFrame, *cols: str) -> DataFrame:
    """Coordinates on 7 decimals, for comparing two engines' sines."""
    return df.withColumns({c: F.round(c, 7) for c in cols})


def tenders_export(court: DataFrame, tax: DataFrame, run_date: str = RUN_DATE) -> DataFrame:
    """PIPE-20: both sources dispersed, renamed to one layout, integer price, placed and active only, slugified."""
    si = disperse_clusters(court).select(
        "area", F.col("place").alias("address"), F.col("court_short").alias("region"), "price", "type",
        F.col("display_lon").alias("lon"), F.col("display_lat").alias("lat"), "is_appr_coor", "period_start",
        "period_end", "link", F.lit(None).cast("string").alias("ideal_parts"), F.lit("court").alias("source"),
    )
    nap = disperse_clusters(tax).select(
        "area", "address", "region", "price", "type",
        F.col("display_lon").alias("lon"), F.col("display_lat").alias("lat"), "is_appr_coor", "period_start",
        "period_end", "link", "ideal_parts", F.lit("tax").alias("source"),
    )
    export = si.unionByName(nap, allowMissingColumns=True)
    export = export.withColumn("price", F.col("price").cast("bigint")).filter(F.col("lon").isNotNull())
    export = export.filter(F.col("period_end") > F.lit(run_date))  # FLT-10: ISO text compare, run date a parameter
    return export.withColumns(
        {"address": slugify_bg("address"), "region": slugify_bg("region"), "type": slugify_bg("type")}
    ).select(*EXPORT_COLUMNS)


def tenders_merge(old: DataFrame, scraped: DataFrame, details: DataFrame) -> DataFrame:
    """PIPE-21: scraped ids not seen before, details left-joined (missing details flagged), unioned with the old
    records (columns the old file lacks become null)."""
    new = only_new(scraped, old, ["page_id"])
    d = details.withColumn("_has_details", F.lit(True))
    new = new.join(d, "page_id", "left").withColumn("details_failed", F.col("_has_details").isNull()).drop("_has_details")
    old_ = old.withColumn("details_failed", F.lit(False))
    return new.unionByName(old_, allowMissingColumns=True)


# Tender text patterns, in the reference's form, so the same fields are read from the same text.
IDEAL_PATTERN = r"(.*)(?:ид|ИД|Ид)(?:\.|еалн|ЕАЛН)|^\s*([\d]+[/\\][\d]+)"
IDEAL_FIRST = r"(.*)(?:ид|ИД|Ид)(?:\.|еалн|ЕАЛН)"
PRICE_PATTERN = r".*:\s+(\d+)\..*"
AREA_PATTERN = r"^(?:[\s-]+)?(\d+)\s+кв\.м\..*"
PLACE_PATTERN = r"^(?:[\s-]+)?\d+\s+кв\.м\.,(.*)"
COURT_SHORT_PATTERN = r".*Окръжен\sсъд\s+([а-яА-Я]+(?:\sЗагора|\sТърново)?).*"
COURT_FULL_PATTERN = r".*Окръжен\s+съд:\s+([а-яА-Я ]+).*"
NOTARY_PATTERN = r".*ЧСИ:\s+([а-яА-Я -]+).*"
TERM_START_PATTERN = r".*\sот\s([\d\.]+).*"
TERM_END_PATTERN = r".*\sдо\s([\d\.]+).*"
ANNOUNCEMENT_PATTERN = r".*Обявяване\sна:\s+([\d\.\s:]+).*"
# The two Sofia courts and the regions they stand for.
SOFIA_COURTS = [("Софийски окръжен съд", "София-област"), ("Софийски градски съд", "София-град")]


def ideal_parts(desc, length: int | None = None) -> Column:
    """STR-22: fraction of ideal parts (from the first ``length`` characters, if given): text before ``ид.``/``идеалн``, else
    a leading ``a/b``, else null."""
    x = as_col(desc) if length is None else F.substring(as_col(desc), 1, length)
    return F.when(x.rlike(IDEAL_FIRST), F.regexp_extract(x, IDEAL_PATTERN, 1)).otherwise(
        nonempty(F.regexp_extract(x, IDEAL_PATTERN, 2))
    )


def court_short(meta) -> Column:
    """JN-9: court name -> region (two Sofia courts are fixed, others read from the text)."""
    m = as_col(meta)
    out = F.when(m.contains(SOFIA_COURTS[0][0]), F.lit(SOFIA_COURTS[0][1]))
    for court, region in SOFIA_COURTS[1:]:
        out = out.when(m.contains(court), F.lit(region))
    return out.otherwise(field(m, COURT_SHORT_PATTERN))


def one_line(c, line_break: str = " ") -> Column:
    """Line breaks and tabs -> spaces (``\\r\\n`` as one), as the text blocks are read before matching; a bare ``\\n`` ->
    ``line_break``."""
    return F.translate(F.replace(as_col(c), F.lit("\r\n"), F.lit(" ")), "\n\t", line_break + " ")


def field(text, pattern: str) -> Column:
    """Group 1 of a ``.*``-led pattern on one-line text, anchored at the start: the same match, without
    re-scanning from every position when the marker is absent; null when absent."""
    return nonempty(F.regexp_extract(text, "^" + pattern, 1))


def tender_fields(df: DataFrame) -> DataFrame:
    """PIPE-22: area, place, price, court, notary, term and announcement from the free-text blocks."""
    ap = one_line("area_and_place", line_break="-")  # the lines of a place end up as its parts
    meta = one_line("meta")
    place = nonempty(F.regexp_extract(ap, PLACE_PATTERN, 1))
    announcement = F.trim(field(meta, ANNOUNCEMENT_PATTERN))
    return df.select(
        "page_id",
        field(one_line("price_text"), PRICE_PATTERN).alias("price"),
        nonempty(F.regexp_extract(ap, AREA_PATTERN, 1)).alias("area"),
        F.regexp_replace(tidy_place(F.trim(place)), r"\s+$", "").alias("place"),
        court_short(meta).alias("court_short"),
        F.trim(F.replace(field(meta, COURT_FULL_PATTERN), F.lit(" ЧСИ"), F.lit(""))).alias("court_full"),
        F.trim(F.replace(field(meta, NOTARY_PATTERN), F.lit(" Срок"), F.lit(""))).alias("notarius"),
        field(meta, TERM_START_PATTERN).alias("period_start"),
        field(meta, TERM_END_PATTERN).alias("period_end"),
        announcement.alias("announcement"),
        parse_dmy(announcement).alias("announced_at"),
        ideal_parts("description").alias("ideal_parts"),
    )


def _court(spark, d):
    return fixtures.court_tenders(spark, d)


QUERIES = {
    "disperse_clusters": lambda spark, d: rounded(disperse_clusters(_court(spark, d)), "display_lon", "display_lat").select(
        "page_id", "lon", "lat", "cluster_size", "display_lon", "display_lat", "is_appr_coor"
    ),
    "tenders_export": lambda spark, d: rounded(tenders_export(_court(spark, d), fixtures.tax_tenders(spark, d)), "lon", "lat"),
    "tenders_merge": lambda spark, d: tenders_merge(
        _court(spark, d).filter(F.col("page_id") % 3 == 0).select("page_id", "link", "price", "area", "place", "type"),
        _court(spark, d).select("page_id", "link", "price", "area", "place", "type"),
        _court(spark, d).filter(F.col("page_id") % 13 != 0).select("page_id", "description", "meta"),
    ),
    "tender_fields": lambda spark, d: tender_fields(_court(spark, d)),
}

_COURT_SQL = (
    "court AS (SELECT " + ", ".join(COURT_TENDERS)
    + " FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)"
)
_TAX_SQL = (
    "tax AS (SELECT " + ", ".join(TAX_TENDERS)
    + " FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)"
)


def _disperse_sql(src: str) -> str:
    return f"""(
  SELECT *,
    CASE WHEN n > {CLUSTER_MIN} THEN round(lon + {CLUSTER_RADIUS} * sqrt(CAST(k AS DOUBLE) / n) * cos(k * {GOLDEN_ANGLE!r}), 7)
         ELSE lon END AS display_lon,
    CASE WHEN n > {CLUSTER_MIN} THEN round(lat + {CLUSTER_RADIUS} * sqrt(CAST(k AS DOUBLE) / n) * sin(k * {GOLDEN_ANGLE!r}), 7)
         ELSE lat END AS display_lat,
    coalesce(n > {CLUSTER_MIN}, false) AS is_appr_coor
  FROM (
    SELECT *, CAST(row_number() OVER (PARTITION BY lon, lat ORDER BY page_id) - 1 AS DOUBLE) AS k,
      count(*) OVER (PARTITION BY lon, lat) AS n
    FROM {src}
  ) s
)"""


# The official streamlined transliteration, letter by letter.
_LETTERS = (
    "ж zh, ц ts, ч ch, ш sh, щ sht, ю yu, я ya, а a, б b, в v, г g, д d, е e, з z, и i, й y, к k, л l, м m, н n, о o, п p, "
    "р r, с s, т t, у u, ф f, х h, ъ a, ь y"
)


def _slug(expr: str) -> str:
    """Lower-cased letters looked up one by one in a MAP, the rest to hyphens."""
    pairs = [p.split(" ") for p in _LETTERS.split(", ")]
    table = "MAP {" + ", ".join(f"'{a}': '{b}'" for a, b in pairs) + "}"
    latin = f"list_aggregate(list_transform(string_split(lower({expr}), ''), lambda ch: coalesce({table}[ch], ch)), 'string_agg', '')"
    return f"CASE WHEN {expr} IN ('', 'nan') OR {expr} IS NULL THEN {expr} ELSE trim(regexp_replace({latin}, '[^a-z0-9]+', '-', 'g'), '-') END"


ORACLE = {
    "disperse_clusters": f"""
WITH {_COURT_SQL}
SELECT page_id, lon, lat, n AS cluster_size, display_lon, display_lat, is_appr_coor FROM {_disperse_sql('court')} d""",
    "tenders_export": f"""
WITH {_COURT_SQL}, {_TAX_SQL},
u AS (
  SELECT area, place AS address, court_short AS region, price, type, display_lon AS lon, display_lat AS lat,
    is_appr_coor, period_start, period_end, link, CAST(NULL AS VARCHAR) AS ideal_parts, 'court' AS source
  FROM {_disperse_sql('court')} c
  UNION ALL
  SELECT area, address, region, price, type, display_lon AS lon, display_lat AS lat,
    is_appr_coor, period_start, period_end, link, ideal_parts, 'tax' AS source
  FROM {_disperse_sql('tax')} t
)
SELECT area, {_slug('address')} AS address, {_slug('region')} AS region, CAST(price AS BIGINT) AS price,
  {_slug('type')} AS type, round(lon, 7) AS lon, round(lat, 7) AS lat, is_appr_coor, period_start, period_end, link, ideal_parts, source
FROM u WHERE lon IS NOT NULL AND period_end > '{RUN_DATE}'""",
    "tenders_merge": f"""
WITH {_COURT_SQL}
SELECT s.page_id, s.link, s.price, s.area, s.place, s.type, d.description, d.meta, d.page_id IS NULL AS details_failed
FROM court s LEFT JOIN (SELECT page_id, description, meta FROM court WHERE page_id % 13 <> 0) d USING (page_id)
WHERE s.page_id % 3 <> 0
UNION ALL
SELECT page_id, link, price, area, place, type, NULL, NULL, false FROM court WHERE page_id % 3 = 0""",
    "tender_fields": f"""
WITH {_COURT_SQL}, f AS (
  SELECT page_id, ap, meta, description, price_text,
    trim(nullif(regexp_extract(ap, '^(?:[\\s-]+)?\\d+\\s+кв\\.м\\.,(.*)', 1), '')) AS pl,
    description AS x
  FROM (SELECT *, replace(replace(replace(area_and_place, chr(13) || chr(10), ' '), chr(10), '-'), chr(9), ' ') AS ap FROM court) lines
)
SELECT page_id,
  nullif(regexp_extract(price_text, '.*:\\s+(\\d+)\\..*', 1), '') AS price,
  nullif(regexp_extract(ap, '^(?:[\\s-]+)?(\\d+)\\s+кв\\.м\\..*', 1), '') AS area,
  regexp_replace(regexp_replace(replace(regexp_replace(pl, '\\s+', ' ', 'g'), '-', ','), ',+$', ''), '\\s+$', '') AS place,
  CASE WHEN meta LIKE '%Софийски окръжен съд%' THEN 'София-област'
       WHEN meta LIKE '%Софийски градски съд%' THEN 'София-град'
       ELSE nullif(regexp_extract(meta, '.*Окръжен\\sсъд\\s+([а-яА-Я]+(?:\\sЗагора|\\sТърново)?).*', 1), '') END AS court_short,
  trim(replace(nullif(regexp_extract(meta, '.*Окръжен\\s+съд:\\s+([а-яА-Я ]+).*', 1), ''), ' ЧСИ', '')) AS court_full,
  trim(replace(nullif(regexp_extract(meta, '.*ЧСИ:\\s+([а-яА-Я -]+).*', 1), ''), ' Срок', '')) AS notarius,
  nullif(regexp_extract(meta, '.*\\sот\\s([\\d\\.]+).*', 1), '') AS period_start,
  nullif(regexp_extract(meta, '.*\\sдо\\s([\\d\\.]+).*', 1), '') AS period_end,
  trim(nullif(regexp_extract(meta, '.*Обявяване\\sна:\\s+([\\d\\.\\s:]+).*', 1), '')) AS announcement,
  try_strptime(trim(regexp_extract(meta, '.*Обявяване\\sна:\\s+([\\d\\.\\s:]+).*', 1)), '%d.%m.%Y %H:%M') AS announced_at,
  CASE WHEN regexp_matches(x, '(.*)(?:ид|ИД|Ид)(?:\\.|еалн|ЕАЛН)')
       THEN regexp_extract(x, '(.*)(?:ид|ИД|Ид)(?:\\.|еалн|ЕАЛН)|^\\s*([\\d]+[/\\\\][\\d]+)', 1)
       ELSE nullif(regexp_extract(x, '(.*)(?:ид|ИД|Ид)(?:\\.|еалн|ЕАЛН)|^\\s*([\\d]+[/\\\\][\\d]+)', 2), '') END AS ideal_parts
FROM f""",
}
