"""Nested store documents (PIPE-24..26): JSON -> flat table, exploded services, degree buffers."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapmetrics.functions.geo import DEG_PER_METRE, buffer_points, ring_wkt
from snapmetrics.sources import fixtures
from snapmetrics.sources.fixture_exprs import STORE_BASE

SERVICE = "array<struct<groupName:string,displayName:string>>"
# Paths of the store documents.
STORE_SCHEMA = (
    "store struct<id:bigint, displayName:string, storeType:struct<name:string>, operationalHours:struct<open24Hours:boolean>,"
    " geoPoint:struct<latitude:double, longitude:double>, openDate:string,"
    " address:struct<postalCode:string, streetAddress:string, city:string, state:string, country:string>,"
    f" canOrderOnlineCustomCakes:boolean, primaryServices:{SERVICE}, secondaryServices:{SERVICE}>"
)
BUFFER_METRES = [10000, 20000]
SEGMENTS = 64


def parse_stores(docs: DataFrame, col: str = "doc") -> DataFrame:
    """SRC-6 + JS-2: parse with a fixed schema; absent subtrees read as null (null-safe paths)."""
    return docs.select(F.from_json(col, STORE_SCHEMA).alias("d")).select("d.store")


def services_text(c) -> F.Column:
    """ARR-1 + AG-13: ``group:name`` pairs joined with ``|`` ('' for an empty list, null when absent)."""
    return F.array_join(F.transform(c, lambda s: F.concat_ws(":", s["groupName"], s["displayName"])), "|")


def stores_flat(docs: DataFrame) -> DataFrame:
    """PIPE-24: one flat row per store document."""
    return flat_from_parsed(parse_stores(docs))


def flat_from_parsed(s: DataFrame) -> DataFrame:
    """JS-2: null-safe paths of a parsed ``store`` struct column -> flat columns."""
    return s.select(
        F.col("store.displayName").alias("store_name"),
        F.col("store.id").alias("store_id"),
        F.col("store.storeType.name").alias("store_type"),
        F.col("store.operationalHours.open24Hours").alias("is_open_24h"),
        F.col("store.geoPoint.longitude").alias("lon"),
        F.col("store.geoPoint.latitude").alias("lat"),
        F.col("store.openDate").alias("opening_date"),
        F.col("store.address.postalCode").alias("postal_code"),
        F.col("store.address.streetAddress").alias("street_address"),
        F.col("store.address.city").alias("city"),
        F.col("store.address.state").alias("state"),
        F.col("store.address.country").alias("country"),
        F.col("store.canOrderOnlineCustomCakes").alias("can_order_custom_cakes_online"),
        services_text(F.col("store.primaryServices")).alias("primary_services"),
        services_text(F.col("store.secondaryServices")).alias("secondary_services"),
    )


def service_pairs(c) -> F.Column:
    """ARR-1: (group, name) pairs of a service list, in order."""
    return F.transform(c, lambda s: F.struct(s["groupName"].alias("group_name"), s["displayName"].alias("display_name")))


def store_services_exploded(docs: DataFrame) -> DataFrame:
    """PIPE-25 (ARR-2): one row per (store, service); stores with empty or missing lists keep one null row per kind. Each
    document is parsed once: the two lists are exploded from one array."""
    kinds = F.array(*[
        F.struct(F.lit(kind).alias("kind"), service_pairs(F.col(f"store.{c}")).alias("pairs"))
        for kind, c in (("primary", "primaryServices"), ("secondary", "secondaryServices"))
    ])
    each = parse_stores(docs).select(F.col("store.id").alias("store_id"), F.explode(kinds).alias("k"))
    each = each.select("store_id", "k.kind", F.explode_outer("k.pairs").alias("p"))
    return each.select("store_id", "kind", "p.group_name", "p.display_name")


def store_buffers(docs: DataFrame, metres: list[int] = BUFFER_METRES, segments: int = SEGMENTS, decimals: int | None = None) -> DataFrame:
    """PIPE-26 (NUM-14, SNK-12): degree buffers per radius, as a WKT polygon plus its bounding box."""
    s = parse_stores(docs).select(
        F.col("store.id").alias("store_id"), F.col("store.geoPoint.longitude").alias("lon"),
        F.col("store.geoPoint.latitude").alias("lat"),
    )
    out = s.select("*", F.explode(F.array(*[F.lit(m) for m in metres])).alias("radius_m"))
    out = out.withColumn("_ring", buffer_points("lon", "lat", "radius_m", segments))
    xs = F.transform("_ring", lambda p: p["x"])
    ys = F.transform("_ring", lambda p: p["y"])
    return out.select(
        "store_id", "radius_m",
        F.array_min(xs).alias("min_lon"), F.array_max(xs).alias("max_lon"),
        F.array_min(ys).alias("min_lat"), F.array_max(ys).alias("max_lat"),
        F.size("_ring").alias("n_points"),
        ring_wkt("_ring", decimals).alias("wkt"),
    )


def _docs(spark, d):
    return fixtures.store_documents(spark, d)


QUERIES = {
    "stores_flat": lambda spark, d: stores_flat(_docs(spark, d)),
    "store_services_exploded": lambda spark, d: store_services_exploded(_docs(spark, d)),
    "store_buffers": lambda spark, d: store_buffers(_docs(spark, d)).drop("wkt"),
    "store_buffers_wkt": lambda spark, d: store_buffers(_docs(spark, d), decimals=5).select("store_id", "radius_m", "wkt"),
}

_BASE = "base AS (SELECT " + ", ".join(STORE_BASE) + " FROM supplier)"
_SVC = """
offered AS (SELECT DISTINCT l_suppkey AS store_id, l_partkey AS p_partkey FROM lineitem),
svc AS (
  SELECT store_id,
    string_agg(CASE WHEN p_partkey % 3 <> 2 THEN p_type || ':' || p_name END, '|' ORDER BY p_partkey) AS prim,
    string_agg(CASE WHEN p_partkey % 3 = 2 THEN p_type || ':' || p_name END, '|' ORDER BY p_partkey) AS sec
  FROM offered JOIN part USING (p_partkey) GROUP BY 1
)"""

ORACLE = {
    "stores_flat": f"""
WITH {_BASE}, {_SVC}
SELECT store_name, b.store_id, store_type, is_open_24h, lon, lat, opening_date,
  CASE WHEN no_address THEN NULL ELSE postal_code END AS postal_code,
  CASE WHEN no_address THEN NULL ELSE street_address END AS street_address,
  CASE WHEN no_address THEN NULL ELSE city END AS city,
  CASE WHEN no_address THEN NULL ELSE state END AS state,
  CASE WHEN no_address THEN NULL ELSE country END AS country,
  can_order_custom_cakes_online,
  CASE WHEN no_address THEN NULL WHEN no_services THEN '' ELSE coalesce(svc.prim, '') END AS primary_services,
  CASE WHEN no_address THEN NULL WHEN no_services THEN '' ELSE coalesce(svc.sec, '') END AS secondary_services
FROM base b LEFT JOIN svc ON b.store_id = svc.store_id""",
    "store_services_exploded": f"""
WITH {_BASE},
offered AS (SELECT DISTINCT l_suppkey AS store_id, l_partkey AS p_partkey FROM lineitem),
p AS (SELECT store_id, p_partkey, p_type, p_name,
        CASE WHEN p_partkey % 3 = 2 THEN 'secondary' ELSE 'primary' END AS kind FROM offered JOIN part USING (p_partkey)),
k AS (SELECT store_id, no_address, no_services, kind FROM base, (VALUES ('primary'), ('secondary')) v(kind))
SELECT k.store_id, k.kind,
  CASE WHEN k.no_address OR k.no_services THEN NULL ELSE p.p_type END AS group_name,
  CASE WHEN k.no_address OR k.no_services THEN NULL ELSE p.p_name END AS display_name
FROM k LEFT JOIN p ON k.store_id = p.store_id AND k.kind = p.kind AND NOT k.no_address AND NOT k.no_services""",
    "store_buffers": f"""
WITH {_BASE}
SELECT store_id, radius_m,
  lon - radius_m * {DEG_PER_METRE!r} AS min_lon, lon + radius_m * {DEG_PER_METRE!r} AS max_lon,
  lat - radius_m * {DEG_PER_METRE!r} AS min_lat, lat + radius_m * {DEG_PER_METRE!r} AS max_lat,
  {SEGMENTS + 1} AS n_points
FROM base, (VALUES (10000), (20000)) r(radius_m)""",
    "store_buffers_wkt": f"""
WITH {_BASE},
ring AS (
  SELECT store_id, radius_m, i,
    lon + radius_m * {DEG_PER_METRE!r} * cos(i * {2 * math.pi / SEGMENTS!r}) AS x, lat + radius_m * {DEG_PER_METRE!r} * sin(i * {2 * math.pi / SEGMENTS!r}) AS y
  FROM base, (VALUES (10000), (20000)) r(radius_m), range({SEGMENTS + 1}) t(i)
)
SELECT store_id, radius_m, 'POLYGON((' || string_agg(printf('%.5f', round(x, 5)) || ' ' || printf('%.5f', round(y, 5)), ', ' ORDER BY i) || '))' AS wkt
FROM ring GROUP BY store_id, radius_m""",
}
