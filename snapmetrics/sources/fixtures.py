"""Test inputs F1–F9 (FIXTURES.md), derived in Spark from the driver tables.

Raw text is assembled from integer columns only, so the DuckDB oracle (``fixtures_sql``) builds the same strings.
Each fixture is a lazy DataFrame over the whole driver table; its work grows with the table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from snapmetrics.operators.ordered import chunked_running_sum
from snapmetrics.sources.fixture_exprs import LISTING_MORE
from snapmetrics.sources.tables import table

TS_FMT = "yyyy-MM-dd HH:mm:ss"


def s(c) -> F.Column:
    return F.col(c).cast("string") if isinstance(c, str) else c.cast("string")


def snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """article snapshots with cumulative counters, one row per (link, visit).

    Columns mirror the reference's snapshot fact: snapshot_id, site, link, title, tags, category, views, comments,
    created_timestamp, visited_timestamp (both ``yyyy-MM-dd HH:mm:ss`` text, as landed).
    """
    ev = table(spark, sf_dir, "events").select(
        "event_id",
        "ts",
        "user_id",
        "event_type",
        F.get_json_object("props", "$.k").cast("bigint").alias("k"),
        (F.col("value").cast("decimal(12,2)") * 100).cast("bigint").alias("v"),
        F.to_date("ts").alias("day"),
    )
    # First visit per user from the scan (partial aggregate), cumulative counters balanced across days.
    created = ev.groupBy("user_id").agg(F.min("ts").alias("created_ts"))
    ev = chunked_running_sum(ev, ["user_id"], "day", ["ts", "event_id"], ["v", "k"])
    site = F.concat(F.lit("s"), s(F.col("user_id") % 5))
    k = F.col("k")
    tags = (
        F.when(k % 11 == 0, F.lit(None).cast("string"))
        .when(k % 13 == 0, F.lit(""))
        .otherwise(F.concat(F.col("event_type"), F.lit(" - k"), s(k % 7)))
    )
    return ev.join(created, "user_id").select(
        F.col("event_id").alias("snapshot_id"),
        site.alias("site"),
        F.concat(F.lit("https://"), site, F.lit(".example.bg/a/"), s("user_id")).alias("link"),
        F.concat(F.lit("t"), s("user_id")).alias("title"),
        tags.alias("tags"),
        F.col("event_type").alias("category"),
        F.col("cum_v").alias("views"),
        F.col("cum_k").alias("comments"),
        F.date_format("created_ts", TS_FMT).alias("created_timestamp"),
        F.date_format("ts", TS_FMT).alias("visited_timestamp"),
    )


def companies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F5 companies: one per nation; details JSON with sector (region) and marketCap, some keys absent."""
    n = table(spark, sf_dir, "nation")
    r = table(spark, sf_dir, "region")
    k = F.col("n_nationkey")
    cap = (k + 1).cast("bigint") * 1000000000 + k.cast("bigint") * 12345678
    details = F.concat(
        F.lit("{"),
        F.concat_ws(
            ", ",
            F.when(k % 12 != 0, F.concat(F.lit('"sector": "'), F.col("r_name"), F.lit('"'))),
            F.when(k % 9 != 0, F.concat(F.lit('"marketCap": '), s(cap))),
            F.concat(F.lit('"shortName": "S'), s(k), F.lit('"')),
            F.concat(F.lit('"longName": "Long '), F.col("n_name"), F.lit('"')),
            F.concat(F.lit('"longBusinessSummary": "Summary of '), F.col("n_name"), F.lit('"')),
        ),
        F.lit("}"),
    )
    return n.join(r, n.n_regionkey == r.r_regionkey).select(
        F.col("n_name").alias("symbol"),
        F.concat(F.lit("Company "), s(k)).alias("name"),
        (k + 1).cast("double").alias("weight"),
        details.alias("details"),
    )


def prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F5 price bars: one per (nation, month) from orders ⋈ customer; volume = sum of floor(total price)."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    j = o.join(c, o.o_custkey == c.c_custkey).join(n, F.col("c_nationkey") == F.col("n_nationkey"))
    ordk = F.struct("o_orderdate", "o_orderkey")
    return j.groupBy(
        F.col("n_name").alias("symbol"), F.trunc(F.to_date("o_orderdate"), "month").alias("at_date")
    ).agg(
        F.sum(F.floor("o_totalprice")).cast("bigint").alias("volume"),
        F.min_by("o_totalprice", ordk).alias("at_open"),
        F.max_by("o_totalprice", ordk).alias("at_close"),
        F.max_by("o_totalprice", ordk).alias("at_close_adj"),
        F.max("o_totalprice").alias("high"),
        F.min("o_totalprice").alias("low"),
    )


def raw_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F5 bars as a market-data download delivers them (capitalised names, index as at_date)."""
    return prices(spark, sf_dir).select(
        "symbol", "at_date",
        F.col("at_open").alias("Open"), F.col("high").alias("High"), F.col("low").alias("Low"),
        F.col("at_close").alias("Close"), F.col("at_close_adj").alias("Adj Close"), F.col("volume").alias("Volume"),
    )


# Fixed values used to render month words in the F3 date texts.
_MONTH_WORDS = "array('януари','февруари','март','април','май','юни','юли','август','септември','октомври','ноември','декември')"


def raw_listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """staged listing rows, all text, as scraped (prices with currency words, areas with units, dates with
    Bulgarian month names, coordinates with decimal commas). ``link`` repeats every 500 parts (first-wins)."""
    p = table(spark, sf_dir, "part").select("p_partkey", "p_size")
    base = p.selectExpr(
        "p_partkey AS pk",
        "p_size AS sz",
        "CAST(p_partkey % 400 + 50 AS STRING) || ' ' || lpad(CAST(p_size * 17 % 1000 AS STRING), 3, '0') AS n_sp",
        "CASE p_partkey % 4 WHEN 0 THEN 'www.listings-a.bg' WHEN 1 THEN 'www.etuovi.com' WHEN 2 THEN 'www.vuokraovi.com'"
        " ELSE 'www.listings-b.bg' END AS host",
        "CASE p_partkey % 6 WHEN 0 THEN ' 1-стаен апартамент' WHEN 1 THEN '2-стаен апартамент'"
        " WHEN 2 THEN '3-СТАЕН апартамент ' WHEN 3 THEN '4-стаен апартамент' WHEN 4 THEN 'Мезонет'"
        " ELSE 'Къща' END AS type_raw",
        "CASE p_partkey % 3 WHEN 0 THEN 'гр. София, Лозенец / близо до център' WHEN 1 THEN 'Софийска област, Банкя'"
        " ELSE 'България, с. Герман ' || CAST(p_partkey % 10 AS STRING) END AS place_raw",
        "p_partkey % 28 + 1 AS d",
        "p_partkey % 12 + 1 AS m",
        "2019 + p_partkey % 2 AS y",
        "lpad(CAST(p_partkey % 24 AS STRING), 2, '0') AS hh",
        "lpad(CAST(p_partkey % 60 AS STRING), 2, '0') AS mi",
    )
    mw = (
        f"CASE (pk div 12) % 3 WHEN 0 THEN element_at({_MONTH_WORDS}, CAST(m AS INT))"
        f" WHEN 1 THEN substr(element_at({_MONTH_WORDS}, CAST(m AS INT)), 1, 3)"
        f" ELSE upper(substr(element_at({_MONTH_WORDS}, CAST(m AS INT)), 1, 1)) ||"
        f" substr(element_at({_MONTH_WORDS}, CAST(m AS INT)), 2, 2) || '.' END"
    )
    return base.selectExpr(
        "'https://' || host || '/offer/' || CAST(pk % 500 AS STRING) AS link",
        "CAST(pk AS STRING) AS id",
        "type_raw AS type",
        "'София' AS city",
        "place_raw AS place",
        "CASE WHEN pk % 5 = 0 THEN 'Друг адрес' ELSE 'София, ' || place_raw || ', бл. ' || CAST(pk AS STRING) END"
        " AS address",
        "CASE pk % 2 WHEN 0 THEN 'True' ELSE 'False' END AS is_for_sale",
        "CASE pk % 5 WHEN 0 THEN 'при запитване' WHEN 1 THEN n_sp || ' лв.' WHEN 2 THEN n_sp || ' EUR'"
        " WHEN 3 THEN ' ' || n_sp ELSE n_sp || ' лв. без ДДС' END AS price",
        "CASE pk % 3 WHEN 0 THEN CAST(pk % 900 + 100 AS STRING) || '.5 лв./кв.м'"
        " WHEN 1 THEN CAST(pk % 900 + 100 AS STRING) || ' EUR/кв.м'"
        " ELSE CAST(pk % 900 + 100 AS STRING) || ' ЛВ/кв.м' END AS price_sqm",
        "CAST(sz AS STRING) || ' кв.м' AS area",
        "CASE pk % 4 WHEN 0 THEN 'партер' WHEN 1 THEN ' Сутерен' WHEN 2 THEN CAST(pk % 8 + 1 AS STRING) || ' от 8'"
        " ELSE NULL END AS floor",
        "'\"{\"\"rooms\"\": ' || CAST(pk % 5 AS STRING) || ', \"\"lift\"\": \"\"' ||"
        " CASE WHEN pk % 2 = 0 THEN 'да' ELSE 'не' END || '\"\"}\"' AS details",
        "CASE WHEN pk % 5 = 0 THEN 'n/a' ELSE 'Строителство ' || CAST(1950 + pk % 70 AS STRING) || ' г.' END AS year",
        "CAST(pk % 1000 AS STRING) || ' пъти' AS views",
        "'Продава ' || type_raw || '   София' AS title",
        f"CASE pk % 4 WHEN 0 THEN CAST(d AS STRING) || ' ' || {mw} || ' ' || CAST(y AS STRING) || ', ' || hh || ':' || mi"
        f" WHEN 1 THEN hh || ':' || mi || ', ' || CAST(d AS STRING) || ' ' || {mw} || ' ' || CAST(y % 100 AS STRING)"
        f" WHEN 2 THEN hh || ':' || mi || ' на ' || CAST(d AS STRING) || ' ' || {mw} || ', ' || CAST(y AS STRING) || ' год.'"
        " ELSE lpad(CAST(d AS STRING), 2, '0') || '.' || lpad(CAST(m AS STRING), 2, '0') || '.' || CAST(y AS STRING)"
        " || ' ' || hh || ':' || mi END AS date_text",
        "'23,' || lpad(CAST(pk % 1000 AS STRING), 3, '0') AS lon",
        "'42,' || lpad(CAST(pk * 7 % 1000 AS STRING), 3, '0') AS lat",
        "'2020-07-' || CAST(10 + pk % 10 AS STRING) AS measurement_day",
        "'07' || CAST(10 + pk % 10 AS STRING) || '_listings.tsv' AS file_name",
        "CAST(pk % 900 + 100 AS STRING) || ' ' || lpad(CAST(pk % 1000 AS STRING), 3, '0') || ',' ||"
        " lpad(CAST(pk % 100 AS STRING), 2, '0') || ' €' AS price_eu",
        "'Hoitovastike ' || CAST(pk % 300 AS STRING) || ',' || lpad(CAST(pk % 100 AS STRING), 2, '0') ||"
        " ' € / kk Rahoitusvastike ' || CAST(pk % 90 AS STRING) || ',50 € / kk' AS fees",
        "CASE pk % 3 WHEN 0 THEN 'Цена: ' || n_sp || ' BGN' WHEN 1 THEN 'Цена: ' || n_sp || ' EUR'"
        " ELSE 'Цена при запитване' END AS price_alt",
        *LISTING_MORE,
    )


def _nation_region(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = table(spark, sf_dir, "nation")
    r = table(spark, sf_dir, "region")
    return n.join(r, n.n_regionkey == r.r_regionkey)


def gazetteer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F6 gazetteer rows (and the page each was crawled from)."""
    from snapmetrics.sources.fixture_exprs import GAZETTEER

    return _nation_region(spark, sf_dir).selectExpr(*GAZETTEER)


def place_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F6 records with free-text places, keyed by ``rid``, with their region."""
    from snapmetrics.sources.fixture_exprs import PLACE_RECORDS

    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    return c.join(_nation_region(spark, sf_dir), F.col("c_nationkey") == F.col("n_nationkey")).selectExpr(*PLACE_RECORDS)


def court_tenders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F7 court tenders from ``customer``."""
    from snapmetrics.sources.fixture_exprs import COURT_TENDERS

    c = table(spark, sf_dir, "customer")
    return c.join(_nation_region(spark, sf_dir), F.col("c_nationkey") == F.col("n_nationkey")).selectExpr(*COURT_TENDERS)


def tax_tenders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F7 tax tenders from ``supplier``."""
    from snapmetrics.sources.fixture_exprs import TAX_TENDERS

    s_ = table(spark, sf_dir, "supplier")
    return s_.join(_nation_region(spark, sf_dir), F.col("s_nationkey") == F.col("n_nationkey")).selectExpr(*TAX_TENDERS)


def store_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F8: one nested JSON document per supplier (``doc``); its services are the parts it delivered, so every ordered part
    reaches a store; the address and service subtrees are missing for every tenth store and the service lists empty for
    every seventh."""
    from snapmetrics.sources.fixture_exprs import STORE_BASE

    base = table(spark, sf_dir, "supplier").selectExpr(*STORE_BASE)
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_type", "p_name")
    offered = table(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("store_id"), F.col("l_partkey").alias("p_partkey")).distinct()
    svc = offered.join(parts, "p_partkey").groupBy("store_id").agg(
        F.sort_array(F.collect_list(F.struct("p_partkey", (F.col("p_partkey") % 3 == 2).alias("secondary"),
                                             F.col("p_type").alias("groupName"), F.col("p_name").alias("displayName"))))
        .alias("svc")
    )
    j = base.join(svc, "store_id", "left").withColumn("svc", F.coalesce("svc", F.array()))

    def pick(secondary: bool):
        kept = F.filter("svc", lambda x: x["secondary"] == F.lit(secondary))
        lst = F.transform(kept, lambda x: F.struct(x["groupName"].alias("groupName"), x["displayName"].alias("displayName")))
        return F.when(F.col("no_services"), F.array().cast("array<struct<groupName:string,displayName:string>>")).otherwise(lst)

    address = F.struct(
        F.col("postal_code").alias("postalCode"), F.col("street_address").alias("streetAddress"),
        F.col("city").alias("city"), F.col("state").alias("state"), F.col("country").alias("country"),
    )
    store = F.struct(
        F.col("store_id").alias("id"),
        F.col("store_name").alias("displayName"),
        F.struct(F.col("store_type").alias("name")).alias("storeType"),
        F.struct(F.col("is_open_24h").alias("open24Hours")).alias("operationalHours"),
        F.struct(F.col("lat").alias("latitude"), F.col("lon").alias("longitude")).alias("geoPoint"),
        F.col("opening_date").alias("openDate"),
        F.when(~F.col("no_address"), address).alias("address"),
        F.col("can_order_custom_cakes_online").alias("canOrderOnlineCustomCakes"),
        F.when(~F.col("no_address"), pick(False)).alias("primaryServices"),
        F.when(~F.col("no_address"), pick(True)).alias("secondaryServices"),
    )
    return j.select(F.col("store_id").alias("file_id"), F.to_json(F.struct(store.alias("store"))).alias("doc"))


def attribute_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """key/value lists and repr texts per part."""
    from snapmetrics.sources.fixture_exprs import ATTRIBUTES

    return table(spark, sf_dir, "part").selectExpr(*[e.replace("ARR(", "array(") for e in ATTRIBUTES])


def listing_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """listing pages, 20 parts per page plus the first two of the next page (overlapping ids); each page's
    script holds ``var aditional = '[{"id":…,"lang":…,"lat":…,"lon":…,"area":…}, …]'``."""
    p = table(spark, sf_dir, "part").select("p_partkey", "p_size")
    page = F.call_function("div", F.col("p_partkey"), F.lit(20))
    pages = F.when(F.col("p_partkey") % 20 < 2, F.array(page, page - 1)).otherwise(F.array(page))
    e = p.select("p_partkey", "p_size", F.explode(pages).alias("page")).filter(F.col("page") >= 0)
    item = F.struct(
        F.col("p_partkey").alias("id"),
        F.when(F.col("p_partkey") % 10 == 0, F.lit("b'g")).otherwise(F.lit("bg")).alias("lang"),
        (F.lit(42.0) + F.col("page") / F.lit(1000.0)).alias("lat"),
        (F.lit(23.0) + F.col("p_partkey") / F.lit(10000.0)).alias("lon"),
        F.col("p_size").alias("area"),
    )
    g = e.groupBy("page").agg(F.sort_array(F.collect_list(item)).alias("items"))
    return g.select(
        F.col("page").alias("page_id"),
        F.concat(
            F.lit("<html><script>var x = 1; var aditional = '"), F.to_json("items"), F.lit("';</script></html>")
        ).alias("html"),
    )


def listing_extras(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F3 extras: snippets for the per-source listing and article text rules."""
    from snapmetrics.sources.fixture_exprs import LISTING_EXTRAS

    return table(spark, sf_dir, "part").selectExpr(*[e.replace("ARR(", "array(") for e in LISTING_EXTRAS])
