"""Items that share a page (PIPE-23, JN-10, STR-30): membership instead of pairs.

A page's n items have n (n - 1) sibling pairs; an item needs n - 1 ids only when somebody asks for it. The result is therefore
linear: each item has its place in the page and the number of its siblings, and the page's ids stand once, in parts of
bounded size. ``siblings`` reads any items' siblings back exactly.

Items are numbered in the order of a digest of their ids, in chunks by its first two digits (``chunked_running_sum``), so a
page that holds a third of all items is numbered by many tasks and ids with a common prefix are spread.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapmetrics.functions.urls import basename
from snapmetrics.operators.ordered import chunked_running_sum
from snapmetrics.sources.tables import table

#: Ids of one part of a page.
PART = 1_000


def related_tenders(items: DataFrame, page: str = "page_id", item: str = "item_id", size: int = PART) -> DataFrame:
    """Every item (one row a page and id; ``items`` may repeat them) with its position in the page from 1, its part and the number
    of its siblings. Rows without a page or id are no items."""
    once = items.select(F.col(page).alias("page_id"), F.col(item).cast("string").alias("item_id")).dropna().distinct()
    digest = F.md5("item_id")
    placed = once.withColumns({"_h": digest, "_c": F.substring(digest, 1, 2), "_one": F.lit(1).cast("long")})
    placed = chunked_running_sum(placed, ["page_id"], "_c", ["_h", "item_id"], ["_one"], prefix="pos_")
    counts = once.groupBy("page_id").agg(F.count("*").alias("n"))
    position = F.col("pos__one")
    return placed.join(counts, "page_id").select(
        "page_id", "item_id", position.alias("position"), F.floor((position - 1) / size).cast("long").alias("part"), (F.col("n") - 1).alias("n_siblings")
    )


def page_parts(related: DataFrame) -> DataFrame:
    """(page, part) with the part's ids, by position: at most ``PART`` ids a row."""
    ids = F.sort_array(F.collect_list(F.struct("position", "item_id")))
    return related.groupBy("page_id", "part").agg(F.transform(ids, lambda x: x["item_id"]).alias("item_ids"))


def siblings(wanted: DataFrame, related: DataFrame, parts: DataFrame) -> DataFrame:
    """One row per part of each wanted item's page (``wanted``: page_id, item_id) with the ids of its siblings in it."""
    own = related.join(wanted.distinct(), ["page_id", "item_id"]).select("page_id", "item_id")
    return own.join(parts, "page_id").select("page_id", "item_id", "part", F.array_remove("item_ids", F.col("item_id")).alias("sibling_ids"))


def _items(spark, d) -> DataFrame:
    """a page per order, an item per line of it, with its picture's link."""
    lines = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber")
    item = F.concat_ws("-", "l_orderkey", "l_linenumber")
    return lines.select(F.col("l_orderkey").alias("page_id"), item.alias("item_id"), F.concat(F.lit("/photos/"), item, F.lit(".jpg")).alias("link"))


def _related(spark, d) -> DataFrame:
    items = _items(spark, d)
    names = items.select("item_id", basename("link").alias("photo")).distinct()
    return related_tenders(items, size=3).join(names, "item_id")


def _parts(spark, d) -> DataFrame:
    return page_parts(related_tenders(_items(spark, d), size=3)).withColumn("item_ids", F.array_join("item_ids", ","))


def _siblings(spark, d) -> DataFrame:
    """Siblings of the first line of every 20th order."""
    items = _items(spark, d)
    related = related_tenders(items, size=3)
    wanted = items.filter((F.col("page_id") % 20 == 0) & F.col("item_id").endswith("-1")).select("page_id", "item_id")
    return siblings(wanted, related, page_parts(related)).withColumn("sibling_ids", F.array_join(F.array_sort("sibling_ids"), ","))


QUERIES = {"related_tenders": _related, "related_page_parts": _parts, "related_siblings": _siblings}

_PLACED = """
WITH items AS (SELECT DISTINCT l_orderkey AS page_id, l_orderkey || '-' || l_linenumber AS item_id FROM lineitem),
placed AS (
  SELECT page_id, item_id, row_number() OVER (PARTITION BY page_id ORDER BY md5(item_id), item_id) AS position,
    CAST((row_number() OVER (PARTITION BY page_id ORDER BY md5(item_id), item_id) - 1) // 3 AS BIGINT) AS part,
    count(*) OVER (PARTITION BY page_id) - 1 AS n_siblings
  FROM items)"""

ORACLE = {
    "related_tenders": f"{_PLACED} SELECT *, item_id || '.jpg' AS photo FROM placed",
    "related_page_parts": f"{_PLACED} SELECT page_id, part, string_agg(item_id, ',' ORDER BY position) AS item_ids FROM placed GROUP BY page_id, part",
    "related_siblings": f"""{_PLACED}
SELECT a.page_id, a.item_id, b.part, coalesce(string_agg(b.item_id, ',' ORDER BY b.item_id) FILTER (WHERE b.item_id <> a.item_id), '') AS sibling_ids
FROM placed a JOIN placed b ON b.page_id = a.page_id
WHERE a.page_id % 20 = 0 AND a.item_id LIKE '%-1' GROUP BY a.page_id, a.item_id, b.part""",
}
