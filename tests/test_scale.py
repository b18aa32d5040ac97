"""Work of the queries is spread over tasks and costs no more than it has to."""

import pytest
from pyspark.sql import functions as F

from snapmetrics.functions.text import class_text
from snapmetrics.plans import tender_pages


@pytest.mark.parametrize(
    "name,table,columns",
    [
        ("court_tender_fields", "customer", "id AS c_custkey, concat('C', id) AS c_name, int(id % 5) AS c_nationkey, 'M' AS c_mktsegment"),
        ("nested_page_fields", "customer", "id AS c_custkey, concat('C', id) AS c_name, int(id % 5) AS c_nationkey, 'M' AS c_mktsegment"),
        ("tax_tender_fields", "supplier", "id AS s_suppkey, concat('S', id) AS s_name, int(id % 5) AS s_nationkey"),
    ],
)
def test_pages_of_a_one_file_table_are_read_in_many_tasks(spark, tmp_path, name, table, columns):
    spark.range(0, 90, 1, 1).createOrReplaceTempView("ninety")
    spark.sql(f"SELECT {columns} FROM ninety UNION ALL SELECT {columns} FROM ninety WHERE id = 7").coalesce(1).write.parquet(f"{tmp_path}/{table}.parquet")
    found = tender_pages.QUERIES[name](spark, str(tmp_path))
    tasks = found.select("page_id", F.spark_partition_id().alias("task")).collect()
    assert len({r["task"] for r in tasks}) >= 8
    assert sorted(r["page_id"] for r in tasks) == sorted([*range(90), 7])


ELEMENTS = [
    ('<div class="x">a<DIV>b</DIV >c</div>d', "abc"),
    ('<p class="x">one<p>two</p>three</p>', "onetwothree"),
    ('<b class="y">n</b><p a="1" class="y x">t<!-- </p -->u</p>v', "t<!--"),
    ('<p class="x">a<pre>b</pre>c</p>', "abc"),
    ('<a class="z">0</a><a class="x">1</a><a class="x">2</a>', "1"),
    ('<i class="x"></i>', None),
    ('<i class="x">open<b></b>', None),
    ('<i class="x">open<i>', None),
    ('<h1 class="x">a<h>b</h>c</h12>d</h1>e', "abcd"),
    ("<i class='x'>\u20ac \U0001f600<u>\u00e9</u></i><i class='x'>2</i>", "\u20ac \U0001f600\u00e9"),
    (None, None),
]


def test_elements_without_inner_ones_of_their_kind_need_no_fold(spark):
    """The same text by the short way and by the fold, whether or not the element holds others of its kind."""
    df = spark.createDataFrame([(i, h) for i, (h, _) in enumerate(ELEMENTS)], "i int, h string")
    got = {r["i"]: r["t"] for r in df.select("i", class_text("h", "x").alias("t")).collect()}
    assert got == {i: t for i, (_, t) in enumerate(ELEMENTS)}


def test_a_start_tag_of_bytes_that_are_no_text_is_found(spark):
    row = spark.sql("SELECT cast(concat(X'3c69206e3d22ff2220636c6173733d2278223e', cast('in</i>out' AS binary)) AS string) AS h")
    assert row.select(class_text("h", "x")).first()[0] == "in"
