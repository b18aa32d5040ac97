"""Stored tables: what an update, a purge or a broken file leaves alone; nesting; places in an order; siblings."""

import glob
import os

import pytest
from pyspark.sql import functions as F

from snapmetrics.functions.text import class_text
from snapmetrics.operators.ordered import positioned
from snapmetrics.plans.related import page_parts, related_tenders, siblings
from snapmetrics.sources.io import purge_cells, read_json_docs
from snapmetrics.sources.versioned import read_table, replace_table, update_table, versions


def files(path):
    return {f: os.stat(f).st_mtime_ns for f in glob.glob(f"{path}/data/**/*.parquet", recursive=True)}


def test_an_update_rewrites_its_buckets_and_switches_once(spark, tmp_path):
    path = f"{tmp_path}/t"
    replace_table(spark.range(200).select(F.col("id").alias("k"), F.lit("old").alias("v")), path, ["k"], 8)
    before = files(path)
    touched = update_table(spark, path, spark.createDataFrame([(3, "new"), (3, "newer"), (999, "nobody")], "k long, v string"), ["v"])
    after = files(path)
    assert {f: after[f] for f in before} == before  # old files are as they were
    made = {f.split("bucket=")[1].split("/")[0] for f in set(after) - set(before)}
    assert made == {str(b) for b in touched} and len(made) <= 2
    assert update_table(spark, path, spark.createDataFrame([(4, "x")], "k long, v string"), ["v"]) and versions(spark, path) == [0, 1, 2]
    rows = {r["k"]: r["v"] for r in read_table(spark, path).collect()}
    assert len(rows) == 200 and rows[3] == "newer" and rows[4] == "x" and rows[5] == "old"
    assert read_table(spark, path, 0).filter("v = 'old'").count() == 200  # earlier versions can be read


def test_a_failed_update_leaves_the_table(spark, tmp_path):
    path = f"{tmp_path}/t"
    replace_table(spark.createDataFrame([(1, "a")], "k long, v string"), path, ["k"], 4)
    bad = spark.createDataFrame([(1, "x")], "k long, v string").withColumn("v", F.raise_error(F.lit("stop")).cast("string"))
    with pytest.raises(Exception, match="stop"):
        update_table(spark, path, bad, ["v"])
    assert [tuple(r) for r in read_table(spark, path).collect()] == [(1, "a")] and versions(spark, path) == [0]
    replace_table(spark.createDataFrame([(2, "b")], "k long, v string"), path, ["k"], 4)
    assert [tuple(r) for r in read_table(spark, path).collect()] == [(2, "b")]


def test_a_purged_day_leaves_no_folder_and_others_no_trace(spark, tmp_path):
    path = f"{tmp_path}/t"
    rows = [(i, s, d) for i, (s, d) in enumerate((s, d) for s in ("a", "b") for d in ("2020-01-01", "2020-01-02", "2020-01-03"))]
    spark.createDataFrame(rows, "id long, site string, day string").write.partitionBy("day").parquet(path)
    kept = {f: os.stat(f).st_mtime_ns for f in glob.glob(f"{path}/day=2020-01-03/*.parquet")}
    cells = spark.createDataFrame([("a", "2020-01-01"), ("b", "2020-01-01"), ("a", "2020-01-02"), ("a", "2019-01-01")], "site string, day string")
    purge_cells(spark, path, "day", cells, ["site", "day"], f"{tmp_path}/left")
    assert sorted(os.path.basename(f) for f in glob.glob(f"{path}/day=*")) == ["day=2020-01-02", "day=2020-01-03"]
    assert sorted(r["id"] for r in spark.read.parquet(path).collect()) == [2, 4, 5]
    assert {f: os.stat(f).st_mtime_ns for f in kept} == kept


def test_documents_and_broken_files(spark, tmp_path):
    texts = {"good": '{"a": 1,\n "b": ["x"]}', "cut": '{"a": 1, "b": ["x"', "empty": "", "blank": " \n", "plain": "no json", "other": '{"c": 2}'}
    for name, text in texts.items():
        (tmp_path / f"{name}.json").write_text(text)
    good, bad = read_json_docs(spark, str(tmp_path), spark.createDataFrame([], "a long, b array<string>").schema)
    name = F.regexp_extract("path", r"/(\w+)\.json$", 1)
    assert sorted((r[0], r["a"]) for r in good.select(name, "a").collect()) == [("good", 1), ("other", None)]
    assert sorted((r[0], r["reason"][:3]) for r in bad.select(name, "reason").collect()) == [("blank", "emp"), ("cut", "not"), ("plain", "not")]
    assert good.rdd.getNumPartitions() < len(texts)  # small files share tasks


@pytest.mark.parametrize(
    ("html", "text"),
    [
        ("<div class=x><div>a</div>b</div>c", None),  # an unquoted class is no match, as before
        ('<div class="x"><div>a</div>b</div>c', "ab"),
        ('<p>q</p><DIV class="x">q</DIV><div class="y x"><p>a<div><div class="x">b</div></div></p>c</div>d</div>', "abc"),
        ('<div class="x">' + "<div>" * 300 + "deep" + "</div>" * 300 + "end</div>out", "deepend"),
        ('<div class="x"><divx>a</divx></div>', "a"),
        ('<div class="x">never closed<div></div>', None),
        ("", None),
    ],
)
def test_an_element_ends_at_its_own_end_tag(spark, html, text):
    assert spark.createDataFrame([(html,)], "x string").select(class_text("x", "x")).first()[0] == text


def test_places_in_an_order(spark):
    df = spark.createDataFrame([(i, i % 7 if i % 5 else None) for i in range(500)], "id long, v long").repartition(9)
    got = [(r["position"], r["id"]) for r in positioned(df, "-v", "id").collect()]
    want = sorted(range(500), key=lambda i: (i % 5 == 0, -(i % 7) if i % 5 else 0, i))
    assert sorted(got) == list(enumerate(want, 1))
    assert positioned(df.limit(0), "id").collect() == []


def test_a_crowded_page_grows_linearly_and_siblings_are_exact(spark):
    crowd = spark.range(5_000).select(F.lit(1).alias("page_id"), F.concat(F.lit("tender-"), "id").alias("item_id"))
    few = spark.createDataFrame([(2, "x"), (2, "y"), (2, "x"), (3, "z"), (None, "n"), (4, None)], "page_id int, item_id string")
    related = related_tenders(crowd.unionByName(few), size=100).cache()
    parts = page_parts(related)
    assert related.count() == 5_003 and parts.count() == 52
    assert sorted(r["position"] for r in related.filter("page_id = 1").collect()) == list(range(1, 5_001))
    assert {r["item_id"]: r["n_siblings"] for r in related.filter("page_id > 1").collect()} == {"x": 1, "y": 1, "z": 0}
    wanted = spark.createDataFrame([(1, "tender-7"), (2, "x"), (3, "z"), (9, "none")], "page_id int, item_id string")
    got = {}
    for r in siblings(wanted, related, parts).collect():
        got.setdefault(r["item_id"], set()).update(r["sibling_ids"])
    assert got == {"tender-7": {f"tender-{i}" for i in range(5_000)} - {"tender-7"}, "x": {"y"}, "z": set()}
    related.unpersist()
