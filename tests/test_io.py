"""Readers and writers (SRC-*, SNK-*) on small files in a pytest temp folder."""

from pyspark.sql import functions as F

from snapmetrics.sources import io


def _write(path, text, encoding="utf-8"):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(text.encode(encoding))


def test_read_snapshots_unnamed_folders(spark, tmp_path):
    # raw/<site>/<date>/<site>_<date>_<h>h.tsv, as the collector lays it out (no key=value folder names)
    head = "\t".join(io.ARTICLE_COLUMNS) + "\n"
    row = ["1", "10", "", "2020-01-01 10:00:00", "2020-01-01 11:00:00", "a - b", "", "T", "", "c",
           "https://x.bg/a/1", "text", "", "", "", ""]
    for site in ["s1", "s2"]:
        for h in [10, 11]:
            _write(tmp_path / "raw" / site / "2020-01-01" / f"{site}_2020-01-01_{h}h.tsv", head + "\t".join(row) + "\n")
    df = io.read_snapshots(spark, str(tmp_path / "raw"))
    got = sorted((r.site, r.visit_day, r.views) for r in df.collect())
    assert got == [("s1", "2020-01-01", "10")] * 2 + [("s2", "2020-01-01", "10")] * 2


def test_read_snapshots_utf16(spark, tmp_path):
    head = "\t".join(io.ARTICLE_COLUMNS) + "\n"
    row = ["1", "10", "", "", "", "спорт - футбол", "", "Заглавие", "", "", "l", "", "", "", "", ""]
    _write(tmp_path / "raw" / "s1" / "2020-01-02" / "s1_2020-01-02_1h.tsv", head + "\t".join(row) + "\n", "utf-16")
    df = io.read_snapshots(spark, str(tmp_path / "raw"), encoding="UTF-16")
    r = df.first()
    assert (r.title, r.tags, r.site) == ("Заглавие", "спорт - футбол", "s1")


def test_read_strings_and_typed(spark, tmp_path):
    _write(tmp_path / "t.csv", "a,b,c\n1,2.5,x\n3,4.0,y\n")
    s = io.read_strings(spark, str(tmp_path / "t.csv"))
    assert [f.dataType.simpleString() for f in s.schema.fields] == ["string"] * 3
    t = io.read_typed(spark, str(tmp_path / "t.csv"))
    assert [f.dataType.simpleString() for f in t.schema.fields] == ["int", "double", "string"]


def test_staging_append_and_partition_overwrite(spark, tmp_path):
    df = spark.createDataFrame([(1, "2020-07-10"), (2, "2020-07-11")], "id long, day string")
    io.load_staging(df, str(tmp_path / "staging"))
    io.load_staging(df, str(tmp_path / "staging"))  # clear + refill
    assert spark.read.parquet(str(tmp_path / "staging")).count() == 2
    io.append_fact(df, str(tmp_path / "fact"), ["day"])
    io.append_fact(df, str(tmp_path / "fact"), ["day"])
    assert spark.read.parquet(str(tmp_path / "fact")).count() == 4
    io.write_partitioned(df, str(tmp_path / "part"), "day")
    io.write_partitioned(spark.createDataFrame([(9, "2020-07-11")], "id long, day string"), str(tmp_path / "part"), "day")
    got = sorted((r.id, str(r.day)) for r in spark.read.parquet(str(tmp_path / "part")).collect())
    assert got == [(1, "2020-07-10"), (9, "2020-07-11")]  # only the rewritten day was replaced


def test_partition_from_filename_and_purge(spark):
    df = spark.createDataFrame([("0712_x.tsv", "a"), ("0713_x.tsv", "b"), ("0714_x.tsv", "a")], "f string, site string")
    df = io.partition_from_filename(df, "f", r"^(\d{2})(\d{2})", 2020, out="day")
    grid = spark.createDataFrame([("a", "2020-07-12"), ("a", "2020-07-13")], "site string, day string")
    left = io.drop_partitions(df, grid, ["site", "day"])
    assert sorted(r.day for r in left.collect()) == ["2020-07-13", "2020-07-14"]


def test_write_tsv_keeps_empty_vs_null(spark, tmp_path):
    df = spark.createDataFrame([("a", None), ("b", "")], "k string, v string").withColumn("site", F.lit("s"))
    df = df.withColumn("visit_day", F.lit("2020-01-01"))
    io.write_tsv(df, str(tmp_path / "lake"), partition_by=["site", "visit_day"], null_value=io.NULL_TEXT)
    back = io.read_snapshots(spark, str(tmp_path / "lake"), ["k", "v"], pattern="*/*/*.csv", null_value=io.NULL_TEXT)
    assert sorted((r.k, r.v) for r in back.collect()) == [("a", None), ("b", "")]
