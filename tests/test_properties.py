"""Properties of the balanced operators: they equal the plain formulations on the fixtures."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from snapmetrics.operators.ordered import chunked_lag, chunked_running_sum
from snapmetrics.plans import places, snapshots
from snapmetrics.sources import fixtures

from small_tables import SMALL


def test_chunked_lag_equals_window(spark):
    ev = spark.read.parquet(f"{SMALL}/events.parquet").withColumn("day", F.to_date("ts"))
    got = chunked_lag(ev, ["user_id"], "day", ["ts", "event_id"], ["value"]).select("event_id", "prev_value", "is_first")
    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    want = ev.select(
        "event_id", F.lag("value").over(w).alias("prev_value"), (F.row_number().over(w) == 1).alias("is_first")
    )
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_chunked_running_sum_equals_window(spark):
    ev = spark.read.parquet(f"{SMALL}/events.parquet").withColumn("day", F.to_date("ts"))
    got = chunked_running_sum(ev, ["user_id"], "day", ["ts", "event_id"], ["event_id"]).select("event_id", "cum_event_id")
    w = Window.partitionBy("user_id").orderBy("ts", "event_id").rowsBetween(Window.unboundedPreceding, 0)
    want = ev.select("event_id", F.sum("event_id").over(w).alias("cum_event_id"))
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_deltas_sum_to_last_counter(spark):
    snaps = fixtures.snapshots(spark, SMALL)
    d = snapshots.snapshot_deltas(snaps)
    sums = d.groupBy("link").agg(F.sum("views_generated").alias("s"), F.max("views").alias("last"))
    assert sums.filter(F.col("s") != F.col("last")).count() == 0


def test_article_sums_equal_site_totals(spark):
    a = snapshots.article_popularity(fixtures.snapshots(spark, SMALL))
    chk = a.groupBy("site", "date").agg(F.sum("sum_views").alias("s"), F.first("site_sum_views").alias("t"))
    assert chk.filter(F.col("s") != F.col("t")).count() == 0


def test_match_places_equals_a_nested_loop(spark):
    rec, gaz = fixtures.place_records(spark, SMALL), fixtures.gazetteer(spark, SMALL)
    names = sorted(gaz.collect(), key=lambda g: g["gorder"])
    got = places.match_places(rec, gaz).collect()
    assert len(got) == rec.count()
    for r in got[:300]:
        best = None
        for g in names:
            rank = {"с": 0, "гр": 1}.get((g["settlement_type"] or "").strip())
            region = "София-град" if (g["mun"] or "").strip() == "София-град" else g["region"]
            at = (r["place"] or "").strip().lower().find(g["name"].strip().lower())
            if rank is not None and at >= 0 and region.strip().lower() == (r["region"] or "").strip().lower():
                best = min(best or (at, rank, g["gorder"], g["name"]), (at, rank, g["gorder"], g["name"]))
        assert r["city_clean"] == (best and best[3])


def test_match_never_crosses_regions(spark):
    m = places.match_places(fixtures.place_records(spark, SMALL), fixtures.gazetteer(spark, SMALL))
    gaz = fixtures.gazetteer(spark, SMALL).select(F.col("name").alias("city_clean"), F.lower("region").alias("gr"))
    j = m.filter(F.col("city_clean").isNotNull()).join(gaz, "city_clean")
    assert j.filter(F.col("gr") != F.col("region")).count() == 0


def test_upsert_is_idempotent(spark):
    from snapmetrics.operators.joins import insert_if_absent

    clean = fixtures.raw_listings(spark, SMALL).select("link", "id", "measurement_day")
    first = insert_if_absent(clean, clean.limit(0).select("link"), ["link"], ["measurement_day", "id"])
    again = insert_if_absent(clean, first.select("link"), ["link"], ["measurement_day", "id"])
    assert again.count() == 0
    assert first.count() == first.select("link").distinct().count()


def test_dispersal_stays_within_radius(spark):
    from snapmetrics.plans.tenders import disperse_clusters

    d = disperse_clusters(fixtures.court_tenders(spark, SMALL))
    dist = F.sqrt((F.col("display_lon") - F.col("lon")) ** 2 + (F.col("display_lat") - F.col("lat")) ** 2)
    assert d.filter(dist > 0.0100001).count() == 0


def test_ensure_table_creates_empty_typed_table(spark, tmp_path):
    from snapmetrics.schemas import PRICE_BAR, ensure_table

    t = ensure_table(spark, "price_actions_test", PRICE_BAR, str(tmp_path / "price_actions"))
    assert t.count() == 0 and t.schema == PRICE_BAR
    t2 = ensure_table(spark, "price_actions_test", PRICE_BAR, str(tmp_path / "price_actions"))
    assert t2.count() == 0


def test_conform_fills_missing_columns(spark):
    from snapmetrics.sources.io import conform

    df = spark.createDataFrame([("a", 1)], "title string, views long")
    out = conform(df, ["views", "title", "author"])
    assert out.columns == ["views", "title", "author"]
    assert out.first()["author"] is None


def test_only_new_keeps_null_keys(spark):
    from snapmetrics.operators.joins import only_new

    df = spark.createDataFrame([(1,), (2,), (None,)], "k long")
    ex = spark.createDataFrame([(1,)], "k long")
    assert sorted(r[0] is None for r in only_new(df, ex, ["k"]).collect()) == [False, True]
    assert only_new(df, ex, ["k"], drop_null_keys=True).count() == 1


def test_chunked_ops_with_hot_key_nulls_and_ties(spark):
    """One key holding most rows over many days, null counters, a null chunk and tied order values."""
    rows = []
    for i in range(600):
        key = "hot" if i % 10 else f"k{i % 7}"
        day = None if i == 5 else f"2024-01-{1 + (i // 25) % 28:02d}"
        ts = None if day is None else f"{day} {(i * 7) % 24:02d}:00:00"
        val = None if i % 13 == 0 else i * 3
        rows.append((i, key, ts, val))
    df = spark.createDataFrame(rows, "id long, k string, ts string, v long").withColumn(
        "ts", F.to_timestamp("ts")
    ).withColumn("day", F.to_date("ts"))
    w = Window.partitionBy("k").orderBy(F.col("ts").asc_nulls_last(), F.col("id").asc_nulls_last())
    want = df.select(
        "id", F.lag("v").over(w).alias("prev_v"), (F.row_number().over(w) == 1).alias("is_first"),
        F.sum("v").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("cum_v"),
    )
    got = chunked_lag(df, ["k"], "day", ["ts", "id"], ["v"]).select("id", "prev_v", "is_first")
    got = got.join(chunked_running_sum(df, ["k"], "day", ["ts", "id"], ["v"]).select("id", "cum_v"), "id")
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
