"""Streams lose no row, cost what their batches hold, and give the batch results whatever the order of delivery."""

import os
import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from snapmetrics.plans.snapshots import daily_views_per_site, snapshot_deltas
from snapmetrics.streaming import streams as st
from snapmetrics.streaming.streams import BUCKET, apply_late, bucket, current_deltas, daily_totals, in_buckets_of, land, landed_snapshots, merge_aside
from snapmetrics.streaming.streams import stream_daily_totals, stream_deltas, stream_snapshots, stream_upsert

SNAP = "snapshot_id long, site string, link string, title string, tags string, category string, views long, comments long, created_timestamp string, visited_timestamp string"


def snap(i, link, views, visited, comments=0):
    return (i, "s", link, "t", None, None, views, comments, "2024-01-01 00:00:00", visited)


def history(seed, n=60, days=12):
    """Visits of five links over some days, with ties of the second, counters that fall or are null, and null links."""
    rng = random.Random(seed)
    when = lambda: f"2024-03-{rng.randrange(1, days + 1):02d} {rng.randrange(24):02d}:{rng.choice((0, 30)):02d}:00"
    return [snap(i, rng.choice(["a", "b", "c", "d", None]), rng.choice([None, rng.randrange(900)]), when(), rng.randrange(50)) for i in range(n)]


def waves_of(rows, seed, n):
    """The rows in n deliveries, mostly in order, some late by any time, some repeated."""
    rng = random.Random(seed)
    rows = sorted(rows, key=lambda r: str(r[-1]))
    out = [[] for _ in range(n)]
    for at, r in enumerate(rows):
        first = at * n // len(rows)
        out[rng.randrange(first, n) if rng.random() < 0.3 else first].append(r)
        if rng.random() < 0.2:
            out[rng.randrange(first, n)].append(r)
    return [w for w in out if w]


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def deliver(spark, wave, path):
    df = spark.createDataFrame(wave, SNAP)
    land(df, f"{path}/landing", ["visited_timestamp", "snapshot_id"])
    return df.schema


# ------------------------------------------------------------------------------------------------------------- STM-1


def test_unreadable_and_late_visits_are_kept_with_the_default_delay(spark, tmp_path):
    waves = [
        [snap(1, "a", 1, "2024-01-01 10:00:00"), snap(2, "b", 1, "n/a")],
        [snap(3, "a", 2, "2024-01-02 10:00:00"), snap(4, "b", 2, "2024-01-02 11:00:00"), snap(1, "a", 1, "2024-01-01 10:00:00"), snap(2, "b", 1, "n/a")],
        [snap(5, None, 1, None), snap(6, "c", 1, "2024-01-09 10:00:00"), snap(5, None, 1, None)],
        [snap(7, "c", 1, "2023-05-05 10:00:00"), snap(1, "a", 1, "2024-01-01 10:00:00"), snap(7, "c", 1, "2023-05-05 10:00:00")],
    ]
    for wave in waves:
        schema = deliver(spark, wave, tmp_path)
        stream_snapshots(spark, f"{tmp_path}/landing", schema, f"{tmp_path}/tables", f"{tmp_path}/ckpt")
        merge_aside(spark, f"{tmp_path}/tables", schema)
    merge_aside(spark, f"{tmp_path}/tables", schema)
    assert sorted(r["snapshot_id"] for r in landed_snapshots(spark, f"{tmp_path}/tables", schema).collect()) == [1, 2, 3, 4, 5, 6, 7]


@pytest.mark.parametrize("seed", [1])
def test_sink_and_merged_rows_are_the_landed_rows_less_copies(spark, tmp_path, seed):
    rows = [snap(i, f"l{i % 3}", i, None if i % 13 == 0 else f"2024-02-{1 + i // 4:02d} {i % 4:02d}:00:00") for i in range(60)]
    rows = [r if r[-1] else (*r[:2], f"x{r[0]}", *r[3:]) for r in rows]
    waves = waves_of(rows, seed, 5)
    random.Random(seed).shuffle(waves)
    for wave in waves:
        schema = deliver(spark, wave, tmp_path)
        stream_snapshots(spark, f"{tmp_path}/landing", schema, f"{tmp_path}/tables", f"{tmp_path}/ckpt")
    merge_aside(spark, f"{tmp_path}/tables", schema)
    assert rows_of(landed_snapshots(spark, f"{tmp_path}/tables", schema)) == sorted(rows, key=str)


# ------------------------------------------------------------------------------------------------------------- STM-2


def test_an_upsert_reads_its_buckets_only(spark, tmp_path):
    df = spark.createDataFrame([("k1", "2020-01-01", "1"), ("k2", "2020-01-01", "2")], "link string, day string, id string")
    many = spark.range(200).select(F.concat(F.lit("n"), "id").alias("link"), F.lit("2020-01-01").alias("day"), F.col("id").cast("string").alias("id"))
    for wave in (many, df):
        land(wave, f"{tmp_path}/landing", ["day", "id"])
        stream_upsert(spark, f"{tmp_path}/landing", df.schema, f"{tmp_path}/table", f"{tmp_path}/ckpt", ["link"], ["day", "id"])
    table = spark.read.parquet(f"{tmp_path}/table")
    assert table.count() == 202
    new = df.withColumn(BUCKET, bucket(["link"]))
    pruned = in_buckets_of(table, new)
    plan = pruned._jdf.queryExecution().executedPlan().toString()
    wanted = {r[BUCKET] for r in new.collect()}
    assert "PartitionFilters: [bucket" in plan and len(wanted) == 2
    assert {f.split("bucket=")[1].split("/")[0] for f in pruned.inputFiles() if f"bucket={min(wanted)}/" in f} == {str(min(wanted))}
    assert pruned.count() < 30


def test_rows_without_a_day_are_landed_and_upserted(spark, tmp_path):
    df = spark.createDataFrame([("a", None, "1"), ("b", "2020-01-01", "2"), ("b", "2020-01-02", "3"), (None, None, "4")], "link string, day string, id string")
    for _ in range(2):  # delivered twice
        land(df, f"{tmp_path}/landing", ["day", "id"])
        stream_upsert(spark, f"{tmp_path}/landing", df.schema, f"{tmp_path}/table", f"{tmp_path}/ckpt", ["link"], ["day", "id"])
    got = spark.read.parquet(f"{tmp_path}/table")
    assert sorted(r["link"] for r in got.filter("link is not null").collect()) == ["a", "b"]
    assert got.filter("link is null").count() == 2  # null keys conflict with nothing


# ------------------------------------------------------------------------------------------------------- STM-3, STM-4


def run_deltas(spark, path, wave, totals=False):
    schema = deliver(spark, wave, path)
    stream_deltas(spark, f"{path}/landing", schema, f"{path}/tables", f"{path}/ckpt", year=2024)
    if totals:
        stream_daily_totals(spark, f"{path}/tables", schema, f"{path}/totals", f"{path}/ckpt-totals")
    return schema


def test_late_same_second_and_unreadable_visits_stay(spark, tmp_path):
    waves = [
        [snap(1, "l", 10, "2024-01-01 10:00:00"), snap(5, "l", 50, "2024-01-01 14:00:00"), snap(9, "m", 1, "no time")],
        [snap(2, "l", 20, "2024-01-01 10:00:00"), snap(3, "l", 30, "2024-01-01 13:00:00"), snap(1, "l", 10, "2024-01-01 10:00:00")],
        [snap(6, "l", 55, "2024-01-02 09:00:00"), snap(7, "n", 3, None)],
    ]
    for wave in waves:
        schema = run_deltas(spark, tmp_path, wave)
    apply_late(spark, f"{tmp_path}/tables", schema)
    got = {r["snapshot_id"]: r["views_generated"] for r in current_deltas(spark, f"{tmp_path}/tables", schema).collect()}
    assert got == {1: 10, 2: 10, 3: 10, 5: 20, 6: 5, 7: 3, 9: 1}


@pytest.mark.parametrize("seed", [3])
def test_deltas_and_totals_equal_the_batch_whatever_the_order(spark, tmp_path, seed):
    rows = history(seed)
    for n, wave in enumerate(waves_of(rows, seed, 4)):
        schema = run_deltas(spark, tmp_path, wave, totals=True)
        if n == 2:  # late rows are applied in the middle and at the end
            apply_late(spark, f"{tmp_path}/tables", schema)
    for _ in range(2):  # a second time changes nothing
        apply_late(spark, f"{tmp_path}/tables", schema)
    stream_daily_totals(spark, f"{tmp_path}/tables", schema, f"{tmp_path}/totals", f"{tmp_path}/ckpt-totals")
    batch = spark.createDataFrame(rows, SNAP)
    assert rows_of(current_deltas(spark, f"{tmp_path}/tables", schema)) == rows_of(snapshot_deltas(batch, 2024))
    assert rows_of(daily_totals(spark, f"{tmp_path}/totals")) == rows_of(daily_views_per_site(batch, 2024))


def test_a_batch_costs_its_rows_and_reads_no_table(spark, tmp_path):
    """Seven days of ten links: every batch writes one row a visit with the right delta although all that earlier batches
    wrote is gone, and a link's state holds the last day and one row before it."""
    for day in range(1, 8):
        rows = [snap(100 * day + i, f"l{i}", 10 * day + i, f"2024-01-{day:02d} {i:02d}:00:00") for i in range(10)]
        schema = run_deltas(spark, tmp_path, rows)
        version = f"{tmp_path}/tables/rows/kind=delta/version={(day - 1) * st.VERSIONS}"
        written = spark.read.schema(st.delta_rows_schema(schema)).parquet(version).collect()
        assert len(written) == 10 and {r["views_generated"] for r in written} == ({10} if day > 1 else set(range(10, 20)))
        os.rename(version, f"{tmp_path}/gone-{day}")  # the next batch can't read it


class State:
    """A state store entry of one key."""

    def __init__(self):
        self.get, self.exists, self.watermark = None, False, 0

    def getCurrentWatermarkMs(self):
        return self.watermark

    def update(self, value):
        self.get, self.exists = value, True


def test_state_is_bounded_by_the_watermark():
    state, sizes = State(), []
    for n in range(50):
        frame = pd.DataFrame({"t": [n * 1_000_000], "i": [n], "row": [str(n)], "readable": [True]})
        out = next(st._follow(("l",), iter([frame]), state))
        assert out["prev"].tolist() == ([str(n - 1)] if n else [None])
        sizes.append(len(state.get[0]))
        state.watermark = (n - 4) * 1_000
    assert max(sizes) == sizes[-1] == sizes[10] < 9 and state.get[3]
    late = pd.DataFrame({"t": [1], "i": [99], "row": ["x"], "readable": [True]})
    assert next(st._follow(("l",), iter([late]), state))["kind"].tolist() == ["late"]


def test_closed_days_are_written_once_and_corrected_beside(spark, tmp_path):
    for day in (1, 2, 5, 6):
        schema = run_deltas(spark, tmp_path, [snap(day, "l", 10 * day, f"2024-01-{day:02d} 10:00:00")], totals=True)
    days = spark.read.parquet(f"{tmp_path}/totals/days")
    assert days.filter("date = '2024-01-01'").count() == 1
    schema = run_deltas(spark, tmp_path, [snap(50, "l", 15, "2024-01-01 12:00:00")], totals=True)
    apply_late(spark, f"{tmp_path}/tables", schema)
    stream_daily_totals(spark, f"{tmp_path}/tables", schema, f"{tmp_path}/totals", f"{tmp_path}/ckpt-totals")
    assert spark.read.parquet(f"{tmp_path}/totals/days").filter("date <= '2024-01-02'").count() == 2
    assert {str(r["date"]): r["d_views"] for r in spark.read.parquet(f"{tmp_path}/totals/corrections").collect()} == {"2024-01-01": 5, "2024-01-02": -5}
    assert {str(r["date"]): r["sum_views"] for r in daily_totals(spark, f"{tmp_path}/totals").collect()} == {"2024-01-01": 15, "2024-01-02": 5, "2024-01-05": 30, "2024-01-06": 10}
