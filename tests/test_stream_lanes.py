"""Links share entries of the state store; what a stream says about a link does not depend on which links share its lane."""

import pandas as pd
import pytest

from snapmetrics.plans.snapshots import daily_views_per_site, snapshot_deltas
from snapmetrics.sources import fixtures
from snapmetrics.streaming import streams as st
from test_streams import SNAP, State, deliver, history, rows_of, snap, waves_of


def frame(*rows):
    return pd.DataFrame([(link, t, i, f"{link}{i}", True) for link, t, i in rows], columns=["link", "t", "i", "row", "readable"])


def told(state, *frames):
    out = next(st._follow((0,), iter(frames), state))
    return sorted(zip(out["kind"], out["row"], out["prev"], out["told"], strict=True), key=str)


def test_links_of_a_lane_follow_their_own_rows():
    state = State()
    got = told(state, frame(("a", 10, 1), ("b", 5, 2), (None, 7, 3)), frame(("a", 20, 4), ("a", 10, 1)))
    assert got == [("delta", "None3", None, False), ("delta", "a1", None, False), ("delta", "a4", "a1", False), ("delta", "b2", None, False)]
    state.watermark = 25 / 1000  # 25 microseconds: of link a the row at 10 goes, of link b the one at 3
    assert told(state, frame(("a", 30, 5), ("b", 3, 6))) == [("delta", "a5", "a4", False), ("delta", "b2", "b6", True), ("delta", "b6", None, False)]
    # rows before those let go are late; the null link had no rows in that batch, so all of its are there
    assert [x[0] for x in told(state, frame(("a", 1, 7), ("b", 2, 8)))] == ["late", "late"]
    assert told(state, frame((None, 6, 9))) == [("delta", "None3", "None9", True), ("delta", "None9", None, False)]


@pytest.mark.parametrize("lanes", [1, 3])
def test_deltas_and_totals_equal_the_batch_when_links_share_lanes(spark, tmp_path, lanes):
    rows = history(11, n=80)
    path = str(tmp_path)
    for wave in waves_of(rows, 11, 3):
        schema = deliver(spark, wave, path)
        st.stream_deltas(spark, f"{path}/landing", schema, f"{path}/tables", f"{path}/ckpt", year=2024, lanes=lanes)
        st.stream_daily_totals(spark, f"{path}/tables", schema, f"{path}/totals", f"{path}/ckpt-totals")
    st.apply_late(spark, f"{path}/tables", schema)
    st.stream_daily_totals(spark, f"{path}/tables", schema, f"{path}/totals", f"{path}/ckpt-totals")
    batch = spark.createDataFrame(rows, SNAP)
    assert rows_of(st.current_deltas(spark, f"{path}/tables", schema)) == rows_of(snapshot_deltas(batch, 2024))
    assert rows_of(st.daily_totals(spark, f"{path}/totals")) == rows_of(daily_views_per_site(batch, 2024))


def test_the_input_of_both_deliveries_is_derived_once(spark, tmp_path, monkeypatch):
    snaps = spark.createDataFrame([snap(i, "a", i, f"2024-01-{1 + i:02d} 10:00:00") for i in range(9)], SNAP)
    derived = spark.sparkContext.accumulator(0)
    count = lambda it: (derived.add(1) or r for r in it)
    counted = spark.createDataFrame(snaps.rdd.mapPartitions(count), snaps.schema)
    monkeypatch.setattr(fixtures, "snapshots", lambda *_: counted)
    waves = st._snapshot_waves(spark, "", str(tmp_path))
    ids = [r["snapshot_id"] for wave in waves for r in wave.collect()]
    assert sorted(set(ids)) == list(range(9)) and derived.value == 9


def test_no_late_rows_cost_no_job_over_the_rest(spark, tmp_path, monkeypatch):
    path = str(tmp_path)
    schema = deliver(spark, [snap(1, "a", 1, "2024-01-01 10:00:00")], path)
    st.stream_deltas(spark, f"{path}/landing", schema, f"{path}/tables", f"{path}/ckpt", year=2024)
    monkeypatch.setattr(st, "_newest", None)
    st.apply_late(spark, f"{path}/tables", schema)
