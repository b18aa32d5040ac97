"""Registered streaming queries (PIPE-36..39); each oracle is the SQL of its batch twin."""

from __future__ import annotations

from snapmetrics.plans.loading import _CLEAN_VIEW, DIMENSION_COLUMNS
from snapmetrics.plans.snapshots import ORACLE as SNAP_ORACLE
from snapmetrics.sources.fixtures_sql import F1_SNAPSHOTS, F3_LISTINGS, with_ctes
from snapmetrics.streaming.streams import (
    q_stream_daily_totals,
    q_stream_deltas,
    q_stream_snapshots,
    q_stream_upsert,
)

QUERIES = {
    "stream_snapshots": q_stream_snapshots,
    "stream_upsert": q_stream_upsert,
    "stream_deltas": q_stream_deltas,
    "stream_daily_totals": q_stream_daily_totals,
}

_DIM = ", ".join(DIMENSION_COLUMNS)

ORACLE = {
    "stream_snapshots": with_ctes(F1_SNAPSHOTS) + "SELECT * FROM snapshots",
    "stream_upsert": with_ctes(F3_LISTINGS, _CLEAN_VIEW) + f"""
SELECT {_DIM} FROM (
  SELECT *, row_number() OVER (PARTITION BY link ORDER BY measurement_day, id) AS rn FROM clean2
) r WHERE rn = 1""",
    "stream_deltas": SNAP_ORACLE["snapshot_deltas"],
    "stream_daily_totals": SNAP_ORACLE["daily_views_per_site"],
}
