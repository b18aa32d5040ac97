"""Date/time column functions (DT-*)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from snapmetrics.functions.common import as_col

TS_FMT = "yyyy-MM-dd HH:mm:ss"


def parse_ts(c, fmt: str = TS_FMT) -> Column:
    """DT-1 ``date_parse``: text -> TIMESTAMP_NTZ, null on bad input (the session zone is UTC)."""
    return F.try_to_timestamp(as_col(c), F.lit(fmt)).cast("timestamp_ntz")


def minutes_between(start, end) -> Column:
    """DT-3: whole elapsed minutes (truncated, like Presto's ``date_diff('minute', …)``)."""
    return F.timestamp_diff("MINUTE", as_col(start), as_col(end))


def in_year(c, year: int) -> Column:
    """FLT-1: ``substr(c, 1, 10) like '<year>-%'`` on a timestamp text — the same as a prefix test on the whole
    text, which reaches the parquet scan as a pushed ``StringStartsWith`` filter."""
    return as_col(c).startswith(f"{year}-")


# The numeric day-first layouts, longest first.
DMY_FORMATS = ["d.M.yyyy H:mm:ss", "d.M.yyyy H:mm", "d.M.yyyy"]


def parse_dmy(c) -> Column:
    """DT-7: ``dd.MM.yyyy[ HH:mm[:ss]]`` -> TIMESTAMP_NTZ (first layout that reads the whole text); null otherwise."""
    s = as_col(c)
    return F.coalesce(*[F.try_to_timestamp(s, F.lit(f)) for f in DMY_FORMATS]).cast("timestamp_ntz")
