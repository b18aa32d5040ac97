"""Order-dependent operators that stay balanced when one key holds a large share of the rows.

A plain ``lag().over(partitionBy(key))`` sends every row of a key to one task. Snapshot data is naturally
partitioned by time, so these operators window over ``(key, chunk)`` — ``chunk`` is a column that never decreases
along the order (the visit day by default) — and carry the last row of each chunk into the next one through a small
per-(key, chunk) summary. The big side is shuffled once, on ``(key, chunk)``; the summary is pre-aggregated
map-side from the input and has one row per key and chunk; the carry join reuses the window's partitioning, so only
the summary side moves. The result is identical to the unchunked window.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from snapmetrics.session import scratch_path


def _order_cols(order: Sequence[str]) -> list[Column]:
    return [F.col(c).asc_nulls_last() for c in order]


def presented(df: DataFrame, *order: str, nulls_first_on_desc: bool = False) -> DataFrame:
    """SRT-1/SRT-2: presentation order of a result; ``-name`` is descending. Ascending puts nulls last in both of the
    reference's engines; descending puts them last in Presto and first in PostgreSQL (``nulls_first_on_desc``). A range
    sort over all tasks, applied last, to results that a person reads."""
    return df.orderBy(*_presentation(order, nulls_first_on_desc))


def _presentation(order: Sequence[str], nulls_first_on_desc: bool) -> list[Column]:
    def key(name: str) -> Column:
        if not name.startswith("-"):
            return F.col(name).asc_nulls_last()
        return F.col(name[1:]).desc_nulls_first() if nulls_first_on_desc else F.col(name[1:]).desc_nulls_last()

    return [key(c) for c in order]


def positioned(df: DataFrame, *order: str, as_col: str = "position", nulls_first_on_desc: bool = False) -> DataFrame:
    """SRT-1/SRT-2 as a column: each row's place from 1 in the order of ``presented`` (ties in any order: end with a key). The rows
    are dealt by ranges and sorted within their tasks, written once, and numbered from the counts of the tasks before."""
    out = scratch_path(df.sparkSession, f"positioned-{uuid.uuid4().hex[:12]}")
    keys = _presentation(order, nulls_first_on_desc)
    ranged = df.repartitionByRange(*keys).sortWithinPartitions(*keys)
    # a task's rows are numbered in the order it has them: the task in the upper bits, the row in the lower 33
    ranged.withColumn("_at", F.monotonically_increasing_id()).write.parquet(out)
    rows = df.sparkSession.read.parquet(out)
    task, at = F.shiftright("_at", 33), F.col("_at").bitwiseAND((1 << 33) - 1)
    counts = rows.groupBy(task.alias("_task")).agg(F.count("*").alias("_n"))  # one row a task of the sort
    before = counts.withColumn("_before", F.sum("_n").over(Window.orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)))
    placed = rows.withColumn("_task", task).join(F.broadcast(before.select("_task", "_before")), "_task")
    return placed.withColumn(as_col, F.coalesce("_before", F.lit(0)) + at + 1).select(*df.columns, as_col)


def order_key(order: Sequence[str]) -> Column:
    """Struct that compares like ``ORDER BY order ASC NULLS LAST`` (for ``max_by``/``min_by``)."""
    fields = []
    for c in order:
        fields += [F.col(c).isNull(), F.col(c)]
    return F.struct(*fields)


def _chunk_key(part: Sequence[str]) -> Column:
    """One struct column over (keys, chunk): windows, the per-chunk summary and the carry join all partition on
    it, so the big side is shuffled once. Struct equality treats null fields as equal, like window partitions."""
    return F.struct(*[F.col(c) for c in part])


def chunked_lag(
    df: DataFrame,
    keys: Sequence[str],
    chunk: str,
    order: Sequence[str],
    cols: Sequence[str],
    prefix: str = "prev_",
    first_flag: str = "is_first",
) -> DataFrame:
    """Add ``prev_<c>`` = ``lag(c)`` over ``partitionBy(keys).orderBy(order)`` and a first-row flag.

    ``chunk`` must be non-decreasing along ``order`` within a key (e.g. the date of the first order column).
    """
    part = [*keys, chunk]
    base = df.withColumn("_pk", _chunk_key(part))
    w = Window.partitionBy("_pk").orderBy(*_order_cols(order))
    out = base.withColumns({"_rn": F.row_number().over(w), **{f"_lag_{c}": F.lag(c).over(w) for c in cols}})

    # Last row of every chunk — a partial aggregate over the input (combined map-side, so only one row per chunk
    # and task is shuffled) — carried to the next chunk of the same key.
    ord_key = order_key(order)
    last = base.groupBy("_pk").agg(*[F.max_by(c, ord_key).alias(f"_last_{c}") for c in cols])
    w2 = Window.partitionBy(*[F.col("_pk")[k] for k in keys]).orderBy(F.col("_pk")[chunk].asc_nulls_last())
    carry = last.select(
        "_pk",
        F.lag(F.lit(True)).over(w2).isNotNull().alias("_has_prev"),
        *[F.lag(f"_last_{c}").over(w2).alias(f"_carry_{c}") for c in cols],
    )
    out = out.join(carry, "_pk", "left")
    first_in_chunk = F.col("_rn") == 1
    new = {
        f"{prefix}{c}": F.when(first_in_chunk, F.col(f"_carry_{c}")).otherwise(F.col(f"_lag_{c}")) for c in cols
    }
    new[first_flag] = first_in_chunk & ~F.coalesce(F.col("_has_prev"), F.lit(False))
    out = out.withColumns(new)
    return out.drop("_pk", "_rn", "_has_prev", *[f"_lag_{c}" for c in cols], *[f"_carry_{c}" for c in cols])


def chunked_running_sum(
    df: DataFrame,
    keys: Sequence[str],
    chunk: str,
    order: Sequence[str],
    cols: Sequence[str],
    prefix: str = "cum_",
) -> DataFrame:
    """Add ``cum_<c>`` = running ``sum(c)`` over ``partitionBy(keys).orderBy(order)`` (rows frame)."""
    part = [*keys, chunk]
    base = df.withColumn("_pk", _chunk_key(part))
    w = Window.partitionBy("_pk").orderBy(*_order_cols(order)).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    out = base.withColumns({f"_run_{c}": F.sum(c).over(w) for c in cols})
    totals = base.groupBy("_pk").agg(*[F.sum(c).alias(f"_tot_{c}") for c in cols])
    w2 = (
        Window.partitionBy(*[F.col("_pk")[k] for k in keys])
        .orderBy(F.col("_pk")[chunk].asc_nulls_last())
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    carry = totals.select("_pk", *[F.sum(f"_tot_{c}").over(w2).alias(f"_before_{c}") for c in cols])
    out = out.join(carry, "_pk", "left")
    new = {}
    for c in cols:
        run, before = F.col(f"_run_{c}"), F.col(f"_before_{c}")
        new[f"{prefix}{c}"] = F.when(run.isNull(), before).otherwise(F.coalesce(before, F.lit(0)) + run)
    out = out.withColumns(new)
    return out.drop("_pk", *[f"_run_{c}" for c in cols], *[f"_before_{c}" for c in cols])


def first_row_values(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], cols: Sequence[str], count_as: str | None = None
) -> DataFrame:
    """One row per key with the values of its first row in ``order`` (``min_by``), optionally its row count.

    WN-3 without a window: ``first_value(x) over (partition by key order by o)`` repeats the same value on every
    row of the key, so a per-key aggregate (partial aggregation map-side, no hot task) plus the row count gives
    the same multiset when the caller weights by the count.
    """
    ord_key = order_key(order)
    aggs = [F.min_by(c, ord_key).alias(c) for c in cols]
    if count_as:
        aggs.append(F.count(F.lit(1)).alias(count_as))
    return df.groupBy(*keys).agg(*aggs)
