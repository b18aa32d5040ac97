"""Join-shaped operators: incremental loads, first-wins upserts, keyed updates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapmetrics.operators.ordered import order_key


def only_new(df: DataFrame, existing: DataFrame, keys: Sequence[str], drop_null_keys: bool = False) -> DataFrame:
    """JN-5 / SET-3 / FLT-12: rows whose key is not in ``existing`` (left anti join; never collected).

    Null keys never match, so they are kept — the reference's Python membership test. ``drop_null_keys=True``
    gives SQL ``NOT IN``: a null key is never returned, and nothing is if ``existing`` holds a null key.
    """
    ex = existing.select(*keys)
    out = df.join(ex.distinct(), list(keys), "left_anti")
    if drop_null_keys:
        some_null = F.lit(False)
        for k in keys:
            out = out.filter(F.col(k).isNotNull())
            some_null = some_null | F.col(k).isNull()
        out = out.join(ex.filter(some_null).select(F.lit(1).alias("_null")).limit(1), F.lit(True), "left_anti")
    return out


def only_known(df: DataFrame, keys_df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """JN-6: rows whose key is in ``keys_df`` (left semi join)."""
    return df.join(keys_df.select(*keys), list(keys), "left_semi")


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """WN-9: first row per key in ``order`` (ascending, nulls last).

    Implemented as ``min_by`` of the whole row: a partial aggregate map-side, so a hot key is combined before the
    shuffle instead of being sorted in one task.
    """
    others = [c for c in df.columns if c not in keys]
    row = F.struct(*[F.col(c) for c in others])
    first = df.groupBy(*keys).agg(F.min_by(row, order_key(order)).alias("_r"))
    return first.select(*keys, *[F.col("_r")[c].alias(c) for c in others]).select(*df.columns)


def insert_if_absent(new: DataFrame, existing: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """SNK-6 / PIPE-10: ``INSERT … SELECT DISTINCT … ON CONFLICT (keys) DO NOTHING``.

    One row per new key (first in ``order`` wins — the reference leaves the winner undefined), minus keys already
    present. Returns the rows to append; appending them twice is a no-op on the next run (idempotent).
    """
    # DISTINCT is subsumed: exactly one row per key survives keep_first, whatever the duplicates.
    # A null key conflicts with nothing, so every row with one is inserted.
    named = F.lit(True)
    for k in keys:
        named = named & F.col(k).isNotNull()
    firsts = keep_first(new.filter(named), keys, order).unionByName(new.filter(~named))
    return only_new(firsts, existing, keys, drop_null_keys=False)


def update_by_key(base: DataFrame, updates: DataFrame, keys: Sequence[str], cols: Sequence[str]) -> DataFrame:
    """SNK-7: set ``cols`` of ``base`` from ``updates`` where the key matches; other rows unchanged. Of several updates of a
    key the largest (by ``cols`` in order) counts."""
    last = updates.groupBy(*keys).agg(F.max(F.struct(*cols)).alias("_u"))
    u = last.select(*keys, *[F.col("_u")[c].alias(f"_u_{c}") for c in cols])
    j = base.join(u, list(keys), "left")
    for c in cols:
        j = j.withColumn(c, F.coalesce(F.col(f"_u_{c}"), F.col(c)))
    return j.drop(*[f"_u_{c}" for c in cols])
