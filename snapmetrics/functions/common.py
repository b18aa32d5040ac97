from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_col(c) -> Column:
    return c if isinstance(c, Column) else F.col(c)


def nonempty(c) -> Column:
    """Empty string -> null (``regexp_extract`` gives '' on no match; the reference's engines give null)."""
    return F.nullif(as_col(c), F.lit(""))


def first_present(*cols) -> Column:
    """PRJ-7: first value that is neither null nor empty."""
    return F.coalesce(*[nonempty(c) for c in cols])


def bound(value: Column, use) -> Column:
    """``use(value)`` with ``value`` computed once a row, however often ``use`` names it (a one-element lambda)."""
    return F.transform(F.array(value), use)[0]
