"""Numeric column functions (NUM-*, AG-4, UDF-1).

All are Column -> Column builders over built-in expressions, so they stay inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from snapmetrics.functions.common import as_col


def idiv(a: Column, b: Column) -> Column:
    """Integer division truncating toward zero (SQL ``a div b``)."""
    return F.call_function("div", a, b)


def round_ratio(part, total, scale: int = 1, mult: int = 100) -> Column:
    """``round(part * mult / total, scale)`` rounded half away from zero, as DOUBLE; null when total is 0 or null.

    AG-4 share. Parts and totals are integer sums; the quotient is rounded on DECIMAL(38,0) integers, so the result
    is exact whatever the size of the sums (no floating error, no overflow).
    """
    p = as_col(part).cast("decimal(38,0)")
    t = as_col(total).cast("decimal(38,0)")
    num = p * F.lit(mult * 10**scale)
    q = idiv(F.abs(num) * 2 + F.abs(t), F.abs(t) * 2)
    signed = F.when((num < 0) != (t < 0), -q).otherwise(q)
    return F.when(t != 0, signed.cast("double") / F.lit(float(10**scale)))


def round_half_up(x, scale: int = 0) -> Column:
    """UDF-1: ``ROUND(float, int)`` through NUMERIC — the double goes through DECIMAL first, so ``1.005`` -> ``1.01``."""
    return F.round(as_col(x).cast("decimal(38,10)"), scale)


def plain_spaces(c) -> Column:
    """No-break, narrow and figure spaces read as spaces (they separate thousands in prices)."""
    return F.translate(as_col(c), "\u00a0\u202f\u2007\u2009", "    ")


def no_spaces(c) -> Column:
    return F.replace(plain_spaces(c), F.lit(" "), F.lit(""))


def digit_run(c) -> Column:
    """The first run of digits and spaces that starts with a digit, spaces removed; null when none."""
    return no_spaces(F.regexp_substr(plain_spaces(c), F.lit(r"[0-9][0-9\s]*")))


def first_number(c, min_len: int, max_len: int | None = None) -> Column:
    """NUM-1: first run of at least ``min_len`` (at most ``max_len``, if given) chars of ``[0-9.]`` after removing spaces;
    null when none."""
    return F.regexp_substr(no_spaces(c), F.lit(f"[0-9.]{{{min_len},{max_len or ''}}}"))


def first_year(c) -> Column:
    """NUM-1: first four digits; null when none."""
    return F.regexp_substr(no_spaces(c), F.lit("[0-9]{4}"))


def decimal_comma(c) -> Column:
    """NUM-9: coordinates written with a decimal comma -> dot."""
    return F.replace(as_col(c), F.lit(","), F.lit("."))


def eu_number(c) -> Column:
    """NUM-7: ``12 345,50 €`` -> ``12345.50`` (drop `` €`` and spaces, comma to dot)."""
    s = F.replace(no_spaces(c), F.lit("€"), F.lit(""))
    return F.replace(s, F.lit(","), F.lit("."))


def strip_units(c, units: list[str], default: str | None = None) -> Column:
    """NUM-15: remove unit words and blanks; an empty result becomes ``default`` (null when None)."""
    s = as_col(c)
    for u in units:
        s = F.replace(s, F.lit(u), F.lit(""))
    s = no_spaces(s)
    return F.when(s == "", F.lit(default)).otherwise(s)


def bgn_to_eur(c, rate: float = 1.9558) -> Column:
    """NUM-4: BGN amount -> EUR rounded to an integer, half-even like Python's ``round``."""
    return F.bround(as_col(c).cast("decimal(38,6)") / F.lit(rate).cast("decimal(10,4)"), 0).cast("bigint")


def counter(c, where: str | int = "first") -> Column:
    """NUM-17: counter text -> integer: the ``first`` or ``last`` integer of a meta line, its n-th word (a number from 1), or
    the digits left after removing ``пъти`` (``times``)."""
    s = as_col(c)
    if isinstance(where, int):
        return F.split_part(s, F.lit(" "), F.lit(where)).try_cast("bigint")
    if where == "first":
        return F.regexp_extract(s, r"^(\d+)", 1).try_cast("bigint")
    if where == "last":
        return F.regexp_extract(s, r"(\d+)$", 1).try_cast("bigint")
    return F.trim(F.replace(s, F.lit("пъти"), F.lit(""))).try_cast("bigint")


def suffixed_price(c, suffix_regex: str = r" €\/kk$", default: str = "0") -> Column:
    """NUM-16: integer part of a price anchored to its currency/period suffix, spaces removed; ``default`` when
    the text does not match."""
    m = F.regexp_extract(plain_spaces(c), r"([\d ]+)(?:[\d,]+)?" + suffix_regex, 1)
    return F.when(m == "", F.lit(default)).otherwise(F.replace(m, F.lit(" "), F.lit("")))


def lon_lat_pair(c) -> tuple[Column, Column]:
    """NUM-18: ``lon,lat`` text -> two texts ('' when absent)."""
    s = as_col(c)
    ok = s.contains(",")
    return (
        F.when(ok, F.split_part(s, F.lit(","), F.lit(1))).otherwise(F.lit("")),
        F.when(ok, F.split_part(s, F.lit(","), F.lit(2))).otherwise(F.lit("")),
    )


def coords_from_dict(c, decimals: int = 5) -> tuple[Column, Column]:
    """NUM-18 + NUM-11: ``{'lat': …, 'lng': …}`` text -> (lon, lat) rounded through DECIMAL."""
    m = F.from_json(as_col(c), "struct<lat:double, lng:double>", {"allowSingleQuotes": "true"})
    return (
        F.round(m["lng"].cast("decimal(38,10)"), decimals).cast("double"),
        F.round(m["lat"].cast("decimal(38,10)"), decimals).cast("double"),
    )
