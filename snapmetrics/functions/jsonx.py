"""JSON, map and array column functions (JS-*, AG-14, ARR-*)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from snapmetrics.functions.common import as_col


def json_drop(c, keys: list[str]) -> Column:
    """JS-6: remove top-level keys from a JSON object text; values keep their JSON types."""
    m = F.from_json(as_col(c), "map<string,variant>")
    kept = F.map_filter(m, lambda k, v: ~k.isin(*keys))
    return F.to_json(kept)


def repair_json(c) -> Column:
    """JS-3: doubled-quote JSON as staged — drop first and last char, ``""`` -> ``"``; null if not valid JSON."""
    s = as_col(c)
    inner = F.substring(s, F.lit(2), F.length(s) - 2)
    fixed = F.replace(inner, F.lit('""'), F.lit('"'))
    return F.when(F.try_parse_json(fixed).isNotNull(), fixed)


def repr_to_map(c) -> Column:
    """JS-4: Python-repr dict text (single quotes) -> map<string,string>."""
    return F.from_json(as_col(c), "map<string,string>", {"allowSingleQuotes": "true"})


def pairs_to_map(items) -> Column:
    """AG-14: alternating key/value list -> map (repeated key: last wins); odd length -> null."""
    a = as_col(items)
    n = F.size(a)
    keys = F.filter(a, lambda x, i: i % 2 == 0)
    vals = F.filter(a, lambda x, i: i % 2 == 1)
    return F.when(n % 2 == 0, F.map_from_arrays(keys, vals))


def zip_to_map(keys, vals) -> Column:
    """AG-14: parallel key and value lists -> map (repeated key: last wins); different lengths -> null."""
    k, v = as_col(keys), as_col(vals)
    return F.when(F.size(k) == F.size(v), F.map_from_arrays(k, v))


def lookup(m, key: str, default: str = "") -> Column:
    """JS-5: map value with a default."""
    return F.coalesce(F.try_element_at(as_col(m), F.lit(key)), F.lit(default))
