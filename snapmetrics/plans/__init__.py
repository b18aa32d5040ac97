"""Composite queries. Each module exports QUERIES (name -> (spark, sf_dir) -> DataFrame) and
ORACLE (name -> DuckDB SQL over the driver's tables)."""

from __future__ import annotations

import importlib

MODULES = ["snapshots", "prices", "listings", "loading", "places", "tenders", "tender_pages", "stores", "pages", "attributes", "related", "roundtrips", "tables", "streams"]


def registry() -> tuple[dict, dict]:
    queries, oracle = {}, {}
    for name in MODULES:
        mod = importlib.import_module(f"snapmetrics.plans.{name}")
        queries.update(mod.QUERIES)
        oracle.update(getattr(mod, "ORACLE", {}))
    return queries, oracle
