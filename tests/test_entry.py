"""The driver contract: the entry module loads by path and its registry is consistent."""

import importlib.util
import os

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def _load():
    spec = importlib.util.spec_from_file_location("entry_by_path", os.path.join(ROOT, "__spark_entry__.py"))
    mod = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(mod)
    return mod


def test_registry_consistent():
    m = _load()
    q, o = m.queries(), m.oracle_sql()
    assert set(o) <= set(q)
    assert len(q) >= 40
    assert all(callable(f) for f in q.values())
    assert all(isinstance(s, str) and s.strip() for s in o.values())


def test_package_shipped_to_workers(spark):
    from snapmetrics.session import _SHIPPED, configure

    configure(spark)
    assert spark.sparkContext.applicationId in _SHIPPED
