"""The driver contract: entry() runs on sf0.001 with a stable schema."""

import importlib.util
import os

from omoplate.plans.registry import QUERIES

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def _entry():
    spec = importlib.util.spec_from_file_location("spark_entry", os.path.join(ROOT, "__spark_entry__.py"))
    mod = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(mod)
    return mod


def test_entry_and_contract(spark):
    m = _entry()
    first = m.entry(spark)
    rows = first.collect()
    assert len(rows) > 0
    assert first.schema == m.entry(spark).schema
    q, sql = m.queries(), m.oracle_sql()
    assert set(sql) <= set(q) and set(QUERIES) <= set(sql)
    assert all(callable(f) for f in q.values())
