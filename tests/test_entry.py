"""The driver contract in ``__spark_entry__.py``."""
import importlib.util
import os

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def _entry_module():
    spec = importlib.util.spec_from_file_location("spark_entry", os.path.join(ROOT, "__spark_entry__.py"))
    m = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(m)
    return m


def test_every_query_has_oracle_sql():
    from caresight.catalog import QUERIES
    m = _entry_module()
    q, o = m.queries(), m.oracle_sql()
    assert len(QUERIES) >= 100
    assert set(QUERIES) <= set(q) and set(o) <= set(q)
    assert sorted(set(QUERIES) - set(o)) == []


def test_entry_flagship_schema(spark):
    df = _entry_module().entry(spark)
    assert df.columns == ["body_area", "treatment_type", "total_cost", "total_treatments",
                          "distinct_patients", "treatment_deliveries"]
    assert df.count() > 0
