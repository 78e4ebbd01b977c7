"""Driver contract and plan shape of every registered query."""

import __spark_entry__ as E
from meterlake import catalog

SF = "/root/testdata/sf0.001"
# map-side helpers that are allowed to run Python: reading each bronze
# file's first line (file metadata) in the file-based queries
ALLOWED_PY = {"MapInPandas"}


def test_entry_runs(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert rows and "division" in df.columns and "revenue" in df.columns


def test_oracle_keys_subset_of_queries():
    assert set(E.oracle_sql()) <= set(E.queries())
    assert len(E.queries()) >= 60


def test_no_row_python_udf_in_any_query(spark):
    for name, fn in catalog.QUERIES.items():
        plan = fn(spark, SF)._jdf.queryExecution().executedPlan().toString()
        assert "BatchEvalPython" not in plan, name
        assert "ArrowEvalPython" not in plan, name
