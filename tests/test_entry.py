"""Driver contract: entry() runs, every query has a callable, oracle keys are a subset."""

import __spark_entry__ as entry


def test_entry_smoke(spark):
    df = entry.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert df.columns == ["grade", "total_loans", "defaults", "default_rate_pct"]


def test_registry_shape():
    qs, sqls = entry.queries(), entry.oracle_sql()
    assert set(sqls) <= set(qs)
    assert len(qs) >= 90
