"""Driver contract: entry runs; every registered query has a name-matched oracle or is listed."""

import __spark_entry__ as se


def test_entry_runs(spark):
    df = se.entry(spark)
    assert df.count() > 0
    assert "thread_id" in df.columns


def test_queries_have_oracles():
    qs, oracles = se.queries(), se.oracle_sql()
    assert set(oracles) <= set(qs)
    assert len(qs) >= 30
