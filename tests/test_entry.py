"""The driver contract: entry(), queries(), oracle_sql()."""

import __spark_entry__ as E


def test_entry_schema_is_stable(spark):
    a, b = E.entry(spark), E.entry(spark)
    assert a.schema == b.schema
    assert a.count() >= 0
    assert set(a.columns) == {"severity", "age_bucket", "vulnerability_category", "total_count", "avg_cvss_score",
                              "avg_composite_risk_score", "max_composite_risk_score", "critical_count"}


def test_contract_shapes():
    q, o = E.queries(), E.oracle_sql()
    assert q and set(o) <= set(q)
    assert all(callable(f) for f in q.values())
    assert all(isinstance(s, str) and s.strip() for s in o.values())
