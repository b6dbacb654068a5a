"""The driver contract in __spark_entry__.py."""

import __spark_entry__ as entry_module
from logonlens.plans.oracle_sql import ORACLE
from logonlens.plans.queries import QUERIES


def test_entry_smoke(spark):
    df = entry_module.entry(spark)
    assert df.columns == ["user", "risk_score", "risk_level", "redteam_events", "total_logins",
                          "unique_computers", "active_days", "max_daily_authentications"]
    rows = df.collect()
    assert 0 < len(rows) <= 100
    scores = [r["risk_score"] for r in rows]
    assert scores == sorted(scores, reverse=True)


def test_every_library_query_has_an_oracle():
    """The library's own queries are all SQL-checked; the optional training-data queries
    may come without a statement (they have brute-force tests), never the other way."""
    q, o = entry_module.queries(), entry_module.oracle_sql()
    assert set(o) <= set(q)
    assert set(QUERIES) == set(ORACLE) and len(QUERIES) >= 40
    assert set(q) - set(QUERIES) == set(entry_module.LLM_QUERIES)
    assert all(o[name] == ORACLE[name] for name in QUERIES)
