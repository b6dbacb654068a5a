"""The SQL statements give the queries' rows."""
from collections import Counter

import duckdb
import pytest

from logonlens.llm.queries import ORACLE, QUERIES

FOLDER = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", list(ORACLE))
def test_query_equals_its_statement(spark, name):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{FOLDER}/documents.parquet')")
    want = con.execute(ORACLE[name])
    columns = sorted(d[0] for d in want.description)
    names = [d[0] for d in want.description]
    got = QUERIES[name](spark, FOLDER)
    assert sorted(got.columns) == columns
    rows = Counter(tuple(r[c] for c in columns) for r in got.collect())
    assert rows == Counter(tuple(dict(zip(names, r, strict=True))[c] for c in columns) for r in want.fetchall())
