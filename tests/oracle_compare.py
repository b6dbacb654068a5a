"""Run registered queries next to their DuckDB oracle and compare the results.

Usage: ``python tests/oracle_compare.py [sf_dir] [name ...]``. Comparison is by column
names, row count and the multiset of rows (exact values; floats also reported with a
relative tolerance so a last-bit difference is told apart from a real one).
"""

from __future__ import annotations

import math
import os
import sys
from collections import Counter

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        path = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return con


def _norm(v, digits=None):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return v if digits is None else float(f"{v:.{digits}g}")
    if hasattr(v, "item"):
        return _norm(v.item(), digits)
    return v


def _rows(records, cols, digits=None):
    return Counter(tuple(_norm(r[c], digits) for c in cols) for r in records)


def compare(spark, con, name: str, sf_dir: str) -> dict:
    from logonlens.plans.oracle_sql import ORACLE
    from logonlens.plans.queries import QUERIES

    sdf = QUERIES[name](spark, sf_dir)
    srows = [r.asDict() for r in sdf.collect()]
    scols = sdf.columns
    ocur = con.execute(ORACLE[name])
    ocols = [d[0] for d in ocur.description]
    orows = [dict(zip(ocols, r)) for r in ocur.fetchall()]
    out = {"name": name, "spark_rows": len(srows), "oracle_rows": len(orows),
           "columns_match": sorted(scols) == sorted(ocols)}
    if not out["columns_match"]:
        out["spark_cols"], out["oracle_cols"] = scols, ocols
        out["ok"] = False
        return out
    cols = sorted(scols)
    exact = _rows(srows, cols) == _rows(orows, cols)
    close = exact or _rows(srows, cols, 12) == _rows(orows, cols, 12)
    out.update(exact=exact, close=close, ok=exact and len(srows) == len(orows))
    if not exact:
        a, b = _rows(srows, cols), _rows(orows, cols)
        out["only_spark"] = list((a - b).items())[:3]
        out["only_oracle"] = list((b - a).items())[:3]
    return out


def main(argv):
    from logonlens.plans.queries import QUERIES
    from logonlens.session import local_session

    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:] or list(QUERIES)
    spark = local_session(8)
    con = duck(sf_dir)
    bad = 0
    for name in names:
        try:
            res = compare(spark, con, name, sf_dir)
        except Exception as exc:  # report and go on
            res = {"name": name, "ok": False, "error": repr(exc)[:600]}
        bad += not res["ok"]
        print(res, flush=True)
    print(f"{len(names) - bad}/{len(names)} ok")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv) else 0)
