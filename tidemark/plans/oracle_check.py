"""Compare a registered Spark query with its DuckDB oracle (row count, columns, values).

Used by the tests and by ``scripts/check_oracle.py``; it mirrors the driver's check:
columns compared by name, rows order-insensitively, floats at 6 decimals.
"""

from __future__ import annotations

import datetime as dt
import math
from decimal import Decimal

from ..sources.tables import TABLES, table_path


def duck(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{table_path(sf_dir, t)}')")
    return con


def _norm(v):
    if v is None:
        return None
    if hasattr(v, "tolist") and not isinstance(v, (str, bytes)):
        v = v.tolist()
    if isinstance(v, float):
        if math.isnan(v):
            return None
        r = round(v, 6)
        return 0.0 if r == 0 else r
    if isinstance(v, Decimal):
        return _norm(float(v))
    if isinstance(v, bool):
        return v
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((str(k), _norm(x)) for k, x in v.items()))
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat(sep=" ") if isinstance(v, dt.datetime) else v.isoformat()
    if hasattr(v, "asDict"):
        return _norm(v.asDict())
    return v


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    return sorted(out, key=repr)


def compare(spark, key: str, sf_dir: str, con=None, queries=None, oracle=None) -> dict:
    """Default: the library's own catalog; ``queries`` and ``oracle`` name others."""
    from .catalog import ORACLE, QUERIES
    queries, oracle = QUERIES if queries is None else queries, ORACLE if oracle is None else oracle
    df = queries[key](spark, sf_dir)
    s_cols = df.columns
    s_rows = [tuple(r) for r in df.collect()]
    res = {"key": key, "spark_rows": len(s_rows)}
    if key not in oracle:
        res["status"] = "rows-only"
        return res
    con = con or duck(sf_dir)
    cur = con.execute(oracle[key])
    d_cols = [c[0] for c in cur.description]
    d_rows = cur.fetchall()
    res["oracle_rows"] = len(d_rows)
    if sorted(s_cols) != sorted(d_cols):
        res["status"] = f"columns differ: spark={sorted(s_cols)} oracle={sorted(d_cols)}"
        return res
    a, b = _rows(s_cols, s_rows), _rows(d_cols, d_rows)
    if a == b:
        res["status"] = "match"
    else:
        diff_a = [r for r in a if r not in set(b)][:3]
        diff_b = [r for r in b if r not in set(a)][:3]
        res["status"] = "values differ"
        res["spark_only"] = [repr(x)[:400] for x in diff_a]
        res["oracle_only"] = [repr(x)[:400] for x in diff_b]
    return res
