"""Spark-vs-DuckDB comparison used by the tests and ``tools/check_oracle.py``."""
from __future__ import annotations

import datetime as dt
import decimal
import os
from collections import Counter

from caresight.sources.tables import TABLES


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if v != v:
            return "nan"
        return repr(round(v, 9))
    if isinstance(v, decimal.Decimal):
        return format(v.normalize(), "f") if v == v else "nan"
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    if isinstance(v, bool):
        return str(int(v))
    return str(v)


def duck(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        p = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(p):
            con.execute(f"create view {t} as select * from read_parquet('{p}')")
    return con


def compare(spark, sf_dir: str, name: str, con=None):
    from caresight.catalog import ORACLE, QUERIES
    df = QUERIES[name](spark, sf_dir)
    rows = df.collect()
    cols = df.columns
    if name not in ORACLE:
        return True, f"rows={len(rows)} (no oracle)"
    con = con or duck(sf_dir)
    res = con.execute(ORACLE[name])
    ocols = [d[0] for d in res.description]
    orows = res.fetchall()
    if sorted(c.lower() for c in cols) != sorted(c.lower() for c in ocols):
        return False, f"columns differ: spark={sorted(cols)} oracle={sorted(ocols)}"
    if sorted(cols) != sorted(ocols):
        return False, f"column case differs: spark={sorted(cols)} oracle={sorted(ocols)}"
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    oorder = sorted(range(len(ocols)), key=lambda i: ocols[i])
    a = Counter(tuple(_norm(r[i]) for i in order) for r in rows)
    b = Counter(tuple(_norm(r[i]) for i in oorder) for r in orows)
    if a != b:
        only_a = list((a - b).elements())[:3]
        only_b = list((b - a).elements())[:3]
        return False, (f"rows spark={len(rows)} oracle={len(orows)}; "
                       f"spark-only={only_a} oracle-only={only_b} cols={[cols[i] for i in order]}")
    return True, f"rows={len(rows)}"
