"""Run registered queries on Spark and their oracle SQL on DuckDB, and compare.

    python tools/check_oracle.py [--sf /root/testdata/sf0.01] [name ...]

Comparison: row count, sorted column names, and the order-insensitive multiset of rows
(values normalised to text).
"""
from __future__ import annotations

import argparse
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def main() -> int:
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf", default="/root/testdata/sf0.01")
    ap.add_argument("names", nargs="*")
    args = ap.parse_args()
    from caresight.session import build_session
    from caresight.testing import compare
    from caresight.catalog import ORACLE, QUERIES
    spark = build_session()
    names = args.names or sorted(QUERIES)
    bad = 0
    for n in names:
        t0 = time.time()
        try:
            ok, msg = compare(spark, args.sf, n)
        except Exception as e:  # noqa: BLE001
            ok, msg = False, f"ERROR {type(e).__name__}: {str(e)[:400]}"
        bad += not ok
        tag = "oracle" if n in ORACLE else "rows-only"
        print(f"{'OK ' if ok else 'BAD'} {n:32s} {tag:9s} {time.time() - t0:6.1f}s {msg}", flush=True)
    print(f"{len(names) - bad}/{len(names)} ok")
    return 1 if bad else 0


if __name__ == "__main__":
    raise SystemExit(main())
