"""CLI: compare every registered query (or the named ones) with its oracle.

    python tests/run_compare.py [--sf /root/testdata/sf0.01] [name ...]
"""

from __future__ import annotations

import argparse
import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as entry  # noqa: E402
from kestrel.session import local_session  # noqa: E402
from tests.harness import compare, duck  # noqa: E402


def main() -> int:
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf", default="/root/testdata/sf0.01")
    ap.add_argument("names", nargs="*")
    args = ap.parse_args()
    spark = local_session(8)
    qs, sqls = entry.queries(), entry.oracle_sql()
    con = duck(args.sf)
    bad = 0
    for name in args.names or list(qs):
        t = time.time()
        if name not in sqls:
            n = qs[name](spark, args.sf).count()
            print(json.dumps({"name": name, "spark_rows": n, "oracle": None}), flush=True)
            continue
        try:
            r = compare(spark, name, qs[name], sqls[name], args.sf, con)
        except Exception as e:  # noqa: BLE001
            r = {"name": name, "error": f"{type(e).__name__}: {str(e)[:800]}", "match": False}
        r["sec"] = round(time.time() - t, 2)
        bad += not r.get("match")
        print(json.dumps(r, default=str), flush=True)
    print(f"mismatches: {bad}")
    return 1 if bad else 0


if __name__ == "__main__":
    raise SystemExit(main())
