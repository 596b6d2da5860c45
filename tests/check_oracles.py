"""Run registered queries against their DuckDB oracles (local stand-in for the driver gate).

usage: python tests/check_oracles.py [sf_dir] [name ...]
"""

from __future__ import annotations

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from oracle_compare import compare, duck  # noqa: E402

import __spark_entry__ as E  # noqa: E402
from ledgerlens.session import get_spark  # noqa: E402


def main() -> int:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:]
    spark = get_spark()
    con = duck(sf)
    qs, orc = E.queries(), E.oracle_sql()
    bad = 0
    for name in names or list(qs):
        t0 = time.time()
        try:
            df = qs[name](spark, sf)
            if name in orc:
                ok, msg = compare(df, orc[name], con)
            else:
                n = df.count()
                ok, msg = True, f"rows-only: {n} rows"
        except Exception as e:  # report and go on
            ok, msg = False, f"ERROR {type(e).__name__}: {str(e)[:400]}"
        bad += not ok
        print(f"{'OK  ' if ok else 'FAIL'} {name:32s} {time.time() - t0:6.2f}s {msg}", flush=True)
    print(f"{len(names or qs) - bad} ok, {bad} failed")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())
