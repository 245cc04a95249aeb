"""Run registered queries against their DuckDB oracles.

usage: python tests/run_oracles.py [sf_dir] [name ...]
"""

from __future__ import annotations

import os
import sys
import time
import traceback

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import __spark_entry__ as entry  # noqa: E402
from hirelake.session import local_session  # noqa: E402
from oracle import compare, duck  # noqa: E402


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:]
    spark = local_session(8, 8)
    con = duck(sf_dir)
    qs, os_ = entry.queries(), entry.oracle_sql()
    bad = 0
    for name in names or list(qs):
        t0 = time.time()
        try:
            df = qs[name](spark, sf_dir)
            if name in os_:
                ok, msg = compare(df, con, os_[name])
            else:
                n = df.count()
                ok, msg = True, f"{n} rows (no oracle)"
        except Exception as e:  # report and continue
            ok, msg = False, f"ERROR {type(e).__name__}: {str(e)[:400]}"
            traceback.print_exc(limit=2)
        bad += not ok
        print(f"{'OK ' if ok else 'BAD'} {name:28s} {time.time() - t0:6.1f}s  {msg}", flush=True)
    print(f"{len(names or qs) - bad} ok, {bad} bad")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
