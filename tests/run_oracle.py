"""Compare every registered query with its DuckDB twin: python tests/run_oracle.py [sf_dir] [name...]"""
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import __spark_entry__ as E  # noqa: E402
from oracle_compare import compare, duck  # noqa: E402
from cadence.session import local_session  # noqa: E402


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    only = set(sys.argv[2:])
    spark = local_session()
    con = duck(sf)
    q, o = E.queries(), E.oracle_sql()
    bad = 0
    for name, fn in q.items():
        if only and name not in only:
            continue
        t = time.time()
        try:
            ok, msg = compare(fn(spark, sf), con, o[name]) if name in o else (True, "no oracle")
        except Exception as e:  # report and continue
            ok, msg = False, f"{type(e).__name__}: {str(e).splitlines()[0][:300]}"
        bad += not ok
        print(f"{'OK ' if ok else 'BAD'} {name:32s} {time.time() - t:6.2f}s {msg}", flush=True)
    ran = len([n for n in q if not only or n in only])
    print(f"{ran - bad}/{ran} match")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main() else 0)
