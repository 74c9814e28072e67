"""python tests/check_queries.py [sf] [name ...]: time each query and compare it with its SQL."""

import os
import sys
import time
import traceback

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from compare import LAST, compare, connect  # noqa: E402

import __spark_entry__ as entry  # noqa: E402
from tickflow.session import local_session  # noqa: E402

sf = sys.argv[1] if len(sys.argv) > 1 else "0.01"
sf_dir = f"/root/testdata/sf{sf}"
names = sys.argv[2:]
spark = local_session(8)
con = connect(sf_dir)
queries, oracle = entry.queries(), entry.oracle_sql()
bad = 0
for name, fn in queries.items():
    if names and not any(name == n or (n.endswith("*") and name.startswith(n[:-1])) for n in names):
        continue
    t, built = time.time(), 0.0
    try:
        LAST.clear()
        df = fn(spark, sf_dir)
        built = time.time() - t
        if name in oracle:
            diff = compare(df, con, oracle[name])
        else:
            n = len(df.collect())
            diff = None if n else "no rows"
    except Exception as e:
        diff = "".join(traceback.format_exception_only(e))[:1500]
    bad += diff is not None
    print(f"{'ok  ' if diff is None else 'FAIL'} {name} {time.time() - t:.2f}s (build {built:.2f} collect {LAST.get('spark', 0):.2f}) {'' if name in oracle else '(rows)'}"
          + (f"\n  {diff}" if diff else ""), flush=True)
print("failures:", bad)
