"""Run every registered query against its oracle SQL (script form).

usage: python tests/run_oracle.py [sf_dir] [key ...]
"""
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from oracle_compare import compare  # noqa: E402

import __spark_entry__ as E  # noqa: E402
from demandspark.session import get_session  # noqa: E402

sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
keys = sys.argv[2:]
spark = get_session("local[8]")
spark.sparkContext.setLogLevel("ERROR")
qs, orc = E.queries(), E.oracle_sql()
bad = 0
for k in (keys or sorted(qs)):
    t = time.time()
    try:
        df = qs[k](spark, sf)
        if k in orc:
            ok, msg = compare(df, orc[k], sf)
        else:
            ok, msg = True, f"rows-only: {df.count()} rows"
    except Exception as e:  # report and continue
        ok, msg = False, f"ERROR {type(e).__name__}: {str(e)[:400]}"
    bad += not ok
    print(f"{'PASS' if ok else 'FAIL'} {k:40s} {time.time() - t:6.1f}s {msg}", flush=True)
print("failures:", bad)
