"""Run registered queries against their DuckDB oracles.

usage: python check.py [sf_dir] [name-prefix ...]
"""
import json
import sys
import time

from carelake.plans.compare import compare, duckdb_conn
from carelake.plans.registry import load_all
from carelake.session import get_session

sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
prefixes = sys.argv[2:]
spark = get_session("local[8]", 8)
con = duckdb_conn(sf)
ok = bad = 0
for name, (fn, q) in sorted(load_all().items()):
    if prefixes and not any(name.startswith(p) for p in prefixes):
        continue
    t = time.time()
    try:
        df = fn(spark, sf)
        if q:
            r = compare(df, q, con)
        else:
            r = {"ok": True, "rows_only": df.count()}
    except Exception as e:  # report and continue
        r = {"ok": False, "error": repr(e)[:600]}
    r["sec"] = round(time.time() - t, 2)
    ok += r["ok"]
    bad += not r["ok"]
    if r["ok"]:
        print("OK  ", name, r.get("spark_rows", r.get("rows_only")), r["sec"], "" if q else "(no oracle)")
    else:
        print("FAIL", name, json.dumps(r, default=str)[:1500])
print(f"{ok} ok, {bad} failed")
