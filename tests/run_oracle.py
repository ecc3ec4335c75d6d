"""Dev tool: python tests/run_oracle.py [sf_dir] [key ...] -> compare Spark vs DuckDB."""
import sys
import time

sys.path.insert(0, ".")
from oracle.registry import ORACLE  # noqa: E402
from ratewise.plans.registry import QUERIES  # noqa: E402
from ratewise.session import get_session  # noqa: E402
from tests.oracle_check import compare, duck  # noqa: E402

sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
keys = sys.argv[2:] or sorted(QUERIES)
spark = get_session("local[8]", 8)
spark.sparkContext.setLogLevel("ERROR")
con = duck(sf_dir)
bad = 0
for k in keys:
    t = time.time()
    try:
        df = QUERIES[k](spark, sf_dir)
    except Exception as e:
        bad += 1
        print(f"{k:32s} FAIL building: {type(e).__name__}: {str(e)[:400]}")
        continue
    if k not in ORACLE:
        try:
            n = df.count()
        except Exception as e:
            bad += 1
            print(f"{k:32s} FAIL running: {type(e).__name__}: {str(e)[:400]}")
            continue
        print(f"{k:32s} rows-only {n} rows {time.time()-t:.1f}s")
        continue
    try:
        p = compare(df, con, ORACLE[k])
    except Exception as e:  # keep going through the list
        p = [f"{type(e).__name__}: {str(e)[:300]}"]
    bad += bool(p)
    print(f"{k:32s} {'OK' if not p else 'FAIL'} {time.time()-t:.1f}s {p}")
print("failures:", bad)
