"""python tests/run_oracle.py FOLDER [name prefix ...]: compare queries with their SQL."""

import sys
import time
import traceback
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
sys.path.insert(0, str(Path(__file__).resolve().parent))

from oracle import connect, difference  # noqa: E402
from quayside.queries import ORACLES, QUERIES  # noqa: E402
from quayside.session import build_session  # noqa: E402

folder, *prefixes = sys.argv[1:]
spark = build_session("oracle", master="local[8]", spark__sql__shuffle__partitions=8, spark__driver__memory="8g")
spark.sparkContext.setLogLevel("ERROR")
con = connect(folder)
bad = 0
for name, fn in QUERIES.items():
    if prefixes and not any(name.startswith(p) for p in prefixes):
        continue
    start = time.time()
    try:
        df = fn(spark, folder)
        if name in ORACLES:
            diff = difference(df, ORACLES[name], con)
        else:
            diff = None if df.count() >= 0 else ""
    except Exception as e:  # noqa: BLE001
        diff = f"{type(e).__name__}: {str(e)[:700]}"
        if not diff.strip():
            diff = traceback.format_exc()[-500:]
    bad += diff is not None
    kind = "" if name in ORACLES else " (rows only)"
    print(f"{'ok  ' if diff is None else 'FAIL'} {name} {time.time() - start:.2f}s{kind} {diff or ''}", flush=True)
print("failed:", bad)
spark.stop()
