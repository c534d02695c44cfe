"""python tests/check.py ROOT [name ...]: run plans against their SQL and print one line each."""

import os
import sys
import time

sys.path.insert(0, os.path.join(os.path.dirname(__file__), ".."))

from tests.oracle import compare, connect  # noqa: E402
from tierwork.plans import ORACLE, QUERIES  # noqa: E402
from tierwork.session import local_session  # noqa: E402

if __name__ == "__main__":
    root, names = sys.argv[1], sys.argv[2:] or list(QUERIES)
    spark, con = local_session(8), connect(root)
    bad = 0
    for n in names:
        t0 = time.time()
        try:
            if n in ORACLE:
                msg = compare(spark, con, root, QUERIES[n], ORACLE[n])
            else:
                msg = "" if QUERIES[n](spark, root).count() else "no rows"
        except Exception as e:  # noqa: BLE001
            msg = f"{type(e).__name__} {str(e)[:600]}"
        bad += bool(msg)
        print(f"{'FAIL' if msg else 'ok  '} {n} {time.time() - t0:.2f}s {msg}", flush=True)
    print(f"{len(names) - bad}/{len(names)} ok")
