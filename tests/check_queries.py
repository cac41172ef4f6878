"""Run queries against their checking SQL: python tests/check_queries.py SF_DIR [name part ...]"""

from __future__ import annotations

import os
import sys
import tempfile
import time
import traceback

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


def main() -> int:
    from catalog.all import ORACLES, QUERIES
    from compare import connect, difference
    from haulmark.session import spark_session

    if os.environ.get("HOT_MIN_ROWS"):  # treat small keys as hot, to run the hot-key code on test data
        from haulmark.operators import skew
        skew.HOT_MIN_ROWS = int(os.environ["HOT_MIN_ROWS"])
    sf = sys.argv[1]
    wanted = sys.argv[2:]
    shared = tempfile.mkdtemp(prefix="haulmark-check-")
    spark = spark_session(master="local[8]", shuffle_partitions=8, extra={"spark.driver.memory": "12g", "spark.checkpoint.dir": shared})
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf)
    bad = 0
    for name, fn in QUERIES.items():
        if wanted and not any(w in name for w in wanted):
            continue
        start = time.time()
        try:
            df = fn(spark, sf)
            if name in ORACLES:
                problem = difference(df, con, ORACLES[name])
                n = " rows=%d" % con.execute(f"select count(*) from ({ORACLES[name]}) q").fetchall()[0][0]
            else:
                n = f" rows={df.count()} (no SQL)"
                problem = None
        except Exception as e:  # noqa: BLE001
            problem, n = f"{type(e).__name__}: {str(e)[:700]}", ""
            if os.environ.get("TRACE"):
                traceback.print_exc()
        bad += problem is not None
        print(f"{'FAIL' if problem else 'ok  '} {name} {time.time() - start:.1f}s{n} {problem or ''}", flush=True)
    print("failures:", bad)
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())
