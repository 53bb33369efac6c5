"""Run registered queries against DuckDB: python tests/check.py [name-prefix ...]"""

from __future__ import annotations

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import oracle  # noqa: E402

from strataflow.catalog import QUERIES, SQL, load_all  # noqa: E402
from strataflow.session import build_session  # noqa: E402


def main() -> int:
    prefixes = sys.argv[1:]
    sf_dir = os.environ.get("STRATA_SF_DIR", "/root/testdata/sf0.01")
    load_all()
    spark = build_session(
        "check", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g"}
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = oracle.connect(sf_dir)
    failed = 0
    total = 0
    for name in sorted(QUERIES):
        if prefixes and not any(name.startswith(p) for p in prefixes):
            continue
        total += 1
        start = time.time()
        try:
            df = QUERIES[name](spark, sf_dir)
            if name in SQL:
                problem = oracle.compare(name, df, con, SQL[name])
                status = "ok" if problem is None else "DIFF"
            else:
                n = len(df.collect())
                problem, status = (None, f"rows={n}") if n else (f"{name}: empty", "EMPTY")
        except Exception as e:  # noqa: BLE001 - report and continue
            problem, status = f"{name}: {type(e).__name__} {str(e)[:1200]}", "ERROR"
        took = time.time() - start
        if problem or took > 3 or len(sys.argv) > 1:
            print(f"{status:6} {name} {took:.1f}s", flush=True)
        if problem:
            failed += 1
            print("   ", problem[:1500], flush=True)
    print(f"{total} checked, {failed} failed", flush=True)
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main())
