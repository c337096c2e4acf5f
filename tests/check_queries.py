"""Compare all registered queries: python tests/check_queries.py [sf folder] [name part ...]"""

from __future__ import annotations

import pathlib
import sys
import time

sys.path.insert(0, str(pathlib.Path(__file__).resolve().parent.parent))

from millrace.session import build_session
from tests.compare import compare, connect
from workload import CASES


def main() -> int:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    parts = sys.argv[2:]
    spark = build_session("check", "local[8]", spark__sql__shuffle__partitions="8", spark__driver__memory="8g")
    spark.sparkContext.setLogLevel("ERROR")
    con, failed = connect(sf), 0
    for name, case in CASES.items():
        if parts and not any(p in name for p in parts):
            continue
        start = time.time()
        try:
            problems = compare(spark, con, case, sf)
        except Exception as error:  # keep going, report all
            problems = [f"{type(error).__name__}: {str(error)[:1500]}"]
        kind = "rows-only" if case.sql is None else "sql"
        print(f"{'FAIL' if problems else 'ok':5}{name:36}{kind:10}{time.time() - start:6.1f}s", *problems, flush=True)
        failed += bool(problems)
    print(f"{failed} failed")
    return failed


if __name__ == "__main__":
    sys.exit(1 if main() else 0)
