"""Runs registered queries against the second engine: ``python tests/check_queries.py SF_DIR [name ...]``."""

from __future__ import annotations

import os
import sys
import time
import traceback

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from eventmart.catalogue.registry import registered  # noqa: E402
from eventmart.session import local_session  # noqa: E402
from tests.oracle import connect, differences  # noqa: E402


def main() -> int:
    sf_dir, chosen = sys.argv[1], sys.argv[2:]
    spark = local_session("8")
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    bad = 0
    for name, (run, sql) in registered().items():
        if chosen and name not in chosen:
            continue
        begin = time.time()
        try:
            df = run(spark, sf_dir)
            problems = differences(df, con, sql) if sql else [] if df.count() >= 0 else ["no result"]
        except Exception:
            problems = [traceback.format_exc(limit=4)[-3000:]]
        bad += bool(problems)
        print(f"{'FAIL' if problems else 'ok  '} {time.time() - begin:6.2f}s {name}{'' if sql else ' (no SQL)'}")
        for p in problems:
            print("     ", p)
    return bad


if __name__ == "__main__":
    sys.exit(main())
