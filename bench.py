"""Times every registered query: warm second run, all rows computed. Prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from eventmart.catalogue.registry import registered  # noqa: E402
from eventmart.session import local_session  # noqa: E402


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    chosen = sys.argv[1:]
    spark = local_session(cpus, "bench", **{"spark.sql.shuffle.partitions": cpus if cpus.isdigit() else "8"})
    spark.sparkContext.setLogLevel("ERROR")
    seconds: dict[str, float] = {}
    for name, (run, _) in registered().items():
        if chosen and name not in chosen:
            continue
        for _ in range(2):
            begin = time.perf_counter()
            run(spark, sf_dir).write.format("noop").mode("overwrite").save()
            seconds[name] = round(time.perf_counter() - begin, 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
