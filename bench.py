"""Time the registered queries and print one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default: all cores) choose the setting;
query names as arguments choose a subset.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from catalog.queries import QUERIES  # noqa: E402
from wickline.session import local_session  # noqa: E402


def run(query, spark, sf_dir: str) -> float:
    """Seconds to compute every row and column of a query, without collecting it."""
    started = time.perf_counter()
    query(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - started


def main(names: list[str]) -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(os.environ.get("BENCH_CPUS", "*"), "wickline-bench")
    spark.sparkContext.setLogLevel("ERROR")
    chosen = {name: QUERIES[name] for name in names or QUERIES}
    run(QUERIES["bars_1h"], spark, sf_dir)  # start the executors and warm the JVM
    run(QUERIES["freshness"], spark, sf_dir)  # write the table that the market reports read
    seconds = {name: round(run(query, spark, sf_dir), 3) for name, query in chosen.items()}
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
    main(sys.argv[1:])
