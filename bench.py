"""Wall time per query; prints one JSON line.

``BENCH_SF_DIR`` names the tables, ``BENCH_CPUS`` the cores. Every query runs to its last row into a
sink that discards them, after one other query has warmed up the session. ``BENCH_REPEATS`` runs
each query more often and keeps its best time.
"""

from __future__ import annotations

import json
import os
import sys
import time

from quipu.demo.queries import QUERIES
from quipu.session import local_session


def run(spark, folder: str, name: str) -> float:
    started = time.perf_counter()
    QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
    return round(time.perf_counter() - started, 3)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = int(os.environ.get("BENCH_CPUS", "8"))
    wanted = sys.argv[1:] or list(QUERIES)
    spark = local_session(cores, app="quipu-bench")
    spark.sparkContext.setLogLevel("ERROR")
    repeats = int(os.environ.get("BENCH_REPEATS", "1"))
    run(spark, folder, "sales_by_country")
    best = {name: min(run(spark, folder, name) for _ in range(repeats)) for name in wanted}
    total = round(sum(best.values()), 3)
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": total,
                "unit": "sec",
                "queries": best,
                "cores": cores,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
