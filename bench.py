"""Time every driver query once and print one JSON line.

Each query first runs untimed on a smaller scale next to the measured one, if there is one, so
that the times show the queries and not the start of the JVM.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

from terrasse.catalogue import QUERIES
from terrasse.settings import build_session


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or list(QUERIES)
    spark = build_session("bench", f"local[{cpus}]", **{
        "spark.sql.shuffle.partitions": cpus,
        "spark.driver.memory": os.environ.get("BENCH_MEMORY", "8g"),
        "spark.ui.enabled": "false",
        "spark.checkpoint.dir": tempfile.mkdtemp(prefix="bench-"),
        "spark.ui.showConsoleProgress": "false",
    })
    spark.sparkContext.setLogLevel("ERROR")
    small = os.path.join(os.path.dirname(sf.rstrip("/")), "sf0.001")

    def run(name: str, path: str) -> None:
        QUERIES[name](spark, path).write.format("noop").mode("overwrite").save()

    run("group_metrics", sf)
    seconds = {}
    for name in names:
        if os.path.isdir(small):
            run(name, small)
        start = time.perf_counter()
        run(name, sf)
        seconds[name] = round(time.perf_counter() - start, 3)
    print(json.dumps({
        "metric": "total_query_seconds", "value": round(sum(seconds.values()), 3), "unit": "sec", "queries": seconds, "sf": sf,
    }))


if __name__ == "__main__":
    main()
