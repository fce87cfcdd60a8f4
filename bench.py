"""Seconds per query at $BENCH_SF_DIR on local[$BENCH_CPUS]; one JSON line.

Each query is run once to warm up, then $BENCH_RUNS times (3 by default); the
median counts. Results go to the no-op sink, so all rows and columns are made.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from retailtide.plans.registry import all_queries  # noqa: E402
from retailtide.session import build_session  # noqa: E402


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    only = [name for name in os.environ.get("BENCH_ONLY", "").split(",") if name]
    spark = build_session(
        "retailtide-bench",
        master=f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus if cpus.isdigit() else "8",
            "spark.driver.memory": "8g",
            "spark.ui.enabled": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")

    seconds: dict[str, float] = {}
    for name, query in all_queries().items():
        if only and name not in only:
            continue
        # a stream query runs a whole stream and starts from nothing each time
        stream = name.endswith("_stream") or name.startswith("log_archive")
        took = []
        for number in range(2 if stream else runs + 1):
            begun = time.perf_counter()
            query(spark, sf_dir).write.format("noop").mode("overwrite").save()
            if number:
                took.append(time.perf_counter() - begun)
        seconds[name] = round(statistics.median(took), 3)
        print(f"{name}: {seconds[name]}", file=sys.stderr, flush=True)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total of median seconds per query",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1],
            }
        )
    )


if __name__ == "__main__":
    main()
