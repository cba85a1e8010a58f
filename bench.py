"""Headline benchmark: prints ONE JSON line.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Each query runs to completion through the ``noop`` sink (every row computed,
nothing collected to the driver). One warm-up pass over all queries (JIT,
file listing), then ``BENCH_REPEAT`` interleaved timed passes (default 3);
each query reports its median, including building its plan. ``value`` is the
sum of the medians.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from cardlake.plans.queries import QUERIES  # noqa: E402
from cardlake.session import get_spark  # noqa: E402

HEADLINE = ["fraud_report", "scd2_clients_day2", "scd2_terminals_day2", "txn_enriched",
            "win_lag12", "fraud_report_accumulated"]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeat = int(os.environ.get("BENCH_REPEAT", "3"))
    only = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q] or HEADLINE
    spark = get_spark(f"local[{cpus}]", shuffle_partitions=cpus)
    spark.sparkContext.setLogLevel("ERROR")

    def once(name: str) -> float:
        t0 = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - t0

    for name in only:
        once(name)  # warm-up pass
    runs: dict[str, list[float]] = {name: [] for name in only}
    for _ in range(repeat):
        for name in only:
            runs[name].append(once(name))
    timings = {name: round(statistics.median(ts), 3) for name, ts in runs.items()}
    sf = sf_dir.rstrip("/").rsplit("sf", 1)[-1]
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(timings.values()), 3),
                      "unit": "sec", "queries": timings, "sf": sf, "cpus": cpus,
                      "repeat": repeat, "spark": spark.version}))
    spark.stop()


if __name__ == "__main__":
    main()
