"""Time the headline queries; prints one JSON line. ``BENCH_SF_DIR`` and ``BENCH_CPUS`` choose data and cores."""

from __future__ import annotations

import json
import os
import statistics
import time

from adapters.queries import CHECKS
from tidemark.session import local_session

HEADLINE = [
    "t04_customer",
    "t07_quote",
    "t08_order",
    "t09_delivery",
    "t10_sales_invoice",
    "t11_porder",
    "t14_time_of",
    "t16_capacity",
    "e1_distinct",
    "e4_equal",
    "k1_surrogate",
    "l1_append_hwm",
    "l2_insert_absent",
    "l4_sync_merge",
    "l5_sync_upsert",
    "s3_read_target",
    "l4_stored_merge",
]
RUNS = int(os.environ.get("BENCH_RUNS", "3"))


def timed(spark, query, sf_dir: str) -> float:
    start = time.perf_counter()
    query(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(int(os.environ.get("BENCH_CPUS", "8")), "bench")
    seconds = {}
    for name in HEADLINE:
        timed(spark, CHECKS[name].query, sf_dir)
        seconds[name] = round(statistics.median(timed(spark, CHECKS[name].query, sf_dir) for _ in range(RUNS)), 3)
    line = {
        "metric": "sum of median query times",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }
    print(json.dumps(line), flush=True)
    spark.stop()


if __name__ == "__main__":
    main()
