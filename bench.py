"""Time the headline queries and print one JSON line.

Each query runs once to warm up and then three times into the no-op sink; its figure is the
median. Streaming and writing queries run once, since building them already does the work.
"""

from __future__ import annotations

import json
import os
import statistics
import time

from hazardlake import catalog
from hazardlake.session import build_session

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
BATCH = ("agg_04", "agg_08", "agg_12", "agg_13", "agg_18", "agg_19", "agg_22", "agg_30", "agg_32", "agg_38",
         "agg_40", "agg_42", "dq_03", "dq_05", "dq_14", "spa_01", "ts_07")
ONCE = ("snk_05", "str_03")


def timed(build) -> float:
    start = time.perf_counter()
    build().write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    spark = build_session("bench", f"local[{CPUS}]", {
        "spark.sql.shuffle.partitions": CPUS, "spark.driver.memory": "12g"})
    spark.sparkContext.setLogLevel("ERROR")
    queries, seconds = catalog.callables(), {}
    for name in BATCH:
        def build(name=name):
            return queries[name](spark, SF_DIR)
        timed(build)
        seconds[name] = round(statistics.median(timed(build) for _ in range(3)), 3)
    for name in ONCE:
        seconds[name] = round(timed(lambda: queries[name](spark, SF_DIR)), 3)
    print(json.dumps({
        "metric": "headline queries, total of medians", "value": round(sum(seconds.values()), 3),
        "unit": "sec", "queries": seconds, "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
    }), flush=True)
    spark.stop()


if __name__ == "__main__":
    main()
