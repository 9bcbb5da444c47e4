"""Time every registered query: one JSON line on stdout.

Reads ``$BENCH_SF_DIR`` (default sf0.1) on ``local[$BENCH_CPUS]``. Each query is run in full into a
sink that discards the rows: once cold, then ``$BENCH_RUNS`` times (default 2), of which the best
counts. Queries whose work is writing do it while they are built, so building is timed too.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from checks.catalog import QUERIES
from perigee.session import build_session


def seconds(build, spark, sf_dir: str) -> float:
    began = time.perf_counter()
    build(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - began


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    names = sys.argv[1:] or list(QUERIES)
    spark = build_session(
        "perigee-bench",
        {
            "spark.master": f"local[{cpus}]",
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "8g"),
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("OFF")
    cold, best = {}, {}
    for name in names:
        cold[name] = round(seconds(QUERIES[name], spark, sf_dir), 3)
        best[name] = round(min(seconds(QUERIES[name], spark, sf_dir) for _ in range(runs)), 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(best.values()), 3),
                "unit": "sec",
                "queries": best,
                "cold": cold,
                "sf": Path(sf_dir).name.removeprefix("sf"),
                "cpus": int(cpus),
            }
        )
    )


if __name__ == "__main__":
    main()
