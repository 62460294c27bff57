"""Times every registered query, and a whole run against the UDF plan. Prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) is the input, BENCH_CPUS the local cores,
BENCH_REPEATS how often each is timed after one warm-up; the best run is reported. Extracts are written in the
warm-up, and everything written is deleted when the process ends.
"""

from __future__ import annotations

import json
import os
import time
from collections.abc import Callable

from pyspark.sql import SparkSession

from checks.extracts import extract, write_csv
from checks.queries import QUERIES, Query
from checks.scratch import scratch_folder
from checks.udf_plan import run_udf_plan
from customer_canon import provider_for, run


def best_seconds(works: dict[str, Callable[[], object]], repeats: int) -> dict[str, float]:
    """Shortest time of each work over ``repeats`` rounds through all of them, after one to warm up."""
    best = dict.fromkeys(works, float("inf"))
    for round_number in range(repeats + 1):
        for name, work in works.items():
            start = time.perf_counter()
            work()
            if round_number > 0:
                best[name] = min(best[name], round(time.perf_counter() - start, 3))
    return best


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeats = int(os.environ.get("BENCH_REPEATS", "2"))
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("customer-canon-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")

    def timed(query: Query) -> Callable[[], object]:
        return lambda: query(spark, sf_dir).write.format("noop").mode("overwrite").save()

    seconds = best_seconds({name: timed(query) for name, query in QUERIES.items()}, repeats)

    provider = provider_for("ERP_B")
    source = scratch_folder(spark, "bench-extract")
    write_csv(extract(spark, sf_dir, "ERP_B"), source)
    out = scratch_folder(spark, "bench-out")
    versus = best_seconds(
        {
            "run": lambda: run(spark, source, f"{out}/p", f"{out}/r", provider),
            "udf_plan": lambda: run_udf_plan(spark, source, f"{out}/up", f"{out}/ur"),
        },
        2 * repeats,
    )
    spark.stop()

    print(
        json.dumps(
            {
                "metric": "total seconds, best run per query",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "run_versus_udf_plan": versus,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
                "cpus": int(cpus),
            }
        )
    )


if __name__ == "__main__":
    main()
