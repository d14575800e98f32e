"""Time the registered queries on local[$BENCH_CPUS] over $BENCH_SF_DIR; print one JSON line.

All of them are, `feed_from_csv` with its files too; $BENCH_QUERIES, names separated by commas,
chooses others.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent))

from harness.queries import QUERIES  # noqa: E402


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("feedwright-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "8g"))
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")

    def timed(query) -> float:
        start = time.perf_counter()
        query(spark, sf_dir).write.format("noop").mode("overwrite").save()
        return round(time.perf_counter() - start, 3)

    chosen = os.environ.get("BENCH_QUERIES")
    names = chosen.split(",") if chosen else list(QUERIES)
    queries = {name: QUERIES[name] for name in names}

    def fixed_job() -> float:
        """Seconds of a job that uses none of the code, to tell the machine from the queries."""
        start = time.perf_counter()
        numbers = spark.range(0, 20_000_000, numPartitions=16).selectExpr("id % 100003 AS k", "sha2(string(id), 256) AS h")
        numbers.groupBy("k").agg({"h": "max"}).write.format("noop").mode("overwrite").save()
        return round(time.perf_counter() - start, 3)

    # Every query runs once untimed, for class loading and compilation.
    for query in queries.values():
        timed(query)
    fixed_job()
    machine = fixed_job()
    seconds = {name: timed(query) for name, query in queries.items()}
    spark.stop()

    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "run": "second of two",
                "fixed_job_seconds": machine,
                "sf": Path(sf_dir).name.removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
