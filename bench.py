"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Each query is built and executed in full (all rows, all columns, no collect to the driver). The reported value is the sum
over the queries, each the better of two runs in one session.
"""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import SparkSession

from linkscout.plans import catalog

HEADLINES = (
    "tower_search_lit", "lit_search", "initial_search", "radius_join", "fcc_buffer_join", "building_rank_all", "cci_rank",
    "path_clearance", "vector_b", "vector_f", "vector_g", "cell_highlights", "link_view", "hub_lookup", "building_export",
    "fw_rank_clearance",
)


def run(spark: SparkSession, name: str, sf_dir: str) -> float:
    start = time.perf_counter()
    catalog.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    only = os.environ.get("BENCH_QUERIES")
    names = only.split(",") if only else HEADLINES
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", "16g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    times = {name: round(min(run(spark, name, sf_dir) for _ in range(2)), 3) for name in names}
    sf = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    print(json.dumps({"metric": "total_query_seconds", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times, "sf": sf}))
    spark.stop()


if __name__ == "__main__":
    main()
