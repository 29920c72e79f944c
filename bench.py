"""Time the headline queries and print one JSON line.

BENCH_SF_DIR and BENCH_CPUS choose data and cores, BENCH_RUNS the number of
timed runs after a first one to warm up; the median counts. A run builds the
plan, works out the whole result and discards it.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import time

import pyarrow.parquet as pq

from verification.compare import local_session
from verification.queries import QUERIES

# Queries by the table whose rows they go through.
HEADLINES = {
    "retain_study_flows": "lineitem",
    "tag_through_pairs": "lineitem",
    "crosstab_tons_margins": "lineitem",
    "annual_truckloads": "lineitem",
    "rejected_flows": "lineitem",
    "sample_daily_trucks": "lineitem",
    "allocate_internal_ends": "lineitem",
    "sample_tripends": "lineitem",
    "temporal_allocation": "lineitem",
    "od_matrices": "lineitem",
    "profile_columns": "lineitem",
    "zonal_attractions": "customer",
    "generate_trips": "customer",
    "sample_local_destinations": "orders",
    "link_districts": "orders",
    "long_distance_matrices": "lineitem",
    "local_trip_matrices": "customer",
}


def timed(query, spark, sf_dir: str) -> float:
    start = time.perf_counter()
    query(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = local_session(os.environ.get("BENCH_CPUS", "8"))
    seconds, rates = {}, {}
    for name, table in HEADLINES.items():
        timed(QUERIES[name], spark, sf_dir)
        median = statistics.median(
            timed(QUERIES[name], spark, sf_dir) for _ in range(runs)
        )
        rows = pq.read_metadata(f"{sf_dir}/{table}.parquet").num_rows
        seconds[name] = round(median, 3)
        rates[name] = round(rows / median)
    scale = re.search(r"sf([\d.]+)", sf_dir)
    print(
        json.dumps(
            {
                "metric": "total time of headline queries, warm, median",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "input_rows_per_sec": rates,
                "sf": float(scale.group(1)) if scale else None,
            }
        )
    )


if __name__ == "__main__":
    main()
