"""Time the headline queries; prints one JSON line.

``BENCH_SF_DIR`` names the table folder, ``BENCH_CPUS`` the local threads,
``BENCH_QUERIES`` (optional, comma-separated) the queries. Each query runs once to warm up
and then ``BENCH_RUNS`` times; the median counts. The whole-warehouse build runs once.
"""

import json
import os
import statistics
import time

from pyspark.sql import SparkSession

from starkeep.queries import QUERIES

BUILD = ["warehouse_facts"]
HEADLINE = [
    "smoke_top10",
    "star_extract",
    "kpi_totals",
    "monthly_trend",
    "category_share",
    "detail_table",
    "ratio_by_month",
    "geo_points",
    "heat_map",
    "scatter",
    "rate_by_band",
    "role_playing_dates",
    "drill_across",
    "clean_incidents",
    "clean_hourly_json",
    "two_format_times",
    "latest_per_user",
    "version_history",
    "version_merge",
    "version_changes",
    "overwrite_upsert",
    "insert_if_absent",
    "fact_upsert",
    "surrogate_keys",
    "asof_lookup",
    "asof_lookup_large",
    "two_key_lookup",
    "two_key_lookup_large",
    "bridge_rows",
    "pair_counts",
    "hours_between",
    "change_hashes",
    "orphan_keys",
    "same_fingerprint",
]


def run(spark, name, folder):
    start = time.perf_counter()
    QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main():
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "1"))
    chosen = os.environ.get("BENCH_QUERIES")
    names = chosen.split(",") if chosen else HEADLINE + BUILD
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in names:
        if name not in BUILD:
            run(spark, name, folder)
        times = [run(spark, name, folder) for _ in range(1 if name in BUILD else runs)]
        seconds[name] = round(statistics.median(times), 3)
    spark.stop()
    report = {
        "metric": "total_seconds",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
    }
    print(json.dumps(report))


if __name__ == "__main__":
    main()
