"""Benchmark the headline queries and print one JSON line.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS
(default 8), BENCH_RUNS (default 3, after one warm-up run).
Each query result goes through the ``noop`` sink, so the whole plan runs
without collecting rows. ``full_run`` is the complete medallion run (O1)
over Bronze CSV landed once from the statistics mapping.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

from pyspark.sql import functions as F  # noqa: E402

from trendflow import catalog  # noqa: E402
from trendflow.plans.gold import run_gold  # noqa: E402
from trendflow.plans.orchestrate import Layout, run_all  # noqa: E402
from trendflow.session import local_session, scratch_path  # noqa: E402
from trendflow.sources.tables import SPREAD  # noqa: E402
from trendflow.sinks.parquet import land_reference  # noqa: E402
from trendflow.sources import tables as src  # noqa: E402

HEADLINE = {
    "trending_analytics": catalog.q_trending_analytics,     # A1
    "channel_analytics": catalog.q_channel_analytics,       # A2 + W2
    "category_analytics": catalog.q_category_analytics,     # A3 + W3
    "dedup_latest": catalog.q_dedup_latest,                 # D1
    "dq_report": catalog.q_dq_report,                       # Q3-Q8, one pass per table
    "silver_statistics": catalog.q_silver_statistics,       # P1-P11 + D1 from raw text
}


def noop(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def timed(fn) -> float:
    t0 = time.perf_counter()
    fn()
    return time.perf_counter() - t0


def land_bronze(spark, sf_dir: str, root: str) -> Layout:
    layout = Layout(f"{root}/bronze/statistics", f"{root}/bronze/reference",
                    f"{root}/silver", f"{root}/gold")
    flat = src.flat_bronze_view(spark, sf_dir).withColumn("region", F.upper(F.trim("region")))
    flat.write.mode("overwrite").option("header", True).partitionBy("region").csv(layout.bronze_statistics)
    docs = src.category_documents_view(spark, sf_dir).select(
        "kind", "etag", "items", F.upper("region").alias("region"))
    land_reference(docs, layout.bronze_reference)
    return layout


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = local_session(cpus, shuffle_partitions=cpus, app="trendflow-bench")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(32 * 1024 * 1024))
    spark.conf.set(SPREAD, str(cpus))  # each test file is a single row group

    jobs = {name: (lambda q=q: noop(q(spark, sf_dir))) for name, q in HEADLINE.items()}
    layout = land_bronze(spark, sf_dir, scratch_path(spark, "bench"))
    regions = ["africa", "america", "asia", "europe", "middle east"]
    jobs["full_run"] = lambda: run_all(spark, layout, regions=regions)

    results = {}
    for name, job in jobs.items():
        job()  # warm-up
        results[name] = round(statistics.median(timed(job) for _ in range(runs)), 3)
    # beside the sum: jobs over the Silver that full_run stored
    more = {}
    spark.conf.unset(SPREAD)
    extra = {"gold_from_silver": lambda: run_gold(spark, layout.silver_statistics, layout.silver_reference, layout.gold_root),
             "gold_of_one_month": lambda: run_gold(spark, layout.silver_statistics, layout.silver_reference, layout.gold_root,
                                                   touched=[(r, 199506) for r in regions])}
    for name, job in extra.items():
        job()
        more[name] = round(statistics.median(timed(job) for _ in range(runs)), 3)
    sf = os.path.basename(sf_dir).removeprefix("sf")
    print(json.dumps({
        "metric": "sum_of_median_query_seconds",
        "value": round(sum(results.values()), 3),
        "unit": "sec",
        "queries": results,
        "more": more,
        "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
        "cpus": cpus,
        "shuffle_partitions": cpus,
        "runs": runs,
        "spark": spark.version,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
