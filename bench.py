"""Time the headline queries; prints one JSON line.

``BENCH_SF_DIR`` names the table folder, ``BENCH_CPUS`` the number of local threads, ``BENCH_REPEAT``
how often each query runs (the best time counts). Results are written to the no-op sink, so every
row is computed and none is collected. Two warm-up queries keep the start of the JVM and of the Python
workers out of the first numbers.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

from pyspark.sql import SparkSession

from checks.registry import QUERIES

HEADLINE = [
    "clean_ads",
    "cleaning_report",
    "quality_checks",
    "enriched_ads",
    "weekly_share",
    "weekly_share_joined",
    "latest_share",
    "skill_counts_view",
    "share_trend",
    "technical_gap",
    "top_terms_by_country",
    "term_hits_documents",
    "term_counts_documents",
    "normalized_pages",
    "value_counts",
    "null_summary",
    "salary_describe",
    "lineitem_describe",
    "price_histogram",
    "price_box_by_flag",
    "event_share_by_day",
    "order_trend",
    "search_pages",
    "page_cutoff",
    "history_normalised",
    "replace_by_key",
    "jobs_master",
    "dimension_job",
    "snapshot_fact",
    "stream_weekly_share",
]


def main(names: list[str]) -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeat = int(os.environ.get("BENCH_REPEAT", "1"))
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("advertlake-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", "16g")
        .config("spark.checkpoint.dir", f"file://{tempfile.mkdtemp(prefix='advertlake-bench-')}")
        .config("spark.log.level", "ERROR")
        .getOrCreate()
    )
    for name in ("weekly_share", "salary_describe"):
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    times = {}
    for name in names or HEADLINE:
        best = None
        for _ in range(repeat):
            start = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            took = time.perf_counter() - start
            best = took if best is None else min(best, took)
        times[name] = round(best, 3)
    spark.stop()
    line = {
        "metric": "headline_queries_total",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }
    print(json.dumps(line), flush=True)


if __name__ == "__main__":
    main(sys.argv[1:])
