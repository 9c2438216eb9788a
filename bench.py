"""Headline queries, timed; prints one JSON line."""

from __future__ import annotations

import json
import os
import re
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from urlsheaf.plans.catalogue import QUERIES  # noqa: E402
from urlsheaf.session import builder, clear_scratch  # noqa: E402

HEADLINE = [
    "clean_manifest",
    "extract_host",
    "extract_extension",
    "sanitize_filename",
    "host_counts",
    "row_index",
    "greedy_pack",
    "partition_by_host",
    "partition_by_label",
    "partition_simple_shuffled",
    "fetch_with_retry",
    "probe_extensions",
    "estimate_sizes",
    "overview_summary",
    "error_breakdown",
    "run_totals",
    "interval_metrics",
    "interval_percentiles",
    "ema",
    "recommend_concurrency",
    "pace_requests",
    "stream_interval_metrics",
    "timing_breakdown",
    "write_imagefolder",
    "write_tar_shards",
    "collect_csv",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        builder("bench")
        .master(f"local[{cpus}]")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="bench-"))
        .config("spark.log.level", "ERROR")
        .getOrCreate()
    )
    QUERIES["host_counts"](spark, sf_dir).count()  # start the JVM's and Python's workers
    QUERIES["greedy_pack"](spark, sf_dir).count()
    seconds = {}
    for name in HEADLINE:
        began = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - began, 3)
        clear_scratch(spark)
    spark.stop()
    found = re.search(r"sf([\d.]+)", sf_dir)
    result = {
        "metric": "headline_queries_total",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": float(found[1]) if found else None,
    }
    print(json.dumps(result))


if __name__ == "__main__":
    main()
