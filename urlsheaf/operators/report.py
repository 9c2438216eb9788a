"""Run reports: many overviews, the manager's log, task timings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from urlsheaf.functions.units import MB_PER_TB, human_duration, parse_task_timing, to_unit

# Stand-ins for errors without a status or text.
NO_STATUS = "unknown"
NO_ERROR = "Unknown error"


def run_totals(overviews: DataFrame) -> DataFrame:
    return overviews.agg(
        *[
            F.coalesce(F.sum(c), F.lit(0)).alias(c)
            for c in ("total_urls", "successful_downloads", "failed_downloads", "downloaded_mb")
        ]
    )


def run_errors(overviews: DataFrame) -> DataFrame:
    """Error counts of all partitions, most frequent first."""
    listed = overviews.select(F.explode("errors").alias("e"))
    return (
        listed.groupBy(
            F.coalesce("e.status_code", F.lit(NO_STATUS)).alias("status_code"),
            F.coalesce("e.error", F.lit(NO_ERROR)).alias("error"),
        )
        .agg(F.sum(F.coalesce("e.count", F.lit(0))).alias("n"))
        .orderBy(F.desc("n"), "status_code", "error")
    )


def partition_stats(overviews: DataFrame) -> DataFrame:
    """Spread of success rate and throughput over partitions; 0 when there are none."""

    def spread(column: str, name: str) -> list[Column]:
        return [
            F.coalesce(F.round(f(column), 2), F.lit(0.0)).alias(f"{name}_{label}")
            for label, f in (("min", F.min), ("max", F.max), ("avg", F.avg))
        ]

    return overviews.agg(
        F.count("*").alias("n_partitions"),
        *spread("success_rate_percent", "success_rate"),
        *spread("avg_speed_mbps", "throughput_mbps"),
    )


def performance_summary(log: DataFrame) -> DataFrame:
    """Per log file: start, end, wall time, peak workers and final counters."""
    first, last = F.min_by("timestamp", "line_no"), F.max_by("timestamp", "line_no")
    sums = log.groupBy("file").agg(
        first.alias("_start"),
        last.alias("_end"),
        F.coalesce(F.max("workers_connected"), F.lit(0)).alias("peak_workers"),
        *[
            F.max_by(c, "line_no").alias(out)
            for c, out in (
                ("tasks_done", "tasks_completed"),
                ("tasks_failed", "tasks_failed"),
                ("bytes_received", "bytes_received"),
            )
        ],
    )
    wall = (F.col("_end") - F.col("_start")) / 1e6
    return sums.select(
        "file",
        F.timestamp_micros("_start").alias("run_start"),
        F.timestamp_micros("_end").alias("run_end"),
        wall.alias("wall_sec"),
        human_duration(wall).alias("wall_human"),
        "tasks_completed",
        "tasks_failed",
        "peak_workers",
        "bytes_received",
        F.round(to_unit(F.col("bytes_received"), "tib"), 2).alias("bytes_received_tib"),
    )


def run_report(
    performance: DataFrame,
    totals: DataFrame,
    stats: DataFrame,
    errors: DataFrame | None = None,
    run_info: dict | None = None,
) -> DataFrame:
    """One row of structs per run summary; ``totals`` and ``stats`` are one-row frames.

    ``errors`` are the counted errors of all partitions, which the report lists most frequent first; ``run_info`` is
    told by the report as it is (what was run, on what).
    """
    made = _report(performance, totals, stats)
    entry = F.struct((-F.col("n")).alias("rank"), "status_code", "error", F.col("n").alias("count"))
    if errors is not None:
        # rows are already counted: one entry per different error
        listed = errors.agg(F.array_sort(F.collect_list(entry)).alias("_errors")).withColumn("_one", F.lit(1))
        made = made.withColumn("_one", F.lit(1)).join(listed, "_one", "left")
        kept = F.transform("_errors", lambda e: F.struct(e["status_code"], e["error"], e["count"]))
        made = made.withColumn("error_breakdown", kept).drop("_errors", "_one")
    if run_info is not None:
        told = [F.lit(v).cast("string").alias(k) for k, v in run_info.items()]
        date = F.substring("run_stats.run_start", 1, 10).alias("run_date")
        made = made.withColumn("run_info", F.struct(*told, date))
    return made


def _report(performance: DataFrame, totals: DataFrame, stats: DataFrame) -> DataFrame:
    known = totals.first().asDict() | stats.first().asDict()
    known["_failed"] = known.pop("failed_downloads")
    whole = performance.select("*", *[F.lit(v).alias(k) for k, v in known.items()])
    rate = F.when(F.col("total_urls") > 0, F.col("successful_downloads") * 100.0 / F.col("total_urls")).otherwise(0.0)
    speed = F.when(F.col("wall_sec") > 0, F.col("downloaded_mb") / F.col("wall_sec")).otherwise(0.0)
    return whole.select(
        F.struct(
            F.date_format("run_start", "yyyy-MM-dd HH:mm:ss").alias("run_start"),
            F.date_format("run_end", "yyyy-MM-dd HH:mm:ss").alias("run_end"),
            F.round("wall_sec", 2).alias("total_wall_time_sec"),
            F.col("wall_human").alias("total_wall_time_human"),
            "tasks_completed",
            "tasks_failed",
            "peak_workers",
            F.col("bytes_received_tib").alias("bytes_received_TB"),
        ).alias("run_stats"),
        F.struct(
            "total_urls",
            "successful_downloads",
            F.col("_failed").alias("failed_downloads"),
            F.round(rate, 2).alias("success_rate_percent"),
            F.round(F.col("downloaded_mb") / MB_PER_TB, 2).alias("total_downloaded_TB"),
            F.round(speed, 2).alias("effective_throughput_MBps"),
        ).alias("download_stats"),
        F.struct(
            F.col("n_partitions").alias("count"),
            _spread("success_rate").alias("success_rate"),
            _spread("throughput_mbps").alias("throughput_MBps"),
        ).alias("partition_stats"),
    )


def _spread(name: str) -> Column:
    return F.struct(*[F.col(f"{name}_{k}").alias(k) for k in ("min", "max", "avg")])


def task_times(tasks: DataFrame) -> DataFrame:
    """Seconds spent per task: execution, output transfer, input transfer."""

    def span(start: str, end: str) -> Column:
        known = (F.col(start) > 0) & (F.col(end) > 0)
        return F.when(known, (F.col(end) - F.col(start)) / 1e6).otherwise(0.0)

    timing = parse_task_timing(F.col("output"))
    return (
        tasks.withColumn("exec_sec", F.coalesce(F.col("time_workers_execute_last") / 1e6, F.lit(0.0)))
        .withColumn("output_sec", span("time_when_commit_start", "time_when_commit_end"))
        .withColumn("_whole", span("time_when_submitted", "time_when_done"))
        .withColumn("input_sec", F.greatest(F.lit(0.0), F.col("_whole") - F.col("exec_sec") - F.col("output_sec")))
        .withColumn("download_sec", F.when(F.col("successful"), timing["download_sec"]))
        .withColumn("tar_sec", F.when(F.col("successful"), timing["tar_sec"]))
        .drop("_whole")
    )


def timing_breakdown(tasks: DataFrame) -> DataFrame:
    """Sums over tasks, and their share of the measured time."""
    parts = ("exec_sec", "input_sec", "output_sec", "download_sec", "tar_sec")
    sums = task_times(tasks).agg(
        *[F.coalesce(F.sum(c), F.lit(0.0)).alias(c) for c in parts],
        F.coalesce(F.sum("bytes_received"), F.lit(0)).alias("bytes_received"),
        F.coalesce(F.sum("bytes_sent"), F.lit(0)).alias("bytes_sent"),
    )
    measured = F.col("exec_sec") + F.col("input_sec") + F.col("output_sec")
    shares = [
        F.when(measured > 0, F.col(c) * 100.0 / measured).alias(c.replace("_sec", "_percent")) for c in parts
    ]
    return sums.select("*", measured.alias("measured_sec"), *shares)


def task_tally(tasks: DataFrame) -> DataFrame:
    """Completed, failed and successful tasks, and the time they took."""
    first = F.min(F.when(F.col("time_when_submitted") > 0, F.col("time_when_submitted")))
    last = F.max(F.when(F.col("time_when_done") > 0, F.col("time_when_done")))
    return tasks.agg(
        F.count("*").alias("completed"),
        F.count_if(~F.col("successful")).alias("failed"),
        (F.count("*") - F.count_if(~F.col("successful"))).alias("successful"),
        ((last - first) / 1e6).alias("elapsed_sec"),
    )
