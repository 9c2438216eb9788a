"""Writing overviews and run reports as JSON."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from urlsheaf.operators.outcomes import count_errors, overview_summary
from urlsheaf.sinks.samples import save_files
from urlsheaf.sinks.store import Store


def overview_documents(
    outcomes: DataFrame, inputs: dict, elapsed, by: str, suffix: str | None = ".tar.gz"
) -> DataFrame:
    """``by`` and ``overview``: the JSON document of each shard or partition.

    ``suffix`` is that of the archives, None without archives.  ``elapsed`` of
    None takes the time from a shard's first request to its last answer.
    """
    summary = overview_summary(outcomes, elapsed=elapsed, by=[by])
    counted = count_errors(outcomes, [by])
    entry = F.struct(
        (-F.col("n")).alias("rank"), "status_code", "error", F.col("n").alias("count")
    )
    # rows are already counted: one entry per different error of the partition
    errors = counted.groupBy(by).agg(F.array_sort(F.collect_list(entry)).alias("_errors"))
    script = F.struct(*[F.lit(v).alias(k) for k, v in inputs.items()])
    document = F.struct(
        script.alias("script_inputs"),
        F.struct(
            "total_urls",
            "successful_downloads",
            "failed_downloads",
            "success_rate_percent",
            "downloaded_mb",
            "elapsed_sec",
            F.col("avg_speed_mbps").alias("avg_speed_MBps"),
            F.lit(False).alias("shutdown_requested"),
            (F.concat(F.col(by).cast("string"), F.lit(suffix)) if suffix else F.lit(None).cast("string")).alias("tar_path"),
        ).alias("summary"),
        F.transform(
            F.coalesce("_errors", F.array()), lambda e: F.struct(e["status_code"], e["error"], e["count"])
        ).alias("error_breakdown"),
        F.date_format(F.current_timestamp(), "yyyy-MM-dd HH:mm:ss").alias("timestamp_local"),
    )
    return summary.join(errors, by, "left").select(by, F.to_json(document).alias("overview"))


def write_overview(documents: DataFrame, out: str, by: str, mode: str = "errorifexists") -> None:
    """``<out>/<name>_overview.json`` beside the shards, one per document."""
    members = documents.select(
        F.concat(F.col(by).cast("string"), F.lit("_overview.json")).alias("path"),
        F.col("overview").cast("binary").alias("content"),
    )
    save_files(members, Store(out), mode)


def write_report(report: DataFrame, path: str, mode: str = "errorifexists") -> None:
    report.coalesce(1).write.mode(mode).json(path)  # one row
