"""Fetch outcomes: merging attempts, retry sets, summaries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from urlsheaf.functions.status import is_connection_error, is_retryable


def needs_retry() -> Column:
    return ~F.col("success") & is_retryable(F.col("status_code"), F.col("error"))


def retry_set(df: DataFrame, outcomes: DataFrame) -> DataFrame:
    """Rows of ``df`` whose outcome is worth another attempt."""
    keys = outcomes.filter(needs_retry()).select("row_key")
    return df.join(keys, "row_key", "left_semi")


def lookup_outcomes(df: DataFrame, outcomes: DataFrame) -> DataFrame:
    """Every row with its outcome; rows without one keep nulls."""
    known = [c for c in outcomes.columns if c == "row_key" or c not in df.columns]
    return df.join(outcomes.select(*known), "row_key", "left")


def upsert_outcomes(old: DataFrame, new: DataFrame) -> DataFrame:
    """One outcome per key, the new one where there is one."""
    kept = old.join(new.select("row_key"), "row_key", "left_anti")
    return kept.unionByName(new, allowMissingColumns=True)


def last_attempts(outcomes: DataFrame) -> DataFrame:
    """One outcome per key from a log of attempts, the latest one."""
    rest = F.struct(*[c for c in outcomes.columns if c != "row_key"])
    return outcomes.groupBy("row_key").agg(F.max_by(rest, "attempt").alias("_o")).select("row_key", "_o.*")


def attempt_summary(outcomes: DataFrame) -> DataFrame:
    return outcomes.groupBy("attempt").agg(
        F.count_if("success").alias("n_success"),
        F.count_if(~F.col("success")).alias("n_failed"),
        F.count_if(needs_retry()).alias("n_retryable"),
    )


def _percent(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, part * 100.0 / whole).otherwise(0.0)


def _rate(amount: Column, secs: Column) -> Column:
    return F.when(secs > 0, amount / secs).otherwise(0.0)


def overview_summary(
    outcomes: DataFrame, total: int | None = None, elapsed: float | Column | None = 0.0, by: list[str] | None = None
) -> DataFrame:
    """Totals, success rate, megabytes (10^6) and speed; one row, or one per ``by``.

    ``elapsed`` of None is the rows' own: from the first request to the last
    first byte, zero where no times are known.
    """
    began = F.col("ts").cast("double") if "ts" in outcomes.columns else F.lit(None).cast("double")
    ended = began + F.coalesce(F.col("ttfb"), F.lit(0.0)) if "ttfb" in outcomes.columns else began
    if elapsed is None:
        secs = F.coalesce(F.col("_span"), F.lit(0.0))
    else:
        secs = elapsed if isinstance(elapsed, Column) else F.lit(float(elapsed))
    sums = outcomes.groupBy(*(by or [])).agg(
        F.count("*").alias("_rows"),
        F.count_if("success").alias("successful_downloads"),
        F.count_if(~F.col("success")).alias("failed_downloads"),
        F.coalesce(F.sum(F.when(F.col("success"), F.col("bytes_downloaded"))), F.lit(0)).alias("_bytes"),
        (F.max(ended) - F.min(began)).alias("_span"),
    )
    rows = F.lit(total).cast("long") if total is not None else F.col("_rows")
    mb = F.col("_bytes") / 1e6
    return sums.select(
        *(by or []),
        rows.alias("total_urls"),
        "successful_downloads",
        "failed_downloads",
        F.round(_percent(F.col("successful_downloads"), rows), 2).alias("success_rate_percent"),
        F.round(mb, 3).alias("downloaded_mb"),
        F.round(secs, 3).alias("elapsed_sec"),
        F.round(_rate(mb, secs), 3).alias("avg_speed_mbps"),
    )


def request_log(outcomes: DataFrame) -> DataFrame:
    """The outcome table as a request log, the input of the interval metrics."""
    return outcomes.select(
        "host",
        "ts",
        "status_code",
        "ttfb",
        F.col("bytes_downloaded").alias("bytes"),
        (F.col("status_code").isNull() & is_connection_error(F.col("error"))).alias("is_conn_error"),
        "retry_after",
    )


def count_errors(outcomes: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Failures per status and message."""
    failed = outcomes.filter(~F.col("success"))
    return failed.groupBy(*(by or []), "status_code", "error").agg(F.count("*").alias("n"))


def error_breakdown(outcomes: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Failures per status and message, most frequent first."""
    counted = count_errors(outcomes, by)
    return counted.orderBy(*(by or []), F.desc("n"), "status_code", "error")


def path_collisions(outcomes: DataFrame) -> DataFrame:
    """Paths that more than one key was written to."""
    written = outcomes.filter(F.col("success") & F.col("file_path").isNotNull())
    return (
        written.groupBy("file_path")
        .agg(F.countDistinct("row_key").alias("n_keys"))
        .filter("n_keys > 1")
    )


def progress_columns(total: Column, secs: Column) -> list[Column]:
    """Progress figures from ``completed``, ``successful`` and ``bytes``."""
    return [
        F.col("completed"),
        F.col("successful"),
        F.col("failed"),
        _percent(F.col("completed"), total).alias("progress_percent"),
        _percent(F.col("successful"), F.col("completed")).alias("success_percent"),
        _rate(F.col("bytes") / 1e6, secs).alias("throughput_mbps"),
    ]


def progress_sums() -> list[Column]:
    return [
        F.count("*").alias("completed"),
        F.count_if("success").alias("successful"),
        F.count_if(~F.col("success")).alias("failed"),
        F.coalesce(F.sum("bytes_downloaded"), F.lit(0)).alias("bytes"),
    ]


def job_progress(outcomes: DataFrame, total: int, elapsed: float) -> DataFrame:
    """Share done, share successful and speed of a running job."""
    sums = outcomes.agg(*progress_sums())
    return sums.select(*progress_columns(F.lit(total), F.lit(float(elapsed))))
