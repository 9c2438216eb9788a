"""Fetching as a table operator, with retries."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from urlsheaf.functions.status import INVALID_URL_TEXT, status_error
from urlsheaf.functions.urls import valid_url
from urlsheaf.operators.outcomes import needs_retry
from urlsheaf.operators.queue import ROWS_PER_FILE, open_queue, work_off
from urlsheaf.session import exists, scratch_path


def _accepted(status: Column, codes: Iterable[int]) -> Column:
    if isinstance(codes, range):
        return F.coalesce(status.between(codes.start, codes.stop - 1), F.lit(False))
    return F.coalesce(status.isin(*codes), F.lit(False))


def fetch(
    requests: DataFrame,
    transport,
    timeout: int = 30,
    success_codes: Iterable[int] = (200,),
    attempt: int = 1,
    error_prefix: str = "HTTP {code}",
    retry_after_status: int | None = None,
    by: str | None = None,
) -> DataFrame:
    """One request per row of a request table; gives the outcome table.

    The outcome of a network transport must be written before it is used
    twice, see ``fetch_with_retry``.  ``by``: a column whose rows are asked
    for together, as far as the transport lays out its requests.
    """
    got = transport.get(requests, attempt, timeout, *([by] if by else []))
    valid = valid_url(F.col("url"))
    ok = valid & _accepted(F.col("status_code"), success_codes)
    status = F.when(valid, F.col("status_code"))
    message = status_error(F.col("status_code"), F.col("kind"), F.col("detail"), error_prefix)
    content = F.when(ok, F.col("content"))
    wait = F.col("retry_after")
    if retry_after_status is not None:
        wait = F.when(F.col("status_code") == retry_after_status, wait)
    kept = [c for c in ("group", "host_cap") if c in requests.columns]
    return got.select(
        "row_key",
        "url",
        "host",
        F.lit(attempt).alias("attempt"),
        ok.alias("success"),
        F.when(valid, F.col("file_path")).alias("file_path"),
        "class_name",
        status.alias("status_code"),
        F.when(~valid, F.lit(INVALID_URL_TEXT)).when(~ok, message).alias("error"),
        F.coalesce(F.length(content), F.lit(0)).cast("long").alias("bytes_downloaded"),
        "ttfb",
        wait.alias("retry_after"),
        "ts",
        *kept,
        content.alias("content"),
    )


def fetch_attempts(
    requests: DataFrame,
    transport,
    max_attempts: int = 3,
    backoff: float = 2.0,
    work_dir: str | None = None,
    keep: Callable[[DataFrame, int, int, bool], DataFrame] | None = None,
    owner: dict | None = None,
    files_per_slice: int | None = None,
    rows_per_file: int = ROWS_PER_FILE,
    **options,
) -> list[DataFrame]:
    """The written outcome table of every attempt.

    An attempt works off a queue on disk, slice by slice; a slice's outcomes
    are on disk before anything reads them, so no later plan can send a
    request again.  Called anew with the same ``work_dir``, it goes on at the
    slice that was broken off.  A ``work_dir`` of another manifest, other
    options or another ``owner`` is refused.

    ``keep`` gets a slice's outcomes with content, the attempt, the slice's
    number and whether it is the last attempt, and gives the rows to write.
    """
    spark = requests.sparkSession
    base = work_dir or scratch_path(spark, "fetch")
    asked = {**options, **(owner or {})}
    pending, attempts = requests, []
    for attempt in range(1, max_attempts + 1):
        own, last = f"{base}/attempt={attempt}", attempt == max_attempts
        queue = open_queue(pending, own, asked, rows_per_file)
        if attempt > 1 and transport.retry_wait and not exists(spark, f"{own}/slices"):
            time.sleep(backoff)

        def step(rows: DataFrame, number: int, attempt: int = attempt, last: bool = last) -> DataFrame:
            got = fetch(rows, transport, attempt=attempt, **options)
            return keep(got, attempt, number, last) if keep else got

        done = work_off(spark, queue, own, step, files_per_slice).withColumn("attempt", F.lit(attempt))
        attempts.append(done)
        retry = done.filter(needs_retry())
        if last or retry.isEmpty():
            break
        pending = retry.select(*[c for c in requests.columns if c in retry.columns])
    return attempts


def fetch_with_retry(requests: DataFrame, transport, max_attempts: int = 3, **options) -> DataFrame:
    """Final outcome per row: the last attempt made for it.

    A row goes on to the next attempt exactly when it can be retried, so the
    final rows are told by a filter on each attempt; nothing is shuffled.
    """
    attempts = fetch_attempts(requests, transport, max_attempts, **options)
    final = [a.filter(~needs_retry()) for a in attempts[:-1]] + attempts[-1:]
    merged = final[0]
    for part in final[1:]:
        merged = merged.unionByName(part)
    return merged
