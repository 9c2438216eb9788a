"""From manifest to stored dataset in one call."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from urlsheaf.functions.names import IMAGEFOLDER
from urlsheaf.operators.fetch import fetch_with_retry
from urlsheaf.operators.manifest import add_row_key, clean_manifest, require_rows, with_host
from urlsheaf.operators.outcomes import needs_retry
from urlsheaf.operators.partition import (
    partition_by_host,
    partition_by_label,
    partition_simple,
)
from urlsheaf.operators.queue import claimed
from urlsheaf.operators.requests import plan_requests
from urlsheaf.operators.transport import HttpTransport
from urlsheaf.session import exists, materialise
from urlsheaf.sinks.reports import overview_documents, write_overview
from urlsheaf.sinks.samples import finish, prepare_target, with_members
from urlsheaf.sinks.store import SHARD_BYTES, Store, store, sweep

HOST, SIMPLE, LABEL = "host", "simple", "label"


@dataclass(frozen=True)
class Job:
    """What to collect, and how."""

    url_col: str = "url"
    label: str | None = None
    groups: int = 8
    method: str = HOST
    fmt: str = IMAGEFOLDER
    naming: str = "sequential"
    pattern: str = "{segment[-2]}"
    default_ext: str = ".jpg"
    max_attempts: int = 3
    backoff: float = 2.0
    timeout: int = 30
    success_codes: tuple | range = (200,)
    compress: bool = True
    shard_bytes: int = SHARD_BYTES
    mean_bytes: int = 200_000


def _split(df: DataFrame, job: Job) -> DataFrame:
    if job.method == HOST:
        return partition_by_host(df, job.url_col, job.groups)
    if job.method == LABEL:
        if job.label is None:
            raise ValueError("partitioning by label needs a label column")
        return partition_by_label(df, job.label, job.groups)
    if job.method == SIMPLE:
        order = [F.col("row_key").cast("long")] if "row_key" in df.columns else None
        return partition_simple(df, job.groups, order)
    raise ValueError(f"unknown method {job.method!r}; use host, label or simple")


def plan_only(df: DataFrame, job: Job = Job()) -> DataFrame:
    """Rows and hosts per partition, and the shard it would fill; fetches nothing."""
    split = _split(clean_manifest(df, job.url_col), job)
    hosted = split if "host" in split.columns else with_host(split, job.url_col)
    sizes = hosted.groupBy("group").agg(F.count("*").alias("n_rows"), F.countDistinct("host").alias("n_hosts"))
    return sizes.withColumn("target", F.format_string("output_partition_%03d", F.col("group")))


def _requests(df: DataFrame, job: Job, out: str) -> DataFrame:
    keyed = materialise(add_row_key(clean_manifest(df, job.url_col)), "manifest")
    require_rows(keyed)
    return plan_requests(
        _split(keyed, job),
        job.url_col,
        label=job.label,
        out=out,
        fmt=job.fmt,
        naming=job.naming,
        pattern=job.pattern,
        default_ext=job.default_ext,
    )


def collect_outcomes(
    df: DataFrame,
    transport,
    job: Job = Job(),
    out: str = "",
    work_dir: str | None = None,
    **options,
) -> DataFrame:
    """Clean, key, partition and fetch; gives the outcome table."""
    return fetch_with_retry(
        _requests(df, job, out),
        transport,
        job.max_attempts,
        backoff=job.backoff,
        work_dir=work_dir,
        timeout=job.timeout,
        success_codes=job.success_codes,
        **options,
    )


def _keeper(transport, target: Store, fmt: str):
    """What becomes of a slice's answers: content goes into its archive or file, the outcomes are kept.

    A task's rows of one group fill its archives, so nothing is shuffled or sorted once there is content.  Recorded
    answers are joined to the requests, in whatever layout that gives, and are brought together first.
    """

    def keep(got: DataFrame, attempt: int, number: int, last: bool) -> DataFrame:
        if target.tar and not transport.keeps_layout:
            got = got.repartition("group")
        final = F.lit(True) if last else ~needs_retry()
        name = F.format_string(
            f"output_partition_%03d_{attempt:02d}_{number:04d}_%04d", F.col("group"), F.spark_partition_id()
        )
        return store(with_members(got, "", fmt).withColumn("shard", F.when(final, name)), target)

    return keep


def collect_dataset(
    df: DataFrame,
    transport,
    out: str,
    job: Job = Job(),
    tar: bool = True,
    mode: str = "errorifexists",
    work_dir: str | None = None,
    **slices: int,
) -> DataFrame:
    """Collect a dataset below ``out``: tar shards, or plain files.

    Answers are written as they come, to ``<out>/shards`` as archives of about ``shard_bytes``, each ended by its
    overview, or to ``<out>/samples``.  The overviews also go to ``<out>/overviews``, and ``_manifest`` beside the shards
    or samples lists what was written.  Gives the outcome table, without content.

    A job that was broken off goes on where it was if it is called anew with the same ``work_dir``: its output is then
    its own, and existing output of any other job is refused or overwritten as ``mode`` says.  ``slices``:
    ``rows_per_file`` and ``files_per_slice`` of the queue.
    """
    spark = df.sparkSession
    targets = [f"{out}/shards" if tar else f"{out}/samples", f"{out}/overviews"]
    begun = claimed(spark, f"{work_dir}/attempt=1") if work_dir else None
    resumed = begun is not None and begun.get("target") == targets[0]
    if not resumed:
        for place in targets:  # before the first request is sent
            prepare_target(place, mode)
    inputs = _script_inputs(job, out)
    target = Store(targets[0], tar, job.compress, job.shard_bytes, inputs if tar else None)
    if isinstance(transport, HttpTransport):
        # a task has the rows of about one archive
        rows = max(1, job.shard_bytes // max(1, job.mean_bytes))
        transport = replace(transport, rows_per_slice=min(transport.rows_per_slice, rows))
    outcomes = collect_outcomes(
        df,
        transport,
        job,
        "",
        work_dir,
        by="group" if tar else None,
        keep=_keeper(transport, target, job.fmt),
        owner={"target": targets[0], "fmt": job.fmt, "compress": job.compress},
        **slices,
    )
    if not exists(spark, f"{targets[0]}/_SUCCESS"):
        manifest = outcomes.filter(F.col("member").isNotNull())
        if tar:
            sweep(target, outcomes.filter(F.col("stored_in").isNotNull()))
        finish(targets[0], manifest.select("stored_in", "member", "bytes_downloaded", "crc32"))
    if tar:
        named = outcomes.withColumn("shard", F.regexp_replace("stored_in", r"\.tar(\.gz)?$", ""))
    else:
        named = outcomes.withColumn("shard", F.format_string("output_partition_%03d", F.col("group")))
    suffix = target.suffix if tar else None
    documents = materialise(overview_documents(named, inputs, None, "shard", suffix), "overviews")
    write_overview(documents, targets[1], "shard", "overwrite" if resumed else mode)
    return outcomes


def _script_inputs(job: Job, out: str) -> dict:
    """What the job was called with, as its overviews tell it."""
    codes = job.success_codes
    listed = f"{codes.start}-{codes.stop - 1}" if isinstance(codes, range) else ",".join(map(str, codes))
    return {
        "output": out,
        "output_format": job.fmt,
        "url_column": job.url_col,
        "label_column": job.label or "",
        "naming_mode": job.naming,
        "naming_pattern": job.pattern,
        "partition_method": job.method,
        "partitions": job.groups,
        "timeout_sec": job.timeout,
        "max_attempts": job.max_attempts,
        "success_codes": listed,
        "compress": job.compress,
    }
