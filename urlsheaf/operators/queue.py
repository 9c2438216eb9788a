"""A queue of requests on disk, worked off in slices that are never done twice.

The requests are written once, as files of a stated number of rows; a stream takes some files at a time.  A slice is done
when the table it makes is committed.  A job that was broken off and is started anew reads the stream's log of offsets,
goes on at the slice it was in, and repeats no other.  Its folder belongs to one job: the rows and options that began it
are told by a fingerprint, and any other job is refused before it does anything.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from urlsheaf.session import exists

#: Rows of a file of the queue.
ROWS_PER_FILE = 25_000
#: Files of a slice, per core that the session has.
FILES_PER_CORE = 4
_SUCCESS = "_SUCCESS"


class AnotherJobError(ValueError):
    """The working folder belongs to another job."""


def written(spark: SparkSession, path: str) -> DataFrame | None:
    """The table at ``path`` if its write was committed as a whole."""
    return spark.read.parquet(path) if exists(spark, f"{path}/{_SUCCESS}") else None


def _sums(df: DataFrame) -> list:
    """Count and content of all rows, in any order."""
    columns = [F.col(f"`{c}`").cast("string") for c in sorted(df.columns)]
    return [
        F.count(F.lit(1)).alias("n"),
        F.coalesce(F.sum(F.xxhash64(*columns).cast("decimal(38,0)")), F.lit(0)).cast("string").alias("content"),
    ]


def _record(n: int, content: str, options: dict) -> str:
    return json.dumps({"rows": n, "content": content, **{k: str(v) for k, v in sorted(options.items())}})


def claimed(spark: SparkSession, base: str) -> dict | None:
    """What is recorded of the job that owns the folder, if any does."""
    record = written(spark, f"{base}/job")
    return json.loads(record.first()["job"]) if record is not None else None


def open_queue(requests: DataFrame, base: str, options: dict, rows_per_file: int = ROWS_PER_FILE) -> str:
    """The folder of the queue of ``requests`` below ``base``; writes it, and claims ``base``, if that is new.

    Rows are dealt by hash, so every slice is an even share of all hosts.  What tells the job apart is read from the
    written files: a metric observed on the way would count a stage that was run again twice.
    """
    spark, queue = requests.sparkSession, f"{base}/queue"
    owner = claimed(spark, base)
    if owner is not None:
        sums = requests.agg(*_sums(requests)).first()
        if owner != json.loads(_record(sums["n"], sums["content"], options)):
            raise AnotherJobError(f"{base} belongs to another job or manifest")
        return queue
    dealt = requests.repartition("row_key")
    dealt.write.mode("overwrite").option("maxRecordsPerFile", rows_per_file).parquet(queue)
    sums = spark.read.parquet(queue).agg(*_sums(requests)).first()
    record = _record(sums["n"], sums["content"], options)
    spark.range(1).select(F.lit(record).alias("job")).write.mode("overwrite").parquet(f"{base}/job")
    return queue


def work_off(
    spark: SparkSession,
    queue: str,
    base: str,
    step: Callable[[DataFrame, int], DataFrame],
    files_per_slice: int | None = None,
) -> DataFrame:
    """``step`` of every slice of the queue, each written as a table of its own; all of them together.

    ``step`` gets a slice and its number and gives the rows to keep.  It runs once for each slice that was not committed.
    """
    files = files_per_slice or FILES_PER_CORE * spark.sparkContext.defaultParallelism
    schema = spark.read.parquet(queue).schema

    def run(rows: DataFrame, number: int) -> None:
        path = f"{base}/slices/slice={number}"
        if not exists(rows.sparkSession, f"{path}/{_SUCCESS}"):
            step(rows, number).write.mode("overwrite").parquet(path)

    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", files).parquet(queue)
    query = (
        stream.writeStream.trigger(availableNow=True)
        .option("checkpointLocation", f"{base}/log")
        .foreachBatch(run)
        .start()
    )
    try:
        query.awaitTermination()
    finally:
        query.stop()
    return spark.read.option("basePath", f"{base}/slices").parquet(f"{base}/slices").drop("slice")
