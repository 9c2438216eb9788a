"""Live request log: interval metrics, percentiles and job progress."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from urlsheaf.operators.intervals import BY_PRESSURE, MIN_SAMPLES, streaming_snapshot
from urlsheaf.operators.outcomes import progress_columns, progress_sums
from urlsheaf.session import scratch_path

# Fixed value: how late a request may be reported.
LATENESS = "1 minute"


def read_log_stream(spark: SparkSession, folder: str, schema: T.StructType | str, glob: str = "*.parquet") -> DataFrame:
    """Request log files as a stream."""
    return spark.readStream.schema(schema).option("pathGlobFilter", glob).parquet(folder)


def stream_interval_metrics(log: DataFrame, interval: str, delay: str = LATENESS) -> DataFrame:
    """Interval metrics and percentiles of a stream, in append mode."""
    return streaming_snapshot(log, interval, delay, MIN_SAMPLES, BY_PRESSURE)


def stream_job_progress(outcomes: DataFrame, total: int, elapsed_col: str = "elapsed") -> DataFrame:
    """Running totals of a job, for output mode ``complete`` or ``update``."""
    sums = outcomes.agg(*progress_sums(), F.max(elapsed_col).alias("_secs"))
    return sums.select(*progress_columns(F.lit(total), F.col("_secs")))


def run_available(stream: DataFrame, mode: str = "append") -> DataFrame:
    """Run a stream over all data available now; gives the written result.

    ``complete`` keeps the result of the last batch only.  Late rows that the
    watermark dropped are counted in the query's progress.
    """
    spark = stream.sparkSession
    base = scratch_path(spark, "stream")
    writer = stream.writeStream.option("checkpointLocation", f"{base}/state").trigger(availableNow=True)
    if mode == "append":
        query = writer.format("parquet").option("path", f"{base}/rows").outputMode("append").start()
    else:

        def store(batch: DataFrame, number: int) -> None:
            batch.write.mode("overwrite").parquet(f"{base}/rows")

        query = writer.foreachBatch(store).outputMode(mode).start()
    query.awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{base}/rows")


def late_rows(query: StreamingQuery) -> int:
    """Rows that were late in the batches whose progress a query still holds, the last 100; ``progress.ProgressTotals``
    counts those of all batches."""
    return sum(
        operator["numRowsDroppedByWatermark"]
        for progress in query.recentProgress
        for operator in progress["stateOperators"]
    )
