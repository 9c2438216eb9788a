"""Reading probe checkpoints, one ``batch_idx=N`` folder per batch."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

RESULT = "idx bigint, corrected_url string, extension string, status string, batch_idx bigint"


def _checkpoints(spark: SparkSession, path: str) -> DataFrame:
    try:
        return spark.read.schema(RESULT).parquet(path)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e.getCondition()):
            return spark.createDataFrame([], RESULT)
        raise


def batch_sizes(spark: SparkSession, path: str) -> DataFrame:
    """``batch_idx, n_rows`` of the batches that have a checkpoint; reads no data column."""
    return _checkpoints(spark, path).groupBy("batch_idx").agg(F.count("*").alias("n_rows"))


def completed_batches(spark: SparkSession, path: str) -> DataFrame:
    """Batches that have a checkpoint."""
    return batch_sizes(spark, path).select("batch_idx")


def read_checkpoints(spark: SparkSession, path: str, expected: int) -> DataFrame:
    """All results, rejected unless there is one per manifest row."""
    results = _checkpoints(spark, path)
    found = results.agg(F.count("*")).first()[0]
    if found != expected:
        raise ValueError(f"checkpoints at {path} hold {found} of {expected} results")
    return results
