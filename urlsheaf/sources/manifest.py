"""Reading manifests and partition sets."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# File suffixes and the formats they stand for.
FORMAT_OF_SUFFIX = {".parquet": "parquet", ".csv": "csv", ".txt": "csv", ".xml": "xml"}
PARTITION_NAME = r"partition_(\d+)"


def infer_format(path: str) -> str:
    for suffix, fmt in FORMAT_OF_SUFFIX.items():
        if path.endswith(suffix):
            return fmt
    raise ValueError(f"cannot tell the file format from the name: {path}")


def read_manifest(
    spark: SparkSession,
    path: str,
    fmt: str | None = None,
    schema: T.StructType | str | None = None,
    row_tag: str = "row",
) -> DataFrame:
    """Manifest from one file or folder; pass ``schema`` to skip inference."""
    fmt = fmt or infer_format(path)
    reader = spark.read
    if fmt == "csv":
        reader = reader.option("header", True).option("inferSchema", schema is None)
    elif fmt == "xml":
        reader = reader.option("rowTag", row_tag)
    elif fmt != "parquet":
        raise ValueError(f"unsupported format {fmt!r}; use one of csv, parquet, xml")
    if schema is not None:
        reader = reader.schema(schema)
    try:
        return reader.format(fmt).load(path)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e.getCondition()):
            raise FileNotFoundError(path) from e
        raise


def read_manifest_dir(spark: SparkSession, path: str) -> DataFrame:
    """All parquet files of a folder; columns are merged, broken files skipped."""
    return (
        spark.read.option("mergeSchema", True)
        .option("ignoreCorruptFiles", True)
        .option("pathGlobFilter", "*.parquet")
        .parquet(path)
    )


def read_partitions(spark: SparkSession, path: str) -> DataFrame:
    """A partition set with its ``group``: ``group=N`` folders or numbered files."""
    df = spark.read.parquet(path)
    if "group" in df.columns:
        return df
    number = F.regexp_extract(F.col("_metadata.file_path"), PARTITION_NAME, 1)
    return df.withColumn("group", F.nullif(number, F.lit("")).cast("int"))


def require_columns(df: DataFrame, *cols: str) -> None:
    """Plan-time check; no job is started."""
    missing = [c for c in cols if c not in df.columns]
    if missing:
        raise ValueError(f"column(s) {', '.join(missing)} not found; available: {', '.join(df.columns)}")
