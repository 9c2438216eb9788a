"""Session helpers: where intermediate tables live, and how they are written.

Every intermediate result that is used more than once, or that must not be
computed twice (a fetch), is written as a parquet table below the folder the
cluster names in ``spark.checkpoint.dir``.  A written table survives the loss
of executors, and its real size lets the optimiser decide on broadcasting.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def checkpoint_root(spark: SparkSession) -> str:
    """Shared folder for intermediate tables, as configured on the session."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    root = tempfile.mkdtemp(prefix="urlsheaf-")
    spark.conf.set("spark.checkpoint.dir", root)
    return root


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unused path below the application's own part of the checkpoint folder."""
    return f"{_own_folder(spark)}/{name}-{uuid.uuid4().hex}"


def _own_folder(spark: SparkSession) -> str:
    return f"{checkpoint_root(spark)}/urlsheaf/{spark.sparkContext.applicationId}"


def clear_scratch(spark: SparkSession) -> None:
    """Remove all intermediate tables of this application, also those of jobs that failed.

    Frames that operators returned read them, so write what is still needed before.
    """
    at = spark._jvm.org.apache.hadoop.fs.Path(_own_folder(spark))
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def exists(spark: SparkSession, path: str) -> bool:
    """Whether there is a file or folder, on any file system that Spark reads."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at)


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once and return a frame that reads the written table."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def builder(app: str = "urlsheaf") -> SparkSession.Builder:
    """Session settings the operators are written for."""
    return (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        # a fetch must not run twice because a task is slow
        .config("spark.speculation", "false")
        .config(
            "spark.sql.streaming.stateStore.providerClass",
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
        )
    )
