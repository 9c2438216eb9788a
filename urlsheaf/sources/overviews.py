"""Reading per-partition overview documents, loose or inside archives."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from urlsheaf.sinks.filesystems import open_target, openers
from urlsheaf.sources.archives import listed, read_members

# Layout of an overview document.
ERRORS = "array<struct<status_code: string, error: string, count: bigint>>"
SUMMARY = (
    "struct<total_urls: bigint, successful_downloads: bigint, failed_downloads: bigint, "
    "success_rate_percent: double, downloaded_mb: double, elapsed_sec: double, avg_speed_MBps: double, "
    "shutdown_requested: boolean, tar_path: string>"
)
OVERVIEW = f"summary {SUMMARY}, error_breakdown {ERRORS}"
MEMBER = "overview.json"


def overview_columns(partition: Column, doc: Column) -> list[Column]:
    """Flat columns of an overview; missing numbers are zero."""
    summary = doc["summary"]

    def number(name: str, alias: str | None = None) -> Column:
        return F.coalesce(summary[name], F.lit(0)).alias(alias or name)

    return [
        partition.alias("partition_name"),
        number("total_urls"),
        number("successful_downloads"),
        number("failed_downloads"),
        number("downloaded_mb"),
        number("elapsed_sec"),
        number("avg_speed_MBps", "avg_speed_mbps"),
        number("success_rate_percent"),
        F.coalesce(doc["error_breakdown"], F.array().cast(ERRORS)).alias("errors"),
    ]


def _stem(path: Column) -> Column:
    name = F.regexp_extract(path, r"([^/]+)$", 1)
    return F.regexp_replace(name, r"(_overview)?\.(json|tar|tar\.gz|tgz)$", "")


def read_overviews(spark: SparkSession, path: str) -> DataFrame:
    """One row per overview: ``*.json`` documents, and ``<root>/overview.json`` wherever it stands in an archive.

    Documents and members that cannot be read are skipped.
    """
    known = openers()
    files = listed(path, known)
    loose = [(f,) for f in files if f.endswith(".json")]

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            pdf["text"] = [_text(p, known) for p in pdf["path"]]
            yield pdf

    texts = read_members(spark, path, f"*/{MEMBER}", content=True).select(
        "path", F.col("content").cast("string").alias("text"), "member"
    )
    texts = texts.filter(F.size(F.split("member", "/")) == 2).drop("member")
    if loose:
        # only paths travel to Python; documents are opened there
        paths = spark.createDataFrame(loose, "path string").repartition("path")
        texts = texts.unionByName(paths.mapInPandas(read, "path string, text string"))
    doc = F.from_json("text", OVERVIEW, {"mode": "PERMISSIVE"})
    parsed = texts.withColumn("_doc", doc).filter(F.col("_doc.summary").isNotNull())
    return parsed.select(*overview_columns(_stem(F.col("path")), F.col("_doc")))


def _text(path: str, known: dict) -> str | None:
    try:
        fs, local = open_target(path, known)
        with fs.open_input_stream(local, compression=None) as f:
            return f.read().decode()
    except (OSError, ValueError):
        return None
