"""Listing written outputs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from urlsheaf.functions.units import to_unit


def list_outputs(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """Name and size of every file; the contents are not read."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).load(path)
    name = F.regexp_extract("path", r"([^/]+)$", 1)
    return files.select(name.alias("name"), to_unit(F.col("length"), "mib").alias("size_mib")).orderBy("name")
