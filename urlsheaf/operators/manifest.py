"""Cleaning, keying and combining manifests."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from urlsheaf.functions.text import strip
from urlsheaf.functions.urls import extract_host
from urlsheaf.operators.ordering import row_index
from urlsheaf.sources.manifest import require_columns


def clean_manifest(df: DataFrame, url_col: str) -> DataFrame:
    """Drop null and blank URLs, strip the rest."""
    require_columns(df, url_col)
    kept = df.filter(F.col(url_col).isNotNull())
    stripped = kept.withColumn(url_col, strip(F.col(url_col)))
    return stripped.filter(F.length(url_col) > 0)


def require_rows(df: DataFrame) -> DataFrame:
    """Raise when there is nothing to do; reads at most one row."""
    if df.isEmpty():
        raise ValueError("no valid URLs found after cleaning")
    return df


def add_row_key(df: DataFrame, order_by=None, out: str = "row_key") -> DataFrame:
    """0-based row index as text."""
    return row_index(df, order_by, out).withColumn(out, F.col(out).cast("string"))


def with_host(df: DataFrame, url_col: str, out: str = "host") -> DataFrame:
    return df.withColumn(out, extract_host(F.col(url_col)))


def concat_all(*dfs: DataFrame) -> DataFrame:
    """Union of all rows; columns are matched by name, missing ones are null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), dfs)


def distinct_hosts(df: DataFrame) -> DataFrame:
    return df.select("host").distinct()


def preview(df: DataFrame, n: int, order_by: list[str]) -> DataFrame:
    """The first ``n`` rows with the table's row and column counts."""
    first = df.orderBy(*order_by).limit(n)
    return first.withColumn("n_rows", F.lit(df.count())).withColumn("n_columns", F.lit(len(df.columns)))
