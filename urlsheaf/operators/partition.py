"""Splitting a manifest into balanced groups, and describing the split."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from urlsheaf.functions.text import whole_quotient
from urlsheaf.operators.joins import attach_by_key
from urlsheaf.operators.manifest import with_host
from urlsheaf.operators.ordering import indexed, indexed_by_key, with_position, without_position
from urlsheaf.operators.packing import greedy_pack
from urlsheaf.sources.manifest import require_columns

# Fixed value: ceiling of an automatically sized worker pool.
MAX_POOL = 10_000


def host_counts(df: DataFrame) -> DataFrame:
    return df.groupBy("host").agg(F.count("*").alias("n_rows")).orderBy(F.desc("n_rows"), "host")


def label_counts(df: DataFrame, label: str) -> DataFrame:
    return df.groupBy(label).agg(F.count("*").alias("n_rows"))


def top_hosts(df: DataFrame, k: int = 5) -> DataFrame:
    return df.groupBy("host").agg(F.count("*").alias("n_rows")).orderBy(F.desc("n_rows"), "host").limit(k)


def attach_host_group(df: DataFrame, groups: DataFrame, host: str = "host") -> DataFrame:
    return attach_by_key(df, groups, host, "n_rows")


def attach_label_group(df: DataFrame, groups: DataFrame, label: str) -> DataFrame:
    """As by host; a null label finds the group of the null label."""
    return attach_by_key(df, groups, label, "n_rows")


def partition_simple(df: DataFrame, n: int, order_by=None, shuffle_seed: int | None = None) -> DataFrame:
    """Contiguous slices in row order; the first ``rows % n`` get one row more."""
    if shuffle_seed is not None and order_by is None:
        placed = with_position(df)
        order = [F.xxhash64(F.lit(shuffle_seed), "_file", "_pos"), F.col("_file"), F.col("_pos")]
        rows, total = indexed(placed, "_i", order)
        rows = without_position(rows)
    else:
        rows, total = indexed(df, "_i", order_by)
    size, extra = divmod(total, n)
    head = extra * (size + 1)
    i = F.col("_i")
    tail_group = extra + whole_quotient(i - head, F.lit(max(size, 1)))
    group = F.when(i < head, whole_quotient(i, F.lit(size + 1))).otherwise(tail_group) + 1
    return rows.withColumn("group", group.cast("int")).drop("_i")


def _in_stretches(df: DataFrame, label: str, n: int, out: str) -> DataFrame:
    """Rows with the number of their stretch, and its name under ``out``."""
    rows, total = indexed_by_key(df, label, "_i")
    size = max(-(-total // n), 1)
    numbered = rows.withColumn("_stretch", whole_quotient(F.col("_i"), F.lit(size)) + 1)
    named = F.concat(F.col(label).cast("string"), F.lit("_"), F.col("_stretch").cast("string"))
    return numbered.withColumn(out, named).drop("_i")


def chunk_labels(df: DataFrame, label: str, n: int, out: str = "label_chunk") -> DataFrame:
    """Cut the label-sorted rows into ``n`` stretches; ``label_k`` names both.

    Pass ``out=label`` to replace the label itself.  Null labels stay null.
    """
    return _in_stretches(df, label, n, out).drop("_stretch")


def partition_by_host(df: DataFrame, url_col: str, n: int, host: str = "host") -> DataFrame:
    """All URLs of a host share one group; groups are packed by URL count."""
    require_columns(df, url_col)
    hosted = with_host(df, url_col, host)
    counts = hosted.groupBy(host).agg(F.count("*").alias("n_rows"))
    return attach_host_group(hosted, greedy_pack(counts, host, "n_rows", n), host)


def partition_by_label(df: DataFrame, label: str, n: int) -> DataFrame:
    """Label chunks, packed by row count; replaces a ``group`` column.

    Rows without a label are cut into stretches like those of any label.
    """
    require_columns(df, label)
    chunked = _in_stretches(df.drop("group"), label, n, "label_chunk")
    unnamed = F.concat(F.lit("\0"), F.col("_stretch").cast("string"))  # no label begins like that
    keyed = chunked.withColumn("_chunk_key", F.coalesce("label_chunk", unnamed)).drop("_stretch")
    counts = keyed.groupBy("_chunk_key").agg(F.count("*").alias("n_rows"))
    return attach_label_group(keyed, greedy_pack(counts, "_chunk_key", "n_rows", n), "_chunk_key").drop("_chunk_key")


def rows_per_partition(df: DataFrame) -> DataFrame:
    return df.groupBy("group").agg(F.count("*").alias("n_rows"))


def partition_summary(df: DataFrame) -> DataFrame:
    """One row: groups, rows, and the smallest, largest and mean group."""
    return rows_per_partition(df).agg(
        F.count("*").alias("n_groups"),
        F.coalesce(F.sum("n_rows"), F.lit(0)).alias("n_rows"),
        F.min("n_rows").alias("min_rows"),
        F.max("n_rows").alias("max_rows"),
        F.avg("n_rows").alias("mean_rows"),
    )


def hosts_per_partition(df: DataFrame, approx: bool = False) -> DataFrame:
    hosts = F.approx_count_distinct("host") if approx else F.countDistinct("host")
    return df.groupBy("group").agg(hosts.alias("n_hosts"))


def plan_parallelism(df: DataFrame, c_max: int, configured: int | None = None) -> DataFrame:
    """Distinct hosts and the worker pool they call for."""
    hosts = df.agg(F.countDistinct("host").alias("n_hosts"))
    if configured is not None and configured > 0:
        pool = F.lit(configured).cast("long")
    else:
        pool = F.least(F.col("n_hosts") * c_max, F.lit(MAX_POOL).cast("long"))
    return hosts.withColumn("pool_size", pool)
