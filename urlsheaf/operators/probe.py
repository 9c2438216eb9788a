"""Repairing file extensions and estimating the size of a dataset."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from urlsheaf.functions.urls import REPAIR_EXTENSIONS, repair_urls, size_urls, split_url_ext
from urlsheaf.operators.ordering import batch_index, row_index, sample_n
from urlsheaf.session import materialise, scratch_path
from urlsheaf.sources.checkpoints import batch_sizes, read_checkpoints
from urlsheaf.sources.manifest import require_columns

# Outcomes of a probe.
UNCHANGED = "unchanged"
CORRECTED = "corrected"
NOT_FOUND = "not_found"
NO_EXTENSION = "no_extension"

# A probe is committed in at most this many waves of whole batches.
MAX_WAVES = 100
MIN_BATCHES_PER_WAVE = 64
# Batch numbers that are broadcast, 16 bytes each.
BROADCAST_BATCHES = 1_000_000


def pending_batches(df: DataFrame, done: DataFrame) -> DataFrame:
    """Rows whose batch has no checkpoint yet."""
    return df.join(done.select("batch_idx"), "batch_idx", "left_anti")


def _probe(work: DataFrame, transport, exts) -> DataFrame:
    """``idx, batch_idx, corrected_url, extension, status`` for ``idx, batch_idx, url``."""
    listed = work.withColumn("_tries", repair_urls(F.col("url"), exts))
    shaped = F.size("_tries") > 0
    found = transport.first_working(listed.filter(shaped), "idx", "_tries")
    pos = F.col("pos")
    own = split_url_ext(F.col("url"))["ext"]
    probed = found.select(
        "idx",
        "batch_idx",
        F.coalesce("candidate", "url").alias("corrected_url"),
        F.when(pos == 0, own)
        .when(pos > 0, F.regexp_extract("candidate", r"(?U)\.(\w+)$", 1))
        .alias("extension"),
        F.when(pos == 0, F.lit(UNCHANGED))
        .when(pos > 0, F.lit(CORRECTED))
        .otherwise(F.lit(NOT_FOUND))
        .alias("status"),
    )
    bare = listed.filter(~shaped).select(
        "idx",
        "batch_idx",
        F.col("url").alias("corrected_url"),
        F.lit(None).cast("string").alias("extension"),
        F.lit(NO_EXTENSION).alias("status"),
    )
    return probed.unionByName(bare)


def probe_extensions(
    df: DataFrame,
    url_col: str,
    transport,
    exts=REPAIR_EXTENSIONS,
    batch_size: int = 500_000,
    checkpoint: str | None = None,
    idx: str | None = None,
    batches_per_wave: int | None = None,
) -> DataFrame:
    """Probe result per row; resumable with a ``checkpoint`` folder.

    Batches are probed in waves of many at a time, and each wave is committed
    as a whole; a transport whose every wave reads all its answers tells how
    many rows are worth one.  A batch with fewer results than rows was broken
    off and is probed anew.  ``idx`` names an existing 0-based index, else the
    file order gives one.
    """
    require_columns(df, url_col)
    spark = df.sparkSession
    numbered = df.withColumn("idx", F.col(idx)) if idx else row_index(df, out="idx")
    work = batch_index(numbered.select("idx", F.col(url_col).alias("url")), batch_size, "idx")
    target = checkpoint or scratch_path(spark, "probe")
    sizes = materialise(work.groupBy("batch_idx").agg(F.count("*").alias("n_rows")), "batches")
    facts = sizes.agg(F.max("batch_idx").alias("last"), F.sum("n_rows").alias("rows")).first()
    if facts["last"] is None:
        return _probe(work, transport, exts)
    if batches_per_wave is None:
        least = max(MIN_BATCHES_PER_WAVE, -(-transport.rows_per_wave // batch_size))
        batches_per_wave = max(least, facts["last"] // MAX_WAVES + 1)
    whole = batch_sizes(spark, target).withColumnRenamed("n_rows", "_found")
    due = sizes.join(whole, "batch_idx", "left").filter(F.coalesce("_found", F.lit(-1)) != F.col("n_rows"))
    low = F.col("batch_idx") - F.col("batch_idx") % batches_per_wave
    due = materialise(due.select("batch_idx", low.alias("wave")), "due")
    # one row per wave, of which there are at most MAX_WAVES
    waves = [r[0] for r in due.select("wave").distinct().orderBy("wave").collect()]
    if len(waves) > 1:
        # written by wave, so that each reads its own rows only
        path = scratch_path(spark, "waves")
        due_work = work.join(F.broadcast(due), "batch_idx") if facts["last"] < BROADCAST_BATCHES else work.join(due, "batch_idx")
        due_work.write.partitionBy("wave").parquet(path)
        work = spark.read.parquet(path)
    else:
        work = work.join(due, "batch_idx")
    for wave in waves:
        found = _probe(work.filter(F.col("wave") == wave).drop("wave"), transport, exts)
        found.hint("rebalance", "batch_idx").write.mode("overwrite").option(
            "partitionOverwriteMode", "dynamic"
        ).partitionBy("batch_idx").parquet(target)
    return read_checkpoints(spark, target, facts["rows"])


def apply_probe(df: DataFrame, results: DataFrame, url_col: str, idx: str = "idx") -> DataFrame:
    """The manifest with its URLs replaced by the corrected ones."""
    fixed = results.select(F.col("idx").alias(idx), F.col("corrected_url").alias("_fixed"))
    columns = [F.col("_fixed").alias(url_col) if c == url_col else F.col(c) for c in df.columns if c != idx]
    return df.join(fixed, idx).select(*columns)


def probe_summary(results: DataFrame) -> DataFrame:
    """Rows and share per status."""
    counts = results.groupBy("status").agg(F.count("*").alias("n"))
    # a window over the few statuses
    whole = F.sum("n").over(W.partitionBy(F.lit(0)))
    return counts.select("status", "n", (F.col("n") * 100.0 / whole).alias("percent"))


def extension_counts(results: DataFrame) -> DataFrame:
    """Working URLs per extension."""
    working = results.filter(F.col("extension").isNotNull())
    return working.groupBy("extension").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "extension")


def estimate_sizes(
    df: DataFrame,
    url_col: str,
    transport,
    key: str,
    sample: int | None = None,
    seed: int = 0,
) -> DataFrame:
    """Size in KB (1024) of every URL, or of a sample; 0 when not resolved."""
    require_columns(df, url_col, key)
    rows = df.filter(F.col(url_col).isNotNull()).select(key, F.col(url_col).alias("url"))
    if sample is not None:
        rows = sample_n(rows, sample, [key], seed)
    tried = rows.withColumn("_tries", size_urls(F.col("url")))
    found = transport.first_size(tried, key, "_tries")
    return found.select(
        key,
        "url",
        "candidate",
        F.coalesce(F.col("size_bytes") / 1024.0, F.lit(0.0)).alias("size_kb"),
        F.col("size_bytes").isNotNull().alias("resolved"),
    )


def size_summary(sizes: DataFrame, total_rows: int, sampled: bool = False) -> DataFrame:
    """Sums, unresolved share, mean per resolved file, scaled to ``total_rows``."""
    sums = sizes.agg(
        F.count("*").alias("n_checked"),
        F.coalesce(F.sum("size_kb"), F.lit(0.0)).alias("total_kb"),
        F.count_if(~F.col("resolved")).alias("n_unresolved"),
    )
    checked, missing = F.col("n_checked"), F.col("n_unresolved")
    whole = checked if sampled else F.lit(total_rows).cast("long")
    scale = F.when(checked > 0, F.lit(total_rows) / checked) if sampled else F.lit(1.0)
    mb = F.col("total_kb") / 1024
    return sums.select(
        "n_checked",
        "n_unresolved",
        F.when(whole > 0, missing * 100.0 / whole).otherwise(0.0).alias("unresolved_percent"),
        "total_kb",
        mb.alias("total_mb"),
        (mb / 1024).alias("total_gb"),
        (F.col("total_kb") / F.greatest(F.lit(1).cast("long"), whole - missing)).alias("avg_kb_per_file"),
        (mb * scale).alias("est_total_mb"),
        (mb / 1024 * scale).alias("est_total_gb"),
    )
