"""Writing samples: class folders, flat samples with JSON, tar shards.

The layouts are plain tables of *members* (path and content), which ``store``
turns into files or into tar archives, on any file system that the output URI
names.
"""

from __future__ import annotations

import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from urlsheaf.functions.names import IMAGEFOLDER, WEBDATASET, sample_metadata
from urlsheaf.operators.joins import attach_by_key
from urlsheaf.session import materialise
from urlsheaf.sinks.filesystems import open_target
from urlsheaf.sinks.store import Store, store

ROWS_PER_SHARD = 100_000
_DONE = "_SUCCESS"
#: Folder of the table that tells what a sink has written.
MANIFEST = "_manifest"


def prepare_target(out: str, mode: str) -> None:
    """``errorifexists`` refuses an existing output, ``overwrite`` removes it."""
    fs, root = open_target(out)
    if fs.get_file_info(root).type == pafs.FileType.NotFound:
        return
    if mode == "overwrite":
        fs.delete_dir(root)
    elif mode != "append":
        raise FileExistsError(f"output exists: {out}")


def finish(out: str, manifest: DataFrame) -> None:
    """Commit what was written below ``out``: the manifest, which Spark commits as a table, then the marker."""
    manifest.write.mode("append").parquet(f"{out}/{MANIFEST}")
    fs, root = open_target(out)
    fs.create_dir(root, recursive=True)
    with fs.open_output_stream(f"{root}/{_DONE}"):
        pass


def save_files(members: DataFrame, target: Store, mode: str) -> None:
    """Write ``members (path, content)``, and ``side`` and ``shard`` if there are any."""
    prepare_target(target.root, mode)
    for name, kind in (("side", "binary"), ("shard", "string")):
        if name not in members.columns:
            members = members.withColumn(name, F.lit(None).cast(kind))
    finish(target.root, store(members, target).select("stored_in", "member", "crc32"))


def _relative(path: Column, out: str) -> Column:
    root = out.rstrip("/") + "/"
    inside = F.substring(path, F.lit(len(root) + 1), F.length(path))
    plain = F.regexp_replace(path, "^/+", "")
    return F.when(path.startswith(root), inside).otherwise(plain)


def with_members(outcomes: DataFrame, out: str, fmt: str = IMAGEFOLDER) -> DataFrame:
    """Adds ``path`` (null where nothing is stored) and ``side``, the side file's bytes, of every sample."""
    stored = F.col("success") & F.col("file_path").isNotNull()
    side = F.lit(None).cast("binary")
    if fmt == WEBDATASET:
        side = F.when(stored, sample_metadata(F.col("row_key"), F.col("url"), F.col("class_name")).cast("binary"))
    return outcomes.withColumn("path", F.when(stored, _relative(F.col("file_path"), out))).withColumn("side", side)


def write_imagefolder(
    outcomes: DataFrame, out: str, mode: str = "errorifexists", layout_root: str | None = None
) -> None:
    """``<out>/<label>/<file>``; no shuffle.  ``layout_root`` is cut from file paths."""
    members = with_members(outcomes, layout_root or out, IMAGEFOLDER).filter(F.col("path").isNotNull())
    save_files(members.select("path", "content", "side"), Store(out), mode)


def write_webdataset(
    outcomes: DataFrame, out: str, mode: str = "errorifexists", layout_root: str | None = None
) -> None:
    """``<out>/<file>`` and ``<out>/<stem>.json``; no shuffle."""
    members = with_members(outcomes, layout_root or out, WEBDATASET).filter(F.col("path").isNotNull())
    save_files(members.select("path", "content", "side"), Store(out), mode)


def shard_names(outcomes: DataFrame, rows_per_shard: int = ROWS_PER_SHARD) -> DataFrame:
    """Adds ``shard``: a numbered slice of its group of about ``rows_per_shard`` rows."""
    counts = materialise(outcomes.groupBy("group").agg(F.count("*").alias("_rows")), "shards")
    sized = counts.withColumn("_shards", F.ceil(F.col("_rows") / rows_per_shard).cast("int"))
    looked = attach_by_key(outcomes, sized, "group", "_rows")
    part = F.pmod(F.xxhash64("row_key"), F.col("_shards")).cast("int")
    return looked.withColumn("shard", F.format_string("output_partition_%03d_%04d", F.col("group"), part + 1)).drop("_shards")


def write_tar_shards(
    outcomes: DataFrame,
    out: str,
    fmt: str = IMAGEFOLDER,
    compress: bool = True,
    layout_root: str = "",
    mode: str = "errorifexists",
    inputs: dict | None = None,
) -> None:
    """Stored outcomes into archives ``<shard>_<part>``; an archive's name is its root folder.

    Rows are brought together by ``shard`` and go in by path.  A job that fetches writes its archives without that, see
    ``plans.collect``.  ``inputs``: every archive ends with an ``overview.json``.
    """
    members = with_members(outcomes, layout_root, fmt)
    laid = members.repartition("shard").sortWithinPartitions("shard", "path")
    save_files(laid, Store(out, tar=True, compress=compress, inputs=inputs), mode)
