"""From manifest rows to fetch requests: names, paths and host slices."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from urlsheaf.functions.names import (
    IMAGEFOLDER,
    label_or_null,
    output_path,
    render_name,
    sanitize_label,
    sequential_name,
)
from urlsheaf.functions.text import strip, whole_quotient
from urlsheaf.functions.urls import extract_host
from urlsheaf.operators.joins import attach_by_key
from urlsheaf.session import materialise

ROWS_PER_SLICE = 100_000
# Beyond this the scheduler suffers; tasks then serve several slices in turn.
MAX_TASKS = 100_000


def plan_requests(
    df: DataFrame,
    url_col: str,
    key: str = "row_key",
    label: str | None = None,
    out: str = "",
    fmt: str = IMAGEFOLDER,
    naming: str = "sequential",
    pattern: str = "{segment[-2]}",
    default_ext: str = ".jpg",
) -> DataFrame:
    """Request table: ``row_key, url, host, class_name, file_path`` and ``group``.

    Sequential names count row keys, so a row keeps its name over retries and
    reruns.
    """
    url = F.col(url_col)
    text = label_or_null(F.col(label)) if label else F.lit(None).cast("string")
    if naming == "sequential":
        name = sequential_name(F.col(key), url, default_ext)
    else:
        name = render_name(pattern, url, F.col(key).cast("string"))
    folder = sanitize_label(text)
    kept = [c for c in ("group",) if c in df.columns]
    return df.select(
        F.col(key).cast("string").alias("row_key"),
        strip(url).alias("url"),
        extract_host(url).alias("host"),
        folder.alias("class_name"),
        output_path(out, fmt, folder, name).alias("file_path"),
        *kept,
    )


def slice_by_host(
    requests: DataFrame,
    rows_per_slice: int = ROWS_PER_SLICE,
    key: str = "row_key",
    cap: int = 1 << 30,
    max_tasks: int = MAX_TASKS,
    by: str | None = None,
) -> DataFrame:
    """Lay requests out by host, at most about ``rows_per_slice`` to a slice.

    A host is served by at most as many slices as it may have requests at a
    time (``cap``, or the ``host_cap`` of its requests), so that each can have
    one.  Adds ``host_slices`` and ``slice_cap``, a slice's share of the cap;
    the shares of a host's slices sum to its cap.  The
    number of tasks is stated, as adaptive coalescing goes by bytes and would
    put a whole small manifest in one; ``max_tasks`` bounds it.

    With ``by`` the slices of one value of that column are brought together,
    again at most about ``rows_per_slice`` rows to a task, unless one host's
    cap asks for more.
    """
    own = F.coalesce(F.min("host_cap"), F.lit(cap)) if "host_cap" in requests.columns else F.lit(cap)
    counted = requests.groupBy("host").agg(F.count("*").alias("_rows"), F.greatest(own, F.lit(1)).alias("_cap"))
    counts = materialise(counted, "hosts")
    wanted = F.ceil(F.col("_rows") / rows_per_slice)
    sized = counts.withColumn("host_slices", F.least(wanted, F.col("_cap")).cast("int"))
    rows = counts.agg(F.coalesce(F.sum("_rows"), F.lit(0))).first()[0]
    parallelism = requests.sparkSession.sparkContext.defaultParallelism
    tasks = min(max(parallelism, -(-rows // rows_per_slice)), max_tasks)
    looked = attach_by_key(requests, sized, "host", "_rows")
    part = F.pmod(F.xxhash64(key), F.col("host_slices")).cast("int")
    share = whole_quotient(F.col("_cap"), F.col("host_slices")) + (F.col("_slice") < F.col("_cap") % F.col("host_slices")).cast("int")
    laid = looked.withColumn("_slice", part).withColumn("slice_cap", share.cast("int"))
    if by is None:
        return laid.repartition(tasks, "host", "_slice").drop("_slice", "_cap")
    values = materialise(requests.groupBy(by).agg(F.count("*").alias("_of")), "values")
    parts = values.withColumn("_parts", F.ceil(F.col("_of") / rows_per_slice).cast("int"))
    tasks = min(max(parallelism, parts.agg(F.coalesce(F.sum("_parts"), F.lit(0))).first()[0]), max_tasks)
    unit = F.pmod(F.xxhash64("host", "_slice"), F.col("_parts")).cast("int")
    placed = attach_by_key(laid, parts, by, "_of").withColumn("_unit", unit)
    return placed.repartition(tasks, by, "_unit").drop("_slice", "_cap", "_unit", "_parts")
